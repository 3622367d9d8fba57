"""Training-data operators: ten independent components and their queries.

Nothing else in ``weftlink`` imports this subpackage; it can be removed as a whole.
"""
