"""DataFrame operators of entity resolution."""
