"""Whole plans: workload view, cycles, registered queries."""
