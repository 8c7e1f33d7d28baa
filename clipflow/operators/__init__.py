"""Operators: each takes relations and parameters and returns a relation."""
