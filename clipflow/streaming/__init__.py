"""Operators with streaming semantics."""
