"""Readers with explicit schemas, writers, and views of the supplied tables."""
