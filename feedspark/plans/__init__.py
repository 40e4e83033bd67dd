"""Queries: the operators bound to tables."""
