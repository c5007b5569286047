"""Derived log tables, the end-to-end pipeline and the query catalog."""
