"""Reusable relational building blocks."""
