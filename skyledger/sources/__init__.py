"""Readers, writers and RAW contracts."""
