"""Readers, writers and the schema contract."""
