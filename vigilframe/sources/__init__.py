"""Readers, writers, table contracts."""
