"""Readers, writers and layer registration."""
