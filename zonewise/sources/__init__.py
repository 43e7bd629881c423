"""Readers, writers and fixed tables."""
