"""Readers, writers and append-only run tables."""
