"""Readers, writers and the publication store."""
