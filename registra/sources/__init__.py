"""Readers, writers, catalog helpers and the shared work folder."""
