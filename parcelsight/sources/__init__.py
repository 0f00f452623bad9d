"""Readers, writers, table schemas and the shared scratch folder."""
