"""Schemas, readers, writers and the test-data adapter."""
