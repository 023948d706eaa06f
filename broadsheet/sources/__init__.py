"""Readers, schema guards and writers."""
