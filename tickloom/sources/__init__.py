"""Readers, writers and fixed table schemas."""
