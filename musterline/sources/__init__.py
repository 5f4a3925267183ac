"""Readers and writers of landed files and published tables."""
