"""Readers and writers. Nothing else in the package touches paths."""
