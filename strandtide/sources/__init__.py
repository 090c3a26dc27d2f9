"""Readers and writers for sequence, feature and metadata files."""
