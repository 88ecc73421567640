"""Readers and writers: CSV folders, catalog tables, versioned feature tables."""
