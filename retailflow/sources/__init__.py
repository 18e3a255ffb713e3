"""Readers and writers for delimited exports and snapshot tables."""
