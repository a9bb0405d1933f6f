"""Readers and writers: CSV tables, media listings, tar archives, subtitle files."""
