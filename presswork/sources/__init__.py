"""Readers and writers: feed files, layer tables, shared work folder."""
