"""Readers: the record stream and the metadata catalog."""
