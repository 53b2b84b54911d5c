"""Readers of registries, transcripts, taxonomies and files."""
