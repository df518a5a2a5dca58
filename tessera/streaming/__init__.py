"""Incremental ingest of files that keep landing in a dataset folder."""
