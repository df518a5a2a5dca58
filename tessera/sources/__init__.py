"""Readers and writers: declared CSV, Parquet tables, catalogs."""
