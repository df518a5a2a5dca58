"""Dataset operators: format, clean, merge, classify, rank, summary,
cluster, geocode and ingest decisions. Each is DataFrame -> DataFrame."""
