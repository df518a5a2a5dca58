"""Plans: the derived test inputs, the registered queries with their SQL
oracles, the batch runner and the end-to-end ingest workflow."""
