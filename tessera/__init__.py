"""tessera: dataset preparation and ingest as Spark jobs.

Every public operator takes DataFrames (plus small parameters) and returns a
lazy DataFrame. Nothing row-sized is collected to the driver; only
per-column, per-partition or per-cluster results (bounded by the schema or
by a parameter) may be.
"""

__version__ = "0.1.0"
