"""Structured Streaming form of the typed ingest (S1 -> T3 -> T2 -> S7).

CSV files arriving in a folder are read against the declared schema,
cleaned, cast with guarded casts and appended to a Parquet table. Progress
lives in a checkpoint under the shared checkpoint root, so a restarted or
retried run picks up exactly the files not yet ingested (file sink commits
are exactly-once).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from tessera.operators.clean import clean_null_tokens
from tessera.operators.format import cast_declared
from tessera.session import scratch_path
from tessera.sources.files import _CSV_READ, CORRUPT_COL


def typed_stream(spark: SparkSession, source_dir: str, raw_schema: StructType, declared: dict[str, str],
                 header: bool = True, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming frame of cleaned, typed rows plus a ``malformed`` flag."""
    full = StructType(list(raw_schema.fields) + [StructField(CORRUPT_COL, StringType(), True)])
    r = spark.readStream.schema(full).options(**_CSV_READ, lineSep="\n").option("header", str(header).lower())
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    raw = r.csv(source_dir)
    flagged = raw.withColumn("malformed", F.col(CORRUPT_COL).isNotNull()).drop(CORRUPT_COL)
    return cast_declared(clean_null_tokens(flagged), declared)


def start_ingest(spark: SparkSession, source_dir: str, raw_schema: StructType, declared: dict[str, str],
                 out_path: str, checkpoint: str | None = None, header: bool = True,
                 available_now: bool = True) -> StreamingQuery:
    """Start the ingest; with ``available_now`` it processes every file
    present now (in as many micro-batches as needed) and stops."""
    ckpt = checkpoint or scratch_path(spark, "stream-ckpt")
    w = (typed_stream(spark, source_dir, raw_schema, declared, header).writeStream
         .format("parquet").option("path", out_path).option("checkpointLocation", ckpt).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
