"""File sources and sinks: declared CSV, CSV pairs, schema documents,
typed and raw copies, media paths."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tessera.functions.sizing import qcol, stage
from tessera.sources import csv_ranges

CORRUPT_COL = "_bad"

# CSV as RFC 4180 has it. Fields that need quotes have them, a
# quote in a field is doubled, line breaks in quotes belong to the field, and
# white space is kept. A null is a field with nothing in it, an empty string
# one with two quotes. The reader needs a text that stands for null: two
# characters that Unicode rules out of interchange, so no field collides.
NULL_MARKER = "\uffff\uffffnull"
_CSV = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
_CSV_WRITE = _CSV | {"nullValue": "", "emptyValue": '""', "lineSep": "\n"}
_CSV_READ = _CSV | {"multiLine": "true", "nullValue": NULL_MARKER, "emptyValue": "",
                    "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COL}


def read_declared(spark: SparkSession, path: str, schema: StructType, header: bool = True, line_sep: str | None = "\n") -> DataFrame:
    """Read CSV against a declared schema. Malformed rows are kept (their
    bad fields null) and flagged in ``_bad``; they never fail the job.

    Rows end with a line feed, and a file is read by as many tasks as it has
    byte ranges (``csv_ranges``). Another ``line_sep``, or None, which has
    the reader find out per file (a field with another kind of line break near its
    start can mislead it), reads each file whole in one task.
    """
    full = StructType(list(schema.fields) + [StructField(CORRUPT_COL, StringType(), True)])
    if line_sep == "\n":
        return csv_ranges.read(spark, path, full, CORRUPT_COL, _CSV_READ | {"lineSep": line_sep}, header)
    more = {"lineSep": line_sep} if line_sep else {}
    return spark.read.schema(full).options(**_CSV_READ, **more).option("header", str(header).lower()).csv(path)


def malformed_count(df: DataFrame) -> DataFrame:
    """One row: rows read, rows flagged malformed, rows with a null field.

    Every declared column is referenced, so the CSV parser (which prunes
    unread columns) checks all of them; Spark also refuses a scan of the
    corrupt-record column alone.
    """
    cols = [c for c in df.columns if c != CORRUPT_COL]
    any_null = F.exists(F.array(*[qcol(c).isNull() for c in cols]), lambda x: x)
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count(CORRUPT_COL).alias("n_malformed"),
                  F.count_if(any_null).alias("n_with_null"))


def write_csv(df: DataFrame, path: str, header: bool, mode: str = "overwrite") -> None:
    """A lone column writes nulls as NULL_MARKER: its null rows would be
    empty lines, which are no rows."""
    more = {"nullValue": NULL_MARKER} if len(df.columns) == 1 else {}
    df.write.mode(mode).options(**(_CSV_WRITE | more)).option("header", str(header).lower()).csv(path)


def write_csv_pair(df: DataFrame, plain_path: str, header_path: str) -> None:
    """The merged file twice: without header and with header. The rows are
    made once, for a stored table that both are written from."""
    rows = stage(df, "csv-pair")
    write_csv(rows, plain_path, header=False)
    write_csv(rows, header_path, header=True)


def schema_document(df: DataFrame, dataset_id: str, resource: str = "learningData") -> str:
    """The stage's output schema document (JSON): dataset id, resource and
    the Spark schema of its columns."""
    return json.dumps({"dataset_id": dataset_id, "resource": resource,
                       "schema": json.loads(df.schema.json())}, sort_keys=True)


def write_schema_document(spark: SparkSession, doc: str, path: str) -> None:
    """Write a schema document as a one-line text file (any filesystem)."""
    spark.createDataFrame([(doc,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_schema_document(spark: SparkSession, path: str) -> tuple[str, StructType]:
    row = spark.read.text(path).first()
    d = json.loads(row["value"])
    return d["dataset_id"], StructType.fromJson(d["schema"])


def as_strings(df: DataFrame) -> DataFrame:
    """All columns as strings (the raw copy kept beside a typed table)."""
    return df.select(*[qcol(c).cast("string").alias(c) for c in df.columns])


def write_typed_and_raw(typed: DataFrame, raw: DataFrame, path: str) -> tuple[str, str]:
    """Clear existing output, write the typed table and the raw all-string
    copy beside it. Overwrite makes a re-run idempotent."""
    tp, rp = f"{path}/typed", f"{path}/raw"
    typed.write.mode("overwrite").parquet(tp)
    as_strings(raw).write.mode("overwrite").parquet(rp)
    return tp, rp


def media_paths(df: DataFrame, col: str, server: str, dataset: str, out: str | None = None) -> DataFrame:
    """Media references become ``server/dataset/<file>`` URLs."""
    return df.withColumn(out or col, F.concat_ws("/", F.lit(server.rstrip("/")), F.lit(dataset), qcol(col)))
