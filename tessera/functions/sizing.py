"""Column references, small literal frames, staged tables and broadcasts of
a checked size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is hinted for broadcast only if it has at most so many bytes.
BROADCAST_BYTES = 8 << 20


def qcol(name: str) -> Column:
    """A column by its literal name (names may hold dots and backticks)."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_name(taken, name: str, prefix: str) -> str:
    """``name`` with as many prefixes as make it clash with no column of
    ``taken`` (Spark tells names apart without regard to case)."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name = f"{prefix}_{name}"
    return name


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and
    read it back. Later stages prune its columns, Spark knows its size, and
    no lineage has to be run again when an executor is lost."""
    from tessera.session import scratch_path
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_frame(spark: SparkSession, fields: list[tuple[str, str]], rows: list[tuple]) -> DataFrame:
    """A frame of a handful of driver-side rows (schema-sized results that
    were already collected), built as literals: no Python serialisation
    and no extra job. ``fields`` are (name, Spark SQL type) pairs."""
    if not rows:
        return spark.createDataFrame([], ", ".join(f"`{n}` {t}" for n, t in fields))
    return spark.range(1).select(F.inline(F.array(*[
        F.struct(*[F.lit(v).cast(t).alias(n) for (n, t), v in zip(fields, r)]) for r in rows])))


def per_column(df: DataFrame, cols: list[str], values: dict, aggs: list[Column],
               broadcast_names: bool = True) -> DataFrame:
    """(ord, col, *aggs): one row for each of ``cols``, from one pass.

    ``values`` maps a value name to a function of (column name, Column) that
    gives the value of a cell. All cells are unpivoted to rows (ord,
    *values) and aggregated by ``ord`` with ``aggs``, so the number of
    expressions does not grow with the width of the table, each task sends
    one row per column, and the input is read once however wide it is.
    Columns of an empty table get a row too (of nulls).
    """
    spark = df.sparkSession
    names = small_frame(spark, [("ord", "int"), ("col", "string")], list(enumerate(cols)))
    if not cols:
        return names
    cells = df.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("ord"), *[fn(c, qcol(c)).alias(n) for n, fn in values.items()])
        for i, c in enumerate(cols)])))
    return names.join(cells.groupBy("ord").agg(*aggs), "ord", "left")


def union_all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
