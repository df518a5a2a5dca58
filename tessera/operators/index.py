"""Dense 0..n-1 row index in a total order, without a single-partition step.

Rows are range-partitioned on the order columns and sorted within each
partition; the result, with each row's partition and place in it, is then
stored once, so every later read sees the same numbers. Per-partition counts (one row per
partition) give each partition's offset, which is broadcast back. No window
ever spans all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.sizing import free_name, qcol, stage

_LOCAL_BITS = 33  # monotonically_increasing_id keeps the row-in-partition here


def row_index(df: DataFrame, order: list, name: str = "row_index",
              num_partitions: int | None = None) -> DataFrame:
    """Append ``name`` = position of the row in ``order`` (ascending, 0-based).

    ``order`` should be a total order for the index to be reproducible;
    ties still get distinct positions. A row id taken before the shuffle is
    the last sort key, so a key value held by a third of the rows is split
    over several range partitions instead of landing in one.
    """
    tie, tid, part, off = (free_name([*df.columns, name], n, "_") for n in ("_tie", "_tid", "_pid", "_off"))
    cols = [qcol(c) if isinstance(c, str) else c for c in order] + [F.col(tie)]
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = stage(df.withColumn(tie, F.monotonically_increasing_id())
                   .repartitionByRange(n, *cols)
                   .sortWithinPartitions(*cols)
                   .withColumn(tid, F.monotonically_increasing_id())
                   .drop(tie), "row-index")
    pid = F.shiftright(F.col(tid), _LOCAL_BITS)
    local = F.col(tid).bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    # One row per partition: bounded by n, so a global window is harmless.
    counts = ranged.groupBy(pid.alias(part)).agg(F.count(F.lit(1)).alias("_cnt"))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(part, F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias(off))
    return (ranged.join(F.broadcast(offsets), pid == F.col(part))
            .withColumn(name, (F.col(off) + local).cast("bigint"))
            .drop(tid, part, off))
