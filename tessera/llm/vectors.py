"""Vectors as tables: validity, Arrow access, blocks and best-k merging."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def usable(v: Column, limit: float | None = None) -> Column:
    """Neither null nor holding null or non-finite components (nor, with a
    limit, larger ones)."""
    bound = float("inf") if limit is None else limit
    return F.coalesce(v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(bound))), F.lit(False))


def common_size(df: DataFrame, col: str) -> int:
    """The most frequent length of a vector (the least of equally frequent);
    vectors of other lengths can't be compared with it."""
    r = df.groupBy(F.size(col).alias("d")).count().where("d > 0").orderBy(F.desc("count"), "d").limit(1).collect()
    return r[0]["d"] if r else 0


def matrix(column, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def grouped(batches, keys: list[str]):
    """Tables of whole key groups, one group each, from sorted batches."""
    held = []
    for b in batches:
        t = pa.Table.from_batches([b])
        while t.num_rows:
            if held and any(held[-1].column(k)[0] != t.column(k)[0] for k in keys):
                yield pa.concat_tables(held).combine_chunks()
                held = []
            same = np.ones(t.num_rows, bool)
            for k in keys:
                c = t.column(k).to_numpy()
                same &= c == c[0]
            n = int(np.argmin(same)) if not same.all() else t.num_rows
            held.append(t.slice(0, n))
            t = t.slice(n)
    if held:
        yield pa.concat_tables(held).combine_chunks()


def best(found: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best of its rows, ties
    to the lesser vec_id."""
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
