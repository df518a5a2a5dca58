"""Clean: null tokens, duplicates, empty and constant columns, imputation,
list columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, IntegralType, StringType

from tessera.functions.sizing import per_column, qcol
from tessera.functions.text import null_tokens_to_null, split_trim
from tessera.operators.summary import MEAN_SCALE, exact_mean


def clean_null_tokens(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Trim string columns; blank and NA-like tokens become null."""
    cols = cols if cols is not None else [f.name for f in df.schema.fields
                                          if isinstance(f.dataType, StringType)]
    return df.select(*[null_tokens_to_null(qcol(c)).alias(c) if c in cols else qcol(c)
                       for c in df.columns])


def dedupe(df: DataFrame) -> DataFrame:
    """Drop exact duplicate rows (an aggregate, so duplicates combine map-side)."""
    return df.dropDuplicates()


def column_flags(df: DataFrame) -> DataFrame:
    """Per column: non-null count, empty (no value) and constant (one value,
    no nulls) flags, and whether the column is kept. One pass, whatever the
    width; values are compared by two 64-bit hashes of their text."""
    text = lambda c: c.cast("string")
    values = {"a": lambda _, c: F.when(c.isNotNull(), F.xxhash64(text(c))),
              "b": lambda _, c: F.when(c.isNotNull(), F.xxhash64(text(c), F.lit(7)))}
    aggs = [F.count(F.lit(1)).alias("n"), F.count("a").alias("nn"),
            *[f(x).alias(f"{n}_{x}") for x in ("a", "b") for n, f in (("lo", F.min), ("hi", F.max))]]
    got = per_column(df, df.columns, values, aggs)
    nn = F.coalesce("nn", F.lit(0).cast("bigint"))
    same = (F.col("lo_a") == F.col("hi_a")) & (F.col("lo_b") == F.col("hi_b"))
    out = got.select("col", nn.alias("n_non_null"), (nn == 0).alias("is_empty"),
                     F.coalesce((F.col("nn") == F.col("n")) & same, F.lit(False)).alias("is_constant"))
    return out.withColumn("kept", ~(F.col("is_empty") | F.col("is_constant")))


def drop_empty_constant(df: DataFrame) -> DataFrame:
    """Drop empty and constant columns (the decision is one row per column)."""
    keep = {r["col"] for r in column_flags(df).where("kept").select("col").collect()}
    return df.select(*[qcol(c) for c in df.columns if c in keep])


def _mean(c: Column, kind: DataType, digits: int) -> Column:
    """The rounded mean: exact for whole numbers and decimals, whatever the
    order of rows; for fractions too if they have at most MEAN_SCALE places."""
    n = F.count(c)
    if isinstance(kind, IntegralType):
        d = "decimal(38,0)"
        total, n = F.sum(c.cast(d)), n.cast(d)
        twice = (F.abs(total) * 2 + n).cast(d)
        return (F.signum(total).cast(d) * ((twice - twice % (n * 2)) / F.nullif(n * 2, F.lit(0).cast(d))).cast(d)).cast(d)
    if isinstance(kind, DecimalType):
        return F.round(F.avg(c), digits)
    v, e = c.cast("double"), c.cast("double").try_cast(f"decimal(38,{MEAN_SCALE})")
    total = F.try_sum(F.when(~F.isnan(v), e))
    kept = F.coalesce(F.bool_and(c.isNull() | F.coalesce(e.cast("double") == v, F.lit(False))), F.lit(False))
    return F.when(kept & (n > 0) & total.isNotNull(), exact_mean(total, n, digits)).otherwise(F.round(F.avg(v), digits))


def impute(df: DataFrame, numeric: list[str], categorical: list[str], digits: int = 2) -> DataFrame:
    """Fill nulls: numeric columns with the mean rounded half-up to
    ``digits`` (to a whole number in a column of whole numbers), categorical
    columns with the most frequent value (ties to the smallest).

    Means come from one aggregate and modes from one unpivoted count; both
    reach the rows as a single scalar subquery, not a join.
    """
    fills = {}
    if numeric:
        means = df.agg(F.struct(*[_mean(qcol(c), df.schema[c].dataType, digits).alias(f"m{i}") for i, c in enumerate(numeric)]).alias("m")).scalar()
        fills |= {c: means[f"m{i}"] for i, c in enumerate(numeric)}
    if categorical:
        long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("col"), qcol(c).cast("string").alias("v"))
                                           for c in categorical]))).where(F.col("v").isNotNull())
        counts = long.groupBy("col", "v").agg(F.count(F.lit(1)).alias("cnt"))
        best = counts.groupBy("col").agg(F.min(F.struct((-F.col("cnt")).alias("k"), F.col("v").alias("v"))).alias("b"))
        modes = best.agg(F.map_from_entries(F.collect_list(F.struct("col", F.col("b.v")))).alias("m")).scalar()
        fills |= {c: modes[F.lit(c)] for c in categorical}
    return df.select(*[F.coalesce(qcol(c), fills[c].cast(df.schema[c].dataType)).alias(c) if c in fills
                       else qcol(c) for c in df.columns])


def split_trim_column(df: DataFrame, col: str, out: str = "parts", explode: bool = False,
                      sep: str = ",") -> DataFrame:
    """Split a list-valued string column and trim each part.

    With ``explode`` one row per part (``pos``, ``part``); an empty list
    yields no row.
    """
    with_list = df.withColumn(out, split_trim(qcol(col), sep))
    if not explode:
        return with_list.withColumn(f"n_{out}", F.size(F.col(out)))
    return with_list.select(*[qcol(c) for c in df.columns], F.posexplode(F.col(out)).alias("pos", "part"))
