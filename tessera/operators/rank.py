"""Rank: numeric projection, row limit, PCA and correlation importance."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.sizing import BROADCAST_BYTES, free_name, per_column, qcol, small_frame, stage
from tessera.operators.index import row_index


def numeric_projection(df: DataFrame, numeric: list[str], categorical: list[str],
                       keep: list[str] | None = None) -> DataFrame:
    """Numeric columns as double; categorical columns replaced by codes
    0..k-1 in sorted value order; other columns dropped.

    All categorical columns share one distributed index over their distinct
    (col, value) pairs, written once; one query then tells the size of each
    column's code table. Those of at most BROADCAST_BYTES are broadcast; all
    others share one join: the rows, stored once under a row key, are
    unpivoted to (row, col, value), joined with the codes, and brought back to
    a row each. So whole rows cross one shuffle however many such columns
    there are, a cell two, and both sides of the join are stored tables, whose
    hot values Spark splits. Missing values and rows keep null codes.
    """
    keep = keep or []
    out, rid = df, free_name(df.columns, "_rid", "_")
    code = [free_name(df.columns, f"__code{i}", "_") for i in range(len(categorical))]
    val = [free_name(df.columns, f"__v{i}", "_") for i in range(len(categorical))]
    if categorical:
        long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("col"), qcol(c).cast("string").alias("value"))
                                           for c in categorical]))).where(F.col("value").isNotNull()).distinct()
        idx = row_index(long, ["col", "value"], "_i")
        start = idx.groupBy("col").agg(F.min("_i").alias("_s"))  # one row per column
        codes = stage(idx.join(F.broadcast(start), "col").select("col", "value", (F.col("_i") - F.col("_s")).alias("code")), "codes")
        sizes = {r["col"]: r["b"] for r in codes.groupBy("col").agg(F.sum(F.octet_length("value") + 16).alias("b")).collect()}
        large = [i for i, c in enumerate(categorical) if sizes.get(c, 0) > BROADCAST_BYTES]
        if large:
            used = dict.fromkeys([*keep, *numeric, *categorical])
            out = stage(df.select(*[qcol(c) for c in used], F.monotonically_increasing_id().alias(rid)), "projection")
            cells = out.select(F.col(rid).alias("_r"), F.inline(F.array(*[
                F.struct(F.lit(categorical[i]).alias("col"), qcol(categorical[i]).cast("string").alias("value")) for i in large])))
            coded = cells.where(F.col("value").isNotNull()).join(codes.where(F.col("col").isin([categorical[i] for i in large])), ["col", "value"])
            wide = coded.groupBy("_r").agg(*[F.max(F.when(F.col("col") == categorical[i], F.col("code"))).alias(code[i]) for i in large])
            out = out.join(wide.withColumnRenamed("_r", rid), rid, "left")
        for i, c in enumerate(categorical):
            if i not in large:
                side = codes.where(F.col("col") == c).select(F.col("value").alias(val[i]), F.col("code").alias(code[i]))
                out = out.join(F.broadcast(side), qcol(c).cast("string") == F.col(val[i]), "left")
    return out.select(*[qcol(c) for c in keep], *[qcol(c).cast("double").alias(c) for c in numeric],
                      *[F.col(code[i]).alias(c) for i, c in enumerate(categorical)])


def row_limit(df: DataFrame, order: list, n: int) -> DataFrame:
    """First ``n`` rows in a key order (a top-n sort, not a full sort)."""
    return df.orderBy(*order).limit(n)


def corr_importance(df: DataFrame, cols: list[str], target: str, digits: int = 6) -> DataFrame:
    """|Pearson correlation| of each column with the target, in one pass over
    the rows that have both."""
    y = qcol(target).cast("double")
    got = per_column(df, cols, {"x": lambda _, c: c.cast("double"), "y": lambda _, c: y},
                     [F.corr("x", "y").alias("r")])
    return got.select("col", F.round(F.abs("r"), digits).alias("importance"))


def pca_importance(df: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    """PCA importance of each column: sum over components k of
    |loading(j, k)| * explained_variance_ratio(k), on standardised data.
    Sign-invariant. Also ``n_used``, the values that a column had.

    PCA of standardised columns is the eigendecomposition of their Pearson
    correlation matrix, so after one pass for the means one distributed pass
    (MLlib ``Correlation``, a tree aggregate) is all the data work; only the
    d x d matrix reaches the driver, where it is decomposed. A missing value
    counts as the column's mean, so no row is dropped. A constant or empty
    column has no variance and gets zero weight.
    """
    import numpy as np
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import Correlation

    spark = df.sparkSession
    value = lambda c: F.when(~F.isnan(c.cast("double")), c.cast("double"))
    got = per_column(df, cols, {"x": lambda _, c: value(c)},
                     [F.avg("x").alias("m"), F.count("x").alias("n"), (F.min("x") < F.max("x")).alias("v")]).collect()  # one row per column
    mean, used = {r["col"]: r["m"] or 0.0 for r in got}, {r["col"]: r["n"] or 0 for r in got}
    data = df.select(*[F.coalesce(value(qcol(c)), F.lit(mean[c])).alias(f"x{i}") for i, c in enumerate(cols)])
    corr = np.zeros((len(cols), len(cols)))
    if any(r["v"] for r in got):
        vec = VectorAssembler(inputCols=data.columns, outputCol="_x").transform(data).select("_x")
        corr = np.nan_to_num(Correlation.corr(vec, "_x").head()[0].toArray(), nan=0.0)
    varies = {r["col"] for r in got if r["v"]}
    for i, c in enumerate(cols):
        if c not in varies:
            corr[i], corr[:, i] = 0.0, 0.0
    w, v = np.linalg.eigh(corr)
    ratio = w.clip(min=0.0) / max(w.clip(min=0.0).sum(), 1e-300)
    imp = np.abs(v) @ ratio
    return small_frame(spark, [("col", "string"), ("importance", "double"), ("n_used", "bigint")],
                       [(c, float(round(imp[j], digits)), int(used[c])) for j, c in enumerate(cols)])


def rank_importance(importance: DataFrame) -> DataFrame:
    """Ranked artefact: descending importance, ties by column name.

    The input has one row per column, so the global window is schema-sized.
    """
    w = Window.orderBy(F.desc_nulls_last("importance"), F.asc("col"))
    return importance.withColumn("rank", F.row_number().over(w).cast("bigint"))
