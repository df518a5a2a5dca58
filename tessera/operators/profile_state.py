"""Column profiles that grow with their table.

A *state* is one row per column: counts, the exact decimal sum, the moments,
the ends, and two sketches of bounded size (distinct values, quantiles).
States of disjoint batches of rows merge to the state of all the rows, in any
order, so the profile of a grown table reads only its new rows. Counts,
sums, means and ends are exact; the number of distinct values and the
quartiles are estimates (some 2 per cent of the count, and of the rank).

Numbers have all of these; dates, times and text have counts, distinct
values and ends as text. NaN and infinities are counted as values only.
Stored states are published by ``sources.snapshot``: of two runs that add
to one dataset at a time, one fails instead of losing rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.sizing import qcol, small_frame
from tessera.operators import summary as Y
from tessera.sources import snapshot

#: Sizes of the sketches (2**HLL_LG registers; KLL's k).
HLL_LG, KLL_K = 14, 400
TABLE = "profile_state"
SCHEMA = ("col string, ord int, n bigint, n_null bigint, n_finite bigint, total decimal(38,10), n_odd bigint, mean double, m2 double, "
          "lo double, hi double, min_text string, max_text string, distinct_sketch binary, quantile_sketch binary")


def state(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """The state of ``df`` (see SCHEMA), from one pass. Text is ordered as text, so
    dates and times, written most significant part first, by value."""
    cols = cols or df.columns
    types = {c: df.schema[c].dataType for c in cols}
    nothing = {"v": F.lit(None).cast("double"), "e": F.lit(None).cast(f"decimal(38,{Y.MEAN_SCALE})"), "k": F.lit(None).cast("bigint")}

    def cell(i, c):
        ord_ = F.lit(i).alias("ord")
        if Y.family(types[c]) == "number":
            x = Y._number_cell(c, qcol(c), types[c])
            return F.struct(ord_, x["v"].alias("v"), x["e"].alias("e"), x["k"].alias("k"), F.lit(None).cast("string").alias("s"))
        return F.struct(ord_, *[x.alias(n) for n, x in nothing.items()], Y._as_text(qcol(c), types[c]).alias("s"))
    long = df.select(F.inline(F.array(*[cell(i, c) for i, c in enumerate(cols)])))
    f = Y._finite(F.col("v"))
    dec = F.coalesce("e", f.try_cast(f"decimal(38,{Y.MEAN_SCALE})"))
    some = F.col("v").isNotNull() | F.col("s").isNotNull()
    key = F.when(F.col("s").isNotNull(), F.xxhash64("s")).when(F.col("v").isNotNull(), F.xxhash64("v", "k"))
    got = long.groupBy("ord").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~some).alias("n_null"), F.count(f).alias("n_finite"), F.sum(dec).alias("total"),
        F.count_if(F.col("e").isNull() & f.isNotNull() & ~F.coalesce(dec.cast("double") == f, F.lit(False))).alias("n_odd"),
        F.avg(f).alias("mean"), F.var_pop(f).alias("_var"), F.min(f).alias("lo"), F.max(f).alias("hi"),
        F.min("s").alias("min_text"), F.max("s").alias("max_text"), F.hll_sketch_agg(key, HLL_LG).alias("distinct_sketch"),
        F.kll_sketch_agg_double(f, KLL_K).alias("quantile_sketch"))
    names = small_frame(df.sparkSession, [("ord", "int"), ("col", "string")], list(enumerate(cols)))
    got = names.join(got, "ord").withColumn("m2", F.col("_var") * F.col("n_finite"))
    return got.select(*[c.split()[0] for c in SCHEMA.replace("decimal(38,10)", "d").split(", ")])


def merge(states: DataFrame) -> DataFrame:
    """One state per column of the rows of any number of states. The moments
    are joined about the common mean, so nothing cancels."""
    mean = F.try_divide(F.sum(F.col("mean") * F.col("n_finite")), F.sum("n_finite"))
    about = states.groupBy("col").agg(mean.alias("_mean"))  # a row per column
    off = F.col("mean") - F.col("_mean")
    return states.join(F.broadcast(about), "col").groupBy("col").agg(
        F.min("ord").alias("ord"), F.sum("n").alias("n"), F.sum("n_null").alias("n_null"), F.sum("n_finite").alias("n_finite"),
        F.sum("total").alias("total"), F.sum("n_odd").alias("n_odd"), F.max("_mean").alias("mean"),
        F.sum(F.col("m2") + F.col("n_finite") * off * off).alias("m2"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        F.min("min_text").alias("min_text"), F.max("max_text").alias("max_text"),
        F.hll_union_agg("distinct_sketch", True).alias("distinct_sketch"), F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch"))


def finish(states: DataFrame, digits: int = 6) -> DataFrame:
    """The profile (col, *PROFILE_COLS) that a state holds."""
    n, r = F.col("n_finite"), lambda c: F.round(c, digits)
    mean = F.when((F.col("n_odd") == 0) & F.col("total").isNotNull(), Y.exact_mean(F.col("total"), n, digits)).otherwise(r(F.col("mean")))
    sd = F.when(n > 1, F.sqrt(F.col("m2") / (n - 1)))
    quartiles = [F.when(n > 0, F.kll_sketch_get_quantile_double("quantile_sketch", F.lit(p))).alias(f"p{int(p * 100)}") for p in Y.QUARTILES]
    return states.orderBy("ord").select(
        "col", "n", "n_null", F.hll_sketch_estimate("distinct_sketch").alias("n_distinct"), F.when(n > 0, mean).alias("mean"), r(sd).alias("stddev"),
        *quartiles, r(F.col("lo")).alias("min"), r(F.col("hi")).alias("max"), "min_text", "max_text")


def stored(spark: SparkSession, root: str, dataset_id: str) -> DataFrame:
    """The published state of a dataset (no rows before the first)."""
    if not snapshot.commits(spark, root).where((F.col("table") == TABLE) & (F.col("dataset_id") == dataset_id)).first():
        return spark.createDataFrame([], SCHEMA)
    return snapshot.read(spark, root, TABLE, SCHEMA).where(F.col("dataset_id") == dataset_id).drop("dataset_id")


def grow(spark: SparkSession, root: str, dataset_id: str, new_rows: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Add rows to a dataset's stored state, reading those rows alone;
    returns the profile of all rows so far."""
    run = snapshot.Run(spark, root)
    run.put(merge(stored(spark, root, dataset_id).unionByName(state(new_rows, cols))), TABLE, dataset_id)
    run.commit()
    return finish(stored(spark, root, dataset_id))
