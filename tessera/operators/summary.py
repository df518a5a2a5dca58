"""Summaries: column profile, frequent values, histograms, text terms,
extrema. Each unpivots its columns and aggregates by column, so the input is
read a fixed number of times whatever its width."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DateType, DecimalType, IntegralType, NumericType, TimestampNTZType, TimestampType

from tessera.functions.sizing import qcol, small_frame, union_all

QUARTILES = (0.25, 0.5, 0.75)
BINS = 1024  # of a quantile pass
FEW = 1 << 16  # values that a step may have to be ranked one by one
MEAN_SCALE = 10  # decimal places that an exact mean keeps of each value


def unpivot_values(df: DataFrame, cols: list[str], value_type: str = "double",
                   keep: list[str] | None = None, keep_nulls: bool = False) -> DataFrame:
    """Long form (``*keep``, col, v) of the values of ``cols``."""
    keep = keep or []
    long = df.select(*keep, F.inline(F.array(*[
        F.struct(F.lit(c).alias("col"), qcol(c).cast(value_type).alias("v")) for c in cols])))
    return long if keep_nulls else long.where(F.col("v").isNotNull())


def family(t: DataType) -> str:
    """``number``, ``time`` or ``text``: how a column's values are ordered."""
    if isinstance(t, NumericType):
        return "number"
    return "time" if isinstance(t, (DateType, TimestampType, TimestampNTZType)) else "text"


def _finite(v: Column) -> Column:
    """Null for NaN and infinities, which have no place in sums and ranges."""
    return F.when(~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))), v)


# -- quantiles ---------------------------------------------------------------

def _bins(long: DataFrame, keys: list[str], ranges: DataFrame) -> DataFrame:
    """Counts, least and greatest value of BINS equal steps of each range
    (*keys, _r, _lo, _hi) that ``long`` (*keys, v) has values in. ``ranges``
    has a few rows per group: it is broadcast, and only counts are shuffled.
    A value in two ranges counts in both."""
    inside = long.join(F.broadcast(ranges), keys).where((F.col("v") >= F.col("_lo")) & (F.col("v") <= F.col("_hi")))
    step = F.when(F.col("_hi") > F.col("_lo"), F.least(F.floor((F.col("v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * BINS), F.lit(BINS - 1))
                  ).otherwise(0).cast("int")
    return inside.groupBy(*keys, "_r", step.alias("_bin")).agg(F.count(F.lit(1)).alias("_n"), F.min("v").alias("_lo"), F.max("v").alias("_hi"))


def _locate(bins: DataFrame, keys: list[str], targets: DataFrame) -> DataFrame:
    """(*keys, rank, skip, _lo, _hi, _n): for each target (*keys, _r, rank, skip)
    the bin of range ``_r`` that holds it; ``skip`` counts the values below."""
    before = Window.partitionBy(*keys, "_r").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    cum = bins.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    at = F.col("rank") - F.col("skip")
    return (targets.join(cum, [*keys, "_r"]).where((at >= F.col("_before")) & (at < F.col("_before") + F.col("_n")))
            .select(*keys, "rank", (F.col("skip") + F.col("_before")).alias("skip"), "_lo", "_hi", "_n"))


def _quantiles_exact(long: DataFrame, keys: list[str], stats: list, probs, passes: int = 2) -> DataFrame:
    """Exact interpolated quantiles (*keys, p, value) per key group (linear
    interpolation between the two nearest ranks).

    Each pass counts the values in equal steps of the ranges that still hold
    a wanted rank and keeps the step that has it, so a pass narrows a range
    by BINS and shuffles only counts; a few rows per group come back and
    enter the next pass as literals. A step of one value is settled; once
    all others have at most FEW values, or after ``passes``, their distinct values are counted and
    ranked. ``stats`` are rows with the keys and _n, _lo, _hi of the groups.
    """
    spark, text = long.sparkSession, [(k, "string") for k in keys]
    wanted, found = [], {}
    for r in stats:
        key = tuple(r[k] for k in keys)
        for p in probs if r["_n"] else ():
            pos = p * (r["_n"] - 1)
            lo, hi = math.floor(pos), math.ceil(pos)
            wanted.append((*key, float(p), lo, hi, pos - lo))
            for rank in (lo, hi):
                found[(*key, rank)] = (0, r["_lo"], r["_hi"], r["_n"])

    def narrowed(found):
        """Ranges and targets of what was found, as small frames."""
        number = {x: n for n, x in enumerate(sorted({(k[:-1], *v[:3]) for k, v in found.items()}))}
        ranges = small_frame(spark, [*text, ("_r", "int"), ("_lo", "double"), ("_hi", "double")],
                             [(*k, n, lo, hi) for (k, _, lo, hi), n in number.items()])
        targets = small_frame(spark, [*text, ("_r", "int"), ("rank", "bigint"), ("skip", "bigint")],
                              [(*k[:-1], number[(k[:-1], *v[:3])], k[-1], v[0]) for k, v in found.items()])
        return ranges, targets

    open_ = lambda: {k: v for k, v in found.items() if v[1] < v[2]}
    for _ in range(passes):
        many = {k: v for k, v in open_().items() if v[3] > FEW}
        if many:
            ranges, targets = narrowed(many)
            rows = _locate(_bins(long, keys, ranges), keys, targets).collect()  # a few rows per group
            found |= {(*(r[k] for k in keys), r["rank"]): (r["skip"], r["_lo"], r["_hi"], r["_n"]) for r in rows}
    # A zero is one whatever its sign.
    exact = small_frame(spark, [*text, ("rank", "bigint"), ("v", "double")], [(*k, v[1] + 0.0) for k, v in found.items() if not v[1] < v[2]])
    if open_():
        ranges, targets = narrowed(open_())
        left = (long.join(F.broadcast(ranges), keys).where((F.col("v") >= F.col("_lo")) & (F.col("v") <= F.col("_hi")))
                .groupBy(*keys, "_r", "v").agg(F.count(F.lit(1)).alias("_n")))
        exact = exact.unionByName(_locate(left.select(*keys, "_r", F.col("v").alias("_bin"), "_n", F.col("v").alias("_lo"), F.col("v").alias("_hi")),
                                          keys, F.broadcast(targets)).select(*keys, "rank", F.col("_lo").alias("v")))
    want = small_frame(spark, [*text, ("p", "double"), ("r0", "bigint"), ("r1", "bigint"), ("frac", "double")], wanted)
    both = want.join(exact, keys).where("rank = r0 or rank = r1")  # a few rows per group on both sides
    at = lambda r: F.max(F.when(F.col("rank") == F.col(r), F.col("v")))
    return both.groupBy(*keys, "p").agg((at("r0") + (at("r1") - at("r0")) * F.max("frac")).alias("value"))


def _quantiles_approx(long: DataFrame, keys: list[str], probs, accuracy: int = 10000) -> DataFrame:
    q = long.groupBy(*keys).agg(F.percentile_approx("v", list(probs), accuracy).alias("_q"))
    return q.select(*keys, F.inline(F.array(*[
        F.struct(F.lit(float(p)).alias("p"), F.col("_q")[i].alias("value")) for i, p in enumerate(probs)])))


# -- profile -----------------------------------------------------------------

def exact_mean(total: Column, n: Column, digits: int) -> Column:
    """The quotient of an exact decimal sum (at MEAN_SCALE places) and a
    count, rounded half away from zero to ``digits``: in whole numbers, so
    that ties round alike on every run and in every engine."""
    d = "decimal(38,0)"
    den = (n.cast(d) * F.lit(10 ** (MEAN_SCALE - digits)).cast(d)).cast(d)
    num = (F.abs(total) * F.lit(10 ** MEAN_SCALE).cast(d)).cast(d)
    twice = (num * 2 + den).cast(d)
    whole = ((twice - twice % (den * 2)) / (den * 2)).cast(d)
    exact = F.signum(total) * whole.cast("double") / F.lit(float(10 ** digits))
    # Sums that leave no room for the steps above: decimal division, to MEAN_SCALE places.
    wide = F.round(F.try_divide(total, n.cast("decimal(20,0)")), digits).cast("double")
    return F.when(F.abs(total) < F.lit("1" + "0" * 20).cast("decimal(38,0)"), exact).otherwise(wide)


#: Whole numbers up to here are doubles as they are.
_DOUBLE_WHOLE = 1 << 53


def _number_cell(name: str, c: Column, t: DataType, exact: bool = True) -> Column:
    """(col, v, e, k): the value as a double, as an exact decimal where its
    type is exact (if asked for), and what tells apart values that are the same double."""
    v = c.cast("double")
    e = F.lit(None).cast(f"decimal(38,{MEAN_SCALE})")
    k = F.lit(0).cast("bigint")
    if isinstance(t, IntegralType):
        e, k = c.cast(f"decimal(38,{MEAN_SCALE})"), c.cast("bigint")
    elif isinstance(t, DecimalType):
        e, k = (c.try_cast(f"decimal(38,{MEAN_SCALE})") if t.scale <= MEAN_SCALE else e), F.xxhash64(c.cast("string"))
    return F.struct(F.lit(name).alias("col"), v.alias("v"), *([e.alias("e")] if exact else []), F.when(c.isNotNull(), k).alias("k"))


def _number_stats(long: DataFrame, doubles: DataFrame, keys: list[str], exact: bool, digits: int) -> tuple[DataFrame, list]:
    """Statistics per key group of long numbers (``_number_cell``), nulls
    included, and the collected row of each group. Sums and moments are one pass;
    distinct counts and quantiles read ``doubles`` (the same without exact parts)."""
    v = F.col("v")
    f = _finite(v)
    dec = F.coalesce("e", f.try_cast(f"decimal(38,{MEAN_SCALE})"))
    distinct = F.count_distinct("v", "k") if exact else F.approx_count_distinct(F.when(v.isNotNull(), F.xxhash64("v", "k")))
    odd = F.col("e").isNull() & f.isNotNull() & ~F.coalesce(dec.cast("double") == f, F.lit(False))
    s = long.groupBy(*keys).agg(
        F.count(f).alias("_n"), F.avg(f).alias("_m"), F.min(f).alias("_lo"), F.max(f).alias("_hi"), F.sum(dec).alias("_sum"),
        F.count_if(odd).alias("_odd"), F.stddev_samp(f).alias("_sd"), F.count(F.lit(1)).alias("n"), F.count_if(v.isNull()).alias("n_null"))
    fin = doubles.select(*keys, f.alias("v"))
    counts = doubles.groupBy(*keys).agg(distinct.alias("n_distinct"))
    # One row per group comes back; later steps have them as literals.
    fields = [*[(k, "string") for k in keys], ("_n", "bigint"), ("_m", "double"), ("_lo", "double"), ("_hi", "double"),
              ("_sum", f"decimal(38,{MEAN_SCALE})"), ("_odd", "bigint"), ("_sd", "double"), ("n", "bigint"), ("n_null", "bigint")]
    rows = s.select(*[n for n, _ in fields]).collect()
    s = small_frame(long.sparkSession, fields, [tuple(r) for r in rows])
    sd = F.col("_sd")
    mean = F.when((F.col("_odd") == 0) & F.col("_sum").isNotNull(), exact_mean(F.col("_sum"), F.col("_n"), digits)).otherwise(F.round("_m", digits))
    q = (_quantiles_exact(fin.where(v.isNotNull()), keys, rows, QUARTILES) if exact
         else _quantiles_approx(fin.where(v.isNotNull()), keys, QUARTILES))
    qw = q.groupBy(*keys).agg(*[F.max(F.when(F.col("p") == p, F.col("value"))).alias(f"p{int(p * 100)}") for p in QUARTILES])
    r = lambda c, name: F.round(c, digits).alias(name)
    out = (counts.join(s, keys, "left").join(qw, keys, "left")
            .select(*keys, "n", "n_null", "n_distinct", F.when(F.col("_n") > 0, mean).alias("mean"), r(sd, "stddev"),
                    *[r(F.col(f"p{int(p * 100)}"), f"p{int(p * 100)}") for p in QUARTILES], r(F.col("_lo"), "min"), r(F.col("_hi"), "max"),
                    F.lit(None).cast("string").alias("min_text"), F.lit(None).cast("string").alias("max_text")))
    return out, rows


def _as_text(c: Column, t: DataType) -> Column:
    """A value in full; a time has its fraction of a second, if any."""
    return (c.cast("timestamp_ntz") if family(t) == "time" else c).cast("string")


def _text_stats(long: DataFrame, ends: DataFrame, keys: list[str], exact: bool) -> DataFrame:
    """Statistics of text ``v`` per key group, nulls included, beside its
    ``ends`` (``extrema``: in a group, texts would be sorted for them); distinct
    values are counted by digests, so no text is shuffled."""
    v = F.col("v")
    dig = long.select(*keys, F.when(v.isNotNull(), F.xxhash64("v")).alias("a"), F.when(v.isNotNull(), F.xxhash64("v", F.lit(7))).alias("b"))
    distinct = F.count_distinct("a", "b") if exact else F.approx_count_distinct("a")
    none = [F.lit(None).cast("double").alias(c) for c in ("mean", "stddev", "p25", "p50", "p75", "min", "max")]
    return (dig.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), (F.count(F.lit(1)) - F.count("a")).alias("n_null"), distinct.alias("n_distinct"))
            .join(ends, keys, "left").select(*keys, "n", "n_null", "n_distinct", *none, "min_text", "max_text"))


PROFILE_COLS = ("n", "n_null", "n_distinct", "mean", "stddev", "p25", "p50", "p75", "min", "max", "min_text", "max_text")


def profile_many(datasets: dict[str, tuple[DataFrame, list[str]]], exact: bool = True, digits: int = 6) -> DataFrame:
    """Profiles (dataset_id, col, *PROFILE_COLS) of several datasets in one
    plan: their values are unioned under a ``dataset_id`` key.

    Columns of numbers have n, n_null, n_distinct, mean, stddev, quartiles,
    min and max (NaN and infinities count as values, but enter none of the
    others). Values are counted as they are, whole numbers and decimals beyond what doubles
    hold too; for those (decimals, and columns with whole numbers beyond 2^53) min_text
    and max_text have the ends in full. Columns of dates, times (to the microsecond) and text have n,
    n_null, n_distinct and the ends of their order as text. The mean is that
    of the exact decimal sum. ``exact=False`` uses bounded sketches for
    quartiles and distinct counts.
    """
    keys, parts, expected = ["dataset_id", "col"], {"number": [], "text": []}, []
    spark, doubles, ends = None, [], []
    for name, (df, cols) in datasets.items():
        spark = df.sparkSession
        expected += [(name, c) for c in cols]
        tag = F.lit(name).alias("dataset_id")
        number = [c for c in cols if family(df.schema[c].dataType) == "number"]
        if number:
            parts["number"].append(df.select(tag, F.inline(F.array(*[_number_cell(c, qcol(c), df.schema[c].dataType) for c in number]))))
            doubles.append(df.select(tag, F.inline(F.array(*[_number_cell(c, qcol(c), df.schema[c].dataType, False) for c in number]))))
        other = [c for c in cols if c not in number]
        if other:
            parts["text"].append(df.select(tag, F.inline(F.array(*[
                F.struct(F.lit(c).alias("col"), _as_text(qcol(c), df.schema[c].dataType).alias("v")) for c in other]))))
            texts = df.select(*[(qcol(c) if family(df.schema[c].dataType) == "time" else qcol(c).cast("string")).alias(c) for c in other])
            ends.append(extrema(texts, other).select(tag, "col", "min_text", "max_text"))
    out = None
    for kind, frames in parts.items():
        if frames:
            long = union_all(frames)
            if kind == "number":
                got, rows = _number_stats(long, union_all(doubles), keys, exact, digits)
                got = _with_exact_ends(got, datasets, rows, keys)
            else:
                got = _text_stats(long, union_all(ends), keys, exact)
            out = got if out is None else out.unionByName(got)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    want = small_frame(spark, [(k, "string") for k in keys], expected)  # every column gets a row, even of an empty table
    return want.join(out, keys, "left").select(*keys, *[zero(c) if c.startswith("n") else F.col(c) for c in PROFILE_COLS])


def _with_exact_ends(stats: DataFrame, datasets: dict, rows: list, keys: list[str]) -> DataFrame:
    """The ends in full, as text, of columns that doubles don't hold."""
    ends = None
    for name, (df, cols) in datasets.items():
        wide = {r["col"] for r in rows if r["dataset_id"] == name and r["_n"] and max(abs(r["_lo"]), abs(r["_hi"])) >= _DOUBLE_WHOLE}
        types = {c: df.schema[c].dataType for c in cols}
        need = [c for c, t in types.items() if isinstance(t, DecimalType) or (isinstance(t, IntegralType) and c in wide)]
        if need:
            part = extrema(df, need).select(F.lit(name).alias("dataset_id"), "col", F.col("min_text").alias("_a"), F.col("max_text").alias("_b"))
            ends = part if ends is None else ends.unionByName(part)
    if ends is None:
        return stats
    return stats.join(ends, keys, "left").withColumns({"min_text": F.coalesce("min_text", "_a"), "max_text": F.coalesce("max_text", "_b")}).drop("_a", "_b")


def profile(df: DataFrame, cols: list[str] | None = None, exact: bool = True, digits: int = 6) -> DataFrame:
    """Column profile, one row per column (see ``profile_many``)."""
    return profile_many({"": (df, cols or df.columns)}, exact, digits).drop("dataset_id")


def top_values(df: DataFrame, cols: list[str], k: int = 5) -> DataFrame:
    """Most frequent values per column (col, value, cnt, rank), ties to the
    smaller value.

    Counts are combined map-side; the per-column window is fed through a
    partial group limit, so each column contributes at most ``k`` rows per
    upstream partition, however many distinct values it has.
    """
    long = unpivot_values(df, cols, "string")
    counts = long.groupBy("col", F.col("v").alias("value")).agg(F.count(F.lit(1)).alias("cnt"))
    w = Window.partitionBy("col").orderBy(F.desc("cnt"), F.asc("value"))
    return (counts.withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= k).withColumn("rank", F.col("rank").cast("bigint")))


def histogram(df: DataFrame, cols: list[str], bins: int = 10, digits: int = 6) -> DataFrame:
    """Equal-width histogram per column (col, bin, lo, hi, cnt); the maximum
    falls in the last bin; a constant column has one bin. Empty bins are
    not listed. NaN and infinities are in no bin: they are counted in a row
    without bin and limits."""
    long = unpivot_values(df, cols).withColumn("v", _finite(F.col("v")))
    rng = long.groupBy("col").agg(F.min("v").alias("_mn"), F.max("v").alias("_mx"))
    width = (F.col("_mx") - F.col("_mn")) / F.lit(bins)
    b = F.when(F.col("v").isNull(), None).when(F.col("_mx") == F.col("_mn"), F.lit(0)).otherwise(
        F.least(F.floor((F.col("v") - F.col("_mn")) / (F.col("_mx") - F.col("_mn")) * F.lit(bins)),
                F.lit(bins - 1))).cast("int")
    # One row per column: bounded by the schema.
    binned = long.join(F.broadcast(rng), "col").withColumn("bin", b)
    return (binned.groupBy("col", "bin", "_mn", "_mx").agg(F.count(F.lit(1)).alias("cnt"))
            .select("col", "bin",
                    F.round(F.col("_mn") + F.col("bin") * width, digits).alias("lo"),
                    F.round(F.col("_mn") + (F.col("bin") + 1) * width, digits).alias("hi"),
                    "cnt"))


def term_pattern(min_letters: int = 1) -> str:
    """A term is a maximal run of letters, at least so many."""
    return rf"\p{{L}}{{{min_letters},}}"


def text_terms(docs: DataFrame, doc_col: str, group_col: str, text_col: str,
               k: int = 10, digits: int = 6, min_letters: int = 1) -> DataFrame:
    """Top TF-IDF terms per group (group, term, tf, df, score, rank).

    A term has ``min_letters`` letters at least (1: every run of letters).
    tf = occurrences of the term in the group, df = documents containing it
    (over all documents; each document belongs to one group), score =
    tf * ln(N / df). Whole texts are tokenised; ties go to the smaller term.

    One aggregate by (group, term) yields tf and the group's document count
    (its distinct step combines map-side); df is their sum by term, joined
    back, so a term of very many groups is no single task's work. The top-k
    window runs behind a partial group limit, so a hot group sends at most k
    rows per task.
    """
    tokens = docs.select(doc_col, group_col,
                         F.explode(F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(term_pattern(min_letters)), 0)).alias("term"))
    g = tokens.groupBy(group_col, "term").agg(F.count(F.lit(1)).alias("tf"), F.count_distinct(doc_col).alias("_dfg"))
    n_docs = docs.agg(F.count(F.lit(1))).scalar()
    df = g.groupBy("term").agg(F.sum("_dfg").alias("df"))
    scored = (g.join(df, "term").withColumn("score", F.round(F.col("tf") * F.ln(n_docs / F.col("df")), digits)))
    w = Window.partitionBy(group_col).orderBy(F.desc("score"), F.asc("term"))
    return (scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select(group_col, "term", F.col("tf").cast("bigint").alias("tf"),
                    F.col("df").cast("bigint").alias("df"), "score", F.col("rank").cast("bigint").alias("rank")))


def extrema(df: DataFrame, cols: list[str]) -> DataFrame:
    """Minimum and maximum per ordered column: (col, min_value, max_value,
    min_text, max_text), in one pass.

    Each value is compared in its column's own type. The values are doubles
    (null for dates, times and text); the texts are exact: whole numbers and
    decimals in full, dates and times (to the microsecond) and text as they
    are ordered, null for doubles. NaN is no extremum.
    """
    types = {f.name: f.dataType for f in df.schema.fields}

    def value(name):
        c, t = qcol(name), types[name]
        if isinstance(t, (IntegralType, BooleanType)):
            return c.cast("bigint")
        if family(t) == "number":
            return c if isinstance(t, DecimalType) else _nan_free(c.cast("double"))
        return c.cast("timestamp_ntz" if family(t) == "time" else "string")

    def cells(i, name):
        """The row of a column, from its ends."""
        t = types[name]
        whole = isinstance(t, (IntegralType, BooleanType, DecimalType))
        has = {"value": ("double", whole or family(t) == "number"), "text": ("string", whole or family(t) != "number")}
        return F.struct(F.lit(name).alias("col"), *[
            (F.col(f"_{end}{i}") if there else F.lit(None)).cast(kind).alias(f"{end}_{what}")
            for what, (kind, there) in has.items() for end in ("min", "max")])
    if not cols:
        return small_frame(df.sparkSession, [("col", "string"), ("min_value", "double"), ("max_value", "double"), ("min_text", "string"), ("max_text", "string")], [])
    # One row of ends for all columns: grouped by column instead, texts (whose
    # ends a hash table can't hold) would have every cell of the table sorted.
    ends = df.agg(*[f(value(c)).alias(f"_{e}{i}") for i, c in enumerate(cols) for e, f in (("min", F.min), ("max", F.max))])
    return ends.select(F.inline(F.array(*[cells(i, c) for i, c in enumerate(cols)])))


def _nan_free(v: Column) -> Column:
    return F.when(~F.isnan(v), v)
