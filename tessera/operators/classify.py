"""Classify: semantic type scoring, gating, best type, type source choice
and verification against the data.

All decisions compare exact counts; probabilities are rounded for display
only.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, IntegralType, LongType, TimestampNTZType, TimestampType

from tessera.functions import exact as E
from tessera.functions.sizing import qcol, small_frame
from tessera.functions.text import go_trim
from tessera.functions.types import (CAST_TARGETS, COORD_RULES, NUMERIC_STORAGE, PATTERNS, PRIORITY, SCORED_TYPES, STORAGE_TYPES,
                                     guarded_cast, storage_of)

DEFAULT_THRESHOLD = 0.8  # fixed value: the default probability threshold
DATE_BYTES, STAMP_BYTES = 10, 26  # of a date, and of a time of day in microseconds
IMAGE_CHARS = 5  # the longest ending of the image pattern
CATEGORICAL_RATIO = 0.05  # fixed value: distinct values at most this share of rows


def text_long(df: DataFrame, cols: list[str]) -> DataFrame:
    """(col, v): every value of ``cols`` as trimmed text, nulls kept."""
    return df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("col"), qcol(c).cast("string").alias("v")) for c in cols]))).select("col", go_trim(F.col("v")).alias("v"))


def _known(c: Column, t: DataType) -> Column | None:
    """Whether the type and range of a value tell all that the tests ask of its
    text: whole numbers of at most 15 digits, dates and times in years of four
    digits (in any time zone). None for other types."""
    if isinstance(t, IntegralType):
        return c.between(1 - 10 ** E.SAFE_DIGITS, 10 ** E.SAFE_DIGITS - 1)
    if isinstance(t, (DateType, TimestampType, TimestampNTZType)):
        return c.between(*[F.lit(d).cast(t) for d in ("0001-01-03", "9999-12-29")])
    return None


def cells(df: DataFrame, cols: list[str]) -> DataFrame:
    """``text_long`` without the texts that say no more than the value
    (``_known``): null for these, with ``num``, the whole number (0 for a time). What
    is alike for all columns comes after the unpivoting: the JVM compiles the pass only up to a size."""
    none = F.lit(None)

    def cell(name):
        c, t = qcol(name), df.schema[name].dataType
        if isinstance(t, IntegralType):
            text, num = none, c
        elif _known(c, t) is not None:
            text, num = F.when(~_known(c, t), c.cast("string")), F.when(_known(c, t), 0)
        else:
            text, num = c.cast("string"), none
        return F.struct(F.lit(name).alias("col"), text.cast("string").alias("v"), num.cast("bigint").alias("num"))
    v, num = F.col("v"), F.col("num")
    within = _known(num, LongType())
    return df.select(F.inline(F.array(*[cell(c) for c in cols]))).select(
        "col", F.when(num.isNull(), go_trim(v)).when(~within, num.cast("string")).alias("v"), F.when(within, num).alias("num"))


def _with_known(stats: DataFrame, df: DataFrame, cols: list[str], casts: bool) -> DataFrame:
    """``stats`` with the values that were counted without their text
    (``_known``), of each column what its type says."""
    says = []
    for c in cols:
        t = df.schema[c].dataType
        if isinstance(t, IntegralType):
            says.append((c, ["n", "m_integer", "m_real", "k_bigint", "k_double", "k_decimal"]))
        elif isinstance(t, DateType):
            says.append((c, ["n", "m_dateTime", "k_date", "k_timestamp_ntz"]))
        elif isinstance(t, (TimestampType, TimestampNTZType)):
            says.append((c, ["n", "n_time", "m_dateTime", "k_timestamp_ntz"]))
    if says:
        rows = small_frame(df.sparkSession, [("col", "string"), ("_says", "array<string>")], says)
        stats = stats.join(F.broadcast(rows), "col", "left")
        more = {n for _, names in says for n in names} & set(stats.columns)
        stats = stats.withColumns({n: F.col(n) + F.when(F.array_contains("_says", F.lit(n)), F.col("_known")).otherwise(0) for n in more})
        whole = F.array_contains("_says", F.lit("m_integer")) & (F.col("_known") > 0)
        stats = stats.withColumns({f"m_{ty}": F.col(f"m_{ty}") + F.when(whole, F.col(f"_{ty}")).otherwise(0) for ty in COORD_RULES})
        if casts:
            digits = {"d_whole": F.length(F.col("_most").cast("bigint").cast("string")), "d_scale": F.lit(0)}
            stats = stats.withColumns({d: F.greatest(d, F.when(whole, x)) for d, x in digits.items()})
    return stats.drop("_known", "_most", "_says", *[f"_{ty}" for ty in COORD_RULES])


def _score_rows(g: DataFrame, types: list[str], digits: int) -> DataFrame:
    """Long scores (col, semantic_type, n, n_match, probability) from the
    per-column counts ``n`` and ``m_<type>``."""
    rows = [F.struct(F.lit(ty).alias("semantic_type"), F.col(f"m_{ty}").alias("n_match")) for ty in types]
    out = g.select("col", "n", F.inline(F.array(*rows)))
    return out.select("col", "semantic_type", "n", "n_match",
                      F.round(F.when(F.col("n") > 0, F.col("n_match") / F.col("n")).otherwise(F.lit(0.0)),
                              digits).alias("probability"))


def _tested(long: DataFrame, casts: bool) -> DataFrame:
    """``long`` with what the tests of a value share, each as a column, so
    that it is found once per value: whether it is a ``real`` number, a whole one
    or a ``stamp``, the ``rest`` (texts that are none of these) and, for
    casts, whether it is padded (``zeros``), and the parts of a number and of
    the double it becomes (``again_``). Whole numbers of up to 15 characters (``short``) say all that themselves;
    others are taken apart (``exact.parts``)."""
    v = F.col("v")
    is_ = lambda ty, may: F.coalesce(may & v.rlike(PATTERNS[ty]), F.lit(False))
    # Numbers begin with a sign, a point or a digit, stamps with a digit; these have a few lengths.
    led = (v >= "+") & (v < ":")
    out = long.select("*", is_("real", led).alias("real"), is_("dateTime", led & F.octet_length(v).between(DATE_BYTES, STAMP_BYTES)).alias("stamp"))
    out = out.select("*", is_("integer", F.col("real")).alias("whole"), F.when(~F.col("real") & ~F.col("stamp"), v).alias("rest"))
    if not casts:
        return out
    short, size = F.col("short"), F.octet_length(v) - F.when(v < "0", 1).otherwise(0)
    out = out.withColumn("short", F.col("whole") & (F.octet_length(v) <= E.SAFE_DIGITS))
    out = E.with_parts(out, F.when(F.col("real") & ~short, v))
    core, point = F.length("core"), F.col("point")
    out = E.with_parts(out, F.when((core <= E.SAFE_DIGITS + 2) & ((core > E.SAFE_DIGITS) | (F.abs(point) >= E.FAR)), v.try_cast("double").cast("string")), "again_")
    led = F.startswith(F.ltrim(v, F.lit("+-")), F.lit("0"))
    return out.withColumn("zeros", F.when(short, (size > 1) & led).otherwise(F.col("padded")))


def _digits() -> dict[str, Column]:
    """Digits left and right of the point of a tested number."""
    size = F.octet_length("v") - F.when(F.col("v") < "0", 1).otherwise(0)
    whole, scale = E.decimal_digits(F.col("core"), F.col("point"))
    return {"d_whole": F.when(F.col("short"), size).otherwise(whole), "d_scale": F.when(F.col("short"), 0).otherwise(scale)}


def _scored(semantic_type: str) -> Column:
    """``matches_type`` of a tested value: the same texts match, but a
    pattern is tried only on those that hold what it needs."""
    v, rest = F.col("v"), F.col("rest")
    found = {"integer": F.col("whole"), "real": F.col("real"), "dateTime": F.col("stamp")}
    if semantic_type in found:
        return found[semantic_type]
    if semantic_type in COORD_RULES:
        hint, bound = COORD_RULES[semantic_type]
        return F.lower("col").contains(hint) & F.col("real") & (F.abs(v.try_cast("double")) <= F.lit(bound))
    end = F.right(rest, F.lit(IMAGE_CHARS))
    may = {"boolean": F.octet_length(rest).between(4, 5), "url": F.contains(rest, F.lit("://")), "email": F.contains(rest, F.lit("@")),
           "image": F.contains(end, F.lit("."))}
    return may[semantic_type] & (end if semantic_type == "image" else rest).rlike(PATTERNS[semantic_type])


def _kept(target: str) -> Column:
    """``kept_cast`` of a tested value."""
    v, stamp = F.col("v"), F.col("stamp")
    if target == "bigint":
        return F.col("whole") & ~F.col("zeros") & (F.col("short") | v.try_cast("bigint").isNotNull())
    if target == "double":
        return F.col("real") & ~F.col("zeros") & (F.col("short") | E.double_holds(F.col("core"), F.col("point"), F.col("again_core"), F.col("again_point")))
    if target == "boolean":
        return _scored("boolean")
    return stamp & (F.octet_length(v) == DATE_BYTES if target == "date" else F.lit(True)) & v.try_cast(target).isNotNull()


def column_stats(df: DataFrame, cols: list[str] | None = None, gazetteer_keys: DataFrame | None = None,
                 casts: bool = False) -> DataFrame:
    """Per column, from one aggregate over the unpivoted text: rows, non-null
    values, a match count per semantic type (``m_<type>``), values with a
    time of day (``n_time``) and, if asked for, values that a cast to each
    storage type keeps (``k_<type>``; ``k_decimal``, and the most digits left
    and right of the point that a decimal needs). Only counts are shuffled, a
    row per column and task. Place hits (``m_place``) come from a semi join of the non-null
    values with the gazetteer's keys."""
    cols = cols or df.columns
    v, num = F.col("v"), F.col("num")
    tested = _tested(cells(df, cols), casts)
    aggs = [F.count(F.lit(1)).alias("n_rows"), F.count(v).alias("n"), F.count_if(F.col("stamp") & (F.octet_length(v) > DATE_BYTES)).alias("n_time")]
    aggs += [F.count_if(_scored(ty)).alias(f"m_{ty}") for ty in SCORED_TYPES]
    aggs += [F.count(num).alias("_known"), *[F.count_if(F.lower("col").contains(hint) & (F.abs(num) <= F.lit(bound))).alias(f"_{ty}")
                                             for ty, (hint, bound) in COORD_RULES.items()]]
    if casts:
        aggs += [F.count_if(_kept(t)).alias(f"k_{t}") for t in CAST_TARGETS]
        unpadded = F.col("real") & ~F.col("zeros")
        aggs += [F.count_if(unpadded).alias("k_decimal"), *[F.max(F.when(unpadded, x)).alias(d) for d, x in _digits().items()],
                 F.max(F.abs(num)).alias("_most")]
    stats = _with_known(tested.groupBy("col").agg(*aggs), df, cols, casts)
    if gazetteer_keys is not None:
        keys = gazetteer_keys.select(F.col(gazetteer_keys.columns[0]).alias("_key")).where("_key is not null")
        hits = (text_long(df, cols).where(v.isNotNull()).select("col", F.upper(v).alias("_key")).join(keys, "_key", "left_semi")
                .groupBy("col").agg(F.count(F.lit(1)).alias("m_place")))
        stats = stats.join(hits, "col", "left").withColumn("m_place", F.coalesce("m_place", F.lit(0).cast("bigint")))
    return stats


def type_scores(df: DataFrame, cols: list[str] | None = None, digits: int = 6) -> DataFrame:
    """Share of non-null values matching each semantic type, per column.

    Long output (col, semantic_type, n, n_match, probability). Values are
    unpivoted once and aggregated by column with one ``count_if`` per type:
    map-side partial aggregation leaves one row per column and task to
    shuffle, and the expression count does not grow with the table width.
    """
    return _score_rows(column_stats(df, cols), SCORED_TYPES, digits)


def best_types(scores: DataFrame) -> DataFrame:
    """The type with most matches per column; ties go to the earlier lattice
    type. (col, semantic_type, n, n_match, probability)."""
    prio = F.create_map(*[x for t, p in PRIORITY.items() for x in (F.lit(t), F.lit(-p))])
    best = scores.groupBy("col").agg(F.max(F.struct("n_match", prio[F.col("semantic_type")].alias("np"),
                                                    "semantic_type", "n", "probability")).alias("b"))
    return best.select("col", "b.semantic_type", "b.n", "b.n_match", "b.probability")


def gate(best: DataFrame, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """A share of matches below the threshold makes the type ``unknown``;
    equal keeps it. The counts are compared in decimals, not the rounded
    share."""
    bar = F.col("n") * F.lit(Decimal(str(threshold)))
    reached = (F.col("n") > 0) & (F.col("n_match") >= bar)
    return best.withColumn("gated_type", F.when(reached, F.col("semantic_type")).otherwise(F.lit("unknown")))


def distinct_of(df: DataFrame, cols: list[str]) -> DataFrame:
    """(col, n_distinct) of ``cols``: exact distinct trimmed texts, counted
    by two 64-bit hashes, so that no text is shuffled however long it is."""
    long = text_long(df, cols).where(F.col("v").isNotNull())
    return (long.select("col", F.xxhash64("v").alias("a"), F.xxhash64("v", F.lit(7)).alias("b"))
            .groupBy("col").agg(F.count_distinct("a", "b").alias("n_distinct")))


def classify(df: DataFrame, cols: list[str] | None = None, threshold: float = DEFAULT_THRESHOLD,
             categorical: bool = True, ratio: float = CATEGORICAL_RATIO,
             gazetteer_keys: DataFrame | None = None, digits: int = 6) -> DataFrame:
    """Suggested semantic type per column (col, semantic_type, probability).

    Score (``place`` too when gazetteer keys are given), pick the best, gate
    at ``threshold``; then, if enabled, a column left ``unknown`` whose
    distinct count is at most ``ratio`` of the rows (and at least one)
    becomes ``categorical``. The scores come from one pass (run here: one
    row per column comes back); the distinct counts read the undecided
    columns only.
    """
    return _classified(df, cols or df.columns, threshold, categorical, ratio, gazetteer_keys, digits, False) \
        .select("col", "semantic_type", "probability")


def classify_verified(df: DataFrame, cols: list[str] | None = None, threshold: float = DEFAULT_THRESHOLD,
                      categorical: bool = True, ratio: float = CATEGORICAL_RATIO,
                      gazetteer_keys: DataFrame | None = None, digits: int = 6) -> DataFrame:
    """Classification and verification (C1-C3 + C5) in one pass: (col,
    semantic_type, probability, n_non_null, n_cast, accepted, storage).

    The same aggregate that scores the types also counts, per column, the
    values that a cast to each storage type keeps (``functions.exact``); the
    suggested type then picks its count. A type is accepted iff a cast keeps
    every non-null value. ``storage`` is what to store an accepted column as:
    numbers that bigint or double would change become the least decimal that
    holds them all; where none does, or texts are zero-padded, the type is
    rejected and the column stays as it is.
    """
    c = _classified(df, cols or df.columns, threshold, categorical, ratio, gazetteer_keys, digits, True)
    plain = storage_of(F.col("semantic_type"), F.col("n_time"))
    lossy = F.coalesce(*[F.when(plain == t, F.col(f"k_{t}") < F.col("n")) for t in NUMERIC_STORAGE])
    wide = F.when(lossy & (F.col("k_decimal") == F.col("n")), E.decimal_type(F.col("d_whole"), F.col("d_scale")))
    c = c.withColumn("storage", F.coalesce(wide, plain))
    n_cast = F.coalesce(*[F.when(F.col("storage") == t, F.col(f"k_{t}")) for t in CAST_TARGETS], F.col("n"))
    return c.select("col", "semantic_type", "probability", F.col("n").alias("n_non_null"),
                    n_cast.alias("n_cast"), (n_cast == F.col("n")).alias("accepted"), "storage")


def _classified(df, cols, threshold, categorical, ratio, gazetteer_keys, digits, casts) -> DataFrame:
    counted = column_stats(df, cols, gazetteer_keys, casts)
    # One row per column comes back: scores and casts are of the same pass.
    stats = small_frame(df.sparkSession, [(f.name, f.dataType.simpleString()) for f in counted.schema.fields], [tuple(r) for r in counted.collect()])
    types = SCORED_TYPES + (["place"] if gazetteer_keys is not None else [])
    keep = ["n_rows", "n_time", *([*[f"k_{t}" for t in CAST_TARGETS], "k_decimal", "d_whole", "d_scale"] if casts else [])]
    g = gate(best_types(_score_rows(stats, types, digits)), threshold).join(stats.select("col", *keep), "col")
    names = ["col", "gated_type", "probability", "n", *keep]
    rows = g.select(*names).collect()  # one row per column
    found = {r["col"] for r in rows}
    rows = [tuple(r) for r in rows] + [(c, "unknown", 0.0, 0, *[0] * len(keep)) for c in cols if c not in found]
    kinds = ["string", "string", "double", *["bigint"] * (len(names) - 3)]
    g = small_frame(df.sparkSession, list(zip(names, kinds)), rows)
    final, open_ = F.col("gated_type"), [r[0] for r in rows if r[1] == "unknown" and r[3]]
    if categorical and open_:
        # One row per undecided column: bounded by the schema.
        g = g.join(F.broadcast(distinct_of(df, open_)), "col", "left")
        few = F.col("n_distinct") <= F.col("n_rows") * F.lit(Decimal(str(ratio)))
        final = F.when((final == "unknown") & (F.col("n_distinct") >= 1) & few, F.lit("categorical")).otherwise(final)
    return g.select("col", final.alias("semantic_type"), "probability", "n", *keep)


def choose_types(declared: DataFrame, suggested: DataFrame, source: str = "classification") -> DataFrame:
    """Type source choice: the classification's type or the declared one.

    ``declared`` has (col, declared); ``suggested`` (col, semantic_type and,
    if verified, accepted and storage). A suggestion that verification
    rejected counts as none; the selected storage type falls back to the
    other source when the chosen one has none for the column.
    """
    st = F.create_map(*[x for t, s in STORAGE_TYPES.items() for x in (F.lit(t), F.lit(s))])
    storage = F.col("storage") if "storage" in suggested.columns else st[F.col("semantic_type")]
    accepted = F.col("accepted") if "accepted" in suggested.columns else F.lit(True)
    sug = suggested.select("col", F.col("semantic_type").alias("suggested"), F.when(accepted, storage).alias("_storage"))
    j = declared.join(sug, "col", "full")
    chosen = (F.coalesce("_storage", "declared") if source == "classification" else F.coalesce("declared", "_storage"))
    return j.select("col", "declared", "suggested", F.lit(source).alias("type_source"), chosen.alias("selected_type"))


def apply_types(df: DataFrame, selected: dict[str, str]) -> DataFrame:
    """Columns cast to their selected storage types; a column whose type is
    already that one, or that has no entry, stays as it is."""
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}

    def cast(name):
        """Whole numbers to bigint and times to timestamps are cast as they are (``_known``), others by their text."""
        c, t, to = qcol(name), df.schema[name].dataType, selected[name]
        if to == "bigint" and isinstance(t, IntegralType) or to == "timestamp_ntz" and isinstance(t, (DateType, TimestampType)):
            return F.when(_known(c, t), c.cast(to)).otherwise(guarded_cast(c, to))
        return guarded_cast(c, to)
    return df.select(*[cast(c).alias(c) if c in selected and selected[c] != have[c] else qcol(c) for c in df.columns])
