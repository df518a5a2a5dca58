"""What larger tables need: no cell sorted or text matched more than asked for."""

import re

from pyspark.sql import functions as F

from tessera.operators import summary as Y


def executed(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_extrema_sort_no_cells(spark):
    """Ends of numbers, times and text come from one row of running ends per task."""
    df = spark.sql("""select * from values (3, 1.5D, timestamp_ntz '2024-01-02 00:00:00', 'b', 1.10BD, true, date '2024-01-05'),
        (-9, double('NaN'), null, 'ä', null, false, null), (null, null, timestamp_ntz '2023-01-02 00:00:00.5', null, -2.00BD, null, date '2020-02-29')
        as t(w, d, ts, `s.x`, m, b, day)""")
    plan = executed(Y.extrema(df, df.columns))
    assert "Sort [" not in plan and not re.search(r"SortAggregate\(key=\[[^\]]", plan)
    got = [tuple(r) for r in Y.extrema(df, df.columns).collect()]
    assert sorted(got, key=str) == sorted([
        ("w", -9.0, 3.0, "-9", "3"), ("d", 1.5, 1.5, None, None), ("ts", None, None, "2023-01-02 00:00:00.5", "2024-01-02 00:00:00"),
        ("s.x", None, None, "b", "ä"), ("m", -2.0, 1.1, "-2.00", "1.10"), ("b", 0.0, 1.0, "0", "1"),
        ("day", None, None, "2020-02-29 00:00:00", "2024-01-05 00:00:00")], key=str)
    empty = Y.extrema(df.limit(0), ["w", "s.x"]).collect()
    assert sorted(map(tuple, empty)) == [("s.x", None, None, None, None), ("w", None, None, None, None)]


def test_classification_reads_its_table_once(spark):
    """Scores and casts come from the same pass."""
    from tessera.operators import classify as C
    seen = spark.sparkContext.accumulator(0)

    def tell(x):
        seen.add(1)
        return x
    df = spark.createDataFrame(spark.sparkContext.parallelize([(str(i), f"{i}.5") for i in range(40)], 2).map(tell), "a string, b string")
    got = {r["col"]: r["storage"] for r in C.classify_verified(df, categorical=False).collect()}
    assert got == {"a": "bigint", "b": "double"} and seen.value == 40


def test_value_tests_are_those_of_the_patterns(spark):
    """Counts of the pass against the plain test of each value."""
    from tessera.functions import exact as E
    from tessera.functions import types as T
    from tessera.operators import classify as C
    texts = [None, "", "0", "-0", "+", ".", "-", "00", "+07", "-7", "5.", ".5", "1e3", "1E-400", "1e99999999999", "123456789012345", "-12345678901234",
             "1234567890123456", "99999999999999999999", "12345678901234567.89", "0.1000", "9007199254740993", "9223372036854775808", "1e299", "1e301", "1.5e305",
             "true", "FALSE", "truex", "2024-01-05", "2024-13-05", "2024-01-05 10:00", "2024-01-05T10:00:00.123456", "2024-01-05 10:00:00.1234567", "2024-01-05x",
             "http://a.b/c", "HTTPS://x", "ftp://", "see http://a.b", "a@b.co", "a@b", "x.png", "x.JPEG", ".tif", "png", "é.tiff", "١٢", "1,5", "90.5", "-90"]
    df = spark.createDataFrame([(f" {t} " if t and i % 3 == 0 else t,) for i, t in enumerate(texts)], "lat string")
    v, name = F.col("v"), F.lit("lat")
    plain = C.text_long(df, ["lat"])
    need = F.when(v.rlike(T.PATTERNS["real"]), E.needs(v))
    want = plain.agg(F.count("v").alias("n"), F.count_if(T.has_time(v)).alias("n_time"),
                     *[F.count_if(v.isNotNull() & T.matches_type(v, ty, name)).alias(f"m_{ty}") for ty in T.SCORED_TYPES],
                     *[F.count_if(T.kept_cast(v, t)).alias(f"k_{t}") for t in T.CAST_TARGETS],
                     F.count(need).alias("k_decimal"), F.max(need["whole"]).alias("d_whole"), F.max(need["scale"]).alias("d_scale")).first().asDict()
    got = C.column_stats(df, casts=True).first().asDict()
    assert {k: got[k] for k in want} == want
    # And each value alone, so that no two differences cancel out.
    each = plain.where("v is not null").select("v", F.when(v.rlike(T.PATTERNS["real"]), E.kept_by_double(v)).alias("double"))
    tested = C._tested(plain.where("v is not null"), True).select("v", C._kept("double").alias("kept"), C._kept("bigint").alias("whole_kept"))
    kept = {r["v"]: (bool(r["kept"]), bool(r["whole_kept"])) for r in tested.collect()}
    assert {r["v"]: bool(r["double"]) for r in each.collect()} == {k: x[0] for k, x in kept.items()}
    assert {r["v"]: r["k"] for r in plain.where("v is not null").select("v", T.kept_cast(v, "bigint").alias("k")).collect()} == {k: x[1] for k, x in kept.items()}


def test_profile_sorts_no_text(spark):
    df = spark.sql("select * from values ('b', date '2024-01-05', true), ('a', null, false), (null, date '2023-01-05', true) as t(s, d, b)")
    prof = Y.profile(df)
    assert not re.search(r"SortAggregate\(key=\[[^\]]", executed(prof))
    got = {r["col"]: (r["n"], r["n_null"], r["n_distinct"], r["min_text"], r["max_text"]) for r in prof.collect()}
    assert got == {"s": (3, 1, 2, "a", "b"), "d": (3, 1, 2, "2023-01-05 00:00:00", "2024-01-05 00:00:00"), "b": (3, 0, 2, "false", "true")}


def test_values_known_by_their_type_need_no_text(spark):
    """Whole numbers, dates and times are counted as their texts would be, of
    which only those out of range are made; casts give the same values."""
    from tessera.functions.types import guarded_cast
    from tessera.operators import classify as C
    df = spark.sql("""select * from values
        (0L, 7, 5S, date '2024-01-05', timestamp '2024-01-05 10:00:00', timestamp_ntz '2024-01-05 00:00:00', 1.5D, -90L, 'a'),
        (-999999999999999L, -7, -5S, date '1600-02-29', timestamp '1890-06-01 01:02:03.000004', timestamp_ntz '9999-12-31 23:59:59', -0D, 91L, ' 007 '),
        (1000000000000000L, 2147483647, 0S, date '9999-12-31', timestamp '0001-01-01 12:00:00', null, double('NaN'), 180L, '12'),
        (9223372036854775807L, null, null, null, null, timestamp_ntz '2024-01-05 00:00:00.5', 1e300D, -181L, null),
        (-9223372036854775807L - 1, 1, 1S, date '0001-01-01', timestamp '2024-01-05 10:00:00', null, 1.0000000000000002D, 9000000000000000001L, '2024-01-05'),
        (null, null, null, date_add(date '9999-12-31', 9), timestampadd(day, 9, timestamp '9999-12-31 00:00:00'), null, null, null, '2024-01-05 10:00')
        as t(w, i, s, day, ts, ntz, d, lat_lon, x)""")
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    for casts in (True, False):
        got, want = (sorted(map(tuple, C.column_stats(x, casts=casts).select("col", *sorted(set(C.column_stats(texts, casts=casts).columns) - {"col"})).collect()))
                     for x in (df, texts))
        assert got == want and len(got) == 9
    made = {r["col"]: r["n"] for r in C.cells(df, df.columns).where("v is not null").groupBy("col").agg(F.count("v").alias("n")).collect()}
    assert made == {"w": 3, "day": 3, "ts": 2, "ntz": 1, "d": 5, "lat_lon": 1, "x": 5}
    for c, to in (("i", "bigint"), ("s", "bigint"), ("w", "bigint"), ("ts", "timestamp_ntz"), ("day", "timestamp_ntz"), ("i", "double"), ("ts", "date")):
        one = C.apply_types(df.select(c), {c: to})
        plain = df.select((F.col(c) if df.schema[c].dataType.simpleString() == to else guarded_cast(F.col(c), to)).alias(c))
        assert one.schema == plain.schema and [tuple(r) for r in one.collect()] == [tuple(r) for r in plain.collect()], (c, to)


def test_quantiles_narrow_only_what_has_many_values(spark, monkeypatch):
    """No pass over the values for steps of few values or a single one; the
    quartiles are the same after none, one or two passes."""
    calls, bins = [], Y._bins
    monkeypatch.setattr(Y, "_bins", lambda *a: calls.append(1) or bins(*a))
    df = spark.range(999).select(F.when(F.col("id") > 2, F.col("id") * F.col("id") / 8).alias("a"), F.lit(-0.0).alias("same"),
                                 F.when(F.col("id") < 500, 1.0).otherwise(1e9).alias("two"), F.lit(None).cast("double").alias("none"))
    want = {r["col"]: tuple(r) for r in df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).alias("v")) for c in df.columns])))
            .groupBy("col").agg(*[F.round(F.expr(f"percentile(v, {p})"), 6).alias(str(p)) for p in Y.QUARTILES]).collect()}
    for few, passes in ((1 << 16, 0), (400, 1), (1, 2)):
        monkeypatch.setattr(Y, "FEW", few, raising=False)
        calls.clear()
        got = {r["col"]: tuple(r) for r in Y.profile(df).select("col", "p25", "p50", "p75").collect()}
        assert got == want and len(calls) == passes, few
    assert str(got["same"][1]) == "0.0"
