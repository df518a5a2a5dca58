"""Edge cases and properties of the operators on small inline frames."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions.text import split_trim
from tessera.operators import classify as C
from tessera.operators import clean as T
from tessera.operators import cluster as KM
from tessera.operators import geocode as G
from tessera.operators import ingest as I
from tessera.operators import merge as M
from tessera.operators import rank as R
from tessera.operators import summary as Y
from tessera.operators.index import row_index


def test_split_trim_edges(spark):
    df = spark.createDataFrame([("",), ("a,,b",), (None,), (" x ,\ty\t",), (",",)], "s string")
    got = [r[0] for r in df.select(split_trim(F.col("s"))).collect()]
    assert got == [[], ["a", "", "b"], None, ["x", "y"], ["", ""]]


def test_null_tokens(spark):
    df = spark.createDataFrame([(" na ",), ("N/A",), ("?",), ("none",), ("NULL",), ("",), (" keep ",)], "s string")
    got = [r[0] for r in T.clean_null_tokens(df).collect()]
    assert got == [None] * 6 + ["keep"]


def test_threshold_compares_exact_counts(spark):
    """800,000 of 1,000,000 keeps the type; one less does not, though its
    share rounds to the threshold."""
    best = spark.createDataFrame([("a", "integer", 10**6, 800_000, 0.8), ("b", "real", 10**6, 799_999, 0.8), ("c", "real", 0, 0, 0.0)],
                                 "col string, semantic_type string, n bigint, n_match bigint, probability double")
    got = {r["col"]: r["gated_type"] for r in C.gate(best, 0.8).collect()}
    assert got == {"a": "integer", "b": "unknown", "c": "unknown"}


def test_one_fraction_in_three_million_survives(spark):
    df = spark.range(0, 3_000_000, numPartitions=8).select(F.when(F.col("id") == 77, "1.5").otherwise(F.col("id").cast("string")).alias("v"))
    got = C.classify_verified(df, categorical=False).collect()[0]
    assert (got["semantic_type"], got["storage"], got["n_cast"], got["accepted"]) == ("real", "double", 3_000_000, True)


def test_dates_keep_times_and_refuse_trailing_text(spark):
    rows = [("2024-01-05", "2024-01-05", "2024-01-05garbage", "2024-01-05 13:45:10"), ("2024-02-29", "2024-01-05 13:45:10", "2024-01-05", "2024-01-05T13:45")]
    df = spark.createDataFrame(rows, "d string, some string, bad string, t string")
    got = {r["col"]: (r["semantic_type"], r["storage"], r["accepted"]) for r in C.classify_verified(df, categorical=False).collect()}
    assert got == {"d": ("dateTime", "date", True), "some": ("dateTime", "timestamp_ntz", True), "bad": ("unknown", "string", True),
                   "t": ("dateTime", "timestamp_ntz", True)}
    typed = C.apply_types(df, {c: v[1] for c, v in got.items()}).orderBy("d").collect()
    assert [str(x) for x in typed[0]] == ["2024-01-05", "2024-01-05 00:00:00", "2024-01-05garbage", "2024-01-05 13:45:10"]
    assert [str(x) for x in typed[1]] == ["2024-02-29", "2024-01-05 13:45:10", "2024-01-05", "2024-01-05 13:45:00"]


def test_all_white_space_is_trimmed(spark):
    df = spark.createDataFrame([("\tNA", "12\r"), ("\u00a0x\u3000", "13\n")], "a string, b string")
    assert [r["a"] for r in T.clean_null_tokens(df).collect()] == [None, "x"]
    assert C.classify(df, ["b"], categorical=False).collect()[0]["semantic_type"] == "integer"


def test_column_names_with_dots(spark):
    df = spark.createDataFrame([("1", "x"), ("2", "x"), (None, "x")], "`a.b` string, `c d` string")
    assert {r["col"] for r in C.classify(df).collect()} == {"a.b", "c d"}
    assert {r["col"]: r["n_non_null"] for r in T.column_flags(df).collect()} == {"a.b": 2, "c d": 3}
    assert T.drop_empty_constant(df).columns == ["a.b"]
    assert T.clean_null_tokens(df).columns == df.columns
    assert {r["col"]: r["max_text"] for r in Y.extrema(df, df.columns).collect()} == {"a.b": "2", "c d": "x"}
    main = spark.createDataFrame([(1, "q")], "`k.1` int, v string")
    out = M.star_merge(main, [M.Relation("r", spark.createDataFrame([(1, "z")], "`k.1` int, `w.1` string"), "k.1", "k.1")])
    assert out.columns == ["k.1", "v", "w.1"] and out.collect()[0]["w.1"] == "z"


def test_best_type_tie_goes_to_upper_row(spark):
    df = spark.createDataFrame([("1",), ("2",), ("30",)], "v string")
    got = C.best_types(C.type_scores(df)).collect()[0]
    assert got["semantic_type"] == "integer" and got["probability"] == 1.0


def test_coordinates_need_name_hint(spark):
    df = spark.createDataFrame([("45.0", "45.0", "200.0")], "lat string, x string, lon string")
    got = {r["col"]: r["semantic_type"] for r in C.classify(df, categorical=False).collect()}
    assert got == {"lat": "latitude", "x": "real", "lon": "real"}


def test_all_null_and_empty_table(spark):
    df = spark.createDataFrame([(None,), (None,)], "a string")
    got = C.classify(df).collect()[0]
    assert got["semantic_type"] == "unknown" and got["probability"] == 0.0
    empty = spark.createDataFrame([], "x double")
    prof = Y.profile(empty, ["x"]).collect()[0]
    assert prof["n"] == 0 and prof["p50"] is None


def test_verify_rejects_partial_and_keeps_the_values(spark):
    df = spark.createDataFrame([(str(i),) for i in range(9)] + [("abc",), (None,)], "v string")
    r = C.classify_verified(df).collect()[0]
    assert (r["semantic_type"], r["n_non_null"], r["n_cast"], r["accepted"]) == ("integer", 10, 9, False)
    declared = spark.createDataFrame([("v", "string")], "col string, declared string")
    assert C.choose_types(declared, C.classify_verified(df)).collect()[0]["selected_type"] == "string"


def test_remote_sensing_case_sensitive(spark):
    reg = spark.createDataFrame([("a", "band"), ("a", "image_file"), ("b", "Band"), ("b", "image_file")],
                                "dataset_id string, col string")
    got = {r[0]: r[1] for r in I.remote_sensing(reg).collect()}
    assert got == {"a": True, "b": False}


@pytest.mark.parametrize("args,mode", [
    (dict(endpoint="http://x"), "catalog"),
    (dict(endpoint="http://x", database="db"), "catalog"),
    (dict(endpoint="http://x", metadata_only=True), "none"),
    (dict(endpoint="http://x", metadata_only=True, database="db"), "relational"),
    (dict(database="db"), "relational"),
    (dict(), "none"),
])
def test_dispatch(args, mode):
    assert I.dispatch(**args) == mode


def test_kmeans_assign_tie_lowest_cluster(spark):
    cents = spark.createDataFrame([(2, [1.0, 0.0]), (1, [-1.0, 0.0])], "cluster int, centroid array<double>")
    pts = spark.createDataFrame([(0, [0.0, 0.0]), (1, [0.9, 0.0])], "id int, v array<float>")
    got = {r["id"]: r["cluster"] for r in KM.assign(pts, "v", cents).collect()}
    assert got == {0: 1, 1: 2}


def test_gazetteer_ambiguity(spark):
    gaz = spark.createDataFrame([("Paris", "city", 1.0, 2.0, 2), ("paris ", "alias", 0.0, 0.0, 2),
                                 ("PARIS", "region", 5.0, 5.0, 1)],
                                "place string, kind string, lat double, lon double, priority int")
    red = G.reduce_gazetteer(gaz).collect()
    assert len(red) == 1 and red[0]["kind"] == "region" and red[0]["n_candidates"] == 3
    pl = spark.createDataFrame([(" paris",), ("Rome",)], "p string")
    got = sorted(G.geocode_forward(pl, "p", gaz).collect(), key=lambda r: r["p"])
    assert got[0]["lat"] == 5.0 and got[1]["lat"] is None


def test_merge_audit_reports_fanout(spark):
    main = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    res = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e")], "rk int, v string")  # nulls are no duplicates
    a = M.merge_audit(main, [M.Relation("r", res, "k", "rk")]).collect()[0]
    assert (a["n_left_rows"], a["n_unmatched"], a["n_dup_keys"], a["n_fanout_rows"]) == (3, 1, 1, 1)
    merged = M.star_merge(main, [M.Relation("r", res, "k", "rk")])
    assert merged.count() == 4


def test_star_merge_prefixes_clash(spark):
    main = spark.createDataFrame([(1, "m")], "k int, name string")
    res = spark.createDataFrame([(1, "r")], "k int, name string")
    out = M.star_merge(main, [M.Relation("res", res, "k", "k")])
    assert out.columns == ["k", "name", "res_name"]


def test_row_index_is_permutation(spark):
    df = spark.range(0, 5000).select(((F.col("id") * 7919) % 5003).alias("k"), (F.col("id") % 3).alias("t"))
    idx = row_index(df, ["k", "t"], num_partitions=7)
    rows = idx.orderBy("row_index").collect()
    assert [r["row_index"] for r in rows] == list(range(5000))
    ks = [(r["k"], r["t"]) for r in rows]
    assert ks == sorted(ks)


def test_histogram_counts_sum_to_n(spark):
    df = spark.range(0, 1001).select((F.col("id") * 0.37).alias("x"), F.lit(3.0).alias("c"))
    h = Y.histogram(df, ["x", "c"], bins=10).collect()
    assert sum(r["cnt"] for r in h if r["col"] == "x") == 1001
    assert max(r["bin"] for r in h if r["col"] == "x") == 9
    assert [(r["bin"], r["cnt"]) for r in h if r["col"] == "c"] == [(0, 1001)]


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(7)
    xs = rng.normal(size=997).round(3).tolist()
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    p = Y.profile(df, ["x"]).collect()[0]
    for q, name in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75")):
        assert p[name] == pytest.approx(float(np.quantile(xs, q)), abs=1e-6)


def test_pca_importance_matches_numpy(spark):
    rng = np.random.default_rng(3)
    a = rng.normal(size=(400, 3))
    a[:, 2] = a[:, 0] * 2 + rng.normal(scale=0.1, size=400)
    df = spark.createDataFrame([tuple(map(float, r)) for r in a], "x double, y double, z double")
    got = {r["col"]: r["importance"] for r in R.pca_importance(df, ["x", "y", "z"]).collect()}
    z = (a - a.mean(0)) / a.std(0, ddof=1)
    w, v = np.linalg.eigh(np.cov(z, rowvar=False))
    ratio = w / w.sum()
    want = np.abs(v) @ ratio
    for j, c in enumerate("xyz"):
        assert got[c] == pytest.approx(want[j], abs=1e-5)
    neg = df.select(*[(-F.col(c)).alias(c) for c in "xyz"])  # sign invariance
    got2 = {r["col"]: r["importance"] for r in R.pca_importance(neg, ["x", "y", "z"]).collect()}
    assert got2 == pytest.approx(got, abs=1e-6)


def test_impute_mode_tie_smallest(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", None), ("b", 3.0), ("a", 2.0), (None, 2.5)], "c string, x double")
    out = T.impute(df, ["x"], ["c"]).collect()
    assert out[4]["c"] == "a" and out[1]["x"] == 2.13


def test_column_flags(spark):
    df = spark.createDataFrame([(1, "k", None, "a"), (2, "k", None, None)], "a int, k string, e string, p string")
    got = {r["col"]: (r["is_empty"], r["is_constant"], r["kept"]) for r in T.column_flags(df).collect()}
    assert got == {"a": (False, False, True), "k": (False, True, False), "e": (True, False, False),
                   "p": (False, False, True)}
    assert T.drop_empty_constant(df).columns == ["a", "p"]


def test_exact_quantiles_hot_value_many_partitions(spark):
    rng = np.random.default_rng(11)
    xs = np.concatenate([np.full(700, 5.0), rng.integers(0, 1000, 1400).astype(float)])
    rng.shuffle(xs)
    df = spark.createDataFrame([(float(x), "g" if i % 2 else "h") for i, x in enumerate(xs)], "x double, g string")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        p = {r["col"]: r for r in Y.profile(df, ["x"]).collect()}["x"]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    for q, name in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75")):
        assert p[name] == pytest.approx(float(np.quantile(xs, q)), abs=1e-6)
    assert p["n_distinct"] == len(set(xs.tolist()))


def test_row_index_splits_a_hot_key(spark):
    df = spark.range(0, 3000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"))
    idx = row_index(df, ["k"], num_partitions=8)
    per_part = idx.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in per_part) < 1000  # the 1000 copies of k=7 are spread
    ks = [r["k"] for r in idx.orderBy("row_index").collect()]
    assert ks == sorted(ks) and len(ks) == 3000


def test_normalize_columns_and_cast(spark):
    from tessera.operators import format as FM
    df = spark.createDataFrame([(" 12 ", "1e3", "2024-01-05T10:00", "TRUE")],
                               "`Order ID` string, `Amount ($)` string, `When?` string, `ok` string")
    n = FM.normalize_columns(df)
    assert n.columns == ["order_id", "amount", "when", "ok"]
    typed = FM.cast_declared(n, {"order_id": "bigint", "amount": "double", "when": "timestamp_ntz", "ok": "boolean"}).collect()[0]
    assert typed["order_id"] == 12 and typed["amount"] == 1000.0 and str(typed["when"]) == "2024-01-05 10:00:00"
    assert typed["ok"] is True
    clash = spark.createDataFrame([(1, 2)], "`A b` int, `a_b` int")
    assert FM.normalize_columns(clash).columns == ["a_b", "a_b_1"]


def test_wide_tables_take_one_pass(spark, sf_dir):
    """300 columns over a merge: the fact table is scanned once."""
    from tessera.operators import format as FM
    from tessera.operators.ingest import column_registry
    from tessera.plans.queries_core import star
    wide = star(spark, sf_dir)
    wide = wide.select(*[(F.col("l_orderkey") + F.col("o_custkey") * i).alias(f"c{i}") for i in range(300)], F.lit("k").alias("konst"))
    frames = {"extrema": Y.extrema(wide, wide.columns[:300]), "registry": column_registry(wide, "w"), "flags": T.column_flags(wide),
              "rejects": FM.cast_rejects(wide, {c: "double" for c in wide.columns[:300]}), "corr": R.corr_importance(wide, wide.columns[:299], "c299")}
    for name, df in frames.items():
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("l_orderkey#") and sum("Relation" in ln and "l_orderkey" in ln for ln in plan.splitlines()) == 1, name
    got = {r["col"]: r for r in frames["extrema"].collect()}
    lo = wide.agg(F.min("c7")).first()[0]
    assert len(got) == 300 and got["c7"]["min_value"] == lo and got["c7"]["min_text"] == str(lo)
    flags = {r["col"]: r["kept"] for r in frames["flags"].collect()}
    assert len(flags) == 301 and flags["konst"] is False and flags["c0"] is True


def test_suggest_shuffle_partitions():
    from tessera.session import suggest_shuffle_partitions
    assert suggest_shuffle_partitions(100 * 2**40) == 409600
    assert suggest_shuffle_partitions(10, slots=8) == 8


def test_classify_verified_one_pass(spark):
    rows = [(str(i), f"{i}.5" if i % 10 else "abc", "2024-01-0%d" % (i % 9 + 1)) for i in range(1, 41)]
    df = spark.createDataFrame(rows, "a string, b string, d string")
    got = {r["col"]: r for r in C.classify_verified(df, categorical=False).collect()}
    assert (got["a"]["semantic_type"], got["a"]["accepted"]) == ("integer", True)
    assert (got["b"]["semantic_type"], got["b"]["n_non_null"], got["b"]["n_cast"], got["b"]["accepted"]) == \
        ("real", 40, 36, False)
    assert (got["d"]["semantic_type"], got["d"]["accepted"]) == ("dateTime", True)


def test_assign_centroids_in_blocks(spark):
    """However many centroids, in blocks of two, with ties and missing values."""
    cents = spark.createDataFrame([(i, [float(i % 5), 0.0]) for i in range(9)], "cluster int, centroid array<double>")
    pts = spark.createDataFrame([(0, [0.2, 0.0]), (1, [4.4, 1.0]), (2, None), (3, [None, 1.0]), (4, [1.5, 0.0]), (5, [float("nan"), 0.0]), (6, [1.0])],
                                "id int, v array<float>")
    for size in (32, 1 << 20):
        got = {r["id"]: (r["cluster"], r["dist"]) for r in KM.assign(pts, "v", cents, block_bytes=size).collect()}
        assert got == {0: (0, 0.04), 1: (4, 1.16), 2: (None, None), 3: (None, None), 4: (1, 0.25), 5: (None, None), 6: (None, None)}
    assert KM.assign(pts, "v", cents.limit(0)).where("cluster is not null").count() == 0


def test_whole_numbers_are_imputed_half_up(spark):
    df = spark.createDataFrame([(None, 1.25), (1, None), (2, 1.0)], "i int, x double")
    got = T.impute(df, ["i", "x"], []).orderBy("i").collect()
    assert sorted(map(tuple, got)) == [(1, 1.13), (2, 1.0), (2, 1.25)]


def test_nan_stays_out_of_histogram_and_profile(spark):
    df = spark.createDataFrame([(float(i),) for i in range(10)] + [(float("nan"),), (float("inf"),)], "x double")
    h = Y.histogram(df, ["x"], bins=3).collect()
    assert {r["bin"]: r["cnt"] for r in h} == {None: 2, 0: 3, 1: 3, 2: 4} and all(r["lo"] is not None for r in h if r["bin"] is not None)
    p = Y.profile(df, ["x"]).collect()[0]
    assert (p["n"], p["n_null"], p["mean"], p["min"], p["max"], p["p50"]) == (12, 0, 4.5, 0.0, 9.0, 4.5)


def test_exact_means_round_ties_alike(spark):
    rows = [(0.0499185 if i % 2 else 0.0499185,) for i in range(60)] + [(-0.0000005,)]
    p = Y.profile(spark.createDataFrame(rows[:60], "x double"), ["x"]).collect()[0]
    assert p["mean"] == 0.049919
    n = Y.profile(spark.createDataFrame(rows[60:], "x double"), ["x"]).collect()[0]
    assert n["mean"] == -0.000001
    huge = Y.profile(spark.createDataFrame([(1e300,), (3e300,)], "x double"), ["x"]).collect()[0]
    assert huge["mean"] == pytest.approx(2e300)


def test_quantiles_of_a_hostile_spread(spark):
    """Values over many magnitudes: narrow bins hold nearly all of them."""
    rng = np.random.default_rng(5)
    xs = np.concatenate([rng.normal(size=600) * 1e-9, [1e18, -1e18, 5.0], np.zeros(200)])
    p = Y.profile(spark.createDataFrame([(float(x),) for x in xs], "x double").repartition(5), ["x"], digits=18).collect()[0]
    for prob, name in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75")):
        assert p[name] == pytest.approx(float(np.quantile(xs, prob)), abs=1e-17)


def test_pca_with_missing_values(spark):
    df = spark.createDataFrame([(1.0, None, 2.0, 7.0), (2.0, None, None, 7.0), (3.0, None, 1.0, 7.0), (None, None, 4.0, 7.0)],
                               "a double, e double, b double, k double")
    got = {r["col"]: (r["importance"], r["n_used"]) for r in R.pca_importance(df, df.columns).collect()}
    assert got["e"] == (0.0, 0) and got["k"] == (0.0, 4) and got["a"][0] > 0 and got["a"][1] == got["b"][1] == 3


def test_projection_jobs_do_not_grow_with_columns(spark):
    df = spark.range(200).select("id", *[(F.col("id") % (i + 2)).cast("string").alias(f"s{i}") for i in range(20)])
    sc, groups = spark.sparkContext, iter(range(9))

    def jobs(n):
        name = f"tessera-projection-{next(groups)}"
        sc.setJobGroup(name, "plan construction")
        try:
            R.numeric_projection(df, [], [f"s{i}" for i in range(n)], keep=["id"])
            return len(sc.statusTracker().getJobIdsForGroup(name))
        finally:
            sc.setJobGroup("", "")
    jobs(2)
    assert abs(jobs(2) - jobs(20)) <= 2
    out = R.numeric_projection(df, [], [f"s{i}" for i in range(20)], keep=["id"]).where("id = 11").collect()[0]
    assert out["s9"] == 0 and out["s0"] == 1  # '0' sorts first among '0'..'10'; 11 % 2 = 1


def test_times_in_full(spark):
    """Times are counted and compared to the microsecond, and by value."""
    stamps = ["2024-01-01 00:00:01", "2024-01-01 00:00:01.000001", "2024-01-01 00:00:01.5", "2024-01-01 00:00:00.999999", "+10000-01-01 00:00:00", None]
    df = spark.createDataFrame([(s,) for s in stamps], "s string").selectExpr("cast(s as timestamp_ntz) t", "cast(s as timestamp) z", "s")
    got = {r["col"]: r for r in Y.profile(df).collect()}
    ends = {r["col"]: r for r in Y.extrema(df, ["t", "z", "s"]).collect()}
    for c in ("t", "z"):
        assert (got[c]["n"], got[c]["n_null"], got[c]["n_distinct"]) == (6, 1, 5)
        for r in (got[c], ends[c]):
            assert (r["min_text"], r["max_text"]) == ("2024-01-01 00:00:00.999999", "+10000-01-01 00:00:00")
    assert got["s"]["min_text"] == ends["s"]["min_text"] == "+10000-01-01 00:00:00"
