"""Columns whose names clash, differ in case only, or hold dots."""

from decimal import Decimal

from tessera.operators import clean as C
from tessera.operators import cluster as K
from tessera.operators import geocode as G
from tessera.operators import ingest as I
from tessera.operators import merge as M
from tessera.operators import rank as R
from tessera.operators.index import row_index


def test_star_merge_finds_free_names(spark):
    main = spark.createDataFrame([(1, 10, "m", "x")], "k int, fk int, Name string, r_name string")
    res = spark.createDataFrame([(10, "r", "z")], "id int, name string, `a.b` string")
    got = M.star_merge(main, [M.Relation("r", res, "fk", "id")])
    assert got.columns == ["k", "fk", "Name", "r_name", "r_r_name", "a.b"] and tuple(got.first()) == (1, 10, "m", "x", "r", "z")


def test_train_target_finds_free_names(spark):
    f = spark.createDataFrame([(1, "a", True), (2, "b", False)], "id int, label string, has_target boolean")
    t = spark.createDataFrame([(1, "y", "q")], "id int, LABEL string, `x.y` string")
    got = M.merge_train_target(f, t, "id")
    assert got.columns == ["id", "label", "has_target", "target_LABEL", "x.y", "target_has_target"]
    assert sorted(tuple(r) for r in got.collect()) == [(1, "a", True, "y", "q", True), (2, "b", False, None, None, False)]


def test_geocode_finds_free_names(spark):
    df = spark.createDataFrame([("Rome", 1.0, "k")], "place string, lat double, __key string")
    gaz = spark.createDataFrame([("ROME", "city", 41.9, 12.5, 1)], "place string, kind string, lat double, lon double, priority int")
    got = G.geocode_forward(df, "place", gaz)
    assert got.columns == ["place", "lat", "__key", "gazetteer_lat", "lon"] and tuple(got.first()) == ("Rome", 1.0, "k", 41.9, 12.5)


def test_bands_and_files_line_up(spark):
    df = spark.createDataFrame([("i", "b1", "x,y.tif"), ("i", "b2", None), ("i", "b3", "z.tif")], "`image.id` string, band string, image_file string")
    got = I.multiband_groups(df, "image.id").first()
    assert (got["image_id"], got["n_bands"], got["bands"], got["files"]) == ("i", 3, ["b1", "b2", "b3"], ["x,y.tif", None, "z.tif"])


def test_row_index_and_clusters_find_free_names(spark):
    df = spark.createDataFrame([(2, "t", [0.0, 1.0], 7.0, 8), (1, "u", [5.0, 5.0], None, 9)],
                               "`a.b` int, _tid string, _v array<double>, _dist double, _cluster int")
    got = row_index(df, ["a.b"], "_pid")
    assert got.columns == [*df.columns, "_pid"] and [(r["a.b"], r["_tid"]) for r in got.orderBy("_pid").collect()] == [(1, "u"), (2, "t")]
    cents = spark.createDataFrame([(0, [0.0, 0.0]), (1, [5.0, 4.0])], "cluster int, centroid array<double>")
    near = K.assign(df, "_v", cents, block_bytes=16)
    assert near.columns == [*df.columns, "cluster", "dist"]
    assert sorted(tuple(r)[1:] for r in near.collect()) == [("t", [0.0, 1.0], 7.0, 8, 0, 1.0), ("u", [5.0, 5.0], None, 9, 1, 1.0)]
    assert sorted(r["cluster"] for r in K.kmeans(near.withColumnRenamed("_dist", "_features"), "_v", 2).collect()) == [0, 1]


def test_imputed_means_are_exact(spark):
    big = 9007199254740993
    df = spark.createDataFrame([(big, Decimal("0.1234567890123456789"), 0.125, None), (big, None, 0.125, None), (None, None, None, None)],
                               "n long, d decimal(38,19), f double, none long")
    got = C.impute(df, ["n", "d", "f", "none"], [], digits=2).collect()[-1]
    assert (got["n"], got["d"], got["f"], got["none"]) == (big, Decimal("0.1200000000000000000"), 0.13, None)
    odd = spark.createDataFrame([(-1, 1e-15), (-2, float("inf")), (None, None)], "n int, f double")
    assert tuple(C.impute(odd, ["n", "f"], []).collect()[-1]) == (-2, float("inf"))
    nan = spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "f double")
    assert str(C.impute(nan, ["f"], []).collect()[-1][0]) == "nan"


def test_large_code_tables_share_one_join(spark, monkeypatch):
    rows = [(i, f"v{i % 7}" if i % 3 else None, "hot" if i % 2 else str(i), float(i)) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, `a.b` string, __v1 string, x double").repartition(5)
    args = (["x"], ["a.b", "__v1"], ["id"])
    want = sorted(map(str, R.numeric_projection(df, *args).collect()))
    for bound in (0, 200):  # both large; the first small
        monkeypatch.setattr(R, "BROADCAST_BYTES", bound)
        got = R.numeric_projection(df, *args)
        assert sorted(map(str, got.collect())) == want
    monkeypatch.setattr(R, "BROADCAST_BYTES", 0)
    wide = spark.createDataFrame([tuple(f"{i}-{c}" for c in range(20)) for i in range(50)], ", ".join(f"c{c} string" for c in range(20)))
    plan = R.numeric_projection(wide, [], wide.columns)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 2  # codes to cells, cells to rows
