"""Metadata tables of a run are seen together or not at all."""

import pytest

from tessera.plans.workflow import Dataset, ingest
from tessera.sources import catalog as K
from tessera.sources import snapshot as SN

ROW = "col string, n bigint"


def put(spark, run, table, dataset, *rows):
    run.put(spark.createDataFrame(list(rows), ROW), table, dataset)


def seen(spark, root, table):
    return sorted(tuple(r) for r in SN.read(spark, root, table, ROW).select("dataset_id", "col", "n").collect())


def test_a_run_that_dies_leaves_the_old_snapshot(spark, tmp_path):
    root = str(tmp_path)
    one = SN.Run(spark, root)
    put(spark, one, "a", "x", ("c", 1))
    put(spark, one, "b", "x", ("c", 1))
    assert one.commit() == 1
    dead = SN.Run(spark, root)
    put(spark, dead, "a", "x", ("c", 2))  # and no more
    assert seen(spark, root, "a") == seen(spark, root, "b") == [("x", "c", 1)]
    again = SN.Run(spark, root)
    put(spark, again, "a", "x", ("c", 3), ("d", 3))
    put(spark, again, "b", "x")
    assert [tuple(r) for r in again.read("a", "x", ROW).orderBy("col").collect()] == [("c", 3), ("d", 3)]
    assert again.commit() == 2
    assert seen(spark, root, "a") == [("x", "c", 3), ("x", "d", 3)] and seen(spark, root, "b") == []
    assert SN.history(spark, root).where("not live").count() == 2


def test_two_runs_at_once(spark, tmp_path):
    """Both survive on different datasets; the slower fails on the same one."""
    root = str(tmp_path)
    runs = {name: SN.Run(spark, root) for name in ("x", "007", "late")}
    put(spark, runs["x"], "a", "x", ("c", 1))
    put(spark, runs["007"], "a", "007", ("c", 2))
    put(spark, runs["late"], "a", "x", ("c", 9))
    assert (runs["x"].commit(), runs["007"].commit()) == (1, 2)
    with pytest.raises(SN.Conflict):
        runs["late"].commit()
    assert seen(spark, root, "a") == [("007", "c", 2), ("x", "c", 1)]


def test_a_number_is_taken_once(spark, tmp_path):
    files = SN._Files(spark, str(tmp_path))
    assert files.last() == 0 and files.create(1, "{}\n") and not files.create(1, "{}\n") and files.last() == 1
    assert [p.name for p in (tmp_path / SN.COMMITS).iterdir() if not p.name.startswith(".")] == ["000000000001.json"]


def test_an_ingest_replaces_all_of_its_dataset(spark, tmp_path):
    """Run again without terms and target, no old rows of them are left; all
    six tables are read back."""
    root = str(tmp_path)
    df = spark.createDataFrame([(i, i * 2.5, "red" if i % 2 else "blue", "some words here") for i in range(40)],
                               "id long, price double, colour string, body string")
    first = Dataset("d", df, [], ["id"], "price", ("id", "colour", "body"))
    ingest(spark, first, root, endpoint="catalog")
    ingest(spark, Dataset("other", df, [], ["id"]), root, endpoint="catalog")
    counts = lambda: {n: K.read_metadata(spark, f"{root}/metadata", n).where("dataset_id = 'd'").count() for n in ("datasets", *K.METADATA_TABLES)}
    before = counts()
    assert before["datasets"] == 1 and before["classification"] == before["profile"] == 5 and before["terms"] == 6
    assert before["importance"] > 0 and before["extrema"] > 0
    ingest(spark, Dataset("d", df, [], ["id"]), root, endpoint="catalog")
    after = counts()
    assert after["terms"] == after["importance"] == 0 and after["datasets"] == 1 and after["classification"] == 5
    assert K.read_metadata(spark, f"{root}/metadata", "datasets").count() == 2
