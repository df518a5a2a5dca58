"""Datasets merged from their document alone."""

import pytest

from tessera.operators import merge as M
from tessera.sources.dataset import dataset_document, read_dataset, write_dataset
from tessera.sources.files import write_schema_document

R = M.Reference


@pytest.fixture
def frames(spark):
    return {"main": spark.createDataFrame([(1, 10, 30, "a,\n\"b\""), (2, 20, None, None), (3, 99, 30, "")], "id int, a_id int, c_id int, note string"),
            "a": spark.createDataFrame([(10, 30, "x"), (20, 40, None)], "id int, c_id int, note string"),
            "c": spark.createDataFrame([(30, "p", 5), (40, "q", 6)], "key int, note string, d_id int"),
            "d": spark.createDataFrame([(5, "five")], "id int, word string"),
            "alone": spark.createDataFrame([(1,)], "z int")}


REFS = {"main": [R("a_id", "a", "id"), R("c_id", "c", "key")], "a": [R("c_id", "c", "key")], "c": [R("d_id", "d", "id")]}


def test_written_read_and_merged(spark, frames, tmp_path):
    """Two ways to c, and d behind each: rows equal joins written by hand."""
    write_dataset(str(tmp_path / "ds"), "ds", "main", frames, REFS)
    ds = read_dataset(spark, str(tmp_path / "ds"))
    rels = ds.relations()
    assert [(r.name, r.left_key, r.right_key) for r in rels] == [
        ("a", "a_id", "id"), ("c", "c_id", "key"), ("c_id_c", "a_c_id", "key"), ("d", "d_id", "id"), ("d_id_d", "c_id_c_d_id", "id")]
    assert ds.unreached() == ["alone"] and ds.dataset_id == "ds" and ds.other == []
    got = ds.merged()
    assert got.columns == ["id", "a_id", "c_id", "note", "a_c_id", "a_note", "c_note", "d_id", "c_id_c_note", "c_id_c_d_id", "word", "d_id_d_word"]
    assert [tuple(r) for r in got.orderBy("id").collect()] == [
        (1, 10, 30, "a,\n\"b\"", 30, "x", "p", 5, "p", 5, "five", "five"),
        (2, 20, None, None, 40, None, None, None, "q", 6, None, None),
        (3, 99, 30, "", None, None, "p", 5, None, None, "five", None)]
    assert {r["resource"]: (r["n_rows"], r["n_malformed"]) for r in ds.malformed().collect()} == {
        "main": (3, 0), "a": (2, 0), "c": (2, 0), "d": (1, 0), "alone": (1, 0)}


def test_key_of_a_resource_leads_on(frames):
    """A column dropped as a key is its left key for those that refer by it."""
    refs = {"main": [R("a_id", "a", "id")], "a": [R("id", "d", "id")]}
    assert [(r.name, r.left_key) for r in M.relations_of("main", frames, refs)] == [("a", "a_id"), ("d", "a_id")]
    assert [tuple(r)[-1] for r in M.star_merge(frames["main"], M.relations_of("main", frames, refs)).orderBy("id").collect()] == [None] * 3


@pytest.mark.parametrize("refs,words", [
    ({"main": [R("a_id", "a", "id")], "a": [R("c_id", "c", "key")], "c": [R("d_id", "a", "id")]}, "circle: main -> a -> c -> a"),
    ({"main": [R("id", "main", "id")]}, "circle: main -> main"),
    ({"main": [R("a_id", "b", "id")]}, "unknown resource 'b'"),
    ({"main": [R("b_id", "a", "id")]}, "'main' has no column 'b_id'"),
    ({"main": [R("a_id", "a", "key")]}, "'a' has no column 'key'")])
def test_bad_references(frames, refs, words):
    with pytest.raises(ValueError, match=words):
        M.relations_of("main", frames, refs)


def test_media_and_bad_documents(spark, frames, tmp_path):
    schema = '{"type":"struct","fields":[{"name":"id","type":"integer","nullable":true,"metadata":{}}]}'
    import json
    table = {"name": "t", "path": "t", "format": "csv", "schema": json.loads(schema), "references": [{"column": "id", "resource": "pics", "key": "file"}]}
    pics = {"name": "pics", "path": "media", "format": "image"}
    frames["d"].select("id").write.option("header", "true").csv(str(tmp_path / "t"))
    write_schema_document(spark, dataset_document("x", "t", [table, pics]), str(tmp_path / "dataset"))
    ds = read_dataset(spark, str(tmp_path))
    assert ds.other == ["pics"] and ds.relations() == [] and [tuple(r) for r in ds.merged().collect()] == [(5,)]
    for main, resources, words in (("t", [table, table], "two resources"), ("pics", [table, pics], "no table")):
        write_schema_document(spark, dataset_document("x", main, resources), str(tmp_path / "dataset"))
        with pytest.raises(ValueError, match=words):
            read_dataset(spark, str(tmp_path))


def test_empty_resources(spark, frames, tmp_path):
    empty = {n: df.limit(0) for n, df in frames.items()}
    write_dataset(str(tmp_path / "e"), "e", "main", empty, REFS)
    assert read_dataset(spark, str(tmp_path / "e")).merged().collect() == []
