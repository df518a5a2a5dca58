"""Dataset folders: a schema document that names several resources, where
each is stored, and which column of which refers to which."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.functions.sizing import union_all
from tessera.operators.merge import Reference, Relation, relations_of, star_merge
from tessera.sources.files import CORRUPT_COL, malformed_count, read_declared, write_csv, write_schema_document

DOCUMENT = "dataset"


@dataclass
class Dataset:
    """``frames`` by resource name, ``main`` the one that others join onto.
    ``flagged`` has the CSV resources with their flag of malformed rows;
    ``other`` names resources that are no tables (media folders)."""
    dataset_id: str
    main: str
    frames: dict[str, DataFrame]
    references: dict[str, list[Reference]]
    flagged: dict[str, DataFrame] = field(default_factory=dict)
    other: list[str] = field(default_factory=list)

    def relations(self) -> list[Relation]:
        return relations_of(self.main, self.frames, self.references)

    def merged(self) -> DataFrame:
        return star_merge(self.frames[self.main], self.relations())

    def unreached(self) -> list[str]:
        """Tables that no chain of references leads to; they are not merged."""
        reached, todo = {self.main}, [self.main]
        while todo:
            for ref in self.references.get(todo.pop(), []):
                if ref.resource not in reached:
                    reached.add(ref.resource)
                    todo.append(ref.resource)
        return [n for n in self.frames if n not in reached]

    def malformed(self) -> DataFrame | None:
        """(resource, n_rows, n_malformed, n_with_null) of the CSV resources;
        None where there are none."""
        parts = [malformed_count(df).select(F.lit(n).alias("resource"), "*") for n, df in self.flagged.items()]
        return union_all(parts) if parts else None


def dataset_document(dataset_id: str, main: str, resources: list[dict]) -> str:
    """The document (JSON, one line). A resource has ``name``, ``path`` (in
    the folder, or a whole path), ``format`` (csv, parquet, or another kind
    that is no table), ``schema`` (Spark's JSON) and ``references``: dicts of
    ``column``, ``resource``, ``key``."""
    return json.dumps({"dataset_id": dataset_id, "main": main, "resources": resources}, sort_keys=True)


def write_dataset(folder: str, dataset_id: str, main: str, frames: dict[str, DataFrame],
                  references: dict[str, list[Reference]], stored: dict[str, str] | None = None) -> None:
    """Write ``frames`` as CSV resources of a folder, and its document last,
    so that a folder with a document is whole. Resources named in ``stored``
    are Parquet tables elsewhere, which are referred to and not copied."""
    stored, resources = stored or {}, []
    for name, df in frames.items():
        path = stored.get(name, f"tables/{name}")
        if name not in stored:
            write_csv(df, f"{folder}/{path}", header=True)
        resources.append({"name": name, "path": path, "format": "parquet" if name in stored else "csv", "schema": json.loads(df.schema.json()),
                          "references": [vars(r) for r in references.get(name, [])]})
    write_schema_document(frames[main].sparkSession, dataset_document(dataset_id, main, resources), f"{folder}/{DOCUMENT}")


def read_dataset(spark: SparkSession, folder: str) -> Dataset:
    """The dataset of a folder from its document alone: every table read
    against its declared schema, malformed CSV rows kept and flagged in
    ``flagged``. A document without a main table or with two resources of one
    name is an error; resources of other formats are listed, not read."""
    doc = json.loads(spark.read.option("wholetext", True).text(f"{folder}/{DOCUMENT}").first()["value"])
    ds = Dataset(doc["dataset_id"], doc["main"], {}, {})
    for r in doc["resources"]:
        name, kind = r["name"], r.get("format", "csv")
        if name in ds.frames or name in ds.other:
            raise ValueError(f"two resources are named {name!r}")
        path = r["path"] if r["path"].startswith("/") or "://" in r["path"] else f"{folder}/{r['path']}"
        if kind == "csv":
            ds.flagged[name] = read_declared(spark, path, StructType.fromJson(r["schema"]))
            ds.frames[name] = ds.flagged[name].drop(CORRUPT_COL)
        elif kind == "parquet":
            ds.frames[name] = spark.read.schema(StructType.fromJson(r["schema"])).parquet(path)
        else:
            ds.other.append(name)
            continue
        ds.references[name] = [Reference(x["column"], x["resource"], x["key"]) for x in r.get("references", []) if x["resource"] not in _media(doc)]
    if ds.main not in ds.frames:
        raise ValueError(f"the main resource {ds.main!r} is no table of the document")
    return ds


def _media(doc: dict) -> set[str]:
    return {r["name"] for r in doc["resources"] if r.get("format", "csv") not in ("csv", "parquet")}
