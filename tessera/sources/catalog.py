"""Catalog tables: artefacts, the datasets catalog, the model catalog, the
typed relational table and the metadata tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources import snapshot

DATASETS_SCHEMA = (
    "dataset_id string, folder string, source string, dataset_type string, n_rows bigint, "
    "variables array<struct<col:string,ord:int,declared:string,suggested:string,probability:double,"
    "selected:string,importance:double,min:double,max:double>>, "
    "groupings array<struct<type:string,id_col:string,sub_cols:array<string>>>, summary_terms array<string>")
MODELS_SCHEMA = "model_id string, dataset_id string, kind string, params string"
METADATA_TABLES = {
    "classification": ("col string, semantic_type string, probability double, n_non_null bigint, n_cast bigint, "
                       "accepted boolean, storage string"),
    "importance": "col string, importance double, rank bigint",
    "extrema": "col string, min_value double, max_value double, min_text string, max_text string",
    "profile": ("col string, n bigint, n_null bigint, n_distinct bigint, mean double, stddev double, p25 double, "
                "p50 double, p75 double, min double, max double, min_text string, max_text string"),
    "terms": "`group` string, term string, tf bigint, df bigint, score double, rank bigint",
}
ARTEFACTS = ("classification", "importance", "summary", "summary_machine")


def put(df: DataFrame, path: str, dataset_id: str) -> None:
    """Replace what a table holds of one dataset (its partition) and keep
    the rest: running again leaves the same table."""
    rows = df if "dataset_id" in df.columns else df.withColumn("dataset_id", F.lit(dataset_id))
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dataset_id").parquet(path))


def write_artifacts(artifacts: dict[str, DataFrame], root: str, dataset_id: str) -> dict[str, str]:
    """Each artefact as its own table under ``root``, keyed by dataset."""
    paths = {}
    for name, df in artifacts.items():
        paths[name] = f"{root}/{name}"
        put(df, paths[name], dataset_id)
    return paths


def read_artifacts(spark: SparkSession, paths: dict[str, str], dataset_id: str) -> dict[str, DataFrame]:
    """The artefacts of one dataset."""
    return {n: spark.read.parquet(p).where(F.col("dataset_id") == dataset_id).drop("dataset_id") for n, p in paths.items()}


def variable_catalog(registry: DataFrame, classification: DataFrame, importance: DataFrame,
                     summary: DataFrame) -> DataFrame:
    """Variables with their artefacts joined back by column key (left joins:
    every registered column stays, artefacts may be missing)."""
    cls = classification.select("col", F.col("semantic_type").alias("suggested"), "probability")
    imp = importance.select("col", "importance")
    smy = summary.select("col", F.col("min_value").alias("min"), F.col("max_value").alias("max"))
    return (registry.join(cls, "col", "left").join(imp, "col", "left").join(smy, "col", "left"))


def upsert_catalog(rows: DataFrame, path: str) -> None:
    """Replace the catalog partitions of the datasets in ``rows`` and keep
    all others (dynamic partition overwrite): re-running is idempotent."""
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("dataset_id").parquet(path))


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def ensure_table(spark: SparkSession, path: str, schema: str) -> None:
    """Create an empty table with ``schema`` unless one exists."""
    empty = spark.createDataFrame([], schema)
    w = empty.write.mode("ignore")
    (w.partitionBy("dataset_id", "run") if "run" in empty.columns else w).parquet(path)


def ensure_model_catalog(spark: SparkSession, path: str) -> None:
    ensure_table(spark, path, MODELS_SCHEMA)


def create_metadata_tables(spark: SparkSession, root: str) -> dict[str, str]:
    """The metadata tables, empty unless they exist; each is partitioned by
    ``dataset_id`` and ``run`` (see ``snapshot``). Returns their paths."""
    paths = {}
    for name in ("datasets", *METADATA_TABLES):
        paths[name] = f"{root}/{name}"
        ensure_table(spark, paths[name], f"{metadata_schema(name)}, dataset_id string, run string")
    return paths


def metadata_schema(name: str) -> str:
    """The columns of a metadata table beside ``dataset_id``."""
    return METADATA_TABLES.get(name) or DATASETS_SCHEMA.removeprefix("dataset_id string, ")


def read_metadata(spark: SparkSession, root: str, name: str) -> DataFrame:
    """What is published of a metadata table, with its declared schema (empty
    ones too)."""
    rows = snapshot.read(spark, root, name, metadata_schema(name))
    return rows.select("dataset_id", *[c for c in rows.columns if c != "dataset_id"])


def publish_all(run: snapshot.Run, dataset_id: str) -> int:
    """Commit a run that replaces all that the metadata tables hold of a
    dataset: tables that it put nothing in have no rows of it from now on."""
    run.pairs |= {(name, dataset_id) for name in ("datasets", *METADATA_TABLES)}
    return run.commit()


def ingest_typed(df: DataFrame, path: str) -> DataFrame:
    """Write the typed table (Parquet stands in for the relational store;
    ``df.write.jdbc`` takes the same frame) and read it back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
