"""Ingest decisions: metadata verification, remote-sensing detection,
groupings, the post-ingest branch and mode dispatch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.sizing import per_column, qcol, small_frame

# The provenance tags and the two group kinds, in order.
SOURCE_SEED = "seed"
DATASET_TYPE_MODELLING = "modelling"
GROUP_MULTIBAND = "multiband_image"
GROUP_GEOBOUNDS = "geo_bounds"
REMOTE_SENSING_VARS = ("band", "image_file")


def column_registry(df: DataFrame, dataset_id: str) -> DataFrame:
    """One row per column (dataset_id, col, ord, data_type, n_non_null).

    Types come from the schema; the non-null counts from one pass, whatever
    the width.
    """
    fields = df.schema.fields
    got = per_column(df, df.columns, {"is": lambda _, c: c.isNotNull()}, [F.count_if("is").alias("n")])
    types = small_frame(df.sparkSession, [("ord", "int"), ("data_type", "string")],
                        [(i, f.dataType.simpleString()) for i, f in enumerate(fields)])
    return got.join(types, "ord").select(F.lit(dataset_id).alias("dataset_id"), "col", "ord", "data_type",
                                         F.coalesce("n", F.lit(0).cast("bigint")).alias("n_non_null"))


def verify_metadata(declared: DataFrame, actual: DataFrame) -> DataFrame:
    """Declared (col, declared) against actual (col, data_type):
    ok, missing, undeclared or type_mismatch per column."""
    j = declared.select("col", "declared").join(actual.select("col", F.col("data_type").alias("actual")), "col", "full")
    status = (F.when(F.col("actual").isNull(), "missing")
              .when(F.col("declared").isNull(), "undeclared")
              .when(F.col("declared") != F.col("actual"), "type_mismatch")
              .otherwise("ok"))
    return j.select("col", "declared", "actual", status.alias("status"))


def remote_sensing(registry: DataFrame) -> DataFrame:
    """True iff a dataset has columns named exactly ``band`` and
    ``image_file`` (case-sensitive)."""
    a, b = REMOTE_SENSING_VARS
    return registry.groupBy("dataset_id").agg(
        (F.bool_or(F.col("col") == a) & F.bool_or(F.col("col") == b)).alias("is_remote_sensing"))


def multiband_groups(df: DataFrame, image_col: str = "image_id", band_col: str = "band",
                     file_col: str = "image_file") -> DataFrame:
    """One row per image: its bands in order and the file of each, as arrays
    of one length (a band without a file has null).

    (image, band) pairs are reduced first, so an image's list holds one
    entry per distinct band, however many rows repeat it.
    """
    pairs = (df.select(qcol(image_col).alias("i"), qcol(band_col).alias("b"), qcol(file_col).alias("f"))
             .groupBy("i", "b").agg(F.min("f").alias("f")))
    g = pairs.groupBy("i").agg(F.sort_array(F.collect_list(F.struct("b", "f"))).alias("_l"))
    return g.select(F.col("i").alias("image_id"), F.size("_l").cast("bigint").alias("n_bands"),
                    F.transform("_l", lambda s: s["b"]).alias("bands"), F.transform("_l", lambda s: s["f"]).alias("files"))


def geobounds(df: DataFrame, group_col: str, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """West, south, east, north per group."""
    return df.groupBy(qcol(group_col)).agg(F.min(qcol(lon)).alias("west"), F.min(qcol(lat)).alias("south"),
                                           F.max(qcol(lon)).alias("east"), F.max(qcol(lat)).alias("north"))


def group_specs(spark, image_col: str = "image_id", band_col: str = "band", file_col: str = "image_file",
                lat: str = "lat", lon: str = "lon") -> DataFrame:
    """The groups registered for a remote-sensing dataset, in order:
    multi-band image first, geo bounds second."""
    return spark.sql(
        "select * from values (0, :g1, :i, array(:b, :f)), (1, :g2, :i, array(:la, :lo)) "
        "as t(ord, type, id_col, sub_cols)",
        args={"g1": GROUP_MULTIBAND, "g2": GROUP_GEOBOUNDS, "i": image_col, "b": band_col, "f": file_col,
              "la": lat, "lo": lon})


def dispatch(endpoint: str = "", metadata_only: bool = False, database: str = "") -> str:
    """Which ingest runs: catalog when an endpoint is set and not
    metadata-only; else relational when a database is set; else none."""
    if endpoint and not metadata_only:
        return "catalog"
    if database:
        return "relational"
    return "none"


def provenance(df: DataFrame, mode: str) -> DataFrame:
    """Catalog rows carry source and dataset type; relational only source."""
    out = df.withColumn("source", F.lit(SOURCE_SEED))
    if mode == "catalog":
        out = out.withColumn("dataset_type", F.lit(DATASET_TYPE_MODELLING))
    return out
