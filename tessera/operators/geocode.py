"""Geocode: forward lookup of place text against a gazetteer table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.sizing import free_name, qcol, stage
from tessera.functions.text import go_trim


def place_key(c) -> F.Column:
    """Normal form of a place name: trimmed, upper case."""
    return F.upper(go_trim(c))


def reduce_gazetteer(gaz: DataFrame, place: str = "place") -> DataFrame:
    """One entry per normalised name: lowest priority wins, then kind, then
    coordinates. Reduced before any join, so a lookup never fans out."""
    best = gaz.groupBy(place_key(qcol(place)).alias("key")).agg(
        F.min(F.struct("priority", "kind", "lat", "lon")).alias("b"),
        F.count(F.lit(1)).alias("n_candidates"))
    return best.select("key", F.col("b.kind").alias("kind"), F.col("b.lat").alias("lat"),
                       F.col("b.lon").alias("lon"), F.col("b.priority").alias("priority"), "n_candidates")


def geocode_forward(df: DataFrame, place_col: str, gazetteer: DataFrame,
                    prefix: str = "", with_kind: bool = False) -> DataFrame:
    """Append ``lat``/``lon`` for the place in ``place_col``; unmatched rows
    keep nulls. A name that the table has already is prefixed with ``gazetteer``.

    The gazetteer is reduced once, to a stored table. Spark knows that
    table's size: a small one is broadcast, a large one meets the rows in a
    shuffle join of two plain exchanges, so that AQE can split a hot place.
    """
    parts = ("lat", "lon", "kind") if with_kind else ("lat", "lon")
    key = free_name(df.columns, "__key", "_")
    red = stage(reduce_gazetteer(gazetteer), "gazetteer").where("key is not null").select(
        F.col("key").alias(key), *[F.col(c).alias(free_name(df.columns, prefix + c, "gazetteer")) for c in parts])
    return df.join(red, place_key(qcol(place_col)) == F.col(key), "left").drop(key)


def geocode_report(geocoded: DataFrame, place_col: str, kind_col: str = "kind") -> DataFrame:
    """Hits per gazetteer kind and misses ('unmatched'), per place column."""
    return (geocoded.groupBy(F.coalesce(F.col(kind_col), F.lit("unmatched")).alias("kind"))
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.lit(place_col).alias("col"), "kind", "n"))
