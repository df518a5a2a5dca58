"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import common as C


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: longs); ``root`` is
    the least node that it is connected to.

    Each round hangs every neighbour on the least one around (large star,
    then small star) and writes the edges as a table, so that no lineage
    grows and no component is ever gathered in one place; rounds grow with
    the logarithm of the longest chain. The least neighbours are a table too:
    a join with them meets two plain exchanges, which AQE splits where one
    node is the centre of many. Self-edges name lone nodes.
    """
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    e = C.stage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label)
    seen = None
    while True:
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == seen or not now[0]:
            break
        seen = now
        both = e.union(e.select("b", "a"))
        least = C.stage(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), label)
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = C.stage(large, label)
        least = C.stage(large.groupBy("a").agg(F.min("b").alias("m")), label)
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = C.stage(small.union(least.select("a", "m")).distinct(), label)
    return nodes.join(e.withColumnsRenamed({"a": "node", "b": "root"}), "node", "left").select(
        "node", F.coalesce("root", "node").alias("root"))
