"""Merkle manifest of a dataset: a digest tree a group, and one over the groups.

A row is a leaf: the SHA-256 of its fields, each ``-`` if null, else its UTF-8
byte count, ``:`` and its value. Within a group leaves stand by their order
columns; every ``fanout`` neighbours become the digest of their digests (hex
text, end to end) until one node is left, and the groups' last nodes become
one root in the same way.

Method. Nodes carry nested intervals: a leaf of rank r covers [r, r + 1), a
parent all that its children cover. At level l a node's ancestor is the one
whose interval holds it; both fall in bucket ``lo div fanout ** l``, so
ancestors are attached by equi-joins on (group, bucket) that check
containment, from the top down, and each level's path is carried on. What the
parent's interval holds to the left and to the right of the node's own are its
siblings. No key has more than ``fanout`` rows on either side, however large
a group is, and ranks come from the counts of a range partitioning, so a
group that holds a third of all rows is no hot key. Every level is written as
a table.

A null group is a group of its own, ahead of all others; groups go by their
UTF-8 bytes. Null order values come first. Ties are ordered by leaf digest;
rows alike in all fields are leaves of their own and interchangeable. A group
of one row has its leaf as its last node, and one group's last node is the
root. Null, empty and long texts are fields like others. An empty table gives
no rows. Extra columns take no part, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm import common as C

FANOUT = 8


def field(value: Column) -> Column:
    s = value.cast("string")
    return F.when(s.isNull(), "-").otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def digest(values: list[Column]) -> Column:
    """Hex SHA-256 of the fields' encodings, end to end."""
    return F.sha2(F.concat(*map(field, values)), 256)


def _levels(largest: int, fanout: int) -> int:
    n = 0
    while fanout ** n < largest:
        n += 1
    return n


def _ranked(rows: DataFrame, order: list, label: str) -> DataFrame:
    """``rows`` (with the group in ``gn``, ``g``) with their rank ``lo`` in the
    group by ``order`` and the group's size ``n``. Rows are range-partitioned
    by (group, order); a rank is the place in the partition plus what earlier
    partitions hold of the group."""
    by = [F.desc("gn"), F.col("g"), *order]
    placed = C.stage(rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id()),
                     label + "-order")
    part = F.shiftright("_at", 33).alias("_p")
    held = placed.groupBy("gn", "g", part).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_m"))
    group = Window.partitionBy("gn", "g")
    so_far = group.orderBy("_p").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = C.stage(held.select("gn", "g", "_p", (F.sum("_m").over(so_far) - F.col("_m") - F.col("_first")).alias("_shift"),
                               F.sum("_m").over(group).alias("n")), label + "-held")
    return placed.withColumn("_p", part).join(held, ["gn", "g", "_p"]).withColumn("lo", F.col("_at") + F.col("_shift")).drop("_at", "_p", "_shift")


def _climb(leaves: DataFrame, fanout: int, label: str) -> list[DataFrame]:
    """The levels above ``leaves`` (gn, g, n, lo, hash): nodes with their
    interval [lo, hi), digest and children (``kids``: lo, hi, hash)."""
    found, nodes = [], leaves.select("gn", "g", "n", "lo", (F.col("lo") + 1).alias("hi"), "hash")
    largest = leaves.agg(F.max("n")).first()[0] or 0
    for level in range(1, _levels(largest, fanout) + 1):
        below = nodes.where(F.col("n") > fanout ** (level - 1))
        kids = F.sort_array(F.collect_list(F.struct("lo", "hi", "hash")))
        grown = (below.groupBy("gn", "g", "n", F.expr(f"lo div {fanout ** level}").alias("bucket")).agg(kids.alias("kids"))
                 .select("gn", "g", "n", "bucket", F.col("kids")[0]["lo"].alias("lo"), F.element_at("kids", -1)["hi"].alias("hi"),
                         F.sha2(F.array_join("kids.hash", ""), 256).alias("hash"), "kids"))
        nodes = C.stage(grown, f"{label}-{level}")
        found.append(nodes)
    return found


def _tops(leaves: DataFrame, levels: list[DataFrame], fanout: int) -> DataFrame:
    """(gn, g, hash): each group's last node."""
    out = leaves.where("n = 1").select("gn", "g", "hash")
    for level, nodes in enumerate(levels, 1):
        out = out.union(nodes.where(F.col("n") <= fanout ** level).select("gn", "g", "hash"))
    return out


_PATH = "array<struct<left:string,right:string>>"


def _attach(leaves: DataFrame, levels: list[DataFrame], tops: DataFrame, fanout: int, label: str) -> DataFrame:
    """``leaves`` with ``path``, the digests left and right of the way up at
    each level, then that of the group's last node (``above``), and with the
    other columns of ``tops`` (gn, g, above, ...)."""
    carried = [c for c in tops.columns if c not in ("gn", "g", "above")]

    def under(nodes: DataFrame, keep: list, level: int, parents: DataFrame | None) -> DataFrame:
        last = nodes.where(F.col("n") <= fanout ** level).join(tops, ["gn", "g"]).select(*keep, *carried, F.col("above").alias("path"))
        if parents is None:
            return last
        p = parents.select("gn", "g", "bucket", F.col("lo").alias("_lo"), F.col("hi").alias("_hi"), F.col("kids").alias("_kids"),
                           *carried, F.col("path").alias("_path"))
        c = nodes.where(F.col("n") > fanout ** level).withColumn("_b", F.expr(f"lo div {fanout ** (level + 1)}"))
        hi = c["hi"] if "hi" in c.columns else c["lo"] + 1
        met = c.join(p, (c["gn"] == p["gn"]) & (c["g"] == p["g"]) & (c["_b"] == p["bucket"]) & (p["_lo"] <= c["lo"]) & (hi <= p["_hi"]))

        def side(test):
            return F.array_join(F.transform(F.filter("_kids", test), lambda k: k["hash"]), "")
        step = F.struct(side(lambda k: k["hi"] <= c["lo"]).alias("left"), side(lambda k: k["lo"] >= hi).alias("right"))
        met = met.select(*[c[k].alias(k) for k in keep], *carried, F.concat(F.array(step), "_path").alias("path"))
        return met.unionByName(last)
    parents = None
    for level in range(len(levels), 0, -1):
        parents = C.stage(under(levels[level - 1], ["gn", "g", "n", "bucket", "lo", "hi", "kids"], level, parents), f"{label}-{level}")
    return under(leaves, [c for c in leaves.columns if c not in ("gn", "g", "n", "lo")], 0, parents)


def manifest(rows: DataFrame, group: Column, order: list[Column], leaf: Column, keep: dict[str, Column] | None = None,
             fanout: int = FANOUT) -> DataFrame:
    """One row per row of ``rows``: the columns of ``keep``, ``leaf``,
    ``subroot`` (its group's last node), ``root`` and ``path`` (left and right
    siblings, from the leaf to the root)."""
    kept = dict(keep or {})
    names = {k: f"k{i}" for i, k in enumerate(kept)}
    sort = {f"o{i}": c for i, c in enumerate(order)}
    g = group.cast("string")
    base = C.stage(rows.select(g.isNull().alias("gn"), F.coalesce(g, F.lit("")).alias("g"), leaf.alias("hash"),
                               *[c.alias(k) for k, c in sort.items()], *[c.alias(names[k]) for k, c in kept.items()]), "merkle-leaves")
    leaves = _ranked(base, [*map(F.col, sort), F.col("hash")], "merkle").drop(*sort)
    levels = _climb(leaves, fanout, "merkle-level")
    groups = C.stage(_tops(leaves, levels, fanout), "merkle-groups")
    # The groups are the leaves of the last tree, whose only group is this one.
    only = {"gn": F.lit(False), "g": F.lit("")}
    heads = groups.select(F.col("gn").alias("o0"), F.col("g").alias("o1"), "hash").withColumns(only)
    heads = _ranked(heads, [F.desc("o0"), F.col("o1")], "merkle-root")
    crown = _climb(heads, fanout, "merkle-crown")
    root = _tops(heads, crown, fanout).select("gn", "g", F.col("hash").alias("root"), F.expr(f"cast(array() as {_PATH})").alias("above"))
    tops = C.stage(_attach(heads, crown, root, fanout, "merkle-crown-path").select(
        F.col("o0").alias("gn"), F.col("o1").alias("g"), F.col("hash").alias("subroot"), "root", F.col("path").alias("above")), "merkle-tops")
    found = _attach(leaves, levels, tops, fanout, "merkle-path")
    return found.select(*[F.col(n).alias(k) for k, n in names.items()], F.col("hash").alias("leaf"), "subroot", "root", "path")


def proof(path: Column) -> Column:
    """SHA-256 of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), ""), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` and its siblings give."""
    return F.aggregate(path, leaf, lambda h, p: F.sha2(F.concat(p["left"], h, p["right"]), 256))
