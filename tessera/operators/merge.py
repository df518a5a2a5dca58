"""Merge: a main resource with its reference resources and targets."""

from __future__ import annotations

from collections import deque
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.sizing import free_name, qcol, stage


@dataclass
class Relation:
    """One referenced resource: ``df`` joins where ``left_key`` (a column of
    the merged-so-far table) equals ``right_key`` (a column of ``df``).

    The join strategy is left to Spark's own size checks
    (``autoBroadcastJoinThreshold`` on the scan estimate, and AQE on runtime
    sizes)."""
    name: str
    df: DataFrame
    left_key: str
    right_key: str


@dataclass
class Reference:
    """``column`` of a resource holds values of ``key`` of ``resource``."""
    column: str
    resource: str
    key: str


def relations_of(main: str, frames: dict[str, DataFrame], references: dict[str, list[Reference]]) -> list[Relation]:
    """The relations that merge all resources that ``main`` refers to, on
    any way, each after the one that refers to it, nearest first.

    A resource that is reached on two ways (the nation of the customer and
    that of the supplier) is joined once for each, the later ones named by
    the column that refers to it. References that lead back to a resource on
    their own way are an error, as are unknown resources and columns.
    """
    def known(name, col):
        if name not in frames:
            raise ValueError(f"unknown resource {name!r}")
        if col not in frames[name].columns:
            raise ValueError(f"resource {name!r} has no column {col!r}")

    out: list[Relation] = []
    todo = deque([(main, {c: c for c in frames[main].columns}, (main,))])
    while todo:
        owner, merged, way = todo.popleft()
        for ref in references.get(owner, []):
            known(owner, ref.column)
            known(ref.resource, ref.key)
            if ref.resource in way:
                raise ValueError("references in a circle: " + " -> ".join([*way, ref.resource]))
            name = free_name({main, *(r.name for r in out)}, ref.resource, ref.column)
            out.append(Relation(name, frames[ref.resource], merged[ref.column], ref.key))
            names = _final_names(frames[main], out)[name]
            todo.append((ref.resource, {**names, ref.key: merged[ref.column]}, (*way, ref.resource)))
    return out


def _final_names(main: DataFrame, relations: list[Relation]) -> dict[str, dict[str, str]]:
    """Column names each resource contributes, as a left-to-right merge
    would name them: a name already taken gets the resource name as
    prefix, again until it is free; the resource key is dropped."""
    taken = set(main.columns)
    out = {}
    for rel in relations:
        names = {}
        for c in rel.df.columns:
            if c == rel.right_key:
                continue
            names[c] = free_name(taken, c, rel.name)
            taken.add(names[c])
        out[rel.name] = names
    return out


def star_merge(main: DataFrame, relations: list[Relation]) -> DataFrame:
    """Left-join each resource onto the main table into one flat table.

    Main rows are never lost. A clashing column name gets the resource name
    as prefix; the resource's key column is dropped (it equals the left key
    when matched). The result equals joining the resources one after the
    other, but a resource keyed by another resource's column (a snowflake
    arm: customer by the order's customer key) is joined onto that resource
    first - left joins on equality keys associate - so the large main table
    is shuffled once per arm, not once per resource. Spark's own size checks
    pick the join (AQE splits skew).
    """
    names = _final_names(main, relations)
    owner = {}  # relation -> the relation whose column is its left key (None: main)
    for i, rel in enumerate(relations):
        if rel.left_key in main.columns:
            owner[rel.name] = None
            continue
        src = [r.name for r in relations[:i] if rel.left_key in names[r.name].values()]
        if not src:
            raise ValueError(f"left key {rel.left_key!r} of {rel.name!r} is not a merged column")
        owner[rel.name] = src[-1]
    by_name = {r.name: r for r in relations}

    def side(rel: Relation) -> DataFrame:
        df = rel.df.select(qcol(rel.right_key).alias(f"__rk_{rel.name}"),
                           *[qcol(c).alias(n) for c, n in names[rel.name].items()])
        for child in relations:  # children in the given order
            if owner[child.name] == rel.name:
                df = _join(df, child, side(child))
        return df

    merged = main
    for rel in relations:
        if owner[rel.name] is None:
            merged = _join(merged, rel, side(rel))
    order = list(main.columns) + [n for r in relations for n in names[r.name].values()]
    return merged.select(*[qcol(c) for c in order])


def _join(left: DataFrame, rel: Relation, right: DataFrame) -> DataFrame:
    rk = f"__rk_{rel.name}"
    return left.join(right, qcol(rel.left_key) == F.col(rk), "left").drop(rk)


def merge_train_target(features: DataFrame, targets: DataFrame, key: str) -> DataFrame:
    """Features left-joined to targets by row key, with a ``has_target`` flag.
    A target column whose name a feature has is prefixed with ``target``.
    Two target rows of one key give two rows; ``merge_audit`` reports them."""
    taken, cols = {*features.columns}, []
    for c in targets.columns:
        name = c if c == key else free_name(taken, c, "target")
        taken.add(name)
        cols.append(qcol(c).alias(name))
    flag, hit = free_name(taken, "has_target", "target"), free_name(taken, "__hit", "_")
    side = targets.select(*cols, F.lit(True).alias(hit))
    return features.join(side, key, "left").withColumn(flag, F.coalesce(F.col(hit), F.lit(False))).drop(hit)


def merge_audit(main: DataFrame, relations: list[Relation]) -> DataFrame:
    """Per relation: left rows, unmatched left rows, duplicated resource keys
    and the extra rows a fan-out would add. A null key matches nothing and
    duplicates nothing.

    The main table is read once: it is reduced to its different combinations
    of the keys that relations need, with their number of rows. Merging a
    relation then moves these weighted combinations on (fan-out multiplies
    their rows) to the keys still needed. A hot key is one row with a large
    weight, so no step's work depends on how often a key occurs.
    """
    names = _final_names(main, relations)

    def needed(cols, later):
        return [c for c in dict.fromkeys(r.left_key for r in later) if c in cols]

    have = needed(main.columns, relations)
    state = stage(main.groupBy(*[qcol(c) for c in have]).agg(F.count(F.lit(1)).alias("__w")), "audit")
    parts = []
    for i, rel in enumerate(relations):
        keys = rel.df.where(qcol(rel.right_key).isNotNull()).groupBy(qcol(rel.right_key).alias("__k")).agg(F.count(F.lit(1)).alias("__cnt"))
        n_dup = keys.where(F.col("__cnt") > 1).agg(F.count(F.lit(1))).scalar()
        left = state.groupBy(qcol(rel.left_key).alias("__lk")).agg(F.sum("__w").alias("__w"))
        joined = left.join(keys, F.col("__lk") == F.col("__k"), "left")
        w = F.col("__w")
        total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
        parts.append(joined.agg(
            F.lit(rel.name).alias("relation"),
            total(w).alias("n_left_rows"),
            total(F.when(F.col("__cnt").isNull(), w)).alias("n_unmatched"),
            n_dup.cast("bigint").alias("n_dup_keys"),
            total(w * F.greatest(F.col("__cnt") - 1, F.lit(0))).alias("n_fanout_rows"),
        ))
        later = relations[i + 1:]
        if later:
            mine = {n: c for c, n in names[rel.name].items()}
            new = needed(list(mine), later)
            side = rel.df.select(qcol(rel.right_key).alias("__k"), *[qcol(mine[n]).alias(n) for n in new])
            side = side.groupBy("__k", *[qcol(n) for n in new]).agg(F.count(F.lit(1)).alias("__c"))
            have = needed([*have, *new], later)
            state = stage(state.join(side, qcol(rel.left_key) == F.col("__k"), "left")
                          .groupBy(*[qcol(c) for c in have]).agg(F.sum(F.col("__w") * F.coalesce("__c", F.lit(1))).alias("__w")), "audit")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def fallback_source(spark, merged_path: str, original: DataFrame, fmt: str = "parquet") -> DataFrame:
    """Use the merged table when it exists, else the original; tag the source.

    "Exists" is a finished write: the folder with the ``_SUCCESS`` marker
    that the writer leaves last. A folder without it is a write that failed,
    which is an error and never a reason to use the original unseen.
    """
    if merged_path:
        jvm = spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(merged_path)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if fs.exists(path):
            if not fs.exists(jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")):
                raise FileNotFoundError(f"{merged_path} holds no finished write (_SUCCESS is missing)")
            return spark.read.format(fmt).load(merged_path).withColumn("resolved_from", F.lit("merged"))
    return original.withColumn("resolved_from", F.lit("original"))
