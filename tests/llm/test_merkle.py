"""The manifest's trees and proofs against a plain build."""

import hashlib

from pyspark.sql import functions as F

from tessera.llm import merkle_manifest as M


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain(digests, fanout):
    """Last node, and each leaf's (left, right) siblings on the way up."""
    ways, nodes = [[] for _ in digests], [(h, [i]) for i, h in enumerate(digests)]
    while len(nodes) > 1:
        above = []
        for i in range(0, len(nodes), fanout):
            run = nodes[i:i + fanout]
            for k, (_, under) in enumerate(run):
                for x in under:
                    ways[x].append(("".join(h for h, _ in run[:k]), "".join(h for h, _ in run[k + 1:])))
            above.append((sha("".join(h for h, _ in run)), [x for _, under in run for x in under]))
        nodes = above
    return nodes[0][0], ways


def expected(rows, fanout):
    """{(group, order, text): set of (leaf, subroot, root, proof)}"""
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    names = sorted(by, key=lambda g: (g is not None, (g or "").encode()))
    built = []
    for g in names:
        own = sorted(by[g], key=lambda r: (r[1] is not None, r[1] or 0, leaf_of(r)))
        built.append((own, *plain([leaf_of(r) for r in own], fanout)))
    root, crown = plain([b[1] for b in built], fanout)
    out = []
    for (own, subroot, ways), up in zip(built, crown):
        for r, way in zip(own, ways):
            out.append((r[1], leaf_of(r), subroot, root, sha("".join(a + b for a, b in way + up))))
    return sorted(out, key=str)


def build(frame, fanout):
    cols = [F.col(c) for c in ("lang", "id", "text")]
    return M.manifest(frame, cols[0], [cols[1]], M.digest(cols), {"id": cols[1], "bad": F.when(F.col("id") % 2 == 0, M.digest([*cols[:2], F.lit("no")]))}, fanout)


def check(spark, rows, fanout):
    frame = spark.createDataFrame(rows, "lang string, id long, text string").repartition(3)
    found = build(frame, fanout)
    got = found.select("id", "leaf", "subroot", "root", M.proof(F.col("path")).alias("proof"), M.fold(F.col("leaf"), F.col("path")).alias("own"),
                       M.fold(F.col("bad"), F.col("path")).alias("other"), "bad").collect()
    assert sorted(((r["id"], r["leaf"], r["subroot"], r["root"], r["proof"]) for r in got), key=str) == expected(rows, fanout)
    assert all(r["own"] == r["root"] for r in got)
    assert all(r["other"] != r["root"] for r in got if r["bad"] is not None and r["bad"] != r["leaf"])


def test_groups_of_all_sizes(spark):
    """A group with most rows, null and empty groups, groups of one row, ties,
    repeated rows, null ids and texts, a long text."""
    rows = [("en", i, f"text {i}") for i in range(75)] + [(None, i, "n") for i in range(9)] + [("", 1, "empty"), ("é", 2, None), ("z", 8, "x" * 50000)]
    rows += [("de", 1, "a"), ("de", 1, "b"), ("de", 1, "b"), ("de", None, ""), ("de", None, None), ("fr", -5, "f"), ("fr", 5, "g")]
    rows += [(f"lang{i}", i, "one") for i in range(12)]
    check(spark, rows, 8)
    check(spark, rows, 3)


def test_small_tables(spark):
    check(spark, [("en", 1, "alone")], 8)
    check(spark, [("en", i, None) for i in range(8)], 8)
    check(spark, [("en", i, None) for i in range(9)], 8)
    none = spark.createDataFrame([], "lang string, id long, text string")
    assert build(none, 8).collect() == []


def test_columns_with_clashing_names(spark):
    frame = spark.createDataFrame([("en", i, "t", 1, "x", "y") for i in range(20)], "lang string, id long, text string, lo int, `gn` string, `a.b` string")
    cols = [F.col("lang"), F.col("id"), F.col("text")]
    found = M.manifest(frame, cols[0], [cols[1]], M.digest(cols), {"lo": F.col("lo"), "path.x": F.col("`a.b`")})
    assert found.columns == ["lo", "path.x", "leaf", "subroot", "root", "path"]
    assert found.where("lo = 1").count() == 20


def test_no_group_is_gathered(spark):
    """A level's joins are on buckets of eight, not on groups."""
    from tessera.llm import common as C
    frame = spark.range(5000).selectExpr("'en' as lang", "id", "cast(id as string) as text")
    keys, stage = [], C.stage

    def watch(df, label):
        if label.startswith("merkle-level"):
            keys.append(max(len(r["kids"]) for r in df.collect()))
        return stage(df, label)
    C.stage = watch
    try:
        build(frame, 8)
    finally:
        C.stage = stage
    assert len(keys) == 5 and max(keys) == 8
