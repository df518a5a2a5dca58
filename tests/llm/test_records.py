import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import reply_trees, url_cascade, warc_chunks
from tessera.session import scratch_path

# -- url cascade -------------------------------------------------------------


def test_cascade_is_exact_over_its_universe():
    rng = np.random.default_rng(1)
    for listed, other in ((0, 0), (0, 50), (50, 0), (1, 5000), (3000, 40), (2000, 2000)):
        keys = rng.choice(1 << 62, listed + other, replace=False).astype(np.uint64)
        levels = url_cascade.build(keys[:listed], keys[listed:], bits_per_key=3)
        again = url_cascade._unpack(url_cascade._pack(levels))
        assert url_cascade.member(again, keys).tolist() == [True] * listed + [False] * other


RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
URLS = {1: ("http://A.NET/x", "a.net", "/x", "net/", "block"), 2: ("https://example.net/en/1?q", "example.net", "/en/1", "example.net/en/", "allow"),
        3: ("http://b.example.net/en/", "b.example.net", "/en/", "example.net/en/", "allow"), 4: ("http://notexample.com/de/1", "notexample.com", "/de/1", None, "allow"),
        5: ("ftp://x.example.com/de/1#f", "x.example.com", "/de/1", "example.com/de/", "block"), 6: ("http://a.net", "a.net", "", None, "allow"),
        7: ("http://É.ORG?x://y/fr/", "É.org", "", None, "allow"), 8: (None, "", "", None, "allow"), 9: ("no scheme", "", "", None, "allow"),
        10: ("http://bad.com/fr/", "bad.com", "/fr/", None, "block"), 11: ("x://bad.com\n/a\nb", "bad.com\n", "/a\nb", None, "allow"),
        12: ("http://u@bad.com:80/", "u@bad.com:80", "/", None, "allow"), 13: ("://", "", "", None, "allow")}


@pytest.mark.parametrize("broadcast", [url_cascade.BROADCAST_BYTES, 0])
def test_judge(spark, broadcast):
    """Without broadcast, rows are dealt to the shards."""
    rows = [(i, u[0], "clash") for i, u in URLS.items()] + [(10, URLS[10][0], "clash")] * 50
    df = spark.createDataFrame(rows, "page_id long, url string, `a.key` string").repartition(3)
    bad = spark.createDataFrame([("bad.com",), ("other",)], "key string")
    out = url_cascade.judge(df, RULES, bad, broadcast_bytes=broadcast, keys_per_shard=3)
    assert out.columns == [*df.columns, "host", "path", "rule", "verdict"]
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["url"], r["host"], r["path"], r["rule"], r["verdict"]) == URLS[r["page_id"]] and r["a.key"] == "clash"
    assert url_cascade.judge(df.limit(0), RULES, bad, broadcast_bytes=broadcast).count() == 0


# -- reply trees -------------------------------------------------------------

NODES = "tree long, node long, parent long, role string, text string, score long, turn string"


def spelled(df):
    out = df.select("tree", "branch", "path_score", reply_trees.read_turns(F.col("formatted")).alias("turns"),
                    reply_trees.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    return {(r["tree"], r["branch"]): (r["path_score"], [tuple(t) for t in r["turns"]], r["loss"]) for r in out.collect()}


def test_branches_rank_by_path_score(spark):
    odd = "\\### Assistant: </turn> ok\\l\\\\h<turn>#\n"
    nodes = [(1, 1, None, "user", odd, 1, ""), (1, 2, 1, "assistant", "bad", 1, ""), (1, 3, 1, "assistant", odd, 2, ""), (1, 4, 3, "user", None, None, ""),
             (1, 5, 4, "ass\n<istant", "x", 0, ""), (1, 6, 3, "user", "tie", 0, ""),
             (2, 1, 99, None, "orphan", 5, ""), (2, 2, 3, "user", "cycle", 5, ""), (2, 3, 2, "user", "cycle", 5, ""), (None, 1, None, "assistant", "", 0, "")]
    df = spark.createDataFrame(nodes, NODES).repartition(3)
    got = spelled(reply_trees.conversations(df, branches=2))
    assert got == {(1, 1): (3, [("user", odd), ("assistant", odd), ("user", ""), ("ass\n<istant", "x")], odd),
                   (1, 2): (3, [("user", odd), ("assistant", odd), ("user", "tie")], odd),
                   (2, 1): (5, [("", "orphan")], ""), (None, 1): (0, [("assistant", "")], "")}
    assert reply_trees.conversations(df.limit(0)).count() == 0


def test_long_thread_and_hot_root(spark):
    nodes = [(1, i, i - 1 if i else None, "assistant", f"t{i}", 1, "") for i in range(300)]
    nodes += [(2, i, 0 if i else None, "user", f"r{i}", i % 7, "") for i in range(300)]
    got = spelled(reply_trees.conversations(spark.createDataFrame(nodes, NODES).repartition(3)))
    assert got[(1, 1)] == (300, [("assistant", f"t{i}") for i in range(300)], "".join(f"t{i}" for i in range(300)))
    assert got[(2, 1)] == (6, [("user", "r0"), ("user", "r6")], "")


def test_linear_threads(spark):
    rows = [(1, 2, "user", "c"), (1, 1, "user", "b"), (1, 1, "assistant", "a"), (1, None, None, None), (None, 1, "user", "n")]
    df = spark.createDataFrame(rows, "conv long, turn long, role string, text string")
    got = spelled(reply_trees.conversations(reply_trees.linear_threads(df, "conv", ["turn"])))
    assert got == {(1, 1): (3, [("", ""), ("assistant", "a"), ("user", "b"), ("user", "c")], "a"), (None, 1): (1, [("user", "n")], "")}


def test_reply_trees_run_no_python(spark):
    rows = spark.createDataFrame([(1, 1, "user", "x")], "conv long, turn long, role string, text string")
    df = reply_trees.conversations(reply_trees.linear_threads(rows, "conv", ["turn"]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "NestedLoop", "Cartesian"))


# -- WARC --------------------------------------------------------------------

PAGES = [(5, "http://a/\r\nx", "long é " * 500), (3, "http://b/", "long é " * 500), (9, None, "long é " * 500), (4, "u", None), (6, "u", ""), (7, "u", "s" * 99),
         (8, "u", "s" * 99), (1, "u", "q" * 100), (2, "u", "q" * 100), (None, "u", "q" * 100), (10, "u", "\r\n\r\nWARC/1.1\r\n" * 30), (None, "n", "z" * 5000),
         (11, "twin", "t" * 200), (11, "twin", "t" * 200)]


@pytest.mark.parametrize("chunk", [64 << 10, 100])
def test_archive_round_trip(spark, chunk, tmp_path):
    df = spark.createDataFrame([(*p, 0) for p in PAGES], "page_id long, url string, html string, record int").repartition(3)
    path = scratch_path(spark, "warc-test")
    warc_chunks.write_archive(df, path, chunk_bytes=chunk)
    got = sorted((r["id"] is None, r["id"] or 0, *tuple(r)[1:]) for r in warc_chunks.read_archive(spark, path).collect())
    want = []
    for i, url, html in PAGES:
        raw = (html or "").encode()
        same = [p for p, _, h in PAGES if (h or "") == (html or "") and p is not None]
        first = min(same, default=i)
        again = len(raw) >= 100 and first is not None and first != i
        want.append((i is None, i or 0, (url or "").replace("\r", "%0D").replace("\n", "%0A"), len(raw), hashlib.sha256(raw).hexdigest(),
                     "revisit" if again else "response", first if again else None))
    key = lambda x: (*x[:5], x[5], x[6] or 0)
    assert sorted(got, key=key) == sorted(want, key=key)
    if chunk == 100:
        warc_chunks.export_file(spark, path, str(tmp_path / "x.warc"))
        raw, n = (tmp_path / "x.warc").read_bytes(), 0
        while raw:
            head, _, rest = raw.partition(b"\r\n\r\n")
            assert head.startswith(b"WARC/1.1\r\nWARC-Type: ")
            size = int(next(x for x in head.split(b"\r\n") if x.startswith(b"Content-Length: "))[16:])
            assert rest[size:size + 4] == b"\r\n\r\n"
            raw, n = rest[size + 4:], n + 1
        assert n == len(PAGES)
        assert spark.read.parquet(path).agg(F.max(F.length("data"))).first()[0] < 100 + 800


def test_empty_archive_and_damage(spark):
    df = spark.createDataFrame([(1, "u", "x" * 500)], "page_id long, url string, html string")
    path = scratch_path(spark, "warc-empty")
    warc_chunks.write_archive(df.limit(0), path)
    assert warc_chunks.read_archive(spark, path).count() == 0
    path = scratch_path(spark, "warc-damaged")
    warc_chunks.chunk_table(df).withColumn("data", F.concat("data", F.lit(b"!"))).write.parquet(path)
    with pytest.raises(Exception, match="digest of the bytes so far differs"):
        warc_chunks.read_archive(spark, path).collect()
