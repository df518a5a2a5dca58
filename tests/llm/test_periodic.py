"""Periodic runs against a direct search for every period."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import periodic_runs as P
from tessera.llm import queries

from helpers import docs


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0d]+", text or "")


def runs_of(w):
    """(start, length, smallest period) of every run."""
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            if w[i] == w[i + q]:
                j = i
                while j + q < len(w) and w[j] == w[j + q]:
                    j += 1
                if j + q - i >= max(6, 4 * q):
                    found.setdefault((i, j + q - i), q)
                i = j
            i += 1
    return sorted((a, n, q) for (a, n), q in found.items())


def collapsed_of(w, runs):
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def ordered(runs):
    return sorted(runs, key=lambda r: (r[0], r[2]))


def tail_of(doc_id, w):
    if doc_id is None or not w or (h := zlib.crc32(str(doc_id).encode())) % 10:
        return w
    g = h // 10
    a = g % len(w)
    p = 1 + (len(w) - a) // (3 + g % 8)
    return w[:a] + [w[a + (i - a) % p] for i in range(a, len(w))]


def test_random_words_with_planted_periods():
    rng = np.random.default_rng(11)
    for _ in range(150):
        texts = []
        for _ in range(int(rng.integers(0, 6))):
            n = int(rng.integers(0, 130))
            w = rng.integers(0, int(rng.integers(1, 7)), n)
            for _ in range(int(rng.integers(0, 4))):
                if n > 8:
                    a = int(rng.integers(0, n - 4))
                    p, e = int(rng.integers(1, max(2, (n - a) // 3))), int(rng.integers(a, n + 1))
                    for i in range(a + p, e):
                        w[i] = w[i - p]
            texts.append(w)
        starts = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)]).astype(np.int64)
        flat = np.concatenate([np.zeros(0, np.uint64), *[t.astype(np.uint64) for t in texts]])
        a, b, d = P.find_runs(flat, starts)
        want = [(x + s, n, q) for t, s in zip(texts, starts.tolist()) for x, n, q in ordered(runs_of(t.tolist()))]
        assert list(zip(a.tolist(), (b - a).tolist(), d.tolist())) == want


@pytest.mark.parametrize("n", [1, 2, 7, 64, 300])
def test_wavelet_tree_successor(n):
    rng = np.random.default_rng(n)
    values = rng.permutation(n)
    tree = P.WaveletTree(values.astype(np.int32))
    lo = rng.integers(0, n + 1, 200)
    hi = np.minimum(n, lo + rng.integers(0, n + 1, 200))
    x = rng.integers(0, n, 200)
    want = [min((int(v) for v in values[a:b] if v > y), default=n) for a, b, y in zip(lo, hi, x)]
    assert tree.successor(lo, hi, x).tolist() == want


def test_texts_of_all_kinds(spark):
    long = " ".join(f"w{i}" for i in range(3000)) + " " + "x y z " * 4000 + "end"
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a"), (5, "a " * 6), (6, "a " * 5), (7, "  a b\ta b\na b  a b  tail "), (8, long), (8, long),
            (None, "na na na na na na na na"), (9, "ä b " * 4 + "ä b ä b"), (10, "a b a b a b a c a c a c a c")]
    frame = docs(spark, [(i, t, "k", None) for i, t in rows], ", runs string, collapsed string")
    found = P.periodic_runs(frame, F.col("text"), {"doc_id": F.col("doc_id"), "collapsed text": F.col("runs")})
    assert found.columns == ["doc_id", "collapsed text", "runs", "collapsed"]
    got = sorted(((r["doc_id"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in found.collect()), key=str)
    want = []
    for i, t in rows:
        runs = ordered(runs_of(words_of(t))) if t != long else [(3000, 12000, 3)]
        want.append((i, runs, collapsed_of(words_of(t), runs)))
    assert got == sorted(want, key=str)


def test_empty_table_and_strongest(spark):
    none = docs(spark, [])
    assert P.periodic_runs(none, F.col("text"), {"doc_id": F.col("doc_id")}).collect() == []
    row = spark.sql("""select array(named_struct('start', 9L, 'length', 8L, 'period', 2L), named_struct('start', 1L, 'length', 4L, 'period', 1L),
        named_struct('start', 2L, 'length', 12L, 'period', 3L)) as runs, cast(array() as array<struct<start:bigint,length:bigint,period:bigint>>) as none""")
    best = row.select(P.strongest(F.sort_array("runs")).alias("x"), P.strongest(F.col("none")).alias("y")).first()
    assert tuple(best["x"]) == (1, 4, 1) and best["y"] is None
    with pytest.raises(ValueError):
        P.find_runs(np.zeros(9, np.uint64), np.array([0, 9]), periods=3)


def test_op11_matches_a_direct_search(spark, tmp_path):
    """Every document of the small table with fewer than 400 words, and odd rows."""
    rng = np.random.default_rng(2)
    rows = [(i, " ".join(rng.choice(["a", "b", "c", "d"], int(rng.integers(0, 90))))) for i in range(300)]
    rows += [(1000, None), (1001, ""), (None, "x " * 9), (5, "again"), (5, "again")]
    docs(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((tuple(r) for r in queries.QUERIES["op11_periodic_runs"](spark, str(tmp_path)).collect()), key=str)
    want = []
    for i, t in rows:
        w = tail_of(i, words_of(t))
        runs = ordered(runs_of(w))
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
        lines = "".join(f"{a},{n},{q}\n" for a, n, q in runs)
        want.append((i, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
                     hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapsed_of(w, runs).encode()).hexdigest()))
    assert got == sorted(want, key=str)
