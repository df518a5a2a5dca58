import math
import random

import numpy as np
import pytest

from tessera.llm import kmeans_tree, no_random_access

SCHEMA = "vec_id long, embedding array<float>, rank int"


def rows(seed, n=700, d=8):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, d)).astype(np.float32)
    v[50:300] = v[7]  # one vector holds a third of the rows
    return [(int(i) * 5, [float(x) for x in r], 0) for i, r in enumerate(v)]


BAD = [(9000, None, 0), (9050, [0.0] * 8, 0), (9100, [1.0, None] + [0.0] * 6, 0), (9150, [float("nan")] * 8, 0),
       (9200, [float("inf")] + [1.0] * 7, 0), (9250, [1.0] * 3, 0), (None, [1.0] * 8, 0), (9300, [], 0)]


def test_tree_finds_neighbours(spark):
    data = rows(1)
    df = spark.createDataFrame(data + BAD, SCHEMA).repartition(3)
    queries = df.where("vec_id % 50 = 0")
    got = kmeans_tree.nearest(df, queries, 5, sample_rows=300, branches=4, leaf_rows=8, chunk_rows=64, recall=0.95).collect()
    by = {}
    for r in got:
        by.setdefault(r["query_id"], []).append(r)
    ids, v = np.array([r[0] for r in data]), np.array([r[1] for r in data], np.float32).astype(np.float64)
    norm = np.sqrt((v * v).sum(1))
    hit = 0
    asked = [i for i in range(len(ids)) if ids[i] % 50 == 0]
    assert set(by) == {int(ids[i]) for i in asked}
    for i in asked:
        s = (v @ v[i]) / (norm * norm[i])
        found = sorted(by[int(ids[i])], key=lambda r: r["rank"])
        assert [r["rank"] for r in found] == [1, 2, 3, 4, 5] and int(ids[i]) not in [r["vec_id"] for r in found]
        assert all(abs(s[r["vec_id"] // 5] - r["score"]) < 1e-12 for r in found)
        assert [(-r["score"], r["vec_id"]) for r in found] == sorted((-r["score"], r["vec_id"]) for r in found)
        s[i] = -2
        best = np.lexsort((ids, -np.round(s, 12)))[:5]
        hit += len({int(ids[b]) for b in best} & {r["vec_id"] for r in found})
        if 50 <= i < 300:  # ties go to the least ids
            assert [r["vec_id"] for r in found] == [x for x in [35, *range(250, 300, 5)] if x != ids[i]][:5]
    assert hit >= 0.9 * 5 * len(asked)


def test_tree_small_tables(spark):
    df = spark.createDataFrame([(0, [1e-200, 0.0], 0), (1, [1e200, 0.0], 0), (50, [0.0, 1.0], 0)], "vec_id long, embedding array<double>, rank int")
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in kmeans_tree.nearest(df, df.where("vec_id % 50 = 0"), 5).collect()}
    assert got == {(0, 1): (1, 1.0), (0, 2): (50, 0.0), (50, 1): (0, 0.0), (50, 2): (1, 0.0)}
    empty = spark.createDataFrame([], SCHEMA)
    assert kmeans_tree.nearest(empty, empty, 5).collect() == []


def test_best_bins_are_in_order_of_distance():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 4))
    tree = kmeans_tree.Tree(x, 4, 10)
    order = tree.best_bins(x[0], tree.leaves)
    assert sorted(order) == list(range(tree.leaves)) and tree.best_bins(x[0], 3) == order[:3]


def brute_products(data, k):
    usable = [(i, np.floor(256 * np.array(v, np.float64)).astype(np.int64)) for i, v, _ in data]
    out = {}
    for i, q in usable:
        if i % 50 == 0:
            best = sorted((-int(q @ v), j) for j, v in usable if j != i)[:k]
            out[i] = [(n + 1, j, -s) for n, (s, j) in enumerate(best)]
    return out


@pytest.mark.parametrize("block,queries", [(4096, 2048), (100, 7)])
def test_top_products_are_exact(spark, block, queries):
    data = [(i, [float(np.float32(x)) for x in v], r) for i, v, r in rows(2)]
    df = spark.createDataFrame(data + BAD[:1] + BAD[2:], SCHEMA).repartition(3)
    got = {}
    for r in no_random_access.top_products(df, df.where("vec_id % 50 = 0"), 5, block_rows=block, query_rows=queries).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert {q: sorted(v) for q, v in got.items()} == brute_products(data, 5)


def test_top_products_small_tables(spark):
    df = spark.createDataFrame([(0, [1.0], 0), (50, [0.0], 0)], SCHEMA)
    got = [tuple(r) for r in no_random_access.top_products(df, df.where("vec_id % 50 = 0"), 5).orderBy("query_id").collect()]
    assert got == [(0, 1, 50, 0), (50, 1, 0, 0)]
    assert no_random_access.top_products(df.limit(0), df.limit(0), 5).collect() == []


@pytest.mark.parametrize("scale", [1, 1 << 20])
def test_bounds_never_lose_a_row(scale):
    """Small numbers in single precision, large ones in double with slack."""
    rng = np.random.default_rng(5)
    v = rng.integers(-300, 300, size=(3000, 6)) * scale
    v[7] = 5000 * scale  # far ahead: the bar is high after the first entries
    v[100:900] = v[3]
    lists = no_random_access.SortedLists(np.arange(3000), v)
    q = rng.integers(-200, 200, size=(40, 6))
    q[0] = 0
    want = [sorted((-int(s), i) for i, s in enumerate(v @ x) if i != n)[:4] for n, x in enumerate(q)]
    for bars in (None, np.array([-w[3][0] for w in want], float)):
        got = lists.top(np.arange(40), q, 4, bars)
        assert [[(-int(s), int(i)) for i, s in zip(*g)] for g in got] == want


def test_random_seed_is_fixed():
    x = np.random.default_rng(random.Random(1).randint(0, 9)).normal(size=(200, 3))
    a, b = kmeans_tree.Tree(x, 4, 10), kmeans_tree.Tree(x, 4, 10)
    assert (a.centres == b.centres).all()


@pytest.mark.parametrize("far", [float(1 << 20), float(1 << 40), -float(1 << 41)])
def test_large_components_take_part(spark, far):
    """Whatever fits 64 bits when scaled counts, as in the SQL."""
    data = [(i, [float(np.float32(x)) for x in v], r) for i, v, r in rows(2)] + [(9351, [far, *[0.25] * 7], 0), (9352, [far] * 8, 0)]
    df = spark.createDataFrame(data, SCHEMA).repartition(3)
    got = {}
    for r in no_random_access.top_products(df, df.where("vec_id % 50 = 0"), 5).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    want = {}
    scaled = {i: [math.floor(256 * x) for x in v] for i, v, _ in data}
    for q in (i for i in scaled if i is not None and i % 50 == 0):
        best = sorted((-sum(a * b for a, b in zip(scaled[q], v)), i) for i, v in scaled.items() if i != q)[:5]
        want[q] = [(n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert {q: sorted(v) for q, v in got.items()} == want and any(x[1] > 9350 for v in got.values() for x in v)


def test_scores_beyond_longs():
    v = np.array([[1 << 50, 1 << 50], [1, 2], [-(1 << 50), 3], [1 << 62, -(1 << 62)]], np.int64)
    assert [int(x) for x in no_random_access._products(v, np.array([1 << 20, 1 << 20]))] == [1 << 71, 3 << 20, (3 << 20) - (1 << 70), 0]
    with pytest.raises(OverflowError):
        list(no_random_access.SortedLists(np.arange(4), v).top(np.array([9]), np.array([[1 << 20, 1 << 20]]), 2))


def test_a_best_score_beyond_longs_fails(spark):
    """A finite component takes part however large it is."""
    df = spark.createDataFrame([(i, v, r) for i, v, r in rows(2)] + [(9350, [1e30] * 8, 0)], SCHEMA)
    with pytest.raises(Exception, match="passes 64 bits"):
        no_random_access.top_products(df, df.where("vec_id % 50 = 0"), 5).collect()


@pytest.mark.parametrize("far", [1e17, -3e200, 1.7e308])
def test_components_of_any_size_take_part(spark, far):
    """Their scores with zeros fit; where none of the k best passes 64 bits, all is exact."""
    data = [(i, [float(x), 0.0, 1.0], 0) for i, x in [(1, far), (2, 3), (3, 2), (4, 1)]] + [(50, [0.0, 1.0, 2.0], 0), (100, [-1.0 if far > 0 else 1.0, 0.0, 0.0], 0)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int")
    got = [(r["query_id"], r["rank"], r["vec_id"], r["score"])
           for r in no_random_access.top_products(df, df.where("vec_id % 50 = 0"), 3).orderBy("query_id", "rank").collect()]
    small = [(4, -65536), (3, -131072)] if far > 0 else [(2, 196608), (3, 131072), (4, 65536)]
    want = [(50, n + 1, i, 131072) for n, i in enumerate((1, 2, 3))]
    want += [(100, n + 1, *x) for n, x in enumerate([(50, 0), *small] if far > 0 else small)]
    assert got == want


def test_list_entries_read():
    """Where vectors have near neighbours a third of the entries is read and a
    tenth of the rows resolved; independent components are read nearly whole."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 64))
    for spread, share, rest in ((0.1, 0.4, 0.1), (None, 1, 0.5)):
        x = rng.normal(size=(4000, 64)) if spread is None else centres[rng.integers(0, 40, 4000)] + spread * rng.normal(size=(4000, 64))
        v = np.floor(256 * x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.int64)
        lists = no_random_access.SortedLists(np.arange(4000), v, read_cost=1)
        got = list(lists.top(np.arange(20), v[:20], 5))
        for i, (r, s) in enumerate(got):
            scores = v @ v[i]
            scores[i] = -(1 << 40)
            best = np.lexsort((np.arange(4000), -scores))[:5]
            assert (r == best).all() and (s == scores[best]).all()
        assert lists.read < share * 20 * v.size and lists.resolved < rest * 20 * len(v)
        dear = no_random_access.SortedLists(np.arange(4000), v)
        for (r, s), (r2, s2) in zip(got, dear.top(np.arange(20), v[:20], 5)):
            assert (r == r2).all() and (s == s2).all()
        assert dear.read < lists.read and dear.read < 0.6 * 20 * v.size
