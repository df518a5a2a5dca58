import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import common as C
from tessera.llm import minhash_join, suffix_dedup

from helpers import docs, groups, repeats, shingles


def corpus(seed, n=40, alphabet="ab "):
    rng = random.Random(seed)
    blocks = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 90))) for _ in range(12)]
    return ["".join(rng.choice(blocks) for _ in range(rng.randint(0, 6))) for _ in range(n)]


def test_index_matching_statistics():
    rng = random.Random(5)
    for _ in range(60):
        parts = [bytes(rng.choice(b"ab\0\xff") for _ in range(rng.randint(1, 60))) for _ in range(rng.randint(1, 8))]
        parts += parts[:rng.randint(0, 2)]
        offs = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        index = suffix_dedup.RunLengthIndex(np.frombuffer(b"".join(parts), np.uint8), offs)
        got, at = index.matching_statistics(), 0
        suffixes = [(i, j, p[j:]) for i, p in enumerate(parts) for j in range(len(p))]
        for i, p in enumerate(parts):
            for j in range(len(p)):
                best = max((next((k for k in range(min(len(s), len(p) - j)) if s[k] != p[j + k]), min(len(s), len(p) - j))
                            for a, b, s in suffixes if (a, b) != (i, j)), default=0)
                assert got[at + j] == best
            at += len(p) + 1


@pytest.mark.parametrize("max_pieces", [256, 2])
def test_repeats_match_brute_force(spark, max_pieces):
    """``max_pieces`` 2 sends nearly all keys through both ways of splitting."""
    texts = corpus(1) + [None, "", "x" * 300, "é" * 90, "é" * 90, "\0" * 50] + corpus(2, alphabet="é€a")
    rows = list(enumerate(texts))
    found = suffix_dedup.repeated_spans(docs(spark, rows), length=40, seed=16, max_pieces=max_pieces)
    did, th = C.row_identity(F.col("doc_id"), F.col("text"))
    ids = docs(spark, rows).select("doc_id", did.alias("did"), th.alias("th"))
    got = {r["doc_id"]: ([(s["start"], s["end"]) for s in r["spans"]], bytes(r["kept"])) for r in ids.join(found, ["did", "th"]).collect()}
    for i, (t, runs) in enumerate(zip(texts, repeats(texts, 40))):
        if not runs:
            assert i not in got
            continue
        raw, edge = t.encode(), [0, *(x for r in runs for x in r), len(t.encode())]
        assert got[i] == (runs, b"".join(raw[x:y] for x, y in zip(edge[::2], edge[1::2])))


def test_repeats_long_text_in_segments(spark, monkeypatch):
    rng = random.Random(9)
    text = "".join(rng.choice("abcdef") for _ in range(5000))
    monkeypatch.setattr(suffix_dedup, "_SEGMENT", 700)
    batches = suffix_dedup._pieces(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]), 200, 64)
    starts = sorted(s for _, start, n, _, _ in batches for a, c in zip(start, n) for s in range(a, a + c))
    assert starts == list(range(len(text) - 199))


def test_remove_repeats_edge_cases(spark):
    rows = [(1, "same " * 60, 0, "q", None), (1, "same " * 60, 1, "q", "z"), (None, "ü" * 150, 2, "q", None), (2, "aü" + "ü" * 149, 3, "q", None),
            (3, None, 4, "q", None), (4, "", 5, "q", None), (5, "alone", 6, None, None)]
    df = docs(spark, rows, ", did int, kept string, `a.b` string")
    out = suffix_dedup.remove_repeats(df)
    assert out.columns == df.columns
    got = {r["did"]: (r["doc_id"], r["text"], r["kept"], r["a.b"]) for r in out.collect()}
    assert got == {0: (1, "", "q", None), 1: (1, "", "q", "z"), 2: (None, "", "q", None), 3: (2, "a", "q", None),
                   4: (3, None, "q", None), 5: (4, "", "q", None), 6: (5, "alone", None, None)}
    assert suffix_dedup.remove_repeats(df.limit(0)).count() == 0


def near_corpus(seed, families=6, size=9):
    rng = random.Random(seed)
    rows = []
    for _ in range(families):
        base = [f"w{rng.randint(0, 400)}" for _ in range(rng.randint(8, 60))]
        for _ in range(size):
            w = list(base)
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = f"x{rng.randint(0, 400)}"
            rows.append(" ".join(w))
            if rng.random() < 0.2:
                rows.append("\t" + "\n".join(w).upper())
    return [(n * 3, t) for n, t in enumerate(rows)]


@pytest.mark.parametrize("block", [512, 3])
def test_near_duplicates_match_brute_force(spark, block):
    """Blocks of three rows make every list and cluster meet block by block."""
    rows = near_corpus(4) + [(5000, None), (5001, ""), (5002, " \n"), (5003, "one"), (5004, "ONE"), (5005, "one two")]
    want = groups(rows, 4, 80)
    got = {r["doc_id"]: r for r in minhash_join.near_duplicates(docs(spark, rows), block=block).collect()}
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert {i: r["n_shingles"] for i, r in got.items()} == {i: len(shingles(t, 4)) for i, t in rows}
    assert {i for i, r in got.items() if r["kept"]} == {i for i, c in want.items() if i == c}


def test_near_duplicates_edge_cases(spark):
    text = "a b c d e f g h i j"
    rows = [(7, text, 1), (7, text, 2), (3, text + " k", 3), (None, text, 4), (None, "p q r s t", 5), (None, "p q r s t", 6), (9, "", 7), (9, "", 8)]
    df = docs(spark, rows, ", th int")
    out = minhash_join.one_per_group(df)
    assert out.columns == df.columns
    kept = sorted(r["th"] for r in out.collect())
    assert kept in ([3, 5, 7, 8], [3, 6, 7, 8])
    assert minhash_join.one_per_group(df.limit(0)).count() == 0


def test_long_rows_in_pieces(monkeypatch):
    import pyarrow as pa
    rng = random.Random(2)
    text = " ".join("".join(rng.choice("abc") for _ in range(rng.randint(1, 9))) for _ in range(4000)) + " " + "z" * 3000
    whole = [s for _, sets in minhash_join.row_sets(pa.array([text]), 4) for s in sets][0]
    monkeypatch.setattr(minhash_join, "_CHUNK", 500)
    parts = [s for _, sets in minhash_join.row_sets(pa.array([text]), 4) for s in sets][0]
    assert len(whole) == len(shingles(text, 4)) and (whole == parts).all()


def test_match_threshold():
    assert minhash_join.match_threshold(64, 80) == 26 and minhash_join.match_threshold(64, 80, 1e-8) == 31
    assert minhash_join.match_threshold(1, 80) == 1


def test_components_chain(spark):
    from tessera.llm.components import components
    n = 40
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(100, 100), (200, 300), (250, 300)], "a long, b long")
    got = {r["node"]: r["root"] for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(n + 1)}, 100: 100, 200: 200, 300: 200, 250: 200}


def test_texts_of_one_id_are_told_apart(spark):
    """So many that some 32-bit hashes would be equal."""
    th = C.row_identity(F.lit(1), F.col("id").cast("string"))[1]
    assert spark.range(400_000).select(th.alias("th")).distinct().count() == 400_000
