"""Brute-force versions that the operators are held against."""

import collections
import re


def docs(spark, rows, more=""):
    """(doc_id, text, ...) rows as a frame in several partitions."""
    return spark.createDataFrame(rows, "doc_id long, text string" + more).repartition(3)


def repeats(texts, length):
    """Covered byte runs of each text."""
    count = collections.Counter()
    raw = [(t or "").encode() for t in texts]
    for t in raw:
        count.update(t[i:i + length] for i in range(len(t) - length + 1))
    out = []
    for t in raw:
        runs = []
        for i in range(len(t) - length + 1):
            if count[t[i:i + length]] > 1:
                if runs and i <= runs[-1][1]:
                    runs[-1][1] = i + length
                else:
                    runs.append([i, i + length])
        out.append([tuple(r) for r in runs])
    return out


def shingles(text, words):
    w = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + words]) for i in range(max(1, len(w) - words + 1)))


def groups(rows, words, similarity):
    """{doc_id: least id of its group} over (doc_id, text) rows."""
    sets = [(i, shingles(t, words)) for i, t in rows]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= similarity * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i, _ in sets}
