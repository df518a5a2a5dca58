"""Periodic runs of words: every maximal stretch that repeats with a period.

A text's words are its runs of bytes other than ASCII white space. A run is a
stretch of words with smallest period q (words q apart are the same), at
least ``max(6, 4 q)`` long, that can't be extended keeping the period. The
collapsed text keeps the words that no run covers after its first q words,
joined by one space.

Method (internal pattern matching). The words of a chunk of whole texts get a
suffix array by prefix doubling; the ranks at each step name the classes of
equal factors of 2**k words, and a class is an interval of the suffix array.
Each dyadic block, m = 2**k words from every multiple of m / 2, asks for its
next occurrence within the window of m starts behind it: the successor of its
own place in the interval of its class, by a wavelet tree over the suffix
array. Occurrences of a block within a window of that width form an
arithmetic progression whose difference is the block's smallest period, so
the first of them gives the progression and its difference is the candidate.
A run of period q and length 4 q at least holds a block of m = 2**k in
[q, 2 q) words whose copy q behind is in the run too, and a nearer copy would
make q no smallest period; so each run is found. Candidates are extended
by the ranks, which compare 2**k words at a time, and kept if long enough;
of equal stretches the least period is the smallest.

Blocks that occur less often in their text than any run would hold them (six
times for single words, twice for long blocks) ask nothing. Words are compared
by 64-bit hashes.

Chunks hold ``WORDS`` words or one longer text, whose memory is some 15 to 30
words of 4 bytes a word of it; nothing else grows with the text, and no text
is cut. Rows are independent, so no key can be hot and nothing is shuffled.
Null and empty texts have no words and no runs; their collapsed text is
empty. Repeated rows each have a row of the result. An empty table gives
none. Columns that are kept may have any names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm import common as C

#: Least length of a run, and the least number of its periods.
LEAST, PERIODS = 6, 4
WORDS = 1 << 16
_BYTES = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


# -- words -------------------------------------------------------------------

def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and end byte of each word of texts laid end to end, and each
    text's first word (one more than texts)."""
    n = len(data)
    inside = np.zeros(n + 2, bool)
    np.logical_not(_SPACE[data], out=inside[1:n + 1])
    word, before = inside[1:], inside[:-1]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    first = np.flatnonzero(word & (~before | edge))
    end = np.flatnonzero(before & (~word | edge))
    return first, end, np.searchsorted(first, offsets)


def word_hashes(data: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of words, some bytes of whole words at a time."""
    out, k = np.empty(len(first), np.uint64), 0
    while k < len(first):
        j = max(k + 1, int(np.searchsorted(end, first[k] + _BYTES, side="right")))
        a = first[k]
        out[k:j] = C.spans_hash(C.prefix_hashes(data[a:end[j - 1]]), first[k:j] - a, end[k:j] - a)
        k = j
    return out


# -- index -------------------------------------------------------------------

def factor_ranks(word: np.ndarray, text_end: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix array of words that differ between texts, and ``ranks``: at step
    k two places have the same rank if the 2**k words from there are the same
    (cut at the text's end), and the rank is the first place of the class in the suffix array.
    ``text_end``: for each word, the end of its text."""
    n = len(word)
    sa = np.argsort(word, kind="stable").astype(np.int32)
    ordered = word[sa]
    slots = np.arange(n, dtype=np.int32)
    fresh = np.ones(n, bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    rank = np.empty(n, np.int32)
    rank[sa] = np.maximum.accumulate(np.where(fresh, slots, 0))
    ranks, step = [rank], 1
    while True:
        alone = fresh & np.append(fresh[1:], True)
        slots, fresh = slots[~alone], None
        if not len(slots):
            return sa, ranks
        at = sa[slots]
        ahead = at.astype(np.int64) + step
        inside = ahead < text_end[at]
        key = rank[at].astype(np.int64) * (n + 1)
        key[inside] += rank[ahead[inside]].astype(np.int64) + 1
        order = np.argsort(key, kind="stable")
        at, key = at[order], key[order]
        sa[slots] = at
        fresh = np.ones(len(at), bool)
        fresh[1:] = key[1:] != key[:-1]
        rank = rank.copy()
        rank[at] = np.maximum.accumulate(np.where(fresh, slots, 0))
        ranks.append(rank)
        step *= 2


class WaveletTree:
    """Ranges of a permutation by value: one bit vector for each bit of the
    values, the highest first, each level sorted by the bits above."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.n, self.bits = n, max(1, int(n).bit_length())
        self.zeros, self.counts = [], []
        for bit in range(self.bits - 1, -1, -1):
            one = (values >> bit) & 1 == 1
            count = np.zeros(n + 1, np.int32)
            np.cumsum(~one, out=count[1:])
            self.counts.append(count)
            self.zeros.append(int(count[-1]))
            values = np.concatenate([values[~one], values[one]])

    def successor(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The least value above ``x`` within places [lo, hi) of each query;
        n where there is none."""
        less, a, b, x = np.zeros(len(lo), np.int64), lo.astype(np.int64), hi.astype(np.int64), x + 1
        for level, (count, zeros) in enumerate(zip(self.counts, self.zeros)):
            za, zb = count[a], count[b]
            one = (x >> (self.bits - 1 - level)) & 1 == 1
            less += np.where(one, zb - za, 0)
            a, b = np.where(one, zeros + a - za, za), np.where(one, zeros + b - zb, zb)
        out = np.full(len(lo), self.n, np.int64)
        some = np.flatnonzero(less < hi - lo)
        k, a, b, v = less[some], lo[some].astype(np.int64), hi[some].astype(np.int64), np.zeros(len(some), np.int64)
        for level, (count, zeros) in enumerate(zip(self.counts, self.zeros)):
            za, zb = count[a], count[b]
            one = k >= zb - za
            k -= np.where(one, zb - za, 0)
            a, b = np.where(one, zeros + a - za, za), np.where(one, zeros + b - zb, zb)
            v |= one.astype(np.int64) << (self.bits - 1 - level)
        out[some] = v
        return out


# -- runs --------------------------------------------------------------------

def _class_sizes(sa: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Size of the class that begins at each place of the suffix array."""
    return np.bincount(rank, minlength=len(sa))


def _extend(ranks: list[np.ndarray], i: np.ndarray, d: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The largest stretch around place i with period d: its start and end."""
    a, j = i.astype(np.int64).copy(), i + d
    fore = j.copy()
    for k in range(len(ranks) - 1, -1, -1):
        step, rank = 1 << k, ranks[k]
        while True:
            # Ranks of cut factors are never shared, but places must exist.
            ok = np.flatnonzero(fore < end)
            ok = ok[rank[fore[ok] - d[ok]] == rank[fore[ok]]]
            if not len(ok):
                break
            fore[ok] += step
            if k < len(ranks) - 1:
                break
    for k in range(len(ranks) - 1, -1, -1):
        step, rank = 1 << k, ranks[k]
        while True:
            ok = np.flatnonzero(a - step >= begin)
            ok = ok[rank[a[ok] - step] == rank[a[ok] - step + d[ok]]]
            if not len(ok):
                break
            a[ok] -= step
            if k < len(ranks) - 1:
                break
    return a, fore


def find_runs(word: np.ndarray, starts: np.ndarray, least: int = LEAST, periods: int = PERIODS) -> tuple[np.ndarray, ...]:
    """Runs of texts laid end to end (``starts``: first word of each, one more
    than texts), sorted by start and period: first word, end, period."""
    if periods < 4:
        raise ValueError("a run must hold four periods at least")
    n, none = len(word), np.zeros(0, np.int64)
    if n < least:
        return none, none, none
    text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    begin, end = starts[text], starts[text + 1]
    # The same word has another value in another text.
    sa, ranks = factor_ranks(C.mix(word ^ C.mix(text.astype(np.uint64) + np.uint64(1))), end)
    tree, found = WaveletTree(sa), []
    for k in range(len(ranks)):
        m = 1 << k
        place = np.arange(n)
        if m > 2:
            place = place[(place - begin) % (m // 2) == 0]
        # A run of period q >= m / 2 + 1 is that long and holds its block that often.
        q = m // 2 + 1
        room = max(least, periods * q)
        often = (room - m + 1) // q
        place = place[end[place] - begin[place] >= room]
        size = _class_sizes(sa, ranks[k])
        rank = ranks[k][place]
        place = place[size[rank] >= often]
        if not len(place):
            continue
        rank = ranks[k][place].astype(np.int64)
        gap = tree.successor(rank, rank + size[rank], place) - place
        near = gap <= m
        place, gap = place[near], gap[near]
        if len(place):
            # Blocks of one stretch follow each other with one gap.
            new = np.ones(len(place), bool)
            new[1:] = (gap[1:] != gap[:-1]) | (np.diff(place) > max(1, m // 2))
            found.append((place[new], gap[new]))
    if not found:
        return none, none, none
    i, d = (np.concatenate(x) for x in zip(*found))
    a, b = _extend(ranks, i, d, begin[i], end[i])
    keep = b - a >= np.maximum(least, periods * d)
    a, b, d = a[keep], b[keep], d[keep]
    order = np.lexsort((d, b, a))
    a, b, d = a[order], b[order], d[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    a, b, d = a[new], b[new], d[new]
    order = np.lexsort((d, a))
    return a[order], b[order], d[order]


def collapse(data: np.ndarray, first: np.ndarray, end: np.ndarray, starts: np.ndarray, a: np.ndarray, b: np.ndarray,
             d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the texts' kept words, joined by one space, and the texts'
    offsets in them."""
    drop = np.zeros(len(first) + 1, np.int32)
    np.add.at(drop, a + d, 1)
    np.add.at(drop, b, -1)
    kept = np.flatnonzero(np.cumsum(drop)[:-1] == 0)
    mark = np.zeros(len(data) + 1, np.int8)
    mark[first[kept]] += 1
    mark[end[kept]] -= 1
    keep = np.cumsum(mark[:-1], dtype=np.int8).astype(bool)
    # The white space ahead of a kept word is its space, but for each text's first.
    at = np.searchsorted(kept, starts)
    later = np.ones(len(kept), bool)
    later[at[:-1][at[:-1] < at[1:]]] = False
    ahead = first[kept[later]] - 1
    keep[ahead] = True
    data = data.copy()
    data[ahead] = 0x20
    size = end[kept] - first[kept] + later
    total = np.concatenate([[0], np.cumsum(size)])
    return data[keep], total[at]


_RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def _run(text_col: str, least: int, periods: int):
    kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches):
        for batch in batches:
            data, offsets = C.text_buffer(batch.column(text_col))
            rest = batch.drop_columns([text_col])
            for lo, hi in C.batches_of(offsets, _BYTES):
                part, o = data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
                first, end, starts = word_bounds(part, o)
                word = word_hashes(part, first, end)
                a, b, d = [], [], []
                for x, y in C.batches_of(starts, WORDS):
                    s, e, q = find_runs(word[starts[x]:starts[y]], starts[x:y + 1] - starts[x], least, periods)
                    a.append(s + starts[x]), b.append(e + starts[x]), d.append(q)
                a, b, d = (np.concatenate(z) if z else np.zeros(0, np.int64) for z in (a, b, d))
                text, cut = collapse(part, first, end, starts, a, b, d)
                at = np.searchsorted(a, starts)
                own = np.searchsorted(starts, a, side="right") - 1
                items = pa.StructArray.from_arrays([pa.array(a - starts[own]), pa.array(b - a), pa.array(d)], fields=list(kind))
                runs = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), items)
                yield pa.RecordBatch.from_arrays([*rest.slice(lo, hi - lo).columns, runs, C.binary_array(text, cut).cast(pa.string())],
                                                 names=[*rest.schema.names, "runs", "collapsed"])
    return C.tidy(run)


def periodic_runs(docs: DataFrame, text: Column, keep: dict[str, Column], least: int = LEAST, periods: int = PERIODS) -> DataFrame:
    """One row per row of ``docs``: the columns of ``keep``, ``runs`` (start,
    length, period; by start, then period) and ``collapsed``."""
    names = {k: f"k{i}" for i, k in enumerate(keep)}
    rows = docs.select(*[c.alias(names[k]) for k, c in keep.items()], text.cast("string").alias("text"))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    found = rows.mapInArrow(_run("text", least, periods), f"{fields}, runs {_RUNS}, collapsed string")
    return found.select(*[F.col(n).alias(k) for k, n in names.items()], "runs", "collapsed")


def strongest(runs: Column) -> Column:
    """The run with the greatest exponent (length / period, exactly), ties by
    smallest start, then period; null if there is none."""
    best = F.try_element_at(runs, F.lit(1))
    return F.aggregate(runs, best, lambda x, y: F.when(y["length"] * x["period"] > x["length"] * y["period"], y).otherwise(x))
