"""Exact top-k inner products by no-random-access aggregation.

A block of rows keeps a list for each component, sorted by value. A query
reads the lists in turn, a short run of each at a time, from the end that
contributes most to it. What it knows of a row is the sum of the entries met
(``known``) and how much of the row's and of the query's square length is
still unread: the rest of the score lies within the product of the two
unread lengths (at most the weighted mean of their squares, which is what is
added up), which gives a lower and an upper bound. Rows that no list
has met share one bound, the sum of what each list gives at the depth
reached. The bar is the k-th best lower bound. When outsiders can't reach it
(equality counts: ties are settled by id), reading goes on until it has cost
as much (``READ_COST`` an entry) as it would to resolve the rows that are
left, whose scores are then resolved in full. Other rows' scores are never known.

Rows are cut into blocks of about ``BLOCK_COMPONENTS`` components (or
``block_rows`` rows) and queries into blocks of about ``query_rows``; every
row block meets every query block in a task of its own, and the blocks' best
k are merged. Blocks are dealt by a hash of the id, so no vector that many
rows share weighs on one.

How much is read depends on the data: the more the components are alike and
independent, the deeper (README has figures). The result is exact always.

Null ids and vectors that are null, empty, of another size (than the most
frequent one), or hold null or non-finite components take no part; of rows
with one id, the least vector asks. Components of any finite size count:
scores that could pass 64 bits are added up in unbounded integers, and the
query fails, as SQL does, only if one of the k best does pass. Fewer
candidates than k give fewer rows; an empty table none. Only the id and the
vector column are read, so other columns' names can't clash.
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import common as C
from tessera.llm import vectors as V

BLOCK_COMPONENTS = 1 << 20
QUERY_ROWS = 2048
#: What reading a list entry costs, in components of a row that is resolved (measured: some 10 to 25).
READ_COST = 8
_LONG = 1 << 62


def _whole(x: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x), as Python's integers where 64 bits don't hold all."""
    with np.errstate(over="ignore"):
        f = np.floor(x * scale)
    if np.abs(f).max(initial=0) < _LONG:
        return f.astype(np.int64)
    return np.array([[int(b) if np.isfinite(b) else math.floor(Fraction(a) * Fraction(scale)) for a, b in zip(*r)] for r in zip(x, f)], object)


def _floats(rows: np.ndarray) -> tuple[np.ndarray, int]:
    """The rows as doubles divided by 2**n, and n: all at most about 1."""
    if rows.dtype != object:
        x = rows.astype(np.float64)
        n = int(np.frexp(np.abs(x).max(initial=0))[1])
        return np.ldexp(x, -n), n
    n = max((abs(int(x)).bit_length() for x in rows.flat), default=0)
    cut = max(n - 960, 0)
    return np.ldexp(np.array([[float(int(x) >> cut) for x in r] for r in rows], np.float64).reshape(rows.shape), cut - n), n


def _products(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """The exact inner products, as Python's integers if they may be long."""
    if object not in (rows.dtype, query.dtype):
        reach = np.abs(rows.astype(np.float64)).max(initial=0) * np.abs(query.astype(np.float64)).sum()
        if reach < _LONG:
            return (rows * query).sum(1)
    return (rows.astype(object) * query.astype(object)).sum(1)


class SortedLists:
    """A block's rows (integers) with a sorted list for each component:
    ``order`` has the rows of each list, ``sorted`` their values. ``read``
    counts list entries read, ``resolved`` rows scored in full."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, read_cost: float = READ_COST):
        self.ids, self.rows, self.read_cost = ids, rows, read_cost
        x, self.exponent = _floats(rows)
        self.far = np.abs(x).max(initial=0) * 2.0 ** self.exponent if self.exponent < 53 and rows.dtype != object else np.inf
        self.doubles = rows.astype(np.float64) if self.far < np.inf else None
        by = np.ascontiguousarray(x.T)
        self.order = np.argsort(by, axis=1, kind="stable")
        self.sorted = np.take_along_axis(by, self.order, axis=1)
        self.squares = self.sorted * self.sorted
        self.square, self.largest = (x * x).sum(1), np.abs(x).max(0, initial=0)
        self.read = self.resolved = 0

    def _candidates(self, own: int, query: np.ndarray, k: int, bar: float) -> np.ndarray:
        """The rows that may be among the k best: reads the lists."""
        n, d = len(self.ids), len(query)
        w, exponent = _floats(query[None, :])
        w, open_ = w[0], self.ids != own
        up, down = np.flatnonzero(w > 0), np.flatnonzero(w < 0)
        weight = np.concatenate([w[up], w[down]])[:, None]
        round_ = (d + 8) * 2.0 ** -52  # relative error of a sum
        slack, asked = 2 * round_ * (np.abs(w) @ self.largest), w @ w
        if object in (self.rows.dtype, query.dtype):  # what ``_floats`` cuts off
            slack += (np.abs(w).sum() + self.largest.sum()) * 2.0 ** -900
        # The unread lengths' product is at most (t * the row's square + the query's / t) / 2, for any t.
        t = math.sqrt(asked / max(self.square.mean(), 1e-300)) if asked else 1.0
        known, rest = np.zeros(n), (t * self.square + asked / t) / 2
        spare = round_ * rest
        half = weight * weight / (2 * t)
        seen = np.zeros(n, bool)
        bar = math.ldexp(bar, -exponent - self.exponent) - slack
        step, depth, out_at, left = max(32, n // 32), 0, n, n
        while depth < n and left > 0 and len(weight):
            to = min(n, depth + step)
            at = np.concatenate([self.order[up, n - to:n - depth], self.order[down, depth:to]])
            v = np.concatenate([self.sorted[up, n - to:n - depth], self.sorted[down, depth:to]])
            self.read += at.size
            flat = at.reshape(-1)
            known += np.bincount(flat, (weight * v).reshape(-1), n)
            v2 = np.concatenate([self.squares[up, n - to:n - depth], self.squares[down, depth:to]])
            v2 *= t / 2
            v2 += half
            rest -= np.bincount(flat, v2.reshape(-1), n)
            seen[flat] = True
            depth = to
            gap = np.maximum(rest, 0) + spare
            low = np.where(self.ids != own, known - gap, -np.inf)
            if n > k:
                bar = max(bar, np.partition(low, n - k)[n - k] - slack)
            open_ &= known + gap + slack >= bar
            outside = w[up] @ self.sorted[up, n - depth] + w[down] @ self.sorted[down, depth - 1] + slack
            if outside < bar:
                open_ &= seen
                out_at = min(out_at, depth)
            left = np.count_nonzero(open_)
            if self.read_cost * (depth - out_at) >= left:
                break
        return np.flatnonzero(open_)

    def _scores(self, live: np.ndarray, query: np.ndarray) -> np.ndarray:
        """The rows' exact scores; sums under 2**53 are exact in doubles."""
        if query.dtype != object and self.doubles is not None and self.far * np.abs(query.astype(np.float64)).sum() < 1 << 53:
            return (self.doubles[live] @ query.astype(np.float64)).astype(np.int64)
        return _products(self.rows[live], query)

    def top(self, q_ids: np.ndarray, queries: np.ndarray, k: int, bars: np.ndarray | None = None):
        """For each query the rows and scores of its k best, ties to the
        lesser id; rows under its bar (a k-th best known before) may be
        missing. A score under what 64 bits hold is None."""
        for i, own in enumerate(q_ids):
            live = self._candidates(own, queries[i], k, -np.inf if bars is None else float(bars[i]))
            self.resolved += len(live)
            score = self._scores(live, queries[i])
            if score.dtype != object:
                best = np.lexsort((self.ids[live], -score))[:k]
                yield live[best], score[best].astype(np.int64)
                continue
            best = np.array(sorted(range(len(live)), key=lambda j: (-score[j], self.ids[live[j]]))[:k], np.int64)
            if any(x >= 1 << 63 for x in score[best]):
                raise OverflowError("a score among the k best passes 64 bits")
            yield live[best], np.array([int(x) if x >= -(1 << 63) else None for x in score[best]], object)


_FOUND = "query_id long, vec_id long, score long"


def _aggregate(dim: int, k: int, scale: float):
    """Groups (rows' block, queries' block): rows first, then queries."""
    def run(batches):
        for t in V.grouped(batches, ["rb", "qb"]):
            asks = t.column("asks").to_numpy()
            if asks.all() or not asks.any():
                continue
            ids, v = t.column("vec_id").to_numpy(), V.matrix(t.column("v"), dim)
            block, out = SortedLists(ids[~asks], _whole(v[~asks], scale)), []
            i, q = ids[asks], _whole(v[asks], scale)
            for x, (r, s) in zip(i, block.top(i, q, k)):
                out.append((np.full(len(r), x), block.ids[r], s.astype(object)))
            for a in range(0, len(out), 1024):
                query, vec, score = (np.concatenate(c) for c in zip(*out[a:a + 1024]))
                yield pa.RecordBatch.from_arrays([pa.array(query), pa.array(vec), pa.array(score.tolist(), pa.int64())],
                                                 names=["query_id", "vec_id", "score"])
    return C.tidy(run)


def top_products(vectors: DataFrame, queries: DataFrame, k: int, scale: float = 256, id_col: str = "vec_id", vec_col: str = "embedding",
                 block_rows: int | None = None, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest inner products
    of floor(scale * x) with ``vectors`` (but not its own id)."""
    dim = V.common_size(vectors, vec_col)
    block_rows = block_rows or max(1, BLOCK_COMPONENTS // max(dim, 1))

    def rows(df):
        v = F.col(vec_col)
        df = df.where(F.col(id_col).isNotNull() & V.usable(v) & (F.size(v) == dim) & (F.size(v) > 0))
        return df.select(F.col(id_col).cast("bigint").alias("vec_id"), v.cast("array<double>").alias("v"))

    table, asked = C.stage(rows(vectors), "topk-vectors"), C.stage(rows(queries).groupBy("vec_id").agg(F.min("v").alias("v")), "topk-queries")
    row_blocks, query_blocks = max(1, -(-table.count() // block_rows)), max(1, -(-asked.count() // query_rows))
    block = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    met = table.select(block(row_blocks).alias("rb"), each(query_blocks).alias("qb"), F.lit(False).alias("asks"), "vec_id", "v").union(
        asked.select(each(row_blocks).alias("rb"), block(query_blocks).alias("qb"), F.lit(True), "vec_id", "v"))
    found = met.repartition("rb", "qb").sortWithinPartitions("rb", "qb").mapInArrow(_aggregate(dim, k, scale), _FOUND)
    fits = F.coalesce("score", F.raise_error("a score among the k best passes 64 bits").cast("bigint"))
    return V.best(found, k).withColumn("score", fits)
