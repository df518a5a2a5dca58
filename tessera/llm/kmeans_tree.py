"""Approximate nearest neighbours by a hierarchical k-means tree.

The tree is fitted on a sample of at most ``sample_rows`` vectors (a stated
bound, so that the tree is small enough to send to every task); every vector
is then put in a leaf by descending to the nearest centre. A search goes
best bin first: a priority queue holds unopened branches by the distance of
the query to their centres and opens the nearest next. How many leaves a
search visits is calibrated: for ``calibration`` queries the true neighbours
are found by comparing with every vector, and visits are widened until the
share of them in the visited leaves reaches ``recall``.

Searches are sent to their leaves and meet the leaf's vectors there; a leaf
with more than ``chunk_rows`` vectors (one vector may be a third of all) is
cut into chunks by id, each of which answers the leaf's searches. Scores are
cosines in double precision of the vectors as they are.

Null, zero, wrong-sized vectors and those with null or non-finite components
take no part, nor do null ids; of rows with one id, the least vector asks.
Fewer candidates than k give fewer rows. An empty table gives none.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import common as C
from tessera.llm import vectors as V

SAMPLE_ROWS = 8192
BRANCHES = 8
LEAF_ROWS = 24
CHUNK_ROWS = 4096
CALIBRATION = 128
RECALL = 0.95


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


class Tree:
    """Nodes with centres; a node without children is leaf ``leaf[node]``."""

    def __init__(self, x: np.ndarray, branches: int, leaf_rows: int, rounds: int = 12):
        self.centres, self.children, self.leaf, self.leaves = [x.mean(0)], [[]], [-1], 0
        rng = np.random.default_rng(7)
        todo = [(0, x)]
        while todo:
            node, rows = todo.pop()
            parts = self._split(rows, branches, rounds, rng) if len(rows) > leaf_rows else []
            if len(parts) < 2:
                self.leaf[node] = self.leaves
                self.leaves += 1
                continue
            for centre, part in parts:
                self.children[node].append(len(self.centres))
                self.centres.append(centre)
                self.children.append([])
                self.leaf.append(-1)
                todo.append((len(self.centres) - 1, part))
        self.centres = np.array(self.centres)
        self.children = [np.array(c, np.int64) for c in self.children]

    @staticmethod
    def _split(rows, branches, rounds, rng):
        distinct = np.unique(rows, axis=0)
        if len(distinct) < 2:
            return []
        centres = distinct[rng.choice(len(distinct), min(branches, len(distinct)), replace=False)]
        for _ in range(rounds):
            near = (rows @ centres.T - (centres * centres).sum(1) / 2).argmax(1)
            centres = np.array([rows[near == c].mean(0) for c in range(len(centres)) if (near == c).any()])
        near = (rows @ centres.T - (centres * centres).sum(1) / 2).argmax(1)
        return [(centres[c], rows[near == c]) for c in range(len(centres)) if (near == c).any()]

    def descend(self, x: np.ndarray) -> np.ndarray:
        """Each row's leaf."""
        out = np.zeros(len(x), np.int64)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            kids = self.children[node]
            if not len(kids):
                out[rows] = self.leaf[node]
                continue
            c = self.centres[kids]
            near = (x[rows] @ c.T - (c * c).sum(1) / 2).argmax(1)
            todo += [(kids[i], rows[near == i]) for i in range(len(kids)) if (near == i).any()]
        return out

    def best_bins(self, q: np.ndarray, visits: int) -> list[int]:
        """The first ``visits`` leaves of a best-bin-first search."""
        queue, out = [(0.0, 0)], []
        while queue and len(out) < visits:
            _, node = heapq.heappop(queue)
            kids = self.children[node]
            if not len(kids):
                out.append(self.leaf[node])
                continue
            gap = self.centres[kids] - q
            for d, kid in zip((gap * gap).sum(1).tolist(), kids.tolist()):
                heapq.heappush(queue, (d, kid))
        return out


def _best_of(queries, q_ids, vectors, ids, k: int):
    """(query rows, vector rows, scores): each query's k best, ties to the
    lesser id. Products of whole blocks only preselect; scores are summed
    pair by pair, so equal vectors score alike."""
    qn, vn = np.sqrt((queries * queries).sum(1)), np.sqrt((vectors * vectors).sum(1))
    rough = (queries / qn[:, None]) @ (vectors / vn[:, None]).T
    rough[q_ids[:, None] == ids[None, :]] = -np.inf
    rows, cols, scores = [], [], []
    for i in range(len(queries)):
        r = rough[i]
        at = r if len(r) <= k else np.partition(r, len(r) - k)[len(r) - k:]
        near = np.flatnonzero((r >= at.min() - 1e-9) & (r > -np.inf))
        s = (vectors[near] * queries[i]).sum(1) / (vn[near] * qn[i])
        top = np.lexsort((ids[near], -s))[:k]
        rows.append(np.full(len(top), i))
        cols.append(near[top])
        scores.append(s[top])
    return np.concatenate(rows), np.concatenate(cols), np.concatenate(scores)


_FOUND = "query_id long, vec_id long, score double"


def _found(q_ids, ids, hits):
    rows, cols, scores = hits
    return pa.RecordBatch.from_arrays([pa.array(q_ids[rows]), pa.array(ids[cols]), pa.array(scores)], names=["query_id", "vec_id", "score"])


def _scaled(column, dim):
    """Doubles; rows are scaled by powers of two (which cosines don't feel)
    where their squares would leave the range of doubles."""
    x = V.matrix(column, dim).astype(np.float64)
    top = np.abs(x).max(1, initial=0)
    odd = (top > 1e140) | (top < 1e-140)
    if odd.any():
        x[odd] = np.ldexp(x[odd], -np.frexp(top[odd])[1][:, None])
    return x


def _compare_all(sent, dim: int, k: int):
    def run(batches):
        q_ids, queries = sent.value
        for b in batches:
            ids, v = b.column("vec_id").to_numpy(), _scaled(b.column("v"), dim)
            for a in range(0, len(ids), CHUNK_ROWS):
                yield _found(q_ids, ids[a:a + CHUNK_ROWS], _best_of(queries, q_ids, v[a:a + CHUNK_ROWS], ids[a:a + CHUNK_ROWS], k))
    return C.tidy(run)


def _put_in_leaves(sent, dim: int):
    def run(batches):
        for b in batches:
            yield b.append_column("leaf", pa.array(sent.value.descend(_unit(_scaled(b.column("v"), dim)))))
    return C.tidy(run)


def _open_bins(sent, dim: int, visits: int):
    def run(batches):
        for b in batches:
            bins = [sent.value.best_bins(q, visits) for q in _unit(_scaled(b.column("v"), dim))]
            row = pa.array(np.repeat(np.arange(b.num_rows), [len(x) for x in bins]))
            t = pa.Table.from_batches([b]).take(row).append_column("leaf", pa.array([y for x in bins for y in x], pa.int64()))
            yield from t.to_batches(max_chunksize=4096)
    return C.tidy(run)


def _meet(dim: int, k: int):
    """Groups (leaf, chunk): vectors first, then the searches."""
    def run(batches):
        ids, v, key = [], [], None
        for b in batches:
            leaf, chunk, asks = b.column("leaf").to_numpy(), b.column("chunk").to_numpy(), b.column("asks").to_numpy(zero_copy_only=False)
            vec_id, x = b.column("vec_id").to_numpy(), _scaled(b.column("v"), dim)
            new = np.ones(len(leaf), bool)
            new[1:] = (leaf[1:] != leaf[:-1]) | (chunk[1:] != chunk[:-1]) | (asks[1:] != asks[:-1])
            cuts = np.append(np.flatnonzero(new), len(leaf))
            for a, e in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if key != (leaf[a], chunk[a]):
                    key, ids, v = (leaf[a], chunk[a]), [], []
                if not asks[a]:
                    ids.append(vec_id[a:e])
                    v.append(x[a:e])
                elif ids:
                    ids, v = [np.concatenate(ids)], [np.concatenate(v)]
                    for s in range(a, e, 512):
                        s_end = min(e, s + 512)
                        yield _found(vec_id[s:s_end], ids[0], _best_of(x[s:s_end], vec_id[s:s_end], v[0], ids[0], k))
    return C.tidy(run)


def nearest(vectors: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vec_col: str = "embedding",
            sample_rows: int = SAMPLE_ROWS, branches: int = BRANCHES, leaf_rows: int = LEAF_ROWS, chunk_rows: int = CHUNK_ROWS,
            calibration: int = CALIBRATION, recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest found among
    ``vectors`` (but not its own id), nearest first, ties to the lesser id."""
    spark = vectors.sparkSession
    dim = V.common_size(vectors, vec_col)

    def rows(df):
        v = F.col(vec_col)
        df = df.where(F.col(id_col).isNotNull() & V.usable(v) & (F.size(v) == dim) & F.exists(v, lambda x: x != 0))
        return df.select(F.col(id_col).cast("bigint").alias("vec_id"), v.cast("array<double>").alias("v"))

    asked = rows(queries).groupBy("vec_id").agg(F.min("v").alias("v"))
    first = [F.xxhash64("vec_id"), F.col("vec_id")]
    sample = rows(vectors).orderBy(*first).limit(sample_rows).select("v").toPandas()["v"]
    if not len(sample):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    tree = Tree(_unit(np.array(sample.tolist())), branches, leaf_rows)
    send = spark.sparkContext.broadcast
    sent = send(tree)
    table = C.stage(rows(vectors).mapInArrow(_put_in_leaves(sent, dim), "vec_id long, v array<double>, leaf long"), "tree-leaves")
    test = asked.orderBy(*first).limit(calibration).toPandas()
    visits = 1
    if len(test):
        q_ids, q = test["vec_id"].to_numpy(), np.array(test["v"].tolist())
        truth = V.best(table.select("vec_id", "v").mapInArrow(_compare_all(send((q_ids, q)), dim, k), _FOUND), k)
        truth = truth.join(table.select("vec_id", "leaf"), "vec_id").select("query_id", "leaf").collect()  # calibration * k rows
        place = {int(i): {leaf: n for n, leaf in enumerate(tree.best_bins(x, tree.leaves))} for i, x in zip(q_ids, _unit(q))}
        needed = np.sort([place[r["query_id"]][r["leaf"]] + 1 for r in truth])
        while len(needed) and visits < tree.leaves and (needed <= visits).mean() < recall:
            visits += 1
    sizes = table.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"))
    chunks = sizes.select("leaf", F.ceil(F.col("n") / chunk_rows).cast("long").alias("chunks"))  # a row a leaf
    inside = table.join(F.broadcast(chunks), "leaf").select(
        "leaf", F.pmod(F.xxhash64("vec_id"), "chunks").alias("chunk"), F.lit(False).alias("asks"), "vec_id", "v")
    asking = (asked.mapInArrow(_open_bins(sent, dim, visits), "vec_id long, v array<double>, leaf long").join(F.broadcast(chunks), "leaf")
              .select("leaf", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"),
                      F.lit(True).alias("asks"), "vec_id", "v"))
    met = (inside.union(asking).repartition("leaf", "chunk").sortWithinPartitions("leaf", "chunk", "asks")
           .mapInArrow(_meet(dim, k), _FOUND))
    return V.best(met, k)
