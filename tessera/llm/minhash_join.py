"""Near-duplicate groups by an inverted join over signature coordinates.

A document's set holds its distinct ``words``-word shingles (ASCII letters
lower-cased, words are runs of bytes other than ASCII white space; a text
with fewer words is one shingle). Documents whose sets have a Jaccard
similarity of ``similarity`` per cent at least are linked, exactly; groups
are the connected components.

Method. A signature has ``coordinates`` minima. Equal sets are one node from
the start. Every node is posted under its (coordinate, value) pairs; a pair
of sets at the similarity agrees in a binomial number of coordinates, so
fewer than ``matches`` agree with a probability under ``miss``. Pairs held
by one node are dropped, and nodes with fewer than ``matches`` left are done.
Of the others a node is posted under its rarest pairs only: with s pairs
left, two nodes that agree ``matches`` times meet under one of their
s - matches + 1 rarest (prefix), so the longest lists are skipped. In
a list, collisions of whole signatures are counted and nodes with
``matches`` at least are joined to *clusters*. Every link lies inside a
cluster; there the full sets are compared exactly. Long lists and large
clusters are cut into blocks and every two blocks meet in a task of their
own; a task returns a forest (a row for each member) and never its pairs.

Null and wordless texts have no set and are linked with nothing; they are
groups of their own. Repeated rows are documents with equal sets. Documents
with a null id are linked like others; the least id that is not null names
the group; of several rows with that id, or of rows without ids, the first
by identity stands for it. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import common as C
from tessera.llm.components import components

COORDINATES = 64
MISS = 1e-12
_BLOCK = 512
_CHUNK = 1 << 18
_COLUMNS = 4096


def match_threshold(coordinates: int, similarity: int, miss: float = MISS) -> int:
    """Most coordinates that two sets at the similarity agree in, but for a
    probability of ``miss``."""
    p, total, t = similarity / 100, 0.0, 0
    while t < coordinates:
        total += comb(coordinates, t) * p ** t * (1 - p) ** (coordinates - t)
        if total > miss:
            break
        t += 1
    return max(t, 1)


# -- sets --------------------------------------------------------------------

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of rows laid end to end, and the words of each row."""
    n = len(data)
    word = np.zeros(n + 1, bool)
    word[:n] = ~_SPACE[data]
    before = np.zeros(n + 1, bool)
    before[1:] = word[:n]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True  # words end with their row
    first = np.flatnonzero(word & (~before | edge))
    last = np.flatnonzero(before & (~word | edge))
    h = C.spans_hash(C.prefix_hashes(_LOWER[data]), first, last)
    return h, np.diff(np.searchsorted(first, offsets))


def _long_word_hashes(data: np.ndarray) -> np.ndarray:
    """Word hashes of one long row, a piece at a time; pieces end at spaces."""
    out, at = [], 0
    while at < len(data):
        end = min(at + _CHUNK, len(data))
        while end < len(data):
            space = np.flatnonzero(_SPACE[data[at:end]])
            if len(space):
                end = at + int(space[-1]) + 1
                break
            end = min(end + _CHUNK, len(data))
        out.append(_word_hashes(data[at:end], np.array([0, end - at]))[0])
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


_STEPS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                   0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


def _shingles(h: np.ndarray, words: int) -> np.ndarray:
    """Sorted distinct shingle hashes of one row's word hashes."""
    n = len(h)
    if not n:
        return h
    k = min(words, n)
    acc = np.full(n - k + 1, k, np.uint64)
    for i in range(k):
        acc = C.mix(acc + h[i:n - k + 1 + i] * _STEPS[i % 8])
    return np.unique(acc)


def row_sets(column, words: int):
    """Each row's sorted distinct shingle hashes, a chunk of rows at a time:
    (first row, list of arrays)."""
    data, offs = C.text_buffer(column)
    for lo, hi in C.batches_of(offs, _CHUNK):
        part, o = data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        if hi - lo == 1 and len(part) > 4 * _CHUNK:
            yield lo, [_shingles(_long_word_hashes(part), words)]
            continue
        h, n = _word_hashes(part, o)
        ends = np.cumsum(n)
        # All rows' shingles at once; those that would cross rows are cut off.
        if len(h) >= words:
            acc = np.full(len(h) - words + 1, words, np.uint64)
            for i in range(words):
                acc = C.mix(acc + h[i:len(h) - words + 1 + i] * _STEPS[i % 8])
        yield lo, [np.unique(acc[e - c:e - words + 1]) if c >= words else _shingles(h[e - c:e], words)
                   for e, c in zip(ends.tolist(), n.tolist())]


def _minima(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """Signatures (rows x coordinates, 32 bits) of sets; empty sets give zeros."""
    out = np.zeros((len(sets), coordinates), np.uint32)
    full = [i for i, s in enumerate(sets) if len(s)]
    if full:
        flat = np.concatenate([sets[i] for i in full])
        starts = np.concatenate([[0], np.cumsum([len(sets[i]) for i in full])[:-1]])
        seeds = C.mix(np.arange(1, 2 * coordinates + 1, dtype=np.uint64) * _STEPS[0])
        tmp = np.empty_like(flat)
        for c in range(coordinates):
            np.multiply(flat, seeds[2 * c] | np.uint64(1), out=tmp)
            tmp += seeds[2 * c + 1]
            out[full, c] = np.minimum.reduceat(tmp, starts) >> np.uint64(32)
    return out


def _signatures(words: int, coordinates: int):
    def run(batches):
        for b in batches:
            for lo, sets in row_sets(b.column("text"), words):
                sig = _minima(sets, coordinates)
                n = len(sets)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(lo, n), b.column("did").slice(lo, n), b.column("th").slice(lo, n),
                     pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                     pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * coordinates),
                                              pa.array(sig.view(np.int32).reshape(-1)))],
                    names=["doc_id", "did", "th", "n_shingles", "digest", "sig"])
    return C.tidy(run)


# -- clusters and links ------------------------------------------------------

def _groups(batches, keys: list[str]):
    """Whole groups of equal keys, as tables, from batches sorted by them."""
    held = []
    for b in batches:
        if b.num_rows:
            held.append(pa.Table.from_batches([b]))
        if sum(t.num_rows for t in held) < 4096:
            continue
        t = pa.concat_tables(held).combine_chunks()
        ends = _ends(t, keys)
        yield t.slice(0, ends[-1]) if len(ends) else t.slice(0, 0), ends
        held = [t.slice(ends[-1])] if len(ends) else [t]
    if held:
        t = pa.concat_tables(held).combine_chunks()
        yield t, np.append(_ends(t, keys), t.num_rows)


def _ends(t: pa.Table, keys: list[str]) -> np.ndarray:
    new = np.zeros(max(t.num_rows - 1, 0), bool)
    for k in keys:
        new |= np.diff(t.column(k).to_numpy()) != 0
    return np.flatnonzero(new) + 1


def _forest(adjacent: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix, the least row connected to it."""
    m = len(adjacent)
    label = np.arange(m)
    adjacent = adjacent | np.eye(m, dtype=bool)
    while True:
        new = np.where(adjacent, label[None, :], m).min(1)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _collisions(matches: int):
    """Joins the nodes of each list whose signatures agree often enough."""
    def run(batches):
        for t, ends in _groups(batches, ["key", "i", "j"]):
            node = t.column("node").to_numpy()
            sig = C.text_buffer(t.column("sig8"))[0].reshape(len(node), -1)
            a_out, b_out, a = [], [], 0
            for e in ends.tolist():
                s, n = sig[a:e], node[a:e]
                if e - a == 2:
                    adj = np.full((2, 2), (s[0] == s[1]).sum() >= matches)
                else:
                    count = np.zeros((e - a, e - a), np.uint8)
                    for c in range(s.shape[1]):
                        count += s[:, c][:, None] == s[:, c][None, :]
                    adj = count >= matches
                root = _forest(adj)
                hit = np.flatnonzero(root != np.arange(e - a))
                a_out.append(n[hit])
                b_out.append(n[root[hit]])
                a = e
            if a_out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a_out)), pa.array(np.concatenate(b_out))], names=["a", "b"])
    return C.tidy(run)


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every two sets."""
    m = len(sets)
    flat = np.concatenate(sets)
    row = np.repeat(np.arange(m), [len(s) for s in sets])
    values, col, df = np.unique(flat, return_inverse=True, return_counts=True)
    shared = np.cumsum(df > 1) - 1
    keep = df[col] > 1
    row, col = row[keep], shared[col[keep]]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    total = np.zeros((m, m), np.float64)
    top = int(col[-1]) + 1 if len(col) else 0
    for lo in range(0, top, _COLUMNS):
        a, b = np.searchsorted(col, [lo, lo + _COLUMNS])
        x = np.zeros((m, min(_COLUMNS, top - lo)), np.float32)
        x[row[a:b], col[a:b] - lo] = 1
        total += x @ x.T
    return total.astype(np.int64)


def _exact_links(similarity: int):
    """Joins the nodes of each two blocks of a cluster whose sets are similar."""
    def run(batches):
        for t, ends in _groups(batches, ["root", "i", "j"]):
            node, a = t.column("node").to_numpy(), 0
            column = t.column("shingles")
            a_out, b_out = [], []
            for e in ends.tolist():
                data, o = C.text_buffer(column.slice(a, e - a))
                data = np.ascontiguousarray(data).view(np.uint64)
                o = o // 8
                sets = [data[x:y] for x, y in zip(o[:-1], o[1:])]
                size = np.diff(o)
                both = common_counts(sets)
                root = _forest(100 * both >= similarity * (size[:, None] + size[None, :] - both))
                n = node[a:e]
                hit = np.flatnonzero(root != np.arange(e - a))
                a_out.append(n[hit])
                b_out.append(n[root[hit]])
                a = e
            if a_out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a_out)), pa.array(np.concatenate(b_out))], names=["a", "b"])
    return C.tidy(run)


def _in_block_pairs(rows: DataFrame, key: str, sizes: DataFrame, block: int) -> DataFrame:
    """``rows`` of each ``key`` dealt to the tasks (key, i, j) in which any
    two of them meet once at least: blocks of about ``block`` rows, sent to
    all pairs of blocks that they are in. ``sizes``: (key, _m) rows a key."""
    nb = F.ceil(F.col("_m") / block).cast("int")
    b = F.pmod(F.xxhash64("node"), F.col("_nb")).cast("int")
    return (rows.join(sizes, key).withColumn("_nb", nb).withColumn("_b", b)
            .withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_nb") - 1)))
            .withColumn("i", F.least("_b", "_o")).withColumn("j", F.greatest("_b", "_o"))
            .drop("_m", "_nb", "_b", "_o"))


def _set_bytes(words: int):
    def run(batches):
        for b in batches:
            for lo, sets in row_sets(b.column("text"), words):
                yield pa.RecordBatch.from_arrays(
                    [b.column("node").slice(lo, len(sets)), pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["node", "shingles"])
    return C.tidy(run)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, similarity: int = 80,
                    coordinates: int = COORDINATES, miss: float = MISS, block: int = _BLOCK) -> DataFrame:
    """One row per document: ``doc_id``, its identity (``did``, ``th``),
    ``n_shingles``, ``component_id`` (the least id of its group; its own for
    a document without a set) and ``kept`` (it stands for its group)."""
    matches = match_threshold(coordinates, similarity, miss)
    text = F.col(text_col).cast("string")
    did, th = C.row_identity(F.col(id_col), text)
    base = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), did.alias("did"), th.alias("th"), text.alias("text"))
    sigs = C.stage(base.mapInArrow(
        _signatures(words, coordinates),
        "doc_id long, did long, th long, n_shingles long, digest binary, sig array<int>"), "minhash-signatures")
    some = sigs.where("n_shingles > 0")
    # Equal sets are one node; the ids stand as they are once written.
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "did", "th")
    nodes = C.stage(some.groupBy("digest").agg(F.min(row).alias("row"), F.first("sig").alias("sig"))
                    .select("digest", "row", "row.did", "row.th", "sig", F.monotonically_increasing_id().alias("node")),
                    "minhash-nodes")
    posted = nodes.select("node", F.posexplode("sig").alias("c", "v")).select(
        "node", (F.shiftleft(F.col("c").cast("bigint"), 32) + F.col("v").cast("bigint")).alias("key"))
    # Counts are tables, so that joins with them meet two plain exchanges and a hot list is split.
    held = C.stage(posted.groupBy("key").agg(F.count(F.lit(1)).alias("_m")).where("_m > 1"), "minhash-held")
    prefix = (posted.join(held, "key").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("_m", "key"))).alias("p"))
              .where(F.size("p") >= matches)
              .select("node", F.explode(F.slice("p", F.lit(1), F.size("p") - (matches - 1))).alias("p")).select("node", "p.key"))
    postings = C.stage(prefix, "minhash-postings")
    short = nodes.select("node", F.expr("unhex(concat_ws('', transform(sig, x -> lpad(hex(x & 255), 2, '0'))))").alias("sig8"))
    lists = C.stage(postings.groupBy("key").agg(F.count(F.lit(1)).alias("_m")).where("_m > 1"), "minhash-lists")
    near = (_in_block_pairs(postings.join(short, "node"), "key", lists, block)
            .repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
            .mapInArrow(_collisions(matches), "a long, b long"))
    clusters = C.stage(components(C.stage(near.distinct(), "minhash-near"), "minhash-clusters"), "minhash-cluster")
    wanted = nodes.join(clusters, "node").select("node", "did", "th")
    sets = (base.select("did", "th", "text").join(wanted, ["did", "th"]).dropDuplicates(["node"])
            .select("node", "text").mapInArrow(_set_bytes(words), "node long, shingles binary"))
    sizes = C.stage(clusters.groupBy("root").agg(F.count(F.lit(1)).alias("_m")), "minhash-sizes")
    links = (_in_block_pairs(sets.join(clusters, "node"), "root", sizes, block)
             .repartition("root", "i", "j").sortWithinPartitions("root", "i", "j")
             .mapInArrow(_exact_links(similarity), "a long, b long"))
    groups = C.stage(components(C.stage(links.distinct(), "minhash-links"), "minhash-components"), "minhash-group")
    named = nodes.select("digest", "row", "node").join(groups, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = C.stage(named, "minhash-rows")
    least = C.stage(named.groupBy("root").agg(F.min("row").alias("rep")), "minhash-least")
    named = C.stage(named.join(least, "root").select("digest", "rep"), "minhash-named")
    out = sigs.select("doc_id", "did", "th", "n_shingles", "digest").join(named, "digest", "left")
    alone = F.col("n_shingles") == 0
    return out.select("doc_id", "did", "th", "n_shingles", F.when(alone, F.col("doc_id")).otherwise(F.col("rep.doc_id")).alias("component_id"),
                      (alone | F.col("rep.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("rep.did") == F.col("did"))
                       & (F.col("rep.th") == F.col("th"))).alias("kept"))


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each group; of rows alike in id and text
    one stays, if they have words."""
    found = C.stage(near_duplicates(docs, id_col, text_col, **options).select("did", "th", "n_shingles", "kept"), "minhash-kept")
    names = [C.fresh_name(docs.columns, x) for x in ("did", "th")]
    did, th = C.row_identity(F.col(id_col), F.col(text_col).cast("string"))
    rows = docs.withColumns({names[0]: did, names[1]: th})
    gone = found.where("not kept").select(F.col("did").alias(names[0]), F.col("th").alias(names[1])).distinct()
    rows = rows.join(gone, names, "left_anti")
    again = (found.where("kept and n_shingles > 0").groupBy(F.col("did").alias(names[0]), F.col("th").alias(names[1]))
             .agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    if not again.isEmpty():
        again = C.stage(again, "minhash-again")
        rows = rows.join(again, names, "left_anti").unionByName(rows.join(again, names, "left_semi").dropDuplicates(names))
    return rows.drop(*names)
