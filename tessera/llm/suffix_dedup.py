"""Removal of long repeated byte strings through run-length BWT indexes.

A string of ``length`` bytes that starts at two places of the corpus (the
same document included) is a repeat; every byte that a repeat covers goes.

Method. The corpus cannot be one index, so starts are routed by content:
the least hash among a window's ``seed``-byte substrings (the leftmost of
equals) is its anchor, and equal windows have equal anchors at the same
place. A *piece* is a run of starts with one anchor. Pieces whose anchor
occurs once are done. For the others the piece's bytes are cut out, equal
ones are counted once (a third of the corpus may be one copied passage), and
the different ones of an anchor go to the same block. A block's pieces are
indexed as a run-length compressed Burrows-Wheeler transform with text
positions and longest common prefixes sampled at the ends of its runs only;
streaming over the text, every other position gets its matching statistics
from the sample before it. Starts that match ``length`` bytes elsewhere are
marked. An anchor with more than ``max_pieces`` different pieces is split by
content, first into sub-pieces keyed by all the bytes that their windows
share, then into single windows: no case is dropped and no group has to fit
one task.

Nulls count as empty texts; texts under ``length`` bytes are kept whole;
repeated rows are documents of their own (and so copies of each other); an
empty table gives an empty result. Other columns pass through untouched.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import common as C

LENGTH = 200
SEED = 64
MAX_PIECES = 256
SUB = 16
_POS_BITS = 21
_SEGMENT = 1 << 18
_BLOCK = 500_000
_KNOWN = 200_000
_KEY = "key long, h binary"


# -- the index ---------------------------------------------------------------

class RunLengthIndex:
    """Run-length BWT of several short byte strings (each ends in a
    terminator of its own), with samples at the ends of its runs.

    ``heads`` / ``tails`` are the rows that begin / end a run; ``head_lcp``
    and ``tail_lcp`` hold, for the suffixes there, the length they share
    with the suffix above / below; ``head_pos`` and ``tail_pos`` where those
    suffixes start in the text.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        lengths = np.diff(offsets)
        row, place = C.ragged(lengths + 1)
        self.left = lengths[row] - place  # bytes up to the terminator
        n = len(row)
        sym = np.zeros(n + 8, np.uint64)
        sym[:n][self.left > 0] = data.astype(np.uint64) + np.uint64(1)
        self.text = sym[:n].astype(np.int16)
        # Seven symbols in a key, none beyond the terminator.
        key = np.zeros(n, np.uint64)
        for j in range(7):
            key <<= np.uint64(9)
            key |= np.where(self.left > j, sym[j:n + j], 0).astype(np.uint64)
        ranks, h, longest = [self._dense(key)], 7, int(lengths.max(initial=0))
        while h < longest:
            r = ranks[-1].astype(np.int64)
            nxt = np.zeros(n, np.int64)
            nxt[:n - h] = r[h:] + 1
            nxt[self.left < h] = 0
            ranks.append(self._dense((r * (n + 2) + nxt).astype(np.uint64)))
            h *= 2
        self.steps = [7 << i for i in range(len(ranks))]
        self.ranks = ranks
        # Equal remainders are ordered by place, as distinct terminators would.
        sa = np.argsort(ranks[-1].astype(np.int64) * n + np.arange(n))
        before = np.where(place == 0, -1 - row, sym[np.arange(n) - 1].astype(np.int64))
        bwt = before[sa]
        change = np.ones(n + 1, bool)
        change[1:n] = bwt[1:] != bwt[:-1]
        heads, tails = np.flatnonzero(change[:n]), np.flatnonzero(change[1:])
        self.n, self.runs = n, bwt[heads]
        self.head_pos, self.tail_pos = sa[heads], sa[tails]
        self.head_lcp = np.where(heads > 0, self._lce(sa[np.maximum(heads - 1, 0)], self.head_pos), 0)
        self.tail_lcp = np.where(tails < n - 1, self._lce(sa[np.minimum(tails + 1, n - 1)], self.tail_pos), 0)

    @staticmethod
    def _dense(key: np.ndarray) -> np.ndarray:
        order = np.argsort(key)
        s = key[order]
        step = np.zeros(len(s), np.int32)
        step[1:] = s[1:] != s[:-1]
        out = np.empty(len(s), np.int32)
        out[order] = np.cumsum(step, dtype=np.int32)
        return out

    def _lce(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Bytes that the suffixes at a and b share."""
        cap = np.minimum(self.left[a], self.left[b])
        got = np.zeros(len(a), np.int64)
        for rank, h in zip(self.ranks[::-1], self.steps[::-1]):
            x, y = np.minimum(a + got, self.n - 1), np.minimum(b + got, self.n - 1)
            got += np.where((got < cap) & (rank[x] == rank[y]), h, 0)
        live = np.flatnonzero(got < cap)
        for _ in range(6):  # under seven symbols are left
            x, y = a[live] + got[live], b[live] + got[live]
            live = live[self.text[x] == self.text[y]]
            got[live] += 1
            live = live[got[live] < cap[live]]
        return np.minimum(got, cap)

    def matching_statistics(self) -> np.ndarray:
        """For each place of the text, the bytes from there on that also
        start at another place. Streams forward: a place that is no sample
        has one byte less than the place before it."""
        best = np.zeros(self.n, np.int64)
        at = np.arange(self.n)
        for pos, lcp in ((self.head_pos, self.head_lcp), (self.tail_pos, self.tail_lcp)):
            sampled = np.full(self.n, -1, np.int64)
            sampled[pos] = lcp
            last = np.maximum.accumulate(np.where(sampled >= 0, at, 0))
            np.maximum(best, sampled[last] - (at - last), out=best)
        return np.minimum(best, self.left)


# -- pieces ------------------------------------------------------------------

def _anchors(data: np.ndarray, length: int, seed: int):
    """Hash of each ``seed`` bytes, and each window's anchor, over a buffer."""
    n = len(data)
    prefix = C.prefix_hashes(data)
    i = np.arange(n - seed + 1)
    kh = C.spans_hash(prefix, i, i + seed)
    v = (kh >> np.uint64(_POS_BITS) << np.uint64(_POS_BITS)) | i.astype(np.uint64)
    w, have = length - seed + 1, 1
    while have * 2 <= w:
        v = np.minimum(v[:-have], v[have:])
        have *= 2
    if have < w:
        v = np.minimum(v[:len(v) - (w - have)], v[w - have:])
    return kh, (v & np.uint64((1 << _POS_BITS) - 1)).astype(np.int64)


def _pieces(data: np.ndarray, offsets: np.ndarray, length: int, seed: int):
    """(row, start, n, anchor place, anchor hash) of every piece of the rows."""
    lens = np.diff(offsets)
    segs = []  # (row, first start, bytes)
    for r in np.flatnonzero(lens >= length):
        for s in range(0, int(lens[r]) - length + 1, _SEGMENT):
            segs.append((r, s, int(min(lens[r], s + _SEGMENT + length - 1)) - s))
    i = 0
    while i < len(segs):
        j, size = i, 0
        while j < len(segs) and (j == i or size + segs[j][2] <= _SEGMENT):
            size += segs[j][2]
            j += 1
        part = segs[i:j]
        buf = np.concatenate([data[offsets[r] + s:offsets[r] + s + b] for r, s, b in part])
        ends = np.cumsum([b for _, _, b in part])
        seg_row = np.array([r for r, _, _ in part])
        seg_first = np.array([s for _, s, _ in part])
        seg_at = ends - np.array([b for _, _, b in part])
        i = j
        kh, anchor = _anchors(buf, length, seed)
        p = np.arange(len(anchor))
        seg = np.searchsorted(ends, p, side="right")
        ok = np.flatnonzero(p + length <= ends[seg])
        new = np.ones(len(ok), bool)
        new[1:] = (np.diff(ok) != 1) | (anchor[ok][1:] != anchor[ok][:-1])
        first = np.flatnonzero(new)
        start = ok[first]
        n = np.diff(np.append(first, len(ok)))
        a, g = anchor[start], seg[start]
        yield seg_row[g], start - seg_at[g] + seg_first[g], n, a - start, kh[a]


_PIECE = "did long, th long, at long, key long"


def _emit_pieces(length: int, seed: int):
    def run(batches):
        for b in batches:
            data, offs = C.text_buffer(b.column("text"))
            did, th = b.column("did").to_numpy(), b.column("th").to_numpy()
            for lo, hi in C.batches_of(offs, _SEGMENT):
                for row, start, n, a, kh in _pieces(data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo], length, seed):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(did[lo + row]), pa.array(th[lo + row]),
                         pa.array((start << 16) | (a << 8) | n), pa.array(kh.view(np.int64))],
                        names=["did", "th", "at", "key"])
    return C.tidy(run)


_OCC = "did long, th long, at long, key long, h binary, ctx binary"


def _digest(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    raw = data.tobytes()
    o = offsets.tolist()
    return pa.array([hashlib.blake2b(raw[x:y], digest_size=16).digest() for x, y in zip(o, o[1:])], pa.binary())


def _cut(data, start, lens):
    """The spans' bytes end to end, and their offsets."""
    row, place = C.ragged(lens)
    return data[start[row] + place], np.concatenate([[0], np.cumsum(lens)])


def _emit_contexts(length: int):
    """Cuts the bytes of each document's candidate pieces. Of equal ones a
    task writes the bytes once (or a few times: what it remembers is
    bounded)."""
    def run(batches):
        known: set = set()
        for b in batches:
            data, offs = C.text_buffer(b.column("text"))
            did, th = b.column("did").to_numpy(), b.column("th").to_numpy()
            lists = b.column("pieces")
            counts = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten()
            row = np.repeat(np.arange(len(counts)), counts)
            at, key = flat.field("at").to_numpy(), flat.field("key").to_numpy()
            start, n = at >> 16, at & 255
            for lo, hi in C.batches_of(np.concatenate([[0], np.cumsum(n + length - 1)]), _SEGMENT):
                s = slice(lo, hi)
                ctx, o = _cut(data, offs[row[s]] + start[s], n[s] + length - 1)
                h = _digest(ctx, o)
                new = []
                for x in h.to_pylist():
                    new.append(x not in known)
                    known.add(x)
                if len(known) > _KNOWN:
                    known.clear()
                ctx = pc.if_else(pa.array(new), C.binary_array(ctx, o), pa.scalar(None, pa.binary()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(did[row[s]]), pa.array(th[row[s]]), pa.array(at[s]), pa.array(key[s]), h, ctx],
                    names=["did", "th", "at", "key", "h", "ctx"])
    return C.tidy(run)


# -- marks -------------------------------------------------------------------

def _pack(mask: np.ndarray, counts: np.ndarray) -> pa.Array:
    o = np.concatenate([[0], np.cumsum(counts)])
    return pa.array([np.packbits(mask[x:y]).tobytes() for x, y in zip(o[:-1].tolist(), o[1:].tolist())], pa.binary())


def _index_blocks(length: int):
    """Marks of the pieces of whole keys, block by block. Rows come sorted
    by key; a key's rows are never in two blocks."""
    def solve(t: pa.Table):
        key, w = t.column("key").to_numpy(), t.column("w").to_numpy()
        new = np.ones(len(key) + 1, bool)
        new[1:-1] = key[1:] != key[:-1]
        alone = new[:-1] & new[1:]  # repeated only if it occurs repeatedly
        out = [t.filter(pa.array(~alone)), t.filter(pa.array(alone & (w > 1)))]
        for t, by_index in zip(out, (True, False)):
            if not t.num_rows:
                continue
            data, offs = C.text_buffer(t.column("ctx"))
            counts = np.diff(offs) - length + 1
            mask = (t.column("w").to_numpy() > 1).repeat(counts)
            if by_index:
                row, place = C.ragged(counts)
                ms = RunLengthIndex(data, offs).matching_statistics()
                mask |= ms[(offs[:-1] + np.arange(len(counts)))[row] + place] >= length
            yield pa.RecordBatch.from_arrays(
                [t.column("key").combine_chunks(), t.column("h").combine_chunks(), _pack(mask, counts)],
                names=["key", "h", "mask"])

    def solved(t: pa.Table):
        """The table, all of whole keys, block by block."""
        key, size = t.column("key").to_numpy(), C.text_buffer(t.column("ctx"))[1]
        ends = np.append(np.flatnonzero(np.diff(key)) + 1, len(key))
        a = 0
        while a < len(key):
            fit = np.searchsorted(size[ends], size[a] + _BLOCK, side="right")
            e = int(max(ends[max(fit - 1, 0)], ends[np.searchsorted(ends, a, side="right")]))
            yield from solve(t.slice(a, e - a))
            a = e

    def run(batches):
        held = []
        for b in batches:
            held.append(pa.Table.from_batches([b]))
            if sum(t.nbytes for t in held) < 4 * _BLOCK:
                continue
            t = pa.concat_tables(held).combine_chunks()
            step = np.flatnonzero(np.diff(t.column("key").to_numpy()))
            if len(step):  # the last key may go on
                yield from solved(t.slice(0, int(step[-1]) + 1))
                t = t.slice(int(step[-1]) + 1)
            held = [t]
        if held and sum(t.num_rows for t in held):
            yield from solved(pa.concat_tables(held).combine_chunks())
    return C.tidy(run)


def _split(length: int, sub: int):
    """Sub-pieces of pieces: runs of starts whose distances to the anchor
    fall in one step of ``sub``; the key is a hash of all the bytes that the
    windows at these distances share."""
    def run(batches):
        for b in batches:
            data, offs = C.text_buffer(b.column("ctx"))
            anchor, w = b.column("a").to_numpy().astype(np.int64), b.column("w").to_numpy()
            for lo, hi in C.batches_of(offs, _SEGMENT):
                part, o = data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
                a = anchor[lo:hi]
                row, place = C.ragged(np.diff(o) - length + 1)
                g = (a[row] - place) // sub
                new = np.ones(len(row), bool)
                new[1:] = (row[1:] != row[:-1]) | (g[1:] != g[:-1])
                first = np.flatnonzero(new)
                n = np.diff(np.append(first, len(row)))
                r, s, g = row[first], place[first], g[first]
                core = o[r] + a[r] - g * sub
                key = C.mix(C.spans_hash(C.prefix_hashes(part), core, core + length - sub + 1) + g.astype(np.uint64))
                ctx, cuts = _cut(part, o[r] + s, n + length - 1)
                at = pa.array(lo + r)
                yield pa.RecordBatch.from_arrays(
                    [b.column("key").take(at), b.column("h").take(at), pa.array(s.astype(np.int32)),
                     pa.array(n.astype(np.int32)), pa.array(key.view(np.int64)), _digest(ctx, cuts),
                     C.binary_array(ctx, cuts), pa.array((a[r] - s).astype(np.int32)), pa.array(w[lo + r])],
                    names=["key0", "h0", "s", "n", "key", "h", "ctx", "a", "w"])
    return C.tidy(run)


def _join_masks(batches):
    """One mask of the masks of a piece's sub-pieces."""
    for b in batches:
        masks = []
        for parts in b.column("parts").to_pylist():
            m = np.zeros(max(p["s"] + p["n"] for p in parts), np.uint8)
            for p in parts:
                m[p["s"]:p["s"] + p["n"]] |= _bits(p["mask"], p["n"])
            masks.append(np.packbits(m).tobytes())
        yield pa.RecordBatch.from_arrays([b.column("key"), b.column("h"), pa.array(masks, pa.binary())],
                                         names=["key", "h", "mask"])


def _bits(mask: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(mask, np.uint8), count=n)


def _marks(items: DataFrame, length: int, max_pieces: int, levels: list[int]) -> DataFrame:
    """(key, h, mask) of the different pieces ``items`` (key, h, ctx, a, w):
    one bit for each start of a piece, set where its window repeats."""
    over = C.stage(items.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max_pieces).select("key"), "repeat-over")
    out = (items.join(over, "key", "left_anti").select("key", "h", "ctx", "w")
           .repartition("key").sortWithinPartitions("key").mapInArrow(_index_blocks(length), f"{_KEY}, mask binary"))
    if over.isEmpty():
        return out
    last = len(levels) == 1
    subs = items.join(over, "key").select("key", "h", "ctx", "a", "w").mapInArrow(
        _split(length, levels[0]), f"key0 long, h0 binary, s int, n int, {_KEY}, ctx binary, a int, w long")
    subs = C.stage(subs.drop("ctx") if last else subs, "repeat-sub")
    if last:  # a sub-piece is one window now: equal ones are repeats
        below = subs.groupBy("key", "h").agg(F.sum("w").alias("_w")).where("_w > 1").select(
            "key", "h", F.unhex(F.lit("80")).alias("mask"))
    else:
        twice = C.stage(subs.groupBy("key").agg(F.sum("w").alias("n")).where("n > 1").select("key"), "repeat-sub-keys")
        below = _marks(C.stage(_distinct(subs.join(twice, "key")), "repeat-sub-items"), length, max_pieces, levels[1:])
    found = (subs.select("key0", "h0", "s", "n", "key", "h").join(below, ["key", "h"])
             .groupBy("key0", "h0").agg(F.collect_list(F.struct("s", "n", "mask")).alias("parts")))
    return out.unionByName(found.withColumnsRenamed({"key0": "key", "h0": "h"})
                           .mapInArrow(_join_masks, f"{_KEY}, mask binary"))


def _distinct(rows: DataFrame) -> DataFrame:
    return rows.groupBy("key", "h").agg(F.first("ctx", ignorenulls=True).alias("ctx"), F.first("a").alias("a"), F.sum("w").alias("w"))


def _spans(length: int):
    """Maximal runs of bytes that each document's marked windows cover."""
    def covered(at, mask, doc_parts):
        data, offs = C.text_buffer(mask)
        bits = np.unpackbits(data)
        part, place = C.ragged(np.minimum(at & 255, 8 * np.diff(offs)))
        on = np.flatnonzero(bits[8 * offs[part] + place])
        part, place = part[on], place[on]
        doc = np.repeat(np.arange(len(doc_parts)), doc_parts)[part]
        start = (at >> 16)[part] + place
        order = np.lexsort((start, doc))
        doc, start = doc[order], start[order]
        cut = np.ones(len(doc) + 1, bool)
        cut[1:-1] = (doc[1:] != doc[:-1]) | (start[1:] - start[:-1] > length)
        first, last = np.flatnonzero(cut[:-1]), np.flatnonzero(cut[1:])
        return np.bincount(doc[first], minlength=len(doc_parts)), start[first], start[last] + length

    def run(batches):
        for b in batches:
            lists = b.column("parts")
            counts = np.diff(lists.offsets.to_numpy())
            flat, first = lists.flatten(), np.concatenate([[0], np.cumsum(counts)])
            at, mask = flat.field("at").to_numpy(), flat.field("mask")
            size = np.concatenate([[0], np.cumsum(at & 255)])[first]  # starts before each document
            for lo, hi in C.batches_of(size, _SEGMENT):
                part = slice(int(first[lo]), int(first[hi]))
                n, start, end = covered(at[part], mask.slice(part.start, part.stop - part.start), counts[lo:hi])
                runs = pa.StructArray.from_arrays([pa.array(start), pa.array(end)], names=["start", "end"])
                yield pa.RecordBatch.from_arrays(
                    [b.column("did").slice(lo, hi - lo), b.column("th").slice(lo, hi - lo),
                     pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), runs)],
                    names=["did", "th", "spans"])
    return C.tidy(run)


def _cut_spans(batches):
    for b in batches:
        data, offs = C.text_buffer(b.column("text"))
        kept = []
        for i, spans in enumerate(b.column("spans").to_pylist()):
            edge = [offs[i], *(offs[i] + x for s in spans for x in (s["start"], s["end"])), offs[i + 1]]
            kept.append(b"".join(data[x:y].tobytes() for x, y in zip(edge[::2], edge[1::2])))
        yield pa.RecordBatch.from_arrays([b.column("did"), b.column("th"), b.column("spans"), pa.array(kept, pa.binary())],
                                         names=["did", "th", "spans", "kept"])


def _as_text(batches):
    for b in batches:
        kept = [x.decode("utf-8", "ignore") for x in b.column("kept").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("did"), b.column("th"), pa.array(kept, pa.string())],
                                         names=["did", "th", "kept"])


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   seed: int = SEED, max_pieces: int = MAX_PIECES) -> DataFrame:
    """(did, th, spans, kept) of each document that holds a repeat: its
    identity (``common.row_identity``), the maximal repeated runs of bytes
    [start, end) in order, and the bytes that stay."""
    if not 0 < length - seed < 200:
        raise ValueError("length - seed must be between 1 and 199")
    text = F.col(text_col).cast("string")
    did, th = C.row_identity(F.col(id_col), text)
    base = docs.select(did.alias("did"), th.alias("th"), text.alias("text"))
    pieces = C.stage(base.mapInArrow(_emit_pieces(length, seed), _PIECE), "repeat-pieces")
    twice = C.stage(pieces.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"), "repeat-keys")
    cand = C.stage(pieces.join(twice, "key").groupBy("did", "th")
                   .agg(F.collect_set(F.struct("at", "key")).alias("pieces")), "repeat-candidates")
    some = C.maybe_in(base, cand.select("did", "th"), ["did", "th"])
    held = C.stage(some.join(cand, ["did", "th"]), "repeat-docs")
    occ = C.stage(held.mapInArrow(_emit_contexts(length), _OCC), "repeat-occurrences")
    anchor = F.shiftright("at", 8).bitwiseAND(F.lit(255).cast("bigint")).cast("int")
    items = C.stage(_distinct(occ.select("key", "h", "ctx", anchor.alias("a"), F.lit(1).cast("bigint").alias("w"))),
                    "repeat-items")
    marks = C.stage(_marks(items, length, max_pieces, [SUB, 1]), "repeat-marks")
    spans = (occ.select("did", "th", "at", "key", "h").join(marks, ["key", "h"])
             .groupBy("did", "th").agg(F.collect_list(F.struct("at", "mask")).alias("parts"))
             .mapInArrow(_spans(length), "did long, th long, spans array<struct<start:long,end:long>>")
             .where(F.size("spans") > 0))
    return (held.select("did", "th", "text").dropDuplicates(["did", "th"]).join(spans, ["did", "th"])
            .mapInArrow(_cut_spans, "did long, th long, spans array<struct<start:long,end:long>>, kept binary"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   seed: int = SEED, max_pieces: int = MAX_PIECES) -> DataFrame:
    """``docs`` with ``text_col`` cut: same rows, columns and order of
    columns. Bytes that a cut leaves of a split character are dropped. A
    document that is a repeat as a whole stays with an empty text; a null
    text stays null."""
    found = (repeated_spans(docs, id_col, text_col, length, seed, max_pieces).select("did", "th", "kept")
             .mapInArrow(_as_text, "did long, th long, kept string"))
    names = [C.fresh_name(docs.columns, x) for x in ("did", "th", "kept")]
    did, th = C.row_identity(F.col(id_col), F.col(text_col).cast("string"))
    found = found.select(F.col("did").alias(names[0]), F.col("th").alias(names[1]),
                         F.col("kept").alias(names[2]))
    return (docs.withColumns({names[0]: did, names[1]: th}).join(found, names[:2], "left")
            .withColumn(text_col, F.coalesce(names[2], F.col(text_col))).select(*C.columns(docs)))
