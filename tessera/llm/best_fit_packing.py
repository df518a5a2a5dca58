"""Best-fit decreasing packing of tokenized documents into sequences.

A document's ids and one separator id make a run of tokens; a run longer
than ``capacity`` is cut into pieces of ``capacity`` tokens, the first of
which may be shorter. Pieces go to sequences in order of falling length,
each to the open sequence with the least room that still holds it.

Method. Pieces of one length are alike, so the plan is made over the counts
of at most ``capacity`` lengths, whatever the number of documents: open
sequences are ranges of numbers by remaining room, and a segment tree over
the rooms finds the tightest that fits in logarithmic time; a step places as
many pieces as that range takes. The result is the global best-fit
decreasing packing. Each piece finds its place by its rank among the pieces
of its length: its number within its task, as written to a table, plus the
pieces of earlier tasks (a running sum over one row per task and length).

Ids are those of the ``tokenizers`` library's own call without special tokens
around a text: an added token that a text spells out is that token's id.
A null text counts as empty (one separator). Repeated rows are documents of
their own. An empty table gives an empty result.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from bisect import insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm import common as C

CAPACITY = 2048
SEPARATOR = 0
_LONG = 1 << 20
_PART = 1 << 16
#: Both tokenizer libraries agree on what letters, digits and spaces are here.
_BEYOND_LATIN = re.compile("[^\x00-ɏ]")
#: Single spaces between ASCII letters: a token never spans the place before one.
_SAFE_CUT = re.compile("(?<=[A-Za-z]) (?=[A-Za-z])")


# -- tokens ------------------------------------------------------------------

def _byte_alphabet() -> dict[str, int]:
    """Byte-level BPE files print bytes as characters: printable ones as they
    are, the others as the characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    odd = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(odd)}


class Encoder:
    """Ids of a byte-level BPE file of the ``tokenizers`` library.

    Texts of Latin characters go through a rank encoder built from the same
    file where its ids stand in the order of its merges (several times
    faster, same ids); all others through the library itself. Long texts are
    cut at spaces between letters, where no token can span.

    With ``added`` (the library's default) an added token that a text spells
    out is that token's id; without, it is text like any other. A text is
    split at plain added tokens; where one takes the blanks beside it, stands
    for whole words only or is normalised, the library finds them.
    """

    def __init__(self, path: str, added: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.path, self._slow, self._fast = path, None, None
        file = json.load(open(path, encoding="utf-8"))
        model, tokens = file["model"], (file.get("added_tokens") or []) if added else []
        self.added = {t["content"]: model["vocab"].get(t["content"], t["id"]) for t in tokens}
        self._plain = not any(t[k] for t in tokens for k in ("single_word", "lstrip", "rstrip", "normalized"))
        longest = sorted(self.added, key=len, reverse=True)
        self._spelt = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None
        self._reach = len(longest[0]) if longest else 0
        alphabet, vocab = _byte_alphabet(), model["vocab"]
        merges = [m if isinstance(m, str) else " ".join(m) for m in model["merges"]]
        ids = [vocab.get(m.replace(" ", "")) for m in merges]
        if None not in ids and ids == sorted(set(ids)) and not model.get("ignore_merges"):
            import public_tokenizers
            import tiktoken
            known = set(ids)
            ranks = {bytes(alphabet[c] for c in t): i for t, i in vocab.items() if i in known or len(t) == 1}
            self._fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _holds_added(self, text: str) -> bool:
        return any(t in text for t in self.added)

    def _part(self, text: str) -> list[int]:
        if not self._holds_added(text):
            return self._run(text)
        if not self._plain:
            return self._library(text)
        return [i for n, x in enumerate(self._spelt.split(text)) if x for i in ([self.added[x]] if n % 2 else self._run(x))]

    def _run(self, text: str) -> list[int]:
        if self._fast is not None and not _BEYOND_LATIN.search(text):
            return self._fast.encode_ordinary(text)
        return self._library(text)

    def _library(self, text: str) -> list[int]:
        if self._slow is None:
            from tokenizers import Tokenizer
            self._slow = Tokenizer.from_file(self.path)
            self._slow.encode_special_tokens = not self.added
        return self._slow.encode(text, add_special_tokens=False).ids

    def ids(self, text: str) -> np.ndarray:
        if len(text) <= _PART:
            return np.array(self._part(text), np.uint32)
        out, at = [], 0
        while at < len(text):
            cut = _SAFE_CUT.search(text, at + _PART)
            while cut and self._holds_added(text[max(cut.start() - self._reach, 0):cut.start() + 1 + self._reach]):
                cut = _SAFE_CUT.search(text, cut.end())
            end = cut.start() if cut else len(text)
            out.append(np.array(self._part(text[at:end]), np.uint32))
            at = end
        return np.concatenate(out)


def _pieces(path: str, capacity: int, separator: int, with_ids: bool):
    def run(batches):
        from pyspark import TaskContext
        task = TaskContext.get().partitionId()
        encoder = C._CACHE.get(("encoder", path)) or C._CACHE.setdefault(("encoder", path), Encoder(path, added=True))
        seen = np.zeros(capacity + 1, np.int64)
        for b in batches:
            for lo, hi in C.batches_of(C.text_buffer(b.column("text"))[1], _LONG):
                rows, out_ids = [], []
                for i, t in zip(b.column("doc_id").slice(lo, hi - lo).to_pylist(), b.column("text").slice(lo, hi - lo)):
                    ids = np.append(encoder.ids(t.as_py() or ""), np.uint32(separator)).astype("<u4")
                    first = len(ids) % capacity or capacity
                    cuts = [0, *range(first, len(ids) + 1, capacity)]
                    for k, (x, y) in enumerate(zip(cuts, cuts[1:])):
                        raw = ids[x:y].tobytes()
                        rows.append((i, k, x, y - x, zlib.crc32(raw), task, seen[y - x]))
                        seen[y - x] += 1
                        out_ids.append(raw if with_ids else None)
                cols = [pa.array(list(c), pa.int32() if n in (1, 5) else pa.int64()) for n, c in enumerate(zip(*rows))]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"]
                if with_ids:
                    cols, names = [*cols, pa.array(out_ids, pa.binary())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(cols, names=names)
    return C.tidy(run)


# -- the plan ----------------------------------------------------------------

class TightestRoom:
    """Segment tree over rooms 0..capacity that says which hold any sequence."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.any = [0] * (2 * self.size)

    def set(self, room: int, value: int) -> None:
        i = room + self.size
        self.any[i] = value
        while i > 1:
            i //= 2
            self.any[i] = self.any[2 * i] | self.any[2 * i + 1]

    def at_least(self, room: int) -> int | None:
        """The least room >= ``room`` that is set."""
        i = room + self.size
        if self.any[i]:
            return room
        while i > 1:
            if i % 2 == 0 and self.any[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.any[2 * i] else 2 * i + 1
                return i - self.size
            i //= 2
        return None


def best_fit_plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Steps (length, first rank, first sequence, pieces a sequence, offset)
    of best-fit decreasing over ``counts`` pieces of each length."""
    tree = TightestRoom(capacity)
    open_: dict[int, list[tuple[int, int]]] = {}  # room -> ranges (first sequence, sequences), in order
    plan, sequences = [], 0

    def put(room: int, first: int, n: int) -> None:
        if room and n:
            ranges = open_.setdefault(room, [])
            insort(ranges, (first, n))
            tree.set(room, 1)

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = tree.at_least(length)
            if room is None:
                room, each = capacity, capacity // length
                first, n = sequences, -(-left // each)
                sequences += n
            else:
                each = room // length
                first, n = open_[room].pop(0)
                if not open_[room]:
                    tree.set(room, 0)
            full, rest = divmod(min(left, n * each), each)
            plan.append((length, rank, first, each, capacity - room))
            put(room - each * length, first, full)
            if rest:
                put(room - rest * length, first + full, 1)
            used = full + (rest > 0)
            put(room, first + used, n - used)
            rank += full * each + rest
            left -= full * each + rest
    return plan


def _place(plan: np.ndarray):
    """``plan``: the steps, by length and first rank."""
    step_key = plan[:, 0] << 44 | plan[:, 1]

    def run(batches):
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            s = plan[np.searchsorted(step_key, length << 44 | rank, side="right") - 1]
            q, r = np.divmod(rank - s[:, 1], s[:, 3])
            keep = [n for n in b.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in keep), pa.array(s[:, 2] + q), pa.array(s[:, 4] + r * length)],
                                             names=[*keep, "sequence_id", "offset"])
    return C.tidy(run)


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
         separator: int = SEPARATOR, with_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32,
    sequence_id, offset`` (and ``ids``, little-endian 32-bit, if wanted).
    ``path`` names a byte-level BPE file of the ``tokenizers`` library that
    the executors can read."""
    if not 0 < capacity < 1 << 18:
        raise ValueError("capacity must be between 1 and 2**18 - 1")
    kept = "doc_id long, piece int, start long, length long, ids_crc32 long"
    more = ", ids binary" if with_ids else ""
    pieces = C.stage(docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
                     .mapInArrow(_pieces(path, capacity, separator, with_ids), f"{kept}, task int, nth long{more}"), "pack-pieces")
    by_task = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = by_task.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most capacity rows
    plan = np.array(sorted(best_fit_plan(counts, capacity)), np.int64).reshape(-1, 5)
    ranked = pieces.join(before, ["length", "task"]).withColumn("rank", F.col("before") + F.col("nth")).drop("task", "nth", "before")
    return (ranked.select("doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else []), "rank")
            .mapInArrow(_place(plan), f"{kept}{more}, sequence_id long, offset long"))


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) of pieces packed ``with_ids``; a sequence holds
    ``capacity`` ids at most."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id", F.expr("aggregate(p, X'', (a, x) -> concat(a, x.ids))").alias("ids"))
