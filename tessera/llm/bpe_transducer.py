"""Byte-level BPE by a lazily determinised transducer, and streaming decode.

The merges are compiled into a transducer over bytes. After each prefix of a
word the encoding ends in one token, and an encoding is right exactly if
every two neighbours are (both facts of rank-ordered merging), so the
nondeterministic states are *open tokens*: a token-to-be that starts at some
place, the token before it, and the tokens not yet certain. A deterministic
state is the set of open tokens that the bytes so far allow. States and
transitions are made when first needed; what all open tokens of a state
agree on is emitted, so lookahead is bounded by the longest token. Words seen
before come from a memo of bounded size (a path compressed to one step).

Decoding joins the tokens' bytes and feeds them, a slice at a time, to an
incremental UTF-8 machine that holds back an unfinished character.

A null text counts as empty and has no ids. Very long texts are matched and
encoded slice by slice. Repeated rows and empty tables need no care.
"""

from __future__ import annotations

import base64
import hashlib
from itertools import islice
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import common as C

MEMO_WORDS = 400_000
MAX_TRANSITIONS = 800_000
#: Open tokens with at most so many tokens below are checked for a way on.
FEW = 16
_LONG = 1 << 20
_SLICE = 1 << 16


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a file with a base64 token and its rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in map(bytes.split, filter(bytes.strip, f))}


class Transducer:
    """Encodes words (byte strings that no token spans beyond).

    Tokens are read from a trie: ``child`` maps 256 * node + byte to a node,
    ``ends`` a node to the token that ends there. An open token is (token
    before it or -1, tokens not yet certain, its node).
    """

    def __init__(self, ranks: dict[bytes, int], max_transitions: int = MAX_TRANSITIONS):
        self.ranks, self.bytes = ranks, {r: t for t, r in ranks.items()}
        self.child, self.ends, nodes = {}, {}, 1
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                nxt = self.child.get(node << 8 | byte)
                if nxt is None:
                    nxt = self.child[node << 8 | byte] = nodes
                    nodes += 1
                node = nxt
            self.ends[node] = rank
        self.inner = {key >> 8 for key in self.child}
        self.below = self._few_below()
        self.halves: dict[int, tuple | None] = {}
        self.pairs: dict[int, bool] = {}
        self.dead: dict[int, bool] = {}
        self.max_transitions = max_transitions
        self.reset()

    def _few_below(self) -> dict[int, tuple]:
        """The tokens that end below a node, for nodes with few of them."""
        below: dict[int, list] = {}
        for key in sorted(self.child, key=self.child.get, reverse=True):  # children first
            node, to = key >> 8, self.child[key]
            here = below.setdefault(node, [])
            if len(here) <= FEW:
                here += below.get(to, ())
                if to in self.ends:
                    here.append(self.ends[to])
        return {n: tuple(t) for n, t in below.items() if len(t) <= FEW}

    def _hopeless(self, last: int, node: int) -> bool:
        """Whether no token below the node may follow ``last``."""
        key = (last + 1) << 32 | node
        found = self.dead.get(key)
        if found is None:
            pairs, at = self.pairs, (last + 1) << 32
            found = True
            for token in self.below[node]:
                ok = pairs.get(at | token)
                if self.fits(last, token) if ok is None else ok:
                    found = False
                    break
            if len(self.dead) >= 2 * self.max_transitions:
                self.dead.clear()
            self.dead[key] = found
        return found

    def reset(self) -> None:
        self.states, self.moves, self.finals, self.open, self.made = {}, [], [], [], 0
        self._state(((-1, (), 0),))

    def _state(self, items: tuple) -> int:
        found = self.states.setdefault(items, len(self.open))
        if found == len(self.open):
            self.open.append(items)
            self.moves.append({})
            self.finals.append(items[-1][1])
        return found

    def merge(self, word: bytes, parts_left: int = 1) -> list[bytes]:
        """The merge rule itself, down to ``parts_left`` parts at least."""
        parts = [word[i:i + 1] for i in range(len(word))]
        while len(parts) > parts_left:
            rank, at = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 62), i) for i in range(len(parts) - 1))
            if rank == 1 << 62:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def split(self, token: int) -> tuple | None:
        """The two tokens last merged into ``token``; (token,) for a single
        byte; None if merging never makes the token."""
        if token not in self.halves:
            word = self.bytes[token]
            parts = self.merge(word, 2)
            self.halves[token] = ((token,) if len(word) == 1 else
                                  tuple(self.ranks[p] for p in parts) if len(parts) == 2 else None)
        return self.halves[token]

    def _stay_apart(self, a: int, b: int) -> bool:
        """Whether merging a's and b's bytes ends in just a and b. Takes back
        the latest of the merges that made the two tokens, step by step: at
        no time may the parts that touch have a merge that comes earlier."""
        if self.split(a) is None or self.split(b) is None:
            return False
        undone = 1 << 62  # merges from this rank on come too late
        while True:
            rank = self.ranks.get(self.bytes[a] + self.bytes[b])
            if rank is not None and rank < undone:
                return False
            x, y = self.split(a), self.split(b)
            if len(x) == len(y) == 1:
                return True
            if len(y) == 1 or len(x) == 2 and a > b:
                undone, a = a, x[1]
            else:  # an equal merge to the left comes first
                undone, b = b + 1, y[0]

    def fits(self, last: int, token: int) -> bool:
        """Whether ``token`` may follow ``last`` (-1: begin a word)."""
        if len(self.pairs) >= 2 * self.max_transitions:
            self.pairs.clear()
        ok = self.split(token) is not None if last < 0 else self._stay_apart(last, token)
        self.pairs[(last + 1) << 32 | token] = ok
        return ok

    def _move(self, state: int, byte: int) -> tuple[int, tuple]:
        """Makes the transition of a state on a byte."""
        items, ended, child, ends, pairs = [], None, self.child, self.ends, self.pairs
        inner, below, dead = self.inner, self.below, self.dead
        for last, pending, node in self.open[state]:
            node = child.get(node << 8 | byte)
            if node is None:
                continue
            if node in inner:
                if node in below:
                    out = dead.get((last + 1) << 32 | node)
                    if not (self._hopeless(last, node) if out is None else out):
                        items.append((last, pending, node))
                else:
                    items.append((last, pending, node))
            if ended is None and node in ends:
                token = ends[node]
                ok = pairs.get((last + 1) << 32 | token)
                if self.fits(last, token) if ok is None else ok:
                    ended = (token, (*pending, token), 0)
        items.append(ended)
        first, sure = items[0][1], 0
        for token in first:
            for item in items:
                if len(item[1]) <= sure or item[1][sure] != token:
                    break
            else:
                sure += 1
                continue
            break
        if sure:
            items = [(last, pending[sure:], node) for last, pending, node in items]
        move = self.moves[state][byte] = self._state(tuple(items)), first[:sure]
        self.made += 1
        return move

    def encode(self, word: bytes) -> list[int]:
        whole = self.ranks.get(word)
        if whole is not None:
            return [whole]
        if self.made > self.max_transitions:
            self.reset()
        state, out, moves = 0, [], self.moves
        for byte in word:
            step = moves[state].get(byte)
            if step is None:
                if self.made > 2 * self.max_transitions:  # within one very long word
                    now = self.open[state]
                    self.reset()
                    state, moves = self._state(now), self.moves
                step = self._move(state, byte)
            state, emitted = step
            if emitted:
                out += emitted
        out += self.finals[state]
        return out


class Utf8Stream:
    """Incremental UTF-8: bytes in, whole characters out. The state is the
    beginning of an unfinished character; malformed bytes give U+FFFD."""

    def __init__(self):
        self.held = b""

    def feed(self, data: bytes) -> str:
        data = self.held + data
        end = len(data)
        for back in range(1, min(3, end) + 1):
            lead = data[end - back]
            if lead & 0xC0 != 0x80:  # the last character's first byte
                need = 4 if lead >= 0xF0 else 3 if lead >= 0xE0 else 2 if lead >= 0xC0 else 1
                end -= back if need > back else 0
                break
        self.held = data[end:]
        return data[:end].decode("utf-8", "replace")

    def close(self) -> str:
        held, self.held = self.held, b""
        return held.decode("utf-8", "replace")


class Codec:
    """Whole texts to ids and back."""

    def __init__(self, path: str, pattern: str):
        import regex
        self.fst = Transducer(load_ranks(path))
        self.pattern = regex.compile(pattern)
        self.memo: dict[str, bytes] = {}
        self.token = [self.fst.bytes.get(i, b"") for i in range(max(self.fst.bytes) + 1)]

    def _word(self, word: str) -> bytes:
        if len(self.memo) >= MEMO_WORDS:
            self.memo.clear()
        ids = self.fst.encode(word.encode("utf-8"))
        ids = pack(f"<{len(ids)}I", *ids)
        if len(word) <= 64:
            self.memo[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids as little-endian 32-bit integers, end to end."""
        if len(text) <= _LONG:
            words = iter([self.pattern.findall(text)])
        else:
            matches = self.pattern.finditer(text)
            words = iter(lambda: [m.group() for m in islice(matches, _SLICE)], [])
        memo, word = self.memo, self._word
        return b"".join([memo.get(w) or word(w) for ws in words for w in ws])

    def decode(self, ids: bytes):
        """The text, slice by slice."""
        stream, codes, token = Utf8Stream(), np.frombuffer(ids, "<u4"), self.token
        for at in range(0, len(codes), _SLICE):
            yield stream.feed(b"".join([token[i] for i in codes[at:at + _SLICE].tolist()]))
        yield stream.close()


def _codec(path: str, pattern: str) -> Codec:
    key = ("codec", path, pattern)
    return C._CACHE.get(key) or C._CACHE.setdefault(key, Codec(path, pattern))


def _encode(path: str, pattern: str):
    def run(batches):
        codec = _codec(path, pattern)
        for b in batches:
            text = b.column("text")
            for lo, hi in C.batches_of(C.text_buffer(text)[1], _LONG):
                ids = [codec.encode(t.as_py() or "") for t in text.slice(lo, hi - lo)]
                yield pa.RecordBatch.from_arrays([b.column("id").slice(lo, hi - lo), pa.array(ids, pa.binary())], names=["id", "ids"])
    return C.tidy(run)


def _decode(path: str, pattern: str):
    def run(batches):
        codec = _codec(path, pattern)
        for b in batches:
            texts = ["".join(codec.decode(x.as_py() or b"")) for x in b.column("ids")]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(texts, pa.string())], names=["id", "text"])
    return C.tidy(run)


def _digests(path: str, pattern: str):
    def run(batches):
        codec = _codec(path, pattern)
        for b in _encode(path, pattern)(batches):
            n, sha, back = [], [], []
            for x in b.column("ids"):
                ids, h = x.as_py(), hashlib.sha256()
                for part in codec.decode(ids):
                    h.update(part.encode("utf-8"))
                n.append(len(ids) // 4)
                sha.append(hashlib.sha256(ids).hexdigest())
                back.append(h.hexdigest())
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(n, pa.int64()), pa.array(sha), pa.array(back)],
                                             names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return C.tidy(run)


def _apply(df: DataFrame, id_col: str, col: str, kind: str, name: str, fn, schema: str) -> DataFrame:
    id_type = df.schema[id_col].dataType.simpleString()
    out = df.select(F.col(id_col).alias("id"), F.col(col).cast(kind).alias(name)).mapInArrow(fn, f"id {id_type}, {schema}")
    return out.withColumnRenamed("id", id_col)


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids): each text's ids as little-endian 32-bit integers."""
    return _apply(docs, id_col, text_col, "string", "text", _encode(path, pattern), "ids binary")


def decode(tokens: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text) of rows as ``encode`` returns them."""
    return _apply(tokens, id_col, ids_col, "binary", "ids", _decode(path, pattern), "text string")


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): encodes each text, decodes
    the ids in the same task and keeps the digests of both."""
    return _apply(docs, id_col, text_col, "string", "text", _digests(path, pattern),
                  "n_tokens long, ids_sha256 string, decoded_sha256 string")
