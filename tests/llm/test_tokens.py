import collections
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from tessera.llm import best_fit_packing as B
from tessera.llm import bpe_transducer as T

from helpers import docs

JSON, RANKS = P.path("byte_bpe_50k.json"), P.path("byte_bpe_multi_50k.tiktoken")
ODD = ["", " ", "a" * 3000, "ab" * 900, "=" * 700 + "x", " \n\t" * 60, "\r\n" * 9 + "é", "0123456789" * 30, "<|endoftext|> x", "a b  c   d",
       "ǅ ʰ 中文字 x", "naïve façade — “q”", "🙂🙃 ok 👩‍👩‍👧", "\0\x01\x7f", "don't I'LL we've", "ﬁ\u200b\u3000x\u2028y"]


def scrambled(seed, n=30):
    rng = random.Random(seed)
    pools = [(32, 127), (0xA0, 0x24F), (0x370, 0x5FF), (0x4E00, 0x4FFF), (0x1F300, 0x1F64F)]
    return ["".join(chr(rng.randint(*rng.choice(pools))) for _ in range(rng.randint(0, 200))) for _ in range(n)]


def fresh(*path):
    return tiktoken.Encoding("test", pat_str=P.PATTERN, mergeable_ranks=T.load_ranks(RANKS), special_tokens={})


# -- transducer --------------------------------------------------------------

@pytest.mark.parametrize("limit", [800_000, 60])
def test_encoding_equals_the_library(limit):
    """A limit of 60 transitions rebuilds the tables all the time."""
    codec, library = T.Codec(RANKS, P.PATTERN), fresh()
    codec.fst.max_transitions = limit
    for t in ODD + scrambled(1, 30 if limit > 60 else 6):
        ids = codec.encode(t)
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(t)
        assert "".join(codec.decode(ids)) == t


def test_long_texts_go_slice_by_slice(monkeypatch):
    monkeypatch.setattr(T, "_LONG", 50)
    monkeypatch.setattr(T, "_SLICE", 7)
    codec, library = T.Codec(RANKS, P.PATTERN), fresh()
    for t in scrambled(2):
        assert np.frombuffer(codec.encode(t), "<u4").tolist() == library.encode_ordinary(t)
        assert "".join(codec.decode(codec.encode(t))) == t


def test_utf8_stream_at_any_cut():
    raw = "aé€🙂z".encode()
    for cuts in range(1 << (len(raw) - 1)):
        s, out, at = T.Utf8Stream(), "", 0
        for i in range(1, len(raw) + 1):
            if i == len(raw) or cuts >> (i - 1) & 1:
                out += s.feed(raw[at:i])
                at = i
        assert out + s.close() == "aé€🙂z"
    s = T.Utf8Stream()
    assert s.feed(b"a\xff") + s.feed(b"\xe2\x82") + s.close() == "a\ufffd\ufffd"


def test_encode_decode_frames(spark):
    rows = [(i, t, "x") for i, t in enumerate(ODD)] + [(None, None, None), (1, ODD[1], "x")]
    df = docs(spark, rows, ", ids string")
    tokens = T.encode(df, RANKS, P.PATTERN)
    back = sorted((r["doc_id"] is None, r["doc_id"], r["text"]) for r in T.decode(tokens, RANKS, P.PATTERN).collect())
    assert back == sorted((i is None, i, t or "") for i, t, _ in rows)
    assert T.round_trip(df.limit(0), RANKS, P.PATTERN).count() == 0


# -- packing -----------------------------------------------------------------

def plain_best_fit(lengths, capacity):
    room = []
    for n in sorted(lengths, reverse=True):
        fit = [i for i, r in enumerate(room) if r >= n]
        if fit:
            room[min(fit, key=lambda i: room[i])] -= n
        else:
            room.append(capacity - n)
    return sorted(room)


@pytest.mark.parametrize("seed", range(60))
def test_plan_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([5, 16, 50, 100])
    lengths = [rng.choice([rng.randint(1, capacity), 1, capacity // 2 + 1, capacity]) for _ in range(rng.randint(0, 150))]
    plan = np.array(sorted(B.best_fit_plan(collections.Counter(lengths), capacity)), np.int64).reshape(-1, 5)
    held = collections.defaultdict(list)
    for n, count in collections.Counter(lengths).items():
        for rank in range(count):
            s = plan[np.searchsorted(plan[:, 0] << 44 | plan[:, 1], n << 44 | rank, side="right") - 1]
            q, r = divmod(rank - s[1], s[3])
            held[s[2] + q].append((s[4] + r * n, n))
    for pieces in held.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
    assert sorted(capacity - sum(n for _, n in p) for p in held.values()) == plain_best_fit(lengths, capacity)


def test_tightest_room():
    tree = B.TightestRoom(20)
    for room in (3, 7, 20):
        tree.set(room, 1)
    assert [tree.at_least(n) for n in (0, 3, 4, 7, 8, 20)] == [3, 3, 7, 7, 20, 20]
    tree.set(20, 0)
    assert tree.at_least(8) is None


def test_encoder_equals_the_library(monkeypatch):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(JSON)
    library.encode_special_tokens = True
    monkeypatch.setattr(B, "_PART", 40)
    encoder = B.Encoder(JSON)
    for t in ODD + scrambled(3) + ["word " * 50 + "end"]:
        assert encoder.ids(t).tolist() == library.encode(t, add_special_tokens=False).ids


MARKED = ["<|endoftext|>", "a <|endoftext|> b", "<|endoftext|><|endoftext|>x", "中文<|endoftext|> 字", "<|endoftext|", "<<|endoftext|>>", "word <|endoftext|> " * 30,
          "<|endoftext|>\n\n ok  <|endoftext|>  \t"]


def test_added_tokens_are_the_untouched_librarys(monkeypatch, spark):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(JSON)
    assert 50256 in library.encode("a <|endoftext|> b", add_special_tokens=False).ids
    want = {i: library.encode(t, add_special_tokens=False).ids for i, t in enumerate(ODD + scrambled(3) + MARKED)}
    packed = B.pack(docs(spark, [(i, t, 0) for i, t in enumerate(ODD + scrambled(3) + MARKED)], ", length int"), JSON, capacity=4096, with_ids=True)
    assert {r["doc_id"]: np.frombuffer(bytes(r["ids"]), "<u4").tolist()[:-1] for r in packed.collect()} == want
    monkeypatch.setattr(B, "_PART", 40)
    encoder = B.Encoder(JSON, added=True)
    for i, t in enumerate(ODD + scrambled(3) + MARKED):
        assert encoder.ids(t).tolist() == want[i]


@pytest.mark.parametrize("flags", [{}, {"lstrip": True, "rstrip": True}, {"single_word": True}, {"normalized": True}])
def test_added_tokens_of_any_kind(tmp_path, monkeypatch, flags):
    """Tokens with blanks inside, one the start of another, at cuts of long texts."""
    import json
    from tokenizers import Tokenizer
    file = json.load(open(JSON, encoding="utf-8"))
    kind = {"single_word": False, "lstrip": False, "rstrip": False, "normalized": False, "special": True} | flags
    file["added_tokens"] = [{"id": 50256 + n, "content": c, **kind} for n, c in enumerate(["end of", "end of text", "stop"])]
    path = tmp_path / "tokens.json"
    path.write_text(json.dumps(file), encoding="utf-8")
    library, encoder = Tokenizer.from_file(str(path)), B.Encoder(str(path), added=True)
    monkeypatch.setattr(B, "_PART", 7)
    rng = random.Random(6)
    for _ in range(200):
        t = "".join(rng.choice(["end", " of", " text", " ", "end of text", "stop", "nonstop", " a word", "é", "\n"]) for _ in range(30))
        assert encoder.ids(t).tolist() == library.encode(t, add_special_tokens=False).ids


def test_pack_edge_cases(spark):
    rng = random.Random(4)
    rows = [(i, "a b c " * rng.randint(0, 60), 0) for i in range(60)] + [(100, None, 0), (101, "", 0), (None, "hot", 0)]
    rows += [(200, "same text here", 0)] * 40 + [(300, "x y " * 700, 0)]
    df = docs(spark, rows, ", length int")
    packed = B.pack(df, JSON, capacity=64, with_ids=True).collect()
    encoder, by_doc, sequences = B.Encoder(JSON), collections.defaultdict(list), collections.defaultdict(list)
    for r in packed:
        by_doc[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
        assert r["length"] <= 64 and zlib.crc32(bytes(r["ids"])) == r["ids_crc32"]
    for i, text, _ in rows:
        ids = [*encoder.ids(text or "").tolist(), 0]
        first = len(ids) % 64 or 64
        cuts = [0, *range(first, len(ids) + 1, 64)]
        want = [(k, a, b - a, np.array(ids[a:b], "<u4").tobytes()) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
        got = sorted((r["piece"], r["start"], r["length"], bytes(r["ids"])) for r in by_doc[i])
        assert got == sorted(want * (40 if i == 200 else 1))
    for s in sequences.values():
        at = 0
        for r in sorted(s, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 64
    assert len(sequences) == len(plain_best_fit([r["length"] for r in packed], 64))
    whole = {r["sequence_id"]: bytes(r["ids"]) for r in B.sequences(B.pack(df, JSON, capacity=64, with_ids=True)).collect()}
    assert sum(map(len, whole.values())) == 4 * sum(r["length"] for r in packed) and max(map(len, whole.values())) <= 256
    assert B.pack(df.limit(0), JSON).count() == 0
