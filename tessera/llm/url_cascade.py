"""Exact URL filtering by rules and a cascade of Bloom filters.

A rule (verdict, host, path) fits its host and all subdomains where the
url's path starts with the rule's; the longest rule wins (of equally long
ones the first in order of text). Urls that no rule fits are judged by their
host's membership in a list, held as a cascade: the first Bloom filter
encodes the listed keys, the second those other keys of the corpus that the
first lets through, the third the listed keys that the second lets through,
and so on until none are left. Over the corpus's complete key universe the
first level that a key fails tells exactly whether it is listed: rows need no
join and no lookup of the list.

The universe is cut into shards by hash; a task builds the cascade of one
shard. The finished cascades are broadcast if their size, which is counted
first, is under ``broadcast_bytes``; beyond that rows go to the shards: they
are dealt by shard and salt, and each such group starts with its cascade, so
that a host with a third of all rows is spread and a task holds one shard.

Null urls and urls without ``://`` have an empty host and path. Repeated
rows are judged alike. An empty table gives an empty result; a key outside
the universe may be judged either way.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm import common as C

KEYS_PER_SHARD = 4096
BITS_PER_KEY = 6
BROADCAST_BYTES = 32 << 20
SALTS = 32
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3))
    return F.translate(F.regexp_extract(F.coalesce(rest, F.lit("")), "^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3))
    return F.regexp_extract(F.coalesce(rest, F.lit("")), "^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The winning rule's text and verdict (null where none fits)."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]), reverse=True):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        text, verdict = F.when(fits, F.lit(h + p)).otherwise(text), F.when(fits, F.lit(kind)).otherwise(verdict)
    return text, verdict


# -- the cascade -------------------------------------------------------------

def _probes(hashes: np.ndarray, level: int, bits: int, count: int) -> np.ndarray:
    """Bit numbers (count x keys) of keys at a level."""
    h = C.mix(hashes + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & C.MASK64))
    a, b = h >> np.uint64(32), (h & np.uint64(0xFFFFFFFF)) | np.uint64(1)
    return (a[None, :] + np.arange(count, dtype=np.uint64)[:, None] * b[None, :]) % np.uint64(bits)


def _hits(filter_: tuple[np.ndarray, int], hashes: np.ndarray, level: int) -> np.ndarray:
    packed, count = filter_
    at = _probes(hashes, level, 8 * len(packed), count)
    return (packed[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).all(0)


def build(listed: np.ndarray, other: np.ndarray, bits_per_key: int = BITS_PER_KEY) -> list[tuple[np.ndarray, int]]:
    """Levels (packed bits, probes) that tell the listed hashes from the others."""
    levels, inside, outside = [], listed, other
    count = max(1, round(bits_per_key * 0.69))
    while len(inside):
        if len(levels) > 200:
            raise ValueError("keys with equal hashes on both sides")
        size = max(8, -(-len(inside) * bits_per_key // 8))
        packed = np.zeros(size, np.uint8)
        at = _probes(inside, len(levels), 8 * size, count).reshape(-1)
        np.bitwise_or.at(packed, at >> np.uint64(3), (1 << (at & np.uint64(7))).astype(np.uint8))
        levels.append((packed, count))
        passed = outside[_hits(levels[-1], outside, len(levels) - 1)] if len(outside) else outside
        inside, outside = passed, inside
    return levels


def member(levels: list[tuple[np.ndarray, int]], hashes: np.ndarray) -> np.ndarray:
    """Whether keys of the universe are listed."""
    out = np.full(len(hashes), len(levels) % 2 == 1)
    live = np.arange(len(hashes))
    for n, level in enumerate(levels):
        hit = _hits(level, hashes[live], n)
        out[live[~hit]] = n % 2 == 1
        live = live[hit]
    return out


def _key_hashes(column) -> np.ndarray:
    data, offs = C.text_buffer(column)
    return C.spans_hash(C.prefix_hashes(data), offs[:-1], offs[1:])


def _pack(levels) -> bytes:
    head = np.array([len(levels), *(x for packed, count in levels for x in (len(packed), count))], "<u4")
    return head.tobytes() + b"".join(packed.tobytes() for packed, _ in levels)


def _unpack(raw: bytes) -> list[tuple[np.ndarray, int]]:
    n = int(np.frombuffer(raw, "<u4", 1)[0])
    sizes = np.frombuffer(raw, "<u4", 2 * n, 4).reshape(-1, 2)
    at, out = 4 + 8 * n, []
    for size, count in sizes.tolist():
        out.append((np.frombuffer(raw, np.uint8, size, at), count))
        at += size
    return out


def _build_shards(batches):
    """Cascades of whole shards from rows sorted by shard (a shard is small)."""
    held = None
    for b in chain(batches, [None]):
        t = pa.Table.from_batches([b]) if b is not None else None
        if t is not None and t.num_rows:
            held = t if held is None else pa.concat_tables([held, t])
        if held is None:
            continue
        shard = held.column("shard").to_numpy()
        ends = np.append(np.flatnonzero(np.diff(shard)) + 1, len(shard))
        if b is not None:
            ends = ends[:-1]
        a = 0
        for e in ends.tolist():
            part = held.slice(a, e - a)
            h, listed = _key_hashes(part.column("key")), part.column("listed").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard[a:a + 1]), pa.array([_pack(build(h[listed], h[~listed]))], pa.binary())], names=["shard", "cascade"])
            a = e
        held = held.slice(a) if a < held.num_rows else None


def cascades(universe: DataFrame, keys_per_shard: int = KEYS_PER_SHARD) -> DataFrame:
    """(shard, cascade) over ``universe`` (key, listed), one row a key; also
    the number of shards as column ``shards``."""
    universe = C.stage(universe, "cascade-universe")
    shards = max(1, -(-universe.count() // keys_per_shard))
    rows = universe.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int"))
    built = rows.repartition("shard").sortWithinPartitions("shard").mapInArrow(_build_shards, "shard int, cascade binary")
    return C.stage(built.withColumn("shards", F.lit(shards)), "cascade-shards")


def _judge_all(filters, shards: int):
    def run(batches):
        levels = {s: _unpack(raw) for s, raw in filters.value}
        for b in batches:
            h = _key_hashes(b.column("key"))
            shard, out = b.column("shard").to_numpy(), np.zeros(b.num_rows, bool)
            order = np.argsort(shard, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1):
                if len(part) and shard[part[0]] in levels:
                    out[part] = member(levels[shard[part[0]]], h[part])
            yield b.append_column("listed", pa.array(out))
    return C.tidy(run)


def _judge_dealt(batches):
    """Rows by (shard, salt), each group led by its cascade."""
    levels = []
    for b in batches:
        lead = np.flatnonzero(~b.column("row").is_null().to_numpy(zero_copy_only=False) ^ True)
        h, out, a = _key_hashes(b.column("key")), np.zeros(b.num_rows, bool), 0
        for e in [*lead.tolist(), b.num_rows]:
            if e > a:
                out[a:e] = member(levels, h[a:e])
            if e < b.num_rows:
                levels = _unpack(b.column("cascade")[e].as_py())
            a = e
        keep = pa.array(np.isin(np.arange(b.num_rows), lead, invert=True))
        yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(out)], names=["row", "listed"]).filter(keep)


def listed(rows: DataFrame, key: str, filters: DataFrame, name: str = "listed",
           broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``rows`` with a boolean: whether ``key`` (not null) is listed."""
    head = filters.agg(F.max("shards"), F.coalesce(F.sum(F.length("cascade")), F.lit(0))).first()
    shards, size = head[0] or 1, head[1]
    cols, names = C.columns(rows), rows.columns
    shard = F.pmod(F.xxhash64(F.col(key)), F.lit(shards)).cast("int")
    if size <= broadcast_bytes:
        sent = rows.sparkSession.sparkContext.broadcast([(r["shard"], bytes(r["cascade"])) for r in filters.collect()])
        plain = rows.select(F.struct(*cols).alias("row"), F.col(key).alias("key"), shard.alias("shard"))
        out = plain.mapInArrow(_judge_all(sent, shards), T.StructType([*plain.schema.fields, T.StructField("listed", T.BooleanType())]))
    else:
        plain = rows.select(shard.alias("shard"), F.pmod(F.xxhash64(*cols), F.lit(SALTS)).cast("int").alias("salt"),
                            F.struct(*cols).alias("row"), F.col(key).alias("key"), F.lit(None).cast("binary").alias("cascade"))
        kind = plain.schema["row"].dataType
        lead = filters.select("shard", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"),
                              F.lit(None).cast(kind).alias("row"), F.lit("").alias("key"), "cascade")
        out = (plain.union(lead).repartition("shard", "salt").sortWithinPartitions("shard", "salt", F.col("row").isNotNull())
               .mapInArrow(_judge_dealt, T.StructType().add("row", kind).add("listed", "boolean")))
    return out.select(*[F.col("row")[c].alias(c) for c in names], F.col("listed").alias(name))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], list_: DataFrame, url_col: str = "url",
          broadcast_bytes: int = BROADCAST_BYTES, keys_per_shard: int = KEYS_PER_SHARD) -> DataFrame:
    """``pages`` with ``host, path, rule, verdict`` (columns of these names
    are replaced). ``list_`` has the listed
    hosts (column ``key``); the universe is every host of ``pages``."""
    url = F.col(url_col)
    rows = pages.withColumns({"host": host_of(url), "path": path_of(url)})
    known = rows.groupBy(F.col("host").alias("key")).agg(F.lit(False).alias("listed"))
    universe = known.select("key", "listed").union(list_.select("key", F.lit(True))).groupBy("key").agg(F.max("listed").alias("listed"))
    text, verdict = rule_of(F.col("host"), F.col("path"), rules)
    name = C.fresh_name(rows.columns, "listed")
    out = listed(rows, "host", cascades(universe, keys_per_shard), name, broadcast_bytes)
    return out.withColumns({"rule": text, "verdict": F.coalesce(verdict, F.when(F.col(name), "block").otherwise("allow"))}).drop(name)
