"""Shared helpers: staged tables, Arrow text access and vectorised hashing."""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import scratch_path

#: Odd multiplier of the rolling hash and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
BASE_INV = pow(BASE, -1, 1 << 64)
MASK64 = (1 << 64) - 1

#: What a worker keeps between tasks, by name.
_CACHE: dict = {}


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared checkpoint folder and read
    it back: cuts the lineage, survives the loss of executors, and keeps
    column pruning and file sizes for the planner."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh_name(taken, name: str) -> str:
    """``name``, prefixed until it clashes with no column of ``taken``."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name = "_" + name
    return name


def column(name: str):
    """A column by its name as it is (names may hold dots)."""
    return F.col("`" + name.replace("`", "``") + "`")


def columns(df: DataFrame) -> list:
    """All columns, by quoted name."""
    return [column(c) for c in df.columns]


def row_identity(id_col, text_col):
    """Two columns that name a row by its id and whole text (64 bits, so that
    one id may have many texts): rows equal in both are interchangeable. A
    null id falls back on a hash of the text, so that rows without an id are
    no hot key."""
    return (F.coalesce(id_col.cast("bigint"), F.xxhash64(text_col, F.lit(1))),
            F.xxhash64(F.lit(2), text_col))


#: Bits of the bitmap that ``maybe_in`` sends to every task (1 MiB).
BITMAP_BITS = 1 << 23


def _in_bitmap(sent):
    def run(batches):
        bits = np.unpackbits(np.frombuffer(sent.value, np.uint8), bitorder="little").astype(bool)
        for b in batches:
            yield b.filter(pa.array(bits[b.column("_bit").to_numpy()])).drop_columns(["_bit"])
    return run


def maybe_in(rows: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """``rows`` without most of those whose ``on`` is not in ``keys``: a
    filter ahead of a join with ``keys``, so that fewer rows are shuffled.
    The bitmap has a fixed size; the more keys, the less it holds back."""
    spark = rows.sparkSession
    bit = F.pmod(F.xxhash64(*on), F.lit(BITMAP_BITS))
    hit = keys.select(bit.alias("_bit")).groupBy(F.bitmap_bucket_number(F.col("_bit") + 1).alias("n")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col("_bit") + 1)).alias("bits"))
    whole = bytearray(BITMAP_BITS // 8)
    for r in hit.collect():  # at most 256 rows of 4 KiB
        at = (r["n"] - 1) * 4096
        whole[at:at + 4096] = r["bits"]
    sent = spark.sparkContext.broadcast(bytes(whole))
    return rows.withColumn("_bit", bit).mapInArrow(_in_bitmap(sent), rows.schema)


def give_back() -> None:
    """Return memory that earlier batches used to the system: workers live
    on between stages, and what they hold counts against their executor."""
    pa.default_memory_pool().release_unused()
    if "trim" not in _CACHE:
        try:
            _CACHE["trim"] = ctypes.CDLL("libc.so.6").malloc_trim
        except (OSError, AttributeError):  # another C library
            _CACHE["trim"] = lambda _: 0
    _CACHE["trim"](0)


def tidy(run):
    """``run`` over a task's batches, giving memory back when it ends."""
    def go(batches):
        try:
            yield from run(batches)
        finally:
            give_back()
    return go


def text_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow string or binary column, end to end, and the
    offsets of its rows in them (one more than rows). Nulls are empty."""
    give_back()
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, dtype=np.int64)[column.offset:column.offset + n + 1] if n else np.zeros(1, np.int64)
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf[offsets[0]:offsets[-1]], offsets - offsets[0]


def batches_of(offsets: np.ndarray, target: int):
    """Ranges of rows whose bytes add up to about ``target``; a longer row
    is a range of its own."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + target, side="right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (a bijection), element by element."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n at least (kept per worker)."""
    have = _CACHE.get("powers")
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        up, down = np.full(size, BASE, np.uint64), np.full(size, BASE_INV, np.uint64)
        up[0] = down[0] = 1
        have = (np.multiply.accumulate(up), np.multiply.accumulate(down))
        if size <= 1 << 22:
            _CACHE["powers"] = have
    return have


def byte_values() -> np.ndarray:
    """A fixed 64-bit value for each byte."""
    if "bytes" not in _CACHE:
        with np.errstate(over="ignore"):
            _CACHE["bytes"] = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return _CACHE["bytes"]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Sums of value(byte i) * BASE**i before each position (length + 1)."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(byte_values()[data] * powers(len(data))[0][:len(data)], out=out[1:])
    return out


def spans_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans [start, end); they depend on nothing
    but the spans' bytes."""
    return mix((prefix[end] - prefix[start]) * powers(len(prefix))[1][start])


def ragged(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows of the given lengths laid end to end: each element's row, and
    its place within the row."""
    row = np.repeat(np.arange(len(lengths)), lengths)
    first = np.cumsum(lengths) - lengths
    return row, np.arange(len(row)) - first[row]


def binary_array(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """An Arrow binary array over ``data`` cut at ``offsets``."""
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1,
                                 [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)),
                                  pa.py_buffer(np.ascontiguousarray(data, np.uint8))]).cast(pa.binary())
