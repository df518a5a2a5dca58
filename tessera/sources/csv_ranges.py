"""Quoted CSV read by byte ranges: one file, many tasks, whole records.

A quoted field may hold line breaks, so whether a line begins a record hangs
on all the lines ahead of it in its file. Each line is a function from the state ahead
of it (outside or inside quotes) to the state behind it. These functions
compose, so

1. each byte range (one split of the text reader) composes its lines,
2. a running composition over a file's ranges, a row each, gives the state
   in which each range begins, and
3. each range, told its state, puts its lines together to records in the
   order in which it reads them.

No text is shuffled but the pieces at the ends of ranges, of records that
go on in the next one. Every task is told the ranges that begin inside
quotes, 8 bytes each (6 MB for 100 TB in ranges of 128 MiB). A record of more
than ``max_bytes`` (a quote that is never closed swallows the rest of its
file) is not gathered: each of its lines is a row of its own, flagged as
malformed. The lines of a range are read in sequence, which no built-in
expression can do without a shuffle; so steps 1 and 3 are Arrow functions.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: A longer record is no record.
MAX_BYTES = 64 << 20
#: A record that grows beyond this is handed on in pieces.
PIECE_BYTES = 4 << 20


class LineStates:
    """The state behind a line (True: inside quotes), from that ahead of it.
    Doubled quotes stand for one; a field that a quote begins ends with the next
    one, and what follows up to the separator is part of it; quotes within
    other fields are text."""

    def __init__(self, sep: str):
        s = re.escape(sep)
        self.sep, self.closed = sep, re.compile(f'(^|{s})"[^"]*"[^{s}]*')
        self.opens = re.compile(f'(^|{s})"')

    def behind(self, line: str, inside: bool) -> bool:
        line = line.replace('""', "")
        if '"' not in line:
            return inside
        if inside:
            line = line.partition('"')[2]
            at = line.find(self.sep)
            line = line[at:] if at >= 0 else ""
        return '"' in line and self.opens.search(self.closed.sub(r"\1", line)) is not None


def _stretches(batch, keys):
    """(keys' values, lines) of each range in a batch, a few MB at a time:
    what is made of lines is then as small, however long a batch's are."""
    cut = {0, batch.num_rows}
    for k in keys:
        runs = pc.run_end_encode(batch.column(k))
        cut.update(runs.run_ends.to_pylist())
    cut = sorted(cut)
    for x, y in zip(cut, cut[1:]):
        key, lines = tuple(batch.column(k)[x].as_py() for k in keys), batch.column("value").slice(x, y - x)
        step = max(1, PIECE_BYTES * len(lines) // max(1, lines.nbytes))
        for i in range(0, len(lines), step):
            yield key, lines.slice(i, step)


def _quoted(lines: pa.Array) -> np.ndarray:
    return pc.match_substring(lines, '"').to_numpy(zero_copy_only=False)


def _compose(sep: str):
    """(file, block, f0, f1): the state behind each range for both states ahead."""
    def run(batches):
        states, now, f = LineStates(sep), None, [False, True]
        for batch in batches:
            for key, lines in _stretches(batch, ["file", "block"]):
                if now != key:
                    if now:
                        yield _function_row(now, f)
                    now, f = key, [False, True]
                for line in lines.filter(pa.array(_quoted(lines))).to_pylist():
                    one = states.behind(line, f[0])
                    f = [one, one if f[0] == f[1] else states.behind(line, f[1])]
                # A line without quotes leaves every state as it is.
        if now:
            yield _function_row(now, f)
    return run


def _function_row(now, f):
    return pa.RecordBatch.from_arrays([pa.array([now[0]]), pa.array([now[1]], pa.int64()), pa.array([f[0]]), pa.array([f[1]])],
                                      names=["file", "block", "f0", "f1"])


class _Records:
    """Puts the lines of one range together. Rows: (record, kind, seq), kind 0
    a record, 1 the beginning of one, 2 its continuation."""

    def __init__(self, states: LineStates, inside: bool):
        self.states, self.inside, self.held, self.size, self.seq = states, inside, [], 0, 0
        self.kind = 2 if inside else 1

    def put(self, lines: pa.Array):
        """Arrays of rows that these lines complete: (records, kind, first seq)."""
        quoted = np.flatnonzero(_quoted(lines))
        inside = np.full(len(lines), self.inside)
        for i, line in zip(quoted.tolist(), lines.take(pa.array(quoted)).to_pylist()):
            now = self.states.behind(line, self.inside)
            if now != self.inside:
                self.inside = now
                inside[i:] = now
        ends = np.flatnonzero(~inside) + 1
        if len(ends):
            yield from self.hand_on(lines.slice(0, ends[0]), closed=True)
            if len(ends) > 1:
                yield self._numbered(pc.binary_join(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), lines), "\n"), 0)
            lines = lines.slice(ends[-1])
        if len(lines):
            self.held.append(lines)
            self.size += lines.nbytes
            if self.size > PIECE_BYTES:
                yield from self.hand_on()

    def hand_on(self, more: pa.Array | None = None, closed: bool = False):
        """What is held, with ``more`` behind it, as one row."""
        held = [*self.held, *([more] if more is not None else [])]
        if held:
            text = "\n".join(line for part in held for line in part.to_pylist())
            yield self._numbered(pa.array([text]), 0 if closed and self.kind == 1 else self.kind)
        self.held, self.size, self.kind = [], 0, 1 if closed else 2

    def _numbered(self, rows: pa.Array, kind: int):
        self.seq += len(rows)
        return rows, kind, self.seq - len(rows)


def range_key(file: Column, block: Column) -> Column:
    return F.xxhash64(file, block)


def _gather(sent, sep: str, keys: list[str], pieces: bool):
    """The records of each range, or the pieces at its ends."""

    def rows_of(key, found):
        for rows, kind, seq in found:
            if (kind > 0) == pieces:
                n = len(rows)
                yield pa.RecordBatch.from_arrays(
                    [rows, pa.array(np.full(n, kind, np.int32)), pa.array(np.arange(seq, seq + n)), *[pa.array([k] * n) for k in key[1:]]],
                    names=["record", "kind", "seq", *keys])

    def run(batches):
        states, begin_inside = LineStates(sep), sent.value
        now, rec = None, None
        for batch in batches:
            for key, lines in _stretches(batch, ["key", *keys]):
                if now != key:
                    if now:
                        yield from rows_of(now, rec.hand_on())
                    i = np.searchsorted(begin_inside, key[0])
                    now, rec = key, _Records(states, bool(i < len(begin_inside) and begin_inside[i] == key[0]))
                yield from rows_of(now, rec.put(lines))
        if now:
            yield from rows_of(now, rec.hand_on())
    return run


_ROWS = "record string, kind int, seq long, block long"


def begins_inside(lines: DataFrame, sep: str) -> np.ndarray:
    """The keys of the ranges that begin inside quotes, sorted."""
    ranges = lines.select("file", "block", "value").mapInArrow(_compose(sep), "file string, block long, f0 boolean, f1 boolean")
    # Running composition: the last range that sets a state, and the swaps since.
    w = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    fixed = F.when(F.col("f0") == F.col("f1"), F.col("f0"))
    ranges = ranges.withColumn("n", F.coalesce(F.sum(F.when(F.col("f0") & ~F.col("f1"), 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0)))
    last = F.last(F.when(fixed.isNotNull(), F.struct(fixed.alias("state"), "n")), ignorenulls=True).over(w)
    ranges = ranges.withColumns({"last": last, "before": F.coalesce(F.lag("n").over(Window.partitionBy("file").orderBy("block")), F.lit(0))})
    swaps = F.col("before") - F.coalesce(F.col("last")["n"], F.lit(0))
    inside = F.coalesce(F.col("last")["state"], F.lit(False)) != (swaps % 2 == 1)
    found = ranges.where(inside).select(range_key(F.col("file"), F.col("block")).alias("key")).collect()  # 8 bytes a range
    return np.sort(np.array([r["key"] for r in found], np.int64))


def records(spark: SparkSession, path: str, sep: str = ",", max_bytes: int = MAX_BYTES) -> DataFrame:
    """(record, first, whole): each record of the files at ``path``, whether
    it is its file's first, and whether it is a record (else a line of one that is too long)."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    sent = spark.sparkContext.broadcast(begins_inside(lines, sep))
    keyed = lines.withColumn("key", range_key(F.col("file"), F.col("block")))
    at_start = (F.col("block") == 0) & (F.col("seq") == 0)
    done = keyed.select("key", "block", "value").mapInArrow(_gather(sent, sep, ["block"], False), _ROWS).select("record", at_start.alias("first"), F.lit(True).alias("whole"))

    pieces = keyed.mapInArrow(_gather(sent, sep, ["block", "file"], True), _ROWS + ", file string").withColumn("bytes", F.octet_length("record") + 1)
    owner = F.sum(F.when(F.col("kind") == 1, 1).otherwise(0)).over(
        Window.partitionBy("file").orderBy("block", "seq").rowsBetween(Window.unboundedPreceding, 0))
    owned = pieces.select("file", "block", "seq", "kind", "bytes").withColumn("owner", owner)
    owned = owned.withColumn("total", F.sum("bytes").over(Window.partitionBy("file", "owner"))).drop("kind", "bytes")
    pieces = pieces.drop("kind", "bytes").join(owned, ["file", "block", "seq"])
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "seq", "record"))), lambda x: x["record"]), "\n")
    joined = (pieces.where(F.col("total") <= max_bytes).groupBy("file", "owner").agg(text.alias("record"), F.bool_or(at_start).alias("first"))
              .select("record", "first", F.lit(True).alias("whole")))
    long = pieces.where(F.col("total") > max_bytes).select(F.explode(F.split("record", "\n", -1)).alias("record"), F.lit(False).alias("first"), F.lit(False).alias("whole"))
    return done.unionByName(joined).unionByName(long)


def read(spark: SparkSession, path: str, schema: StructType, corrupt: str, options: dict, header: bool, max_bytes: int = MAX_BYTES) -> DataFrame:
    """The records parsed against ``schema`` (which has the ``corrupt``
    column); empty lines are no records, a header is dropped."""
    rows = records(spark, path, max_bytes=max_bytes).where("record <> ''")
    if header:
        rows = rows.where("not first")
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema)
    parsed = F.from_csv("record", ddl, options)
    if len(schema) == 2:  # a lone column's null is a record of its own, whose lead from_csv would drop
        lone = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])
        parsed = F.when(F.col("record") == options["nullValue"], lone).otherwise(parsed)
    rows = rows.select(parsed.alias("p"), "record", "whole")
    broken = {corrupt: F.col("record")}
    return rows.select(*[F.when(F.col("whole"), F.col("p")[f.name]).otherwise(broken.get(f.name, F.lit(None))).alias(f.name) for f in schema])
