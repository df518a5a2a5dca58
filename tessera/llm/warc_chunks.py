"""WARC archives as a table of record chunks.

A record's bytes (header block, HTTP header, payload, two line breaks) are
rows (record, chunk_no, last, data, digest): ``data`` has ``chunk_bytes`` of
payload at most and ``digest`` is the SHA-256 of the record's bytes so far,
carried from row to row. The rows' data in order of (record, chunk_no) are a
WARC 1.1 file. Payloads are sliced where they lie and streamed, so neither
writing nor reading ever assembles a record. Chunks of one record stream
through one task in order (the digest is sequential); records of one chunk,
nearly all of them, are read where they lie without a shuffle.

Of records with equal payloads of ``min_revisit`` bytes at least, the one
with the least id is a response and the others are revisits that refer to
it. Null payloads are empty, null urls too; line breaks in urls are
percent-encoded; a null id never names a response (alone with its payload it
is one). Rows that share the least id are all responses. An empty table gives
an empty archive. Damaged chunks make the reader fail, naming the record.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import common as C

CHUNK_BYTES = 64 << 10
MIN_REVISIT = 100
#: Fixed values of the WARC 1.1 format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
_TABLE = "record long, chunk_no long, last boolean, data binary, digest string"
_READ = "id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _running_digests(batches):
    """Adds the digest so far; a record's chunks come in order."""
    sha = hashlib.sha256()
    for b in batches:
        out = []
        for no, data in zip(b.column("chunk_no").to_pylist(), b.column("data")):
            if no == 0:
                sha = hashlib.sha256()
            sha.update(memoryview(data.as_buffer()))
            out.append(sha.hexdigest())
        yield b.append_column("digest", pa.array(out, pa.string()))


def chunk_table(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                chunk_bytes: int = CHUNK_BYTES, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """The chunk rows of a record for each row of ``pages``."""
    text = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url"),
                        text.cast("binary").alias("payload"), F.sha2(text, 256).alias("sha"),
                        F.octet_length(text).cast("bigint").alias("size"))
    firsts = C.stage(rows.where(F.col("size") >= min_revisit).groupBy("sha").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
                     .where("n > 1").select("sha", "first"), "warc-firsts")
    rows = rows.join(firsts, "sha", "left").withColumn("record", F.monotonically_increasing_id())
    revisit = F.coalesce(~F.col("first").eqNullSafe(F.col("id")) & F.col("first").isNotNull() & (F.col("size") >= min_revisit), F.lit(False))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"),
                    F.lit("\r\n\r\n"))
    block = F.when(revisit, F.lit("")).otherwise(http)
    body = F.when(revisit, F.lit(0)).otherwise(F.col("size"))
    name = F.concat(F.lit("<urn:x-page:"), F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(">"))
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    fields = [("WARC-Type: ", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))), ("WARC-Record-ID: ", name),
              ("WARC-Date: ", F.lit(DATE)), ("WARC-Target-URI: ", url), ("WARC-Payload-Digest: sha256:", F.col("sha")),
              ("WARC-Payload-Length: ", F.col("size").cast("string"))]
    head = F.concat(F.lit("WARC/1.1\r\n"), *(x for k, v in fields for x in (F.lit(k), v, F.lit("\r\n"))),
                    F.when(revisit, F.concat(F.lit(f"WARC-Profile: {PROFILE}\r\nWARC-Refers-To: <urn:x-page:"), F.col("first").cast("string"),
                                             F.lit(">\r\n"))).otherwise(F.lit("")),
                    F.lit("Content-Type: "), F.when(revisit, F.lit("message/http")).otherwise(F.lit("application/http; msgtype=response")),
                    F.lit("\r\nContent-Length: "), (body + F.length(block)).cast("string"), F.lit("\r\n\r\n"), block)
    slices = F.greatest(F.ceil(body / chunk_bytes), F.lit(1)).cast("bigint")
    part = F.when(F.col("body") > 0, F.substr("payload", (F.col("chunk_no") * chunk_bytes + 1).cast("int"), F.lit(chunk_bytes))
                  ).otherwise(F.lit(b""))
    rows = (rows.select("record", "payload", head.alias("head"), body.alias("body"), slices.alias("slices"))
            .select("record", "payload", "head", "body", "slices", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("slices") - 1)).alias("chunk_no")))
    last = F.col("chunk_no") == F.col("slices") - 1
    data = F.concat(F.when(F.col("chunk_no") == 0, F.col("head").cast("binary")).otherwise(F.lit(b"")), part,
                    F.when(last, F.lit(b"\r\n\r\n")).otherwise(F.lit(b"")))
    return rows.select("record", "chunk_no", last.alias("last"), data.alias("data")).mapInArrow(_running_digests, _TABLE)


def write_archive(pages: DataFrame, path: str, **options) -> None:
    """Writes the chunk table of ``pages`` at ``path`` (a shared folder)."""
    chunk_table(pages, **options).write.option("compression", "zstd").parquet(path)


class RecordReader:
    """Reads one record, fed chunk by chunk; keeps only header bytes."""

    def __init__(self, record: int):
        self.record, self.sha, self.payload = record, hashlib.sha256(), hashlib.sha256()
        self.head, self.fields, self.left, self.size = b"", None, 0, 0

    def fail(self, what: str):
        raise ValueError(f"record {self.record}: {what}")

    def feed(self, data: memoryview, digest: str) -> None:
        self.sha.update(data)
        if self.sha.hexdigest() != digest:
            self.fail("digest of the bytes so far differs")
        if self.fields is None:
            self.head += data.tobytes()
            end = self.head.find(b"\r\n\r\n")
            if not self.head.startswith(b"WARC/1.1\r\n") or end < 0:
                self.fail("no header block")
            lines = self.head[:end].decode("utf-8").split("\r\n")[1:]
            self.fields = dict(x.split(": ", 1) for x in lines)
            data, self.left = memoryview(self.head)[end + 4:], int(self.fields["Content-Length"])
            if self.left:
                http = self.head.index(b"\r\n\r\n", end + 4) + 4
                data, self.left = memoryview(self.head)[http:], self.left - (http - end - 4)
            self.head = b""
        part = data[:self.left]
        self.payload.update(part)
        self.size += len(part)
        self.left -= len(part)

    def close(self) -> tuple:
        f = self.fields
        if self.left:
            self.fail("bytes are missing")
        said = f["WARC-Payload-Digest"].removeprefix("sha256:")
        number = lambda x: int(m[1]) if (m := re.fullmatch(r"<urn:x-page:(-?\d+)>", x)) else None
        if f["WARC-Type"] == "response":
            if self.payload.hexdigest() != said or self.size != int(f["WARC-Payload-Length"]):
                self.fail("payload differs from its header")
        return (number(f["WARC-Record-ID"]), f["WARC-Target-URI"], int(f["WARC-Payload-Length"]), said, f["WARC-Type"],
                number(f.get("WARC-Refers-To", "")))


def _read(batches):
    """Records whose chunks come one after the other, in order."""
    names = ["id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    now = None
    for b in batches:
        out = []
        for record, no, last, data, digest in zip(b.column("record").to_pylist(), b.column("chunk_no").to_pylist(),
                                                  b.column("last").to_pylist(), b.column("data"), b.column("digest").to_pylist()):
            if no == 0:
                now = RecordReader(record)
            elif now is None or now.record != record:
                raise ValueError(f"record {record}: chunk {no} without those before")
            now.feed(memoryview(data.as_buffer()), digest)
            if last:
                out.append(now.close())
                now = None
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out), kinds)], names=names)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: ``id, url, payload_bytes, payload_digest,
    record_type, refers_to``; all digests are checked on the way."""
    table = spark.read.schema(_TABLE).parquet(path)
    short = table.where("chunk_no = 0 and last").mapInArrow(_read, _READ)
    long_ = table.where("not (chunk_no = 0 and last)")
    order = ["record", "chunk_no"]
    return short.unionByName(long_.repartition("record").sortWithinPartitions(*order).mapInArrow(_read, _READ))


def export_file(spark: SparkSession, path: str, file: str) -> None:
    """Streams an archive to one local ``.warc`` file on the driver, a
    partition at a time (for looking at, not for whole crawls)."""
    rows = spark.read.schema(_TABLE).parquet(path).repartitionByRange("record").sortWithinPartitions("record", "chunk_no")
    with open(file, "wb") as f:
        for r in rows.select("data").toLocalIterator():
            f.write(r["data"])
