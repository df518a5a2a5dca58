"""Incremental file ingest: a second run with the same checkpoint picks up
only the new files."""

from pyspark.sql.types import StructType

from tessera.session import scratch_path
from tessera.sources import files as S
from tessera.streaming.file_ingest import start_ingest


def test_incremental_exactly_once(spark):
    src, out, ckpt = (scratch_path(spark, n) for n in ("s_src", "s_out", "s_ckpt"))
    schema = StructType.fromDDL("k string, v string")
    declared = {"k": "bigint", "v": "double"}
    S.write_csv(spark.createDataFrame([("1", "1.5"), ("2", " NA ")], "k string, v string"), f"{src}/a",
                header=True)
    start_ingest(spark, f"{src}/*", schema, declared, out, ckpt).awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(out).select("k", "v", "malformed").collect())) == [(1, 1.5, False), (2, None, False)]
    S.write_csv(spark.createDataFrame([("3", "x")], "k string, v string"), f"{src}/b", header=True)
    start_ingest(spark, f"{src}/*", schema, declared, out, ckpt).awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(out).select("k", "v", "malformed").collect())) == [(1, 1.5, False), (2, None, False), (3, None, False)]
