"""Tables published together: a run's rows of all tables, or none.

A run writes each table under its own id (partitions ``dataset_id`` and
``run``) and then one commit file that names the (table, dataset) pairs it
replaces. Readers fold the commits: of each pair the run of the last one
is live, rows of all others are not seen. A run that dies between two tables
has no commit, so readers stay with what they had.

Commit files are numbered without gaps and never change. A run writes the number after the last
one by a rename that fails if the number is taken; then another run was
faster. If that one replaced none of the same pairs, the next number is
tried; else the run fails with ``Conflict`` (what it read of its dataset is not
what it would replace). The file system's rename must refuse an existing
target, as HDFS does; on others let one process publish at a time.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

COMMITS = "_commits"
_ENTRY = "version bigint, run string, `table` string, dataset_id string"


class Conflict(RuntimeError):
    """Another run replaced rows of the same dataset in the meantime."""


class _Files:
    """The few file operations of a commit, on any Hadoop file system."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.gateway = spark._jvm, spark.sparkContext._gateway
        self.folder = self.path(root.rstrip("/") + "/" + COMMITS)
        self.fs = self.folder.getFileSystem(spark._jsc.hadoopConfiguration())
        self.folder = self.fs.makeQualified(self.folder)
        self.context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.folder.toUri(), spark._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def last(self) -> int:
        """The last commit's number; 0 before the first."""
        if not self.fs.exists(self.folder):
            return 0
        names = [s.getPath().getName() for s in self.fs.listStatus(self.folder)]
        return max((int(n[:-5]) for n in names if n.endswith(".json")), default=0)

    def create(self, version: int, text: str) -> bool:
        """Write a commit; False if its number is taken."""
        self.fs.mkdirs(self.folder)
        draft = self.path(f"{self.folder}/.{uuid.uuid4().hex}")
        out = self.fs.create(draft, False)
        out.write(bytearray(text.encode()))
        out.close()
        none = self.gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 1)
        none[0] = self.jvm.org.apache.hadoop.fs.Options.Rename.NONE
        try:
            self.context.rename(draft, self.path(f"{self.folder}/{version:012d}.json"), none)
            return True
        except Exception as e:
            self.fs.delete(draft, False)
            if "FileAlreadyExists" in str(e):
                return False
            raise


def commits(spark: SparkSession, root: str, after: int = 0) -> DataFrame:
    """The entries (version, run, table, dataset_id) of the commits ``after`` one."""
    if not _Files(spark, root).last():
        return spark.createDataFrame([], _ENTRY)
    return spark.read.schema(_ENTRY).json(f"{root}/{COMMITS}").where(F.col("version") > after)


def live(spark: SparkSession, root: str, table: str) -> DataFrame:
    """(dataset_id, run): the run whose rows of each dataset are seen."""
    last = commits(spark, root).where(F.col("table") == table).groupBy("dataset_id").agg(F.max_by("run", "version").alias("run"))
    return last.select("dataset_id", "run")


def read(spark: SparkSession, root: str, table: str, schema: str) -> DataFrame:
    """The published rows of a table whose folder exists: dataset_id leads
    no path of its own, so other runs' files are pruned by the join."""
    rows = spark.read.schema(f"{schema}, dataset_id string, run string").parquet(f"{root}/{table}")
    return rows.join(live(spark, root, table), ["dataset_id", "run"], "left_semi").drop("run")


class Run:
    """Tables written under one id, seen by nobody until ``commit``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.run = spark, root.rstrip("/"), uuid.uuid4().hex
        self.files, self.pairs = _Files(spark, root), set()
        self.base = self.files.last()

    def put(self, df: DataFrame, table: str, dataset_id: str) -> None:
        """The rows of one dataset that are to replace those of ``table``."""
        rows = df.withColumns({"dataset_id": F.lit(dataset_id), "run": F.lit(self.run)})
        rows.write.mode("append").partitionBy("dataset_id", "run").parquet(f"{self.root}/{table}")
        self.pairs.add((table, dataset_id))

    def read(self, table: str, dataset_id: str, schema: str) -> DataFrame:
        """What this run has put, before it is published."""
        rows = self.spark.read.schema(f"{schema}, dataset_id string, run string").parquet(f"{self.root}/{table}")
        return rows.where((F.col("run") == self.run) & (F.col("dataset_id") == dataset_id)).drop("run", "dataset_id")

    def commit(self) -> int:
        """Publish all that was put; returns the commit's number."""
        seen = self.base
        while True:
            last = self.files.last()
            if last > seen:
                others = commits(self.spark, self.root, seen).select("table", "dataset_id").distinct()
                mine = self.spark.createDataFrame(sorted(self.pairs), "`table` string, dataset_id string")
                hit = others.join(F.broadcast(mine), ["table", "dataset_id"], "left_semi").first()
                if hit:
                    raise Conflict(f"{hit['dataset_id']} in {hit['table']} was replaced since commit {self.base}")
                seen = last
            entries = [{"version": last + 1, "run": self.run, "table": t, "dataset_id": d} for t, d in sorted(self.pairs)]
            if self.files.create(last + 1, "".join(json.dumps(e) + "\n" for e in entries)):
                return last + 1


def history(spark: SparkSession, root: str) -> DataFrame:
    """(table, dataset_id, run, version, live): every published run."""
    w = Window.partitionBy("table", "dataset_id")
    return commits(spark, root).select("table", "dataset_id", "run", "version", (F.col("version") == F.max("version").over(w)).alias("live"))
