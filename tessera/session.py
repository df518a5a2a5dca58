"""Session construction and the shared folders a job may write to."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "tessera", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume.

    On a cluster call this without ``master``; the cluster's own defaults
    (including ``spark.checkpoint.dir``) are kept.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only when the cluster names none (local tests) is a private folder set.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster "
                               "(checkpoints and staged tables must survive executor loss)")
        root = tempfile.mkdtemp(prefix="tessera-ckpt-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)  # private to this process
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    root = checkpoint_root(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared checkpoint root for staged writes."""
    root = ensure_checkpoint_dir(spark)
    path = os.path.join(root, "tessera-stage", f"{label}-{uuid.uuid4().hex}")
    _SCRATCH.append(path)
    return path


_SCRATCH: list[str] = []


def release_scratch(spark: SparkSession) -> int:
    """Delete what this process staged so far; returns the number of folders.

    For the end of a job, when no frame that reads a staged table is needed
    any more (``scratch_path`` can't know: its tables are read lazily).
    """
    jvm, conf, n = spark._jvm, spark._jsc.hadoopConfiguration(), 0
    while _SCRATCH:
        path = jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        n += bool(path.getFileSystem(conf).delete(path, True))
    return n


def suggest_shuffle_partitions(input_bytes: int, target_bytes: int = 256 << 20, slots: int = 1) -> int:
    """Shuffle partitions so that each holds about ``target_bytes`` of the
    input (at least one wave of ``slots`` tasks). Start high: AQE coalesces
    small partitions at run time but never splits large ones (except for
    skewed joins), and an oversized partition spills or fails.

    100 TB at 256 MiB per partition gives about 400k partitions.
    """
    return max(slots, -(-int(input_bytes) // int(target_bytes)))
