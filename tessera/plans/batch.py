"""Run one stage over a list of datasets as one Spark plan.

Each dataset's long result carries its ``dataset_id``; the union is one
plan per stage, not one session per dataset. Stages whose work is a
per-group aggregate do better still by unioning the inputs first
(``summary.profile_many``: one aggregate and one sort for all datasets).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def run_stage(datasets: dict[str, tuple[DataFrame, list[str]]],
              stage: Callable[[DataFrame, list[str]], DataFrame]) -> DataFrame:
    out = None
    for name, (df, cols) in datasets.items():
        r = stage(df, cols).select(F.lit(name).alias("dataset_id"), "*")
        out = r if out is None else out.unionByName(r)
    return out
