"""Format: row index and declared-type casting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.sizing import per_column, qcol, small_frame
from tessera.functions.text import normalize_name
from tessera.functions.types import guarded_cast
from tessera.operators.index import row_index


def add_row_index(df: DataFrame, order: list, name: str = "row_index") -> DataFrame:
    """``row_index`` 0..n-1 in the total order ``order`` (see ``index.row_index``)."""
    return row_index(df, order, name)


def normalize_columns(df: DataFrame) -> DataFrame:
    """Rename columns to their normal form; clashes get a numeric suffix."""
    seen: set[str] = set()
    out = []
    for c in df.columns:
        n = base = normalize_name(c)
        k = 0
        while n in seen:
            k += 1
            n = f"{base}_{k}"
        seen.add(n)
        out.append(qcol(c).alias(n))
    return df.select(*out)


def cast_declared(df: DataFrame, declared: dict[str, str]) -> DataFrame:
    """Cast each declared column with a pattern-guarded cast (null on reject)."""
    return df.select(*[guarded_cast(qcol(c), declared[c]).alias(c) if c in declared else qcol(c)
                       for c in df.columns])


def cast_rejects(df: DataFrame, declared: dict[str, str]) -> DataFrame:
    """Per declared column: non-null values, values that cast, rejects; one
    pass, whatever the width."""
    cols = [c for c in df.columns if c in declared]
    values = {"is": lambda _, c: c.isNotNull(), "ok": lambda n, c: guarded_cast(c, declared[n]).isNotNull()}
    got = per_column(df, cols, values, [F.count_if("is").alias("n"), F.count_if("ok").alias("k")])
    types = small_frame(df.sparkSession, [("ord", "int"), ("declared", "string")], [(i, declared[c]) for i, c in enumerate(cols)])
    n, k = (F.coalesce(x, F.lit(0).cast("bigint")) for x in ("n", "k"))
    return got.join(types, "ord").select("col", "declared", n.alias("n_non_null"), k.alias("n_cast"), (n - k).alias("n_rejected"))
