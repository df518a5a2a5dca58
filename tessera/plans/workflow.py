"""The ingest of one dataset, from raw frames to catalog and metadata tables.

Format and clean (null tokens, duplicates, row index) -> merge, written once
as a table -> merged-or-original -> verify metadata -> classify, gate, verify
-> cast accepted types -> post-ingest branch -> rank, summarise -> schema
document, artefacts, catalog row, model catalog, metadata tables. ``ingest``
dispatches between the catalog and the relational path.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.sizing import small_frame
from tessera.functions.types import STORAGE_TYPES, is_number
from tessera.operators import classify as C
from tessera.operators import clean as T
from tessera.operators import format as FM
from tessera.operators import ingest as I
from tessera.operators import merge as M
from tessera.operators import rank as R
from tessera.operators import summary as Y
from tessera.session import ensure_checkpoint_dir
from tessera.sources import catalog as K
from tessera.sources import files as S
from tessera.sources import snapshot as SN

CATALOG_TERMS = 100  # a catalog row shows the terms of the highest scores
GROUPINGS_TYPE = "array<struct<type:string,id_col:string,sub_cols:array<string>>>"


@dataclass
class Dataset:
    """What an ingest is given: the main table, its relations, the columns
    that put its rows in order, the column to rank against, and optionally
    (document, group, text) columns for the terms."""
    dataset_id: str
    main: DataFrame
    relations: list = field(default_factory=list)
    order: list = field(default_factory=list)
    target: str | None = None
    terms: tuple | None = None
    declared: DataFrame | None = None  # (col, declared)


def is_remote_sensing(df: DataFrame) -> bool:
    """I2 on the schema: exact, case-sensitive column names."""
    return set(I.REMOTE_SENSING_VARS) <= set(df.columns)


VERIFIED_FIELDS = [("col", "string"), ("semantic_type", "string"), ("probability", "double"), ("n_non_null", "bigint"),
                   ("n_cast", "bigint"), ("accepted", "boolean"), ("storage", "string")]


def collected(spark: SparkSession, verified: DataFrame) -> tuple[list, DataFrame]:
    """The verification's rows (one per column), and the same as literals."""
    rows = verified.select(*[n for n, _ in VERIFIED_FIELDS]).collect()
    return rows, small_frame(spark, VERIFIED_FIELDS, [tuple(r) for r in rows])


def chosen_types(df: DataFrame, verified: list) -> dict[str, str]:
    """Column -> storage type: the suggested one where a cast keeps every
    value, else the declared. That holds for remote-sensing datasets too:
    they skip the verification's rows (I6), not the test."""
    declared = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return declared | {r["col"]: r["storage"] for r in verified if r["accepted"]}


def catalog_row(spark: SparkSession, dataset_id: str, folder: str, df: DataFrame, classification: DataFrame,
                importance: DataFrame | None = None, extrema: DataFrame | None = None,
                terms: DataFrame | None = None, prefix: str = "") -> DataFrame:
    """One datasets-catalog row: provenance, row count, variables with their
    artefacts, the registered groups (remote sensing only) and summary terms.
    ``prefix`` leads the dataset's id. Variables are one entry per column, so
    the list is schema-sized."""
    reg = I.column_registry(df, prefix + dataset_id)
    remote = is_remote_sensing(df)
    storage = F.col("storage") if "storage" in classification.columns else F.create_map(
        *[x for t, s in STORAGE_TYPES.items() for x in (F.lit(t), F.lit(s))])[F.col("semantic_type")]
    accepted = F.col("accepted") if "accepted" in classification.columns else F.lit(True)
    v = reg.join(classification.select("col", F.col("semantic_type").alias("suggested"), "probability",
                                       F.when(accepted, storage).alias("storage")), "col", "left")
    v = v.join(importance.select("col", "importance"), "col", "left") if importance is not None \
        else v.withColumn("importance", F.lit(None).cast("double"))
    v = v.join(extrema.select("col", F.col("min_value").alias("min"), F.col("max_value").alias("max")), "col", "left") \
        if extrema is not None else v.withColumn("min", F.lit(None).cast("double")).withColumn("max", F.lit(None).cast("double"))
    var = F.struct(F.col("col"), F.col("ord").cast("int").alias("ord"), F.col("data_type").alias("declared"),
                   "suggested", F.col("probability").cast("double").alias("probability"),
                   F.coalesce("storage", "data_type").alias("selected"),
                   F.col("importance").cast("double").alias("importance"),
                   F.col("min").cast("double").alias("min"), F.col("max").cast("double").alias("max"))
    # Lists are ordered explicitly (sort on a struct led by the ordinal):
    # collect_list alone keeps no order across a shuffle.
    row = v.groupBy("dataset_id").agg(
        F.transform(F.sort_array(F.collect_list(F.struct(F.col("ord").cast("int").alias("o"), var.alias("v")))),
                    lambda x: x["v"]).alias("variables"))
    if remote:
        g = I.group_specs(spark).agg(F.transform(
            F.sort_array(F.collect_list(F.struct("ord", F.struct("type", "id_col", "sub_cols").alias("g")))),
            lambda x: x["g"]).alias("g")).scalar()
        groupings = g.cast(GROUPINGS_TYPE)
    else:
        groupings = F.array().cast(GROUPINGS_TYPE)
    term_list = F.lit(None).cast("array<string>")
    if terms is not None:
        order = [c for c in ("group", "rank", "term") if c in terms.columns]
        best = [F.desc("score")] if "score" in terms.columns else []
        shown = terms.orderBy(*best, *order).limit(CATALOG_TERMS)  # the table of terms has all
        term_list = shown.agg(F.transform(F.sort_array(F.collect_list(F.struct(*order))), lambda x: x["term"])).scalar()
    n_rows = df.agg(F.count(F.lit(1))).scalar()
    row = I.provenance(row.withColumn("folder", F.lit(folder)), "catalog")
    return row.select("dataset_id", "folder", "source", "dataset_type", n_rows.cast("bigint").alias("n_rows"),
                      "variables", groupings.alias("groupings"), term_list.alias("summary_terms"))


def post_ingest(spark: SparkSession, dataset_id: str, df: DataFrame, verified: DataFrame) -> DataFrame:
    """I6: a remote-sensing dataset registers its groups and skips type
    verification; any other dataset verifies its suggested types. Both then
    record extrema of their numeric columns.

    ``verified`` is ``classify.classify_verified(df)``: one pass already
    scored, chose and verified every column; its one row per column is
    collected once and re-enters as literals. Only the extrema read the
    data again. Rows (dataset_id, step, item, flag, min_value, max_value).
    """
    got, _ = collected(spark, verified)
    remote = is_remote_sensing(df)
    fields = [("dataset_id", "string"), ("step", "string"), ("item", "string"), ("flag", "boolean"),
              ("min_value", "double"), ("max_value", "double")]
    if remote:
        steps = I.group_specs(spark).select(
            F.lit(dataset_id).alias("dataset_id"), F.lit("group").alias("step"), F.col("type").alias("item"),
            F.lit(None).cast("boolean").alias("flag"), F.lit(None).cast("double").alias("min_value"),
            F.lit(None).cast("double").alias("max_value"))
    else:
        steps = small_frame(spark, fields, [(dataset_id, "verify", r["col"], r["accepted"], None, None) for r in got])
    types = chosen_types(df, got)
    num = [c for c in df.columns if is_number(types[c])]
    if num:
        ext = Y.extrema(C.apply_types(df.select(*[F.col(f"`{c}`") for c in num]), types), num)
        steps = steps.unionByName(ext.select(
            F.lit(dataset_id).alias("dataset_id"), F.lit("extrema").alias("step"), F.col("col").alias("item"),
            F.lit(None).cast("boolean").alias("flag"), "min_value", "max_value"))
    return steps


def prepare(spark: SparkSession, ds: Dataset, root: str) -> DataFrame:
    """Clean, index and merge; the merged table is written once, with its
    schema document, and every later stage reads it (or the original, where
    no merge was written)."""
    main = T.dedupe(T.clean_null_tokens(ds.main))
    if ds.order:
        main = FM.add_row_index(main, ds.order)
    rels = [M.Relation(r.name, T.clean_null_tokens(r.df), r.left_key, r.right_key) for r in ds.relations]
    M.star_merge(main, rels).write.mode("overwrite").parquet(f"{root}/merged")
    merged = M.fallback_source(spark, f"{root}/merged", ds.main).drop("resolved_from")
    S.write_schema_document(spark, S.schema_document(merged, ds.dataset_id, "merged"), f"{root}/schema")
    return merged


def _metadata(spark, ds: Dataset, df: DataFrame, root: str, rows: list):
    """Types accepted, table typed and written with the raw copy beside it
    (S9), metadata tables there."""
    types = chosen_types(df, rows)
    path, _ = S.write_typed_and_raw(C.apply_types(df, types), df, root)
    typed = spark.read.parquet(path)
    K.create_metadata_tables(spark, f"{root}/metadata")
    return types, typed


def verified_metadata(df: DataFrame, ds: Dataset) -> DataFrame:
    """I1 for the table that is to be ingested, against the declared columns
    (its own registry if none were declared)."""
    reg = I.column_registry(df, ds.dataset_id)
    declared = ds.declared if ds.declared is not None else reg.select("col", F.col("data_type").alias("declared"))
    return I.verify_metadata(declared, reg)


def ingest_catalog(spark: SparkSession, ds: Dataset, root: str, prefix: str = "", threshold: float = C.DEFAULT_THRESHOLD) -> DataFrame:
    """The catalog path; returns the dataset's catalog row as read back."""
    df = prepare(spark, ds, root)
    K.put(verified_metadata(df, ds), f"{root}/verification", prefix + ds.dataset_id)
    rows, cls = collected(spark, C.classify_verified(df, threshold=threshold))
    types, typed = _metadata(spark, ds, df, root, rows)
    key = prefix + ds.dataset_id
    num = [c for c in typed.columns if is_number(types[c]) and c != ds.target]
    timed = [c for c in typed.columns if Y.family(typed.schema[c].dataType) != "text"]
    found = {"classification": cls, "profile": Y.profile(typed), "extrema": Y.extrema(typed, timed)}
    if ds.target and num:
        found["importance"] = R.rank_importance(R.corr_importance(typed, num, ds.target))
    if ds.terms:
        found["terms"] = Y.text_terms(typed, *ds.terms).withColumnRenamed(ds.terms[1], "group").withColumn("group", F.col("group").cast("string"))
    # All tables of the run are seen at once, by its commit, or none is.
    run = SN.Run(spark, f"{root}/metadata")
    for name, part in found.items():
        run.put(part, name, key)
    meta = {n: run.read(n, key, K.metadata_schema(n)) for n in found}
    arte = {"classification": meta["classification"], "summary": meta["extrema"]}
    arte |= {a: meta[m] for a, m in (("importance", "importance"), ("summary_machine", "terms")) if m in meta}
    K.write_artifacts(arte, f"{root}/artefacts", key)
    row = catalog_row(spark, ds.dataset_id, f"{root}/typed", df, meta["classification"], meta.get("importance"), meta["extrema"],
                      meta.get("terms"), prefix)
    run.put(row, "datasets", key)
    K.publish_all(run, key)
    K.ensure_model_catalog(spark, f"{root}/models")
    return K.read_metadata(spark, f"{root}/metadata", "datasets").where(F.col("dataset_id") == key)


def ingest_relational(spark: SparkSession, ds: Dataset, root: str, threshold: float = C.DEFAULT_THRESHOLD) -> DataFrame:
    """The relational path: verified metadata, accepted types, the typed
    table and the metadata tables; provenance is the source alone. Returns
    the typed table as read back, with its source."""
    df = prepare(spark, ds, root)
    K.put(verified_metadata(df, ds), f"{root}/verification", ds.dataset_id)
    rows, cls = collected(spark, C.classify_verified(df, threshold=threshold))
    _, typed = _metadata(spark, ds, df, root, rows)
    run = SN.Run(spark, f"{root}/metadata")
    run.put(cls, "classification", ds.dataset_id)
    run.commit()
    return I.provenance(typed, "relational")


def ingest(spark: SparkSession, ds: Dataset, root: str, endpoint: str = "", metadata_only: bool = False, database: str = "",
           prefix: str = "", threshold: float = C.DEFAULT_THRESHOLD) -> DataFrame | None:
    """I7/I9: the path that the settings ask for; None where they ask for
    neither."""
    ensure_checkpoint_dir(spark)
    mode = I.dispatch(endpoint, metadata_only, database)
    if mode == "catalog":
        return ingest_catalog(spark, ds, root, prefix, threshold)
    if mode == "relational":
        return ingest_relational(spark, ds, root, threshold)
    return None
