"""Driver queries: classification, catalog artefacts and ingest decisions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import classify as C
from tessera.operators import ingest as I
from tessera.operators import rank as R
from tessera.operators import summary as Y
from tessera.plans.fixtures import derived, duck_body
from tessera.plans.queries_prep import DIRTY_COLS, DIRTY_STR, cleaned
from tessera.plans.registry import register
from tessera.plans.sqlgen import (best_sql, cast_expr, casts_sql, classify_sql, clean_expr, distinct_sql, gate_expr, q,
                                  scores_sql, spark_type_case, storage_values, trim_expr, verified_sql)
from tessera.plans.workflow import catalog_row, chosen_types, collected, post_ingest
from tessera.session import scratch_path
from tessera.sources import catalog as K
from tessera.sources.tables import table

BAND_COLS = ["image_id", "band", "image_file", "lat", "lon", "tile"]
CUSTOMER_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
STAMP_COLS = ["o_orderkey", "some_times", "tail_text", "under_bar", "nearly_whole", "odd_space"]
DATASETS = {"dirty_customer": ("cleaned", DIRTY_COLS), "bands": ("bands", BAND_COLS), "stamps": ("stamps", STAMP_COLS)}
ALL_INPUTS = ["dirty_customer", "bands", "stamps"]


def with_ctes(names, extra=()):
    parts = []
    for n in names:
        parts.append(f"{n} AS ({duck_body(n)})")
    if "dirty_customer" in names:
        parts.append("cleaned AS (select c_custkey, " + ", ".join(f"{clean_expr(c)} as {c}" for c in DIRTY_STR)
                     + " from dirty_customer)")
    parts += list(extra)
    return "WITH " + ",\n".join(parts) + "\n"


def inputs(spark, sf_dir):
    return {"dirty_customer": cleaned(spark, sf_dir), "bands": derived(spark, sf_dir, "bands"), "stamps": derived(spark, sf_dir, "stamps")}


def _union(frames):
    out = None
    for f in frames:
        out = f if out is None else out.unionByName(f)
    return out


def _per_dataset(spark, sf_dir, fn):
    from tessera.plans.batch import run_stage
    return run_stage({n: (df, df.columns) for n, df in inputs(spark, sf_dir).items()}, lambda df, cols: fn(df))


SCORES_CTE = "scores AS (" + "\nunion all\n".join(
    scores_sql(src, cols, ds) for ds, (src, cols) in DATASETS.items()) + ")"
DISTINCT_CTE = "dist AS (" + "\nunion all\n".join(
    distinct_sql(src, cols, ds) for ds, (src, cols) in DATASETS.items()) + ")"
BEST_CTE = "best AS (" + best_sql("scores", "dataset_id, col") + ")"
CLASS_CTE = "cls AS (" + classify_sql("best", "dist", "dataset_id, col") + ")"
CASTS_CTE = "cc AS (" + "\nunion all\n".join(casts_sql(src, cols, ds) for ds, (src, cols) in DATASETS.items()) + ")"
VERIFIED_CTE = "ver AS (" + verified_sql("cls", "cc") + ")"
ALL_CLASS = with_ctes(ALL_INPUTS, [SCORES_CTE, DISTINCT_CTE, BEST_CTE, CLASS_CTE])
VERIFY_SQL = with_ctes(ALL_INPUTS, [SCORES_CTE, DISTINCT_CTE, BEST_CTE, CLASS_CTE, CASTS_CTE, VERIFIED_CTE])


@register("classify_scores", with_ctes(ALL_INPUTS, [SCORES_CTE]) + "select * from scores")
def q_classify_scores(spark, sf_dir):
    return _per_dataset(spark, sf_dir, C.type_scores)


@register("classify_gate", with_ctes(ALL_INPUTS, [SCORES_CTE, BEST_CTE]) + f"""
select dataset_id, col, semantic_type, n, n_match, probability, {gate_expr()} as gated_type from best""")
def q_classify_gate(spark, sf_dir):
    return _per_dataset(spark, sf_dir, lambda df: C.gate(C.best_types(C.type_scores(df))))


@register("classify_best", ALL_CLASS + "select * exclude (n_time) from cls")
def q_classify_best(spark, sf_dir):
    return _per_dataset(spark, sf_dir, C.classify)


def _declared_sql(src, cols):
    return "\nunion all\n".join(
        f"select {q(c)} as col, (select {spark_type_case(f'any_value(typeof({c}))')} from {src}) as declared"
        for c in cols)


@register("type_source", VERIFY_SQL.rstrip() + f""",
decl as ({_declared_sql('cleaned', DIRTY_COLS)}),
j as (select * from decl d full join (select col, semantic_type as suggested, case when accepted then storage end as storage from ver
      where dataset_id = 'dirty_customer') c using (col))
select j.col, j.declared, j.suggested, src.type_source,
  case when src.type_source = 'classification' then coalesce(j.storage, j.declared)
       else coalesce(j.declared, j.storage) end as selected_type
from j cross join (values ('classification'), ('declared')) as src(type_source)""")
def q_type_source(spark, sf_dir):
    df = cleaned(spark, sf_dir)
    declared = I.column_registry(df, "dirty_customer").select("col", F.col("data_type").alias("declared"))
    _, sug = collected(spark, C.classify_verified(df))
    return _union([C.choose_types(declared, sug, s) for s in ("classification", "declared")])


@register("verify_types", VERIFY_SQL + "select * exclude (probability) from ver")
def q_verify_types(spark, sf_dir):
    return _per_dataset(spark, sf_dir, lambda df: C.classify_verified(df).drop("probability"))


# Expected upstream classification of dirty_customer (checked by
# classify_best): integer, unknown, real, categorical, categorical, unknown.
# Not every acctbal casts to real, so verification rejects the type and the
# column keeps its text; likewise tail_text and odd_space below.
@register("ingest_typed", with_ctes(["dirty_customer"]) + f"""
select {cast_expr('c_custkey', 'bigint')} as c_custkey, name, acctbal, segment, konst, empty_col from cleaned""")
def q_ingest_typed(spark, sf_dir):
    df = cleaned(spark, sf_dir)
    rows, _ = collected(spark, C.classify_verified(df))
    return K.ingest_typed(C.apply_types(df, chosen_types(df, rows)), scratch_path(spark, "typed"))


@register("ingest_typed_stamps", with_ctes(["stamps"]) + f"""
select o_orderkey, {cast_expr('some_times', 'timestamp_ntz')} as some_times, tail_text, under_bar,
  {cast_expr('nearly_whole', 'double')} as nearly_whole, odd_space from stamps""")
def q_ingest_typed_stamps(spark, sf_dir):
    """A column with a few times of day keeps them; a suggestion that not
    every value fits changes no value."""
    df = derived(spark, sf_dir, "stamps")
    rows, _ = collected(spark, C.classify_verified(df))
    return K.ingest_typed(C.apply_types(df, chosen_types(df, rows)), scratch_path(spark, "typed"))


# What a cast would change stays: zero-padded texts, numbers out of range,
# digits that a double drops (those become decimals).
EXACT_TYPES = {"o_orderkey": "bigint", "padded": "string", "overflows": "string", "money": "decimal(20,2)", "beyond": "decimal(20,0)",
               "powers": "double", "padded_once": "string", "price": "double"}


@register("ingest_typed_exact", with_ctes(["exact"]) + "select o_orderkey::varchar as o_orderkey, padded, overflows, money, beyond, "
          "powers::double as powers, padded_once, price::double as price, " + q(",".join(f"{c}:{t}" for c, t in EXACT_TYPES.items()))
          + " as types from exact")
def q_ingest_typed_exact(spark, sf_dir):
    """Every value of every column comes back, in the least type that keeps it."""
    df = derived(spark, sf_dir, "exact")
    rows, _ = collected(spark, C.classify_verified(df))
    typed = K.ingest_typed(C.apply_types(df, chosen_types(df, rows)), scratch_path(spark, "typed"))
    types = ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in typed.schema)
    as_is = ("powers", "price")
    return typed.select(*[F.col(c) if c in as_is else F.col(c).cast("string").alias(c) for c in typed.columns], F.lit(types).alias("types"))


@register("ingest_remote_sensing", with_ctes(["bands_mixed"]) + """
select 'typed' as variant, image_id, band, image_file, lat, lon, reading, scene from bands_mixed
union all select 'raw', image_id, band, image_file, lat, lon, reading, scene from bands_mixed""")
def q_ingest_remote_sensing(spark, sf_dir):
    """A remote-sensing dataset skips the verification's rows, not its test:
    a mixed column and padded numbers keep every value; the raw copy lies
    beside the typed table."""
    from tessera.plans.workflow import Dataset, ingest
    root = scratch_path(spark, "ingest")
    ds = Dataset("bands_mixed", derived(spark, sf_dir, "bands_mixed"))
    typed = ingest(spark, ds, root, endpoint="catalog", metadata_only=True, database="store").drop("source")
    raw = spark.read.parquet(f"{root}/raw").withColumns({c: F.col(c).cast("double") for c in ("lat", "lon")})
    return typed.select(F.lit("typed").alias("variant"), "*").unionByName(raw.select(F.lit("raw").alias("variant"), "*"))


# --------------------------------------------------------- catalog (S4) ---

CUST_CLASS = with_ctes([], [
    "scores AS (" + scores_sql("customer", CUSTOMER_COLS, "customer") + ")",
    "dist AS (" + distinct_sql("customer", CUSTOMER_COLS, "customer") + ")",
    "best AS (" + best_sql("scores", "dataset_id, col") + ")",
    "cls AS (" + classify_sql("best", "dist", "dataset_id, col") + ")"])
CUST_NUM = ["c_custkey", "c_nationkey", "c_acctbal"]
CUST_REG = ("reg AS (select (ordinal_position - 1)::int as ord, column_name as col, "
            f"{spark_type_case('data_type')} as data_type, n.n_non_null from information_schema.columns i join ("
            + "\nunion all\n".join(f"select {q(c)} as cname, count({c}) as n_non_null from customer"
                                   for c in CUSTOMER_COLS)
            + ") n on i.column_name = n.cname where i.table_name = 'customer')")
CUST_IMP = "imp AS (" + "\nunion all\n".join(
    f"select {q(c)} as col, round(abs(corr({c}, c_acctbal)), 6) as importance from customer" for c in CUST_NUM) + ")"
CUST_EXT = "ext AS (" + "\nunion all\n".join(
    f"select {q(c)} as col, min({c})::double as min, max({c})::double as max from customer" for c in CUST_NUM) + ")"


@register("variable_catalog", CUST_CLASS.rstrip() + ",\n" + ",\n".join([CUST_REG, CUST_IMP, CUST_EXT]) + """
select reg.col, reg.ord, reg.data_type, reg.n_non_null, cls.semantic_type as suggested, cls.probability,
  imp.importance, ext.min, ext.max
from reg left join cls using (col) left join imp using (col) left join ext using (col)""")
def q_variable_catalog(spark, sf_dir):
    cust = table(spark, sf_dir, "customer")
    root = scratch_path(spark, "artefacts")
    found = {"classification": C.classify(cust), "importance": R.corr_importance(cust, CUST_NUM, "c_acctbal"),
             "summary": Y.extrema(cust, CUST_NUM)}
    paths = K.write_artifacts(found, root, "customer")
    K.write_artifacts({n: a.withColumn("col", F.lit("c_custkey")) for n, a in found.items()}, root, "other")  # must not cross over
    art = K.read_artifacts(spark, paths, "customer")
    reg = I.column_registry(cust, "customer").drop("dataset_id")
    return K.variable_catalog(reg, art["classification"], art["importance"], art["summary"])


# ------------------------------------------------- catalog upsert (S5) ---

def _catalog_sql():
    bands_class = with_ctes(["bands"], [
        "scores AS (" + scores_sql("bands", BAND_COLS, "bands") + "\nunion all\n"
        + scores_sql("customer", CUSTOMER_COLS, "customer") + ")",
        "dist AS (" + distinct_sql("bands", BAND_COLS, "bands") + "\nunion all\n"
        + distinct_sql("customer", CUSTOMER_COLS, "customer") + ")",
        "best AS (" + best_sql("scores", "dataset_id, col") + ")",
        "cls AS (" + classify_sql("best", "dist", "dataset_id, col") + ")",
        "ords AS (select * from (values " + ", ".join(
            f"('bands', {q(c)}, {i})" for i, c in enumerate(BAND_COLS)) + ", " + ", ".join(
            f"('customer', {q(c)}, {i})" for i, c in enumerate(CUSTOMER_COLS)) + ") as o(dataset_id, col, ord))"])
    return bands_class + """
select dataset_id, 'datasets/' || dataset_id as folder, 'seed' as source, 'modelling' as dataset_type,
  case dataset_id when 'bands' then (select count(*) from bands) else (select count(*) from customer) end as n_rows,
  count(*)::int as n_variables,
  string_agg(col || ':' || semantic_type, ',' order by ord) as variables,
  case when dataset_id = 'bands' then 'multiband_image,geo_bounds' else '' end as groupings
from cls join ords using (dataset_id, col) group by dataset_id"""


@register("catalog_upsert", _catalog_sql())
def q_catalog_upsert(spark, sf_dir):
    path = scratch_path(spark, "catalog")
    ins = {"customer": table(spark, sf_dir, "customer"), "bands": derived(spark, sf_dir, "bands")}
    cls = lambda df: collected(spark, C.classify_verified(df))[1]  # noqa: E731  one row per column, re-used by both writes
    rows = {n: catalog_row(spark, n, f"datasets/{n}", df, cls(df)) for n, df in ins.items()}
    K.upsert_catalog(rows["customer"].unionByName(rows["bands"]), path)
    K.upsert_catalog(rows["customer"], path)  # re-run of one dataset: idempotent, bands kept
    cat = K.read_catalog(spark, path)
    return cat.select(
        "dataset_id", "folder", "source", "dataset_type", "n_rows",
        F.size("variables").alias("n_variables"),
        F.array_join(F.transform(F.array_sort("variables", lambda a, b: a["ord"] - b["ord"]),
                                 lambda v: F.concat_ws(":", v["col"], v["suggested"])), ",").alias("variables"),
        F.array_join(F.transform("groupings", lambda g: g["type"]), ",").alias("groupings"))


# ------------------------------------------------------ ingest decisions ---

@register("verify_metadata", with_ctes(["declared"], [
    "act AS (select column_name as col, " + spark_type_case("data_type") + " as actual, n.n_non_null "
    "from information_schema.columns i join (" + "\nunion all\n".join(
        f"select {q(c)} as cname, count({c}) as n_non_null from customer" for c in CUSTOMER_COLS)
    + ") n on i.column_name = n.cname where i.table_name = 'customer')"]) + """
select col, d.declared, a.actual, case when a.actual is null then 'missing' when d.declared is null then 'undeclared'
  when d.declared <> a.actual then 'type_mismatch' else 'ok' end as status, a.n_non_null
from declared d full join act a using (col)""")
def q_verify_metadata(spark, sf_dir):
    reg = I.column_registry(table(spark, sf_dir, "customer"), "customer")
    v = I.verify_metadata(derived(spark, sf_dir, "declared"), reg)
    return v.join(reg.select("col", "n_non_null"), "col", "left")


def _rs_sql():
    parts = []
    for ds, (src, cols) in DATASETS.items():
        names = ", ".join(f"({q(c)})" for c in cols)
        sums = " + ".join(f"(select count({c}) from {src})" for c in cols)
        parts.append(f"select {q(ds)} as dataset_id, bool_or(col = 'band') and bool_or(col = 'image_file') "
                     f"as is_remote_sensing, ({sums})::bigint as n_values from (values {names}) as t(col)")
    return with_ctes(ALL_INPUTS) + "\nunion all\n".join(parts)


@register("remote_sensing", _rs_sql())
def q_remote_sensing(spark, sf_dir):
    regs = _union([I.column_registry(df, n) for n, df in inputs(spark, sf_dir).items()])
    flags = I.remote_sensing(regs)
    vals = regs.groupBy("dataset_id").agg(F.sum("n_non_null").alias("n_values"))
    return flags.join(vals, "dataset_id")


@register("multiband_group", with_ctes(["bands"]) + """
select image_id, count(*)::bigint as n_bands, string_agg(band, ',' order by band) as bands,
  string_agg(f, ',' order by band) as files
from (select image_id, band, min(image_file) as f from bands group by image_id, band) group by image_id""")
def q_multiband_group(spark, sf_dir):
    found = I.multiband_groups(derived(spark, sf_dir, "bands"))
    return found.withColumns({c: F.array_join(c, ",") for c in ("bands", "files")})


@register("geobounds_group", with_ctes(["bands"]) + """
select tile, min(lon) as west, min(lat) as south, max(lon) as east, max(lat) as north from bands group by tile""")
def q_geobounds_group(spark, sf_dir):
    return I.geobounds(derived(spark, sf_dir, "bands"), "tile")


@register("post_ingest", VERIFY_SQL.rstrip() + f""",
num as (select dataset_id, col from ver where storage in ('bigint', 'double') and (accepted or dataset_id = 'bands'))
select 'bands' as dataset_id, 'group' as step, g as item, null::boolean as flag, null::double as min_value,
  null::double as max_value from (values ('multiband_image'), ('geo_bounds')) as t(g)
union all
select dataset_id, 'verify', col, accepted, null, null from ver where dataset_id <> 'bands'
union all
""" + "\nunion all\n".join(
    f"select * from (select {q(ds)}, 'extrema', {q(c)}, null, min({cast_expr(c, 'double')}), "
    f"max({cast_expr(c, 'double')}) from {src}) where exists "
    f"(select 1 from num where num.dataset_id = {q(ds)} and num.col = {q(c)})"
    for ds, (src, cols) in DATASETS.items() for c in cols))
def q_post_ingest(spark, sf_dir):
    return _union([post_ingest(spark, n, df, C.classify_verified(df)) for n, df in inputs(spark, sf_dir).items()])


# ------------------------------------------------------------- streaming ---

@register("stream_ingest", with_ctes(["dirty_customer"]) + f"""
select {cast_expr('c_custkey', 'bigint')} as c_custkey, name, {cast_expr('acctbal', 'double')} as acctbal,
  segment, konst, empty_col from cleaned""")
def q_stream_ingest(spark, sf_dir):
    """The typed ingest of dirty_customer, fed as CSV files to a stream."""
    from pyspark.sql.types import StructType

    from tessera.sources import files as S
    from tessera.streaming.file_ingest import start_ingest
    raw = derived(spark, sf_dir, "dirty_customer")
    src = scratch_path(spark, "stream-src")
    S.write_csv(raw, src, header=True)
    schema = StructType.fromDDL(", ".join(f"{c} string" for c in raw.columns))
    declared = {"c_custkey": "bigint", "acctbal": "double"}
    out = scratch_path(spark, "stream-out")
    q_ = start_ingest(spark, src, schema, declared, out)
    q_.awaitTermination()
    return spark.read.parquet(out).select(*raw.columns)


# ------------------------------------------ url, email and place types ---

EXT_DATASETS = {"pages": ("pages", ["page_id", "url", "html"]),
                "places": ("places", ["c_custkey", "place_raw"]),
                "contacts": ("contacts_clean", ["doc_id", "contact", "lang"])}


def _place_sql(src, cols, ds):
    return "\nunion all\n".join(
        f"select {q(ds)} as dataset_id, {q(c)} as col, 'place' as semantic_type, count(*) as n, "
        f"count(r.key)::bigint as n_match, round(case when count(*) > 0 then count(r.key) / count(*) else 0.0 end, 6) as probability "
        f"from (select upper({trim_expr(c)}) as v from {src} where {c} is not null) x "
        f"left join red r on x.v = r.key" for c in cols)


def _extended_sql():
    from tessera.plans.queries_stats import GAZ_RED
    scores = "\nunion all\n".join(scores_sql(src, cols, ds) + "\nunion all\n" + _place_sql(src, cols, ds)
                                    for ds, (src, cols) in EXT_DATASETS.items())
    dist = "\nunion all\n".join(distinct_sql(src, cols, ds) for ds, (src, cols) in EXT_DATASETS.items())
    return with_ctes(["gazetteer", "places", "contacts"], [
        GAZ_RED,
        "contacts_clean AS (select doc_id, " + clean_expr("contact") + " as contact, lang from contacts)",
        f"scores AS ({scores})", f"dist AS ({dist})",
        "best AS (" + best_sql("scores", "dataset_id, col") + ")",
        "cls AS (" + classify_sql("best", "dist", "dataset_id, col") + ")"]) + "select * exclude (n_time) from cls"


@register("classify_extended", _extended_sql())
def q_classify_extended(spark, sf_dir):
    from tessera.operators import clean as T
    from tessera.operators.geocode import reduce_gazetteer
    from tessera.functions.sizing import stage
    keys = stage(reduce_gazetteer(derived(spark, sf_dir, "gazetteer")).select("key"), "gazetteer")  # used by every dataset
    ins = {"pages": table(spark, sf_dir, "pages").select("page_id", "url", "html"),
           "places": derived(spark, sf_dir, "places"),
           "contacts": T.clean_null_tokens(derived(spark, sf_dir, "contacts"), ["contact"])}
    return _union([C.classify(df, gazetteer_keys=keys).select(F.lit(n).alias("dataset_id"), "*") for n, df in ins.items()])


# ------------------------------------------------ all four artefacts (S4) ---

DOC_COLS = ["doc_id", "text", "lang", "source", "n_chars"]
DOC_NUM = ["doc_id", "n_chars"]


def _artifact_sql():
    from tessera.plans.queries_stats import TERMS_SQL
    return with_ctes([], [
        "scores AS (" + scores_sql("documents", DOC_COLS, "documents") + ")",
        "dist AS (" + distinct_sql("documents", DOC_COLS, "documents") + ")",
        "best AS (" + best_sql("scores", "dataset_id, col") + ")",
        "cls AS (" + classify_sql("best", "dist", "dataset_id, col") + ")",
        "reg AS (select (ordinal_position - 1)::int as ord, column_name as col, "
        f"{spark_type_case('data_type')} as data_type from information_schema.columns "
        "where table_name = 'documents')",
        "imp AS (" + "\nunion all\n".join(
            f"select {q(c)} as col, round(abs(corr({c}, n_chars)), 6) as importance from documents"
            for c in DOC_NUM) + ")",
        "ext AS (" + "\nunion all\n".join(
            f"select {q(c)} as col, min({c})::double as min, max({c})::double as max from documents"
            for c in DOC_NUM) + ")",
        "terms AS (" + TERMS_SQL + ")"]) + """
select reg.col, reg.ord, reg.data_type, cls.semantic_type as suggested, cls.probability, imp.importance,
  ext.min, ext.max, (select string_agg(lang || ':' || term, ',' order by lang, rank) from terms) as summary_terms
from reg left join cls using (col) left join imp using (col) left join ext using (col)"""


@register("artifact_catalog", _artifact_sql())
def q_artifact_catalog(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    root = scratch_path(spark, "artefacts4")
    paths = K.write_artifacts({
        "classification": C.classify(docs),
        "importance": R.corr_importance(docs, DOC_NUM, "n_chars"),
        "summary": Y.extrema(docs, DOC_NUM),
        "summary_machine": Y.text_terms(docs, "doc_id", "lang", "text", k=10),
    }, root, "documents")
    art = K.read_artifacts(spark, paths, "documents")
    reg = I.column_registry(docs, "documents").select("col", "ord", "data_type")
    terms = art["summary_machine"].agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("lang", "rank", "term"))),
        lambda t: F.concat_ws(":", t["lang"], t["term"])), ",").alias("summary_terms"))
    cat = K.variable_catalog(reg, art["classification"], art["importance"], art["summary"])
    return cat.withColumn("summary_terms", terms.scalar())
