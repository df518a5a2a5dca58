"""Driver queries: format, clean, merge and file sources/sinks."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from tessera.operators import clean as T
from tessera.operators import format as FM
from tessera.operators import merge as M
from tessera.plans.fixtures import cte, derived
from tessera.plans.queries_core import STAR_SQL, star, star_relations
from tessera.plans.registry import register
from tessera.plans.sqlgen import cast_expr, clean_expr, q, spark_type_case
from tessera.session import scratch_path
from tessera.sources import files as S
from tessera.sources.tables import table

DIRTY_COLS = ["c_custkey", "name", "acctbal", "segment", "konst", "empty_col"]
DIRTY_STR = DIRTY_COLS[1:]
DIRTY_DECLARED = {"c_custkey": "bigint", "name": "string", "acctbal": "double", "segment": "string",
                  "konst": "string", "empty_col": "string"}


def cleaned(spark, sf_dir):
    return T.clean_null_tokens(derived(spark, sf_dir, "dirty_customer"))


CLEAN_CTE = cte("dirty_customer") + ", cleaned AS (select c_custkey, " + ", ".join(
    f"{clean_expr(c)} as {c}" for c in DIRTY_STR) + " from dirty_customer)\n"

# ---------------------------------------------------------------- format ---


@register("format_row_index",
          "select *, (row_number() over (order by o_orderkey) - 1)::bigint as row_index from orders")
def q_format_row_index(spark, sf_dir):
    return FM.add_row_index(table(spark, sf_dir, "orders"), ["o_orderkey"])


@register("format_cast_rejects", cte("dirty_customer") + "\nunion all\n".join(
    f"select {q(c)} as col, {q(t)} as declared, count({c}) as n_non_null, count({cast_expr(c, t)}) as n_cast, "
    f"count({c}) - count({cast_expr(c, t)}) as n_rejected from dirty_customer"
    for c, t in DIRTY_DECLARED.items()))
def q_format_cast_rejects(spark, sf_dir):
    return FM.cast_rejects(derived(spark, sf_dir, "dirty_customer"), DIRTY_DECLARED)


@register("format_normalize", CLEAN_CTE + """
select c_custkey as customer_id, segment as the_name, name as the_name_1, acctbal as acct_bal from cleaned""")
def q_format_normalize(spark, sf_dir):
    df = cleaned(spark, sf_dir).select(F.col("c_custkey").alias(" Customer ID "), F.col("segment").alias("the name"),
                                       F.col("name").alias("The-Name?"), F.col("acctbal").alias("acct.bal"))
    return FM.normalize_columns(df)


# ----------------------------------------------------------------- clean ---

register("clean_null_tokens", CLEAN_CTE + "select * from cleaned")(cleaned)


@register("clean_dedupe", CLEAN_CTE + "select distinct * from cleaned")
def q_clean_dedupe(spark, sf_dir):
    return T.dedupe(cleaned(spark, sf_dir))


@register("clean_drop_columns", CLEAN_CTE + "\nunion all\n".join(
    f"select {q(c)} as col, count({c}) as n_non_null, count({c}) = 0 as is_empty, "
    f"coalesce(count({c}) = count(*) and min({c}) = max({c}), false) as is_constant, "
    f"not (count({c}) = 0 or coalesce(count({c}) = count(*) and min({c}) = max({c}), false)) as kept from cleaned"
    for c in DIRTY_COLS))
def q_clean_drop_columns(spark, sf_dir):
    return T.column_flags(cleaned(spark, sf_dir))


@register("clean_kept_columns", CLEAN_CTE + "select c_custkey, name, acctbal, segment from cleaned")
def q_clean_kept_columns(spark, sf_dir):
    return T.drop_empty_constant(cleaned(spark, sf_dir))


IMPUTE_SQL = CLEAN_CTE + f""", typed as (select c_custkey, name, {cast_expr('acctbal', 'double')} as acctbal, segment
  from cleaned),
mean_acct as (select round(avg(acctbal), 2) as m from typed),
mode_name as (select name as m from typed where name is not null group by name order by count(*) desc, name limit 1),
mode_seg as (select segment as m from typed where segment is not null group by segment order by count(*) desc, segment limit 1)
select c_custkey, coalesce(name, (select m from mode_name)) as name,
  coalesce(acctbal, (select m from mean_acct)) as acctbal, coalesce(segment, (select m from mode_seg)) as segment
from typed"""


@register("clean_impute", IMPUTE_SQL)
def q_clean_impute(spark, sf_dir):
    t = FM.cast_declared(cleaned(spark, sf_dir).select("c_custkey", "name", "acctbal", "segment"),
                         {"acctbal": "double"})
    return T.impute(t, ["acctbal"], ["name", "segment"])


@register("split_trim_explode", """
select p_partkey, (generate_subscripts(arr, 1) - 1)::bigint as pos, trim(unnest(arr)) as part
from (select p_partkey, case when l = '' then []::varchar[] else string_split(l, ',') end as arr
      from (select p_partkey, replace(p_name, ' ', ' , ') as l from part))""")
def q_split_trim_explode(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", F.replace(F.col("p_name"), F.lit(" "), F.lit(" , ")).alias("l"))
    out = T.split_trim_column(p, "l", explode=True)
    return out.select("p_partkey", F.col("pos").cast("bigint").alias("pos"), "part")


# ----------------------------------------------------------------- merge ---

@register("merge_train_target", """
select d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic, l.doc_id is not null as has_target
from documents d left join labels l on d.doc_id = l.doc_id""")
def q_merge_train_target(spark, sf_dir):
    return M.merge_train_target(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id")


def _audit_sql():
    rels = [("orders", "l_orderkey", "o_orderkey", "lineitem l"),
            ("customer", "o_custkey", "c_custkey", "lineitem l left join orders o on l.l_orderkey = o.o_orderkey"),
            ("nation", "c_nationkey", "n_nationkey",
             "lineitem l left join orders o on l.l_orderkey = o.o_orderkey left join customer c on o.o_custkey = c.c_custkey"),
            ("region", "n_regionkey", "r_regionkey",
             "lineitem l left join orders o on l.l_orderkey = o.o_orderkey left join customer c on o.o_custkey = c.c_custkey "
             "left join nation n on c.c_nationkey = n.n_nationkey")]
    parts = []
    for name, lk, rk, left in rels:
        parts.append(
            f"select {q(name)} as relation, count(*) as n_left_rows, count_if(k.cnt is null)::bigint as n_unmatched, "
            f"(select count(*) from (select {rk} from {name} group by {rk} having count(*) > 1)) as n_dup_keys, "
            f"coalesce(sum(greatest(k.cnt - 1, 0)), 0)::bigint as n_fanout_rows "
            f"from {left} left join (select {rk} as kk, count(*) as cnt from {name} group by {rk}) k on {lk} = k.kk")
    return "\nunion all\n".join(parts)


@register("merge_audit", _audit_sql())
def q_merge_audit(spark, sf_dir):
    return M.merge_audit(table(spark, sf_dir, "lineitem"), star_relations(spark, sf_dir))


@register("fallback_source", "select *, 'merged' as resolved_from from (" + STAR_SQL + ")")
def q_fallback_source(spark, sf_dir):
    path = scratch_path(spark, "merged")
    star(spark, sf_dir).write.mode("overwrite").parquet(path)
    return M.fallback_source(spark, path, table(spark, sf_dir, "lineitem"))


# ----------------------------------------------------------- file sinks ---

DIRTY_SCHEMA = StructType([StructField("c_custkey", LongType()), StructField("name", StringType()),
                           StructField("acctbal", DoubleType()), StructField("segment", StringType()),
                           StructField("konst", StringType()), StructField("empty_col", StringType())])


@register("read_declared", cte("dirty_customer") + f"""
select c_custkey, name, {cast_expr('acctbal', 'double')} as acctbal, segment, konst, empty_col,
  acctbal is not null and {cast_expr('acctbal', 'double')} is null as malformed
from dirty_customer""")
def q_read_declared(spark, sf_dir):
    path = scratch_path(spark, "declared_csv")
    S.write_csv(derived(spark, sf_dir, "dirty_customer"), path, header=True)
    back = S.read_declared(spark, path, DIRTY_SCHEMA, header=True)
    return back.withColumn("malformed", F.col(S.CORRUPT_COL).isNotNull()).drop(S.CORRUPT_COL)


@register("read_declared_text", "select *, false as malformed from documents")
def q_read_declared_text(spark, sf_dir):
    """Whole texts with quotes and line breaks, through CSV and back."""
    docs, path = table(spark, sf_dir, "documents"), scratch_path(spark, "declared_text")
    S.write_csv(docs, path, header=True)
    back = S.read_declared(spark, path, docs.schema, header=True)
    return back.withColumn("malformed", F.col(S.CORRUPT_COL).isNotNull()).drop(S.CORRUPT_COL)


@register("write_csv_pair_rows", "select 'plain' as variant, * from pages union all select 'header', * from pages")
def q_write_csv_pair_rows(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    paths = {"plain": scratch_path(spark, "plain_pages"), "header": scratch_path(spark, "header_pages")}
    S.write_csv_pair(pages, paths["plain"], paths["header"])
    out = [S.read_declared(spark, p, pages.schema, header=v == "header").drop(S.CORRUPT_COL).select(F.lit(v).alias("variant"), "*")
           for v, p in paths.items()]
    return out[0].unionByName(out[1])


ORDERS_SCHEMA_DDL = ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
                     "o_orderdate timestamp_ntz, o_orderpriority string")


@register("write_csv_pair", "\nunion all\n".join(
    f"select {q(v)} as variant, count(*) as n_rows, 0::bigint as n_malformed, "
    f"sum(o_totalprice)::decimal(18,2) as sum_totalprice, min(o_orderdate) as min_orderdate, "
    f"max(o_orderdate) as max_orderdate, count(distinct o_orderpriority) as n_priorities from orders"
    for v in ("plain", "header")))
def q_write_csv_pair(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    plain, header = scratch_path(spark, "plain_csv"), scratch_path(spark, "header_csv")
    S.write_csv_pair(orders, plain, header)
    schema = StructType.fromDDL(ORDERS_SCHEMA_DDL)
    out = None
    for variant, path, h in (("plain", plain, False), ("header", header, True)):
        back = S.read_declared(spark, path, schema, header=h)
        agg = back.agg(F.lit(variant).alias("variant"), F.count(F.lit(1)).alias("n_rows"),
                       F.count(S.CORRUPT_COL).alias("n_malformed"),
                       F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(18,2)").alias("sum_totalprice"),
                       F.min("o_orderdate").alias("min_orderdate"), F.max("o_orderdate").alias("max_orderdate"),
                       F.count_distinct("o_orderpriority").alias("n_priorities"))
        out = agg if out is None else out.unionByName(agg)
    return out


LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@register("schema_registry", f"""
select 'lineitem' as dataset_id, column_name as col, (ordinal_position - 1)::int as ord,
  {spark_type_case('data_type')} as data_type, c.n_non_null
from information_schema.columns i join (""" + "\nunion all\n".join(
    f"select {q(c)} as cname, count({c}) as n_non_null from lineitem" for c in LINEITEM_COLS) + """) c
  on i.column_name = c.cname
where i.table_name = 'lineitem'""")
def q_schema_registry(spark, sf_dir):
    from tessera.operators.ingest import column_registry
    li = table(spark, sf_dir, "lineitem")
    path = scratch_path(spark, "schema_doc")
    S.write_schema_document(spark, S.schema_document(li, "lineitem"), path)
    ds, schema = S.read_schema_document(spark, path)
    # The registry is built from the document read back, over the data.
    return column_registry(spark.read.schema(schema).parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet"), ds)


@register("ingest_raw_pair", """
select 'typed' as variant, count(*) as n_rows, count(o_totalprice) as n_values,
  sum(o_totalprice)::decimal(18,2) as sum_totalprice from orders
union all
select 'raw', count(*), count(o_totalprice), sum(cast(cast(o_totalprice as varchar) as double))::decimal(18,2) from orders""")
def q_ingest_raw_pair(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    tp, rp = S.write_typed_and_raw(orders, orders, scratch_path(spark, "typed_raw"))
    out = None
    for variant, path in (("typed", tp), ("raw", rp)):
        back = spark.read.parquet(path)
        agg = back.agg(F.lit(variant).alias("variant"), F.count(F.lit(1)).alias("n_rows"),
                       F.count("o_totalprice").alias("n_values"),
                       F.sum(F.col("o_totalprice").cast("double").cast("decimal(18,2)"))
                       .cast("decimal(18,2)").alias("sum_totalprice"))
        out = agg if out is None else out.unionByName(agg)
    return out


@register("ingest_raw_pair_rows", "select 'typed' as variant, * from orders union all select 'raw', * from orders")
def q_ingest_raw_pair_rows(spark, sf_dir):
    """Every cell of the typed table, and of the raw one cast back."""
    orders = table(spark, sf_dir, "orders")
    tp, rp = S.write_typed_and_raw(orders, orders, scratch_path(spark, "typed_raw"))
    raw = spark.read.parquet(rp)
    back = raw.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in orders.schema.fields])
    return spark.read.parquet(tp).select(F.lit("typed").alias("variant"), "*").unionByName(back.select(F.lit("raw").alias("variant"), "*"))


@register("media_paths", cte("bands") + """
select image_id, band, concat_ws('/', 'http://media.local', 'bands', image_file) as image_file from bands""")
def q_media_paths(spark, sf_dir):
    b = derived(spark, sf_dir, "bands").select("image_id", "band", "image_file")
    return S.media_paths(b, "image_file", "http://media.local", "bands")
