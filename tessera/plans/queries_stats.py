"""Driver queries: summaries, ranking, clustering, geocoding, batch runs and
the end-to-end ingest."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import cluster as KM
from tessera.operators import geocode as G
from tessera.operators import merge as M
from tessera.operators import rank as R
from tessera.operators import summary as Y
from tessera.plans.fixtures import derived
from tessera.plans.queries_classify import with_ctes
from tessera.plans.registry import register
from tessera.plans.sqlgen import q, unpivot_sql
from tessera.plans.workflow import Dataset, ingest
from tessera.session import scratch_path
from tessera.sources.tables import table

PROFILE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
TOPK_COLS = ["o_orderstatus", "o_orderpriority"]
HIST_COLS = ["l_quantity", "l_extendedprice", "l_discount"]
CORR_COLS = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]


LINEITEM_TIMED, LINEITEM_TEXT = ["l_shipdate"], ["l_returnflag", "l_linestatus"]
LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", *PROFILE_COLS, *LINEITEM_TEXT, *LINEITEM_TIMED]


def mean_sql(c: str) -> str:
    """The exact decimal mean, rounded half away from zero to six places."""
    total, den = f"sum(cast({c} as decimal(38,10)))", f"(count({c})::hugeint * 10000)"
    return (f"case when count({c}) > 0 then sign({total})::double * ((2 * (abs({total}) * 10000000000)::hugeint + {den}) // (2 * {den}))::double "
            f"/ 1000000.0 end")


def profile_sql(src, cols, dataset_id=None, timed=(), text=()):
    ds = f"{q(dataset_id)} as dataset_id, " if dataset_id else ""
    numbers = ("mean", "stddev", "p25", "p50", "p75", "min", "max")

    def one(c):
        v = f"strftime({c}, '%Y-%m-%d %H:%M:%S')" if c in timed else c
        head = f"select {ds}{q(c)} as col, count(*) as n, count(*) - count({c}) as n_null, count(distinct {v}) as n_distinct, "
        if c in timed or c in text:
            return head + ", ".join(f"null::double as {n}" for n in numbers) + f", min({v}) as min_text, max({v}) as max_text from {src}"
        return (head + f"{mean_sql(c)} as mean, round(stddev_samp({c}), 6) as stddev, "
                + ", ".join(f"round(quantile_cont({c}, {p}), 6) as p{int(p * 100)}" for p in Y.QUARTILES)
                + f", round(min({c})::double, 6) as min, round(max({c})::double, 6) as max, null::varchar as min_text, "
                f"null::varchar as max_text from {src}")
    return "\nunion all\n".join(one(c) for c in cols)


# --------------------------------------------------------------- summary ---

@register("summary_profile", profile_sql("lineitem", LINEITEM_COLS, timed=LINEITEM_TIMED, text=LINEITEM_TEXT))
def q_summary_profile(spark, sf_dir):
    """Every column: numbers, text and times."""
    return Y.profile(table(spark, sf_dir, "lineitem"), LINEITEM_COLS)


EXACT_SQL = """wide as (select o_orderkey, o_orderkey + 9007199254740992 as big,
  cast(cast(o_orderkey as decimal(20,0)) * 100000000000 + cast(o_orderkey % 7 as decimal(20,0)) as decimal(30,0)) as whole,
  cast(case when o_orderkey % 9 = 0 then null else concat('1', lpad(cast(o_orderkey % 100000 as varchar(20)), 5, '0'), '12345678901.',
       case when o_orderkey % 2 = 0 then '01' else '02' end) end as decimal(38,2)) as money from {orders})"""


def _exact_row(c):
    return (f"select {q(c)} as col, count(*) as n, count(*) - count({c}) as n_null, count(distinct {c}) as n_distinct, "
            f"min({c})::double as min, max({c})::double as max, {{}} as min_text, {{}} as max_text from wide")


@register("summary_profile_exact", "with " + EXACT_SQL.format(orders="orders") + "\n" + "\nunion all\n".join(
    _exact_row(c).format(*([f"min({c})::varchar", f"max({c})::varchar"] if c != "o_orderkey" else ["null::varchar"] * 2))
    for c in ("o_orderkey", "big", "whole", "money")))
def q_summary_profile_exact(spark, sf_dir):
    """Whole numbers beyond 2^53 and decimals, counted and compared in full."""
    df = spark.sql("with " + EXACT_SQL + " select * from wide", orders=table(spark, sf_dir, "orders"))
    return Y.profile(df).select("col", "n", "n_null", "n_distinct", "min", "max", "min_text", "max_text")


GROWN = ["l_quantity", "l_extendedprice", "l_orderkey", "l_returnflag", "l_shipdate"]


def _grown_sql(c):
    head = f"select {q(c)} as col, count(*) as n, count(*) - count({c}) as n_null, "
    if c in ("l_returnflag", "l_shipdate"):
        return head + f"null::double as mean, null::double as stddev, null::double as min, null::double as max, min({c})::varchar as min_text, " \
                      f"max({c})::varchar as max_text, true as close from lineitem"
    return head + (f"{mean_sql(c)} as mean, round(stddev_samp({c}), 6) as stddev, round(min({c})::double, 6) as min, round(max({c})::double, 6) as max, "
                   "null::varchar as min_text, null::varchar as max_text, true as close from lineitem")


@register("summary_profile_grown", "\nunion all\n".join(map(_grown_sql, GROWN)))
def q_summary_profile_grown(spark, sf_dir):
    """Three batches of rows, each read once and added to the stored state;
    the sketches' estimates are near the exact figures."""
    from tessera.operators import profile_state as PS
    rows, root = table(spark, sf_dir, "lineitem").select(*GROWN), scratch_path(spark, "state")
    for part in range(3):
        got = PS.grow(spark, root, "lineitem", rows.where(F.pmod(F.xxhash64("l_orderkey"), F.lit(3)) == part))
    exact = Y.profile(rows).select("col", F.col("n_distinct").alias("_d"), *[F.col(f"p{p}").alias(f"_p{p}") for p in (25, 50, 75)], F.col("stddev").alias("_sd"))
    close = F.abs(F.col("n_distinct") - F.col("_d")) <= 1 + 0.05 * F.col("_d")
    for p in (25, 50, 75):
        close = close & F.coalesce(F.abs(F.col(f"p{p}") - F.col(f"_p{p}")) <= 0.1 * F.col("_sd") + 1, F.lit(True))
    return got.join(exact, "col").select("col", "n", "n_null", "mean", "stddev", "min", "max", "min_text", "max_text", close.alias("close"))


def times_sql(src, c, numbers):
    """Times counted and compared as they are."""
    return (f"select {q(c)} as col, count(*) as n, count(*) - count({c}) as n_null, count(distinct {c}) as n_distinct, "
            + ", ".join(f"null::double as {n}" for n in numbers) + f", min({c})::varchar as min_text, max({c})::varchar as max_text from {src}")


@register("summary_profile_times", times_sql("events", "ts", ("mean", "stddev", "p25", "p50", "p75", "min", "max")))
def q_summary_profile_times(spark, sf_dir):
    """Times with fractions of a second."""
    return Y.profile(table(spark, sf_dir, "events"), ["ts"])


@register("extrema_times", "select 'ts' as col, null::double as min_value, null::double as max_value, min(ts)::varchar as min_text, "
          "max(ts)::varchar as max_text from events")
def q_extrema_times(spark, sf_dir):
    return Y.extrema(table(spark, sf_dir, "events"), ["ts"])


@register("summary_topk", "select * from (select col, value, cnt, row_number() over (partition by col order by "
          "cnt desc, value asc)::bigint as rank from (" + "\nunion all\n".join(
              f"select {q(c)} as col, cast({c} as varchar) as value, count(*) as cnt from orders "
              f"where {c} is not null group by 1, 2" for c in TOPK_COLS) + ")) where rank <= 3")
def q_summary_topk(spark, sf_dir):
    return Y.top_values(table(spark, sf_dir, "orders"), TOPK_COLS, k=3)


@register("summary_histogram", f"""
with long as ({unpivot_sql('lineitem', HIST_COLS)}),
rng as (select col, min(v) as mn, max(v) as mx from long group by col)
select col, bin, round(mn + bin * ((mx - mn) / 10), 6) as lo, round(mn + (bin + 1) * ((mx - mn) / 10), 6) as hi,
  count(*) as cnt
from (select l.col, (case when mx = mn then 0 else least(floor((v - mn) / (mx - mn) * 10), 9) end)::int as bin, mn, mx
      from long l join rng using (col))
group by col, bin, mn, mx""")
def q_summary_histogram(spark, sf_dir):
    return Y.histogram(table(spark, sf_dir, "lineitem"), HIST_COLS, bins=10)


TERMS_SQL = f"""
with tok as (select doc_id, lang, unnest(regexp_extract_all(lower(text), {q(Y.term_pattern())})) as term from documents),
pairs as (select doc_id, lang, term, count(*) as c from tok group by doc_id, lang, term),
tf as (select lang, term, sum(c) as tf from pairs group by lang, term),
df as (select term, count(*) as df from pairs group by term),
sc as (select lang, term, tf, df, round(tf * ln((select count(*) from documents) / df), 6) as score
       from tf join df using (term))
select lang, term, tf::bigint as tf, df::bigint as df, score, rank from (
  select *, row_number() over (partition by lang order by score desc, term asc)::bigint as rank from sc)
where rank <= 10"""


@register("summary_terms", TERMS_SQL)
def q_summary_terms(spark, sf_dir):
    return Y.text_terms(table(spark, sf_dir, "documents"), "doc_id", "lang", "text", k=10)


# ------------------------------------------------------------------ rank ---

RANK_NUMERIC_SQL = """
select c_custkey, c_acctbal::double as c_acctbal, c_nationkey::double as c_nationkey,
  (dense_rank() over (order by c_mktsegment) - 1)::bigint as c_mktsegment from customer"""


def _rank_numeric(spark, sf_dir):
    return R.numeric_projection(table(spark, sf_dir, "customer"), ["c_acctbal", "c_nationkey"], ["c_mktsegment"],
                                keep=["c_custkey"])


register("rank_numeric", RANK_NUMERIC_SQL)(_rank_numeric)


@register("rank_row_limit", RANK_NUMERIC_SQL + " order by c_custkey limit 1000")
def q_rank_row_limit(spark, sf_dir):
    return R.row_limit(_rank_numeric(spark, sf_dir), ["c_custkey"], 1000)


def pca_sql(src: str, cols: list[str], sweeps: int = 12) -> str:
    """Importance from the eigenvectors of the correlation matrix, which
    Jacobi rotations give: each step turns one pair of axes so that their
    entry vanishes. The state is the matrix ``a`` and the axes ``v``, each
    row by row."""
    d = len(cols)
    pairs = [(i, j) for i in range(d) for j in range(i + 1, d)]
    at = lambda m, i, j: f"{m}[({i}) * {d} + ({j}) + 1]"
    cell = "lambda k: "
    i, j = f"(k // {d})", f"(k % {d})"
    turn_cols = (f"list_transform(range({d * d}), {cell}case when {j} = p then c * {at('M', i, 'p')} - s * {at('M', i, 'q')} "
                 f"when {j} = q then s * {at('M', i, 'p')} + c * {at('M', i, 'q')} else {at('M', i, j)} end)")
    turn_rows = (f"list_transform(range({d * d}), {cell}case when {i} = p then c * {at('b', 'p', j)} - s * {at('b', 'q', j)} "
                 f"when {i} = q then s * {at('b', 'p', j)} + c * {at('b', 'q', j)} else {at('b', i, j)} end)")
    corr = ", ".join("1.0::double" if x == y else f"corr({x}, {y})" for x in cols for y in cols)
    return f"""
with recursive pairs(n, p, q) as (values {", ".join(f"({n}, {i}, {j})" for n, (i, j) in enumerate(pairs))}),
start as (select [{corr}] as a from {src}),
turns(step, a, v) as (
  select 0, a, list_transform(range({d * d}), {cell}case when {i} = {j} then 1.0::double else 0.0::double end) from start
  union all
  select step + 1, {turn_rows} as a, w as v from (
    select *, {turn_cols.replace('M[', 'a[')} as b, {turn_cols.replace('M[', 'v[')} as w from (
      select *, 1 / sqrt(1 + t * t) as c, t / sqrt(1 + t * t) as s from (
        select *, case when abs({at('a', 'p', 'q')}) < 1e-300 then 0.0 when tau >= 0 then 1 / (tau + sqrt(1 + tau * tau))
                  else -1 / (-tau + sqrt(1 + tau * tau)) end as t from (
          select turns.*, p, q, case when abs({at('a', 'p', 'q')}) < 1e-300 then 0.0
                 else ({at('a', 'q', 'q')} - {at('a', 'p', 'p')}) / (2 * {at('a', 'p', 'q')}) end as tau
          from turns join pairs on step % {len(pairs)} = n where step < {sweeps * len(pairs)}))))),
last as (select a, v, list_sum(list_transform(range({d}), {cell}greatest({at('a', 'k', 'k')}, 0))) as total from turns order by step desc limit 1)
""" + "\nunion all\n".join(
        f"select {q(c)} as col, round(list_sum(list_transform(range({d}), {cell}abs({at('v', n, 'k')}) * greatest({at('a', 'k', 'k')}, 0) / total)), 6) "
        f"as importance, (select count({c}) from {src}) as n_used from last" for n, c in enumerate(cols))


@register("rank_pca", pca_sql("lineitem", PROFILE_COLS))
def q_rank_pca(spark, sf_dir):
    return R.pca_importance(table(spark, sf_dir, "lineitem"), PROFILE_COLS)


CORR_SQL = "\nunion all\n".join(
    f"select {q(c)} as col, round(abs(corr({c}, l_extendedprice)), 6) as importance from lineitem" for c in CORR_COLS)


def _corr(spark, sf_dir):
    return R.corr_importance(table(spark, sf_dir, "lineitem"), CORR_COLS, "l_extendedprice")


register("rank_corr", CORR_SQL)(_corr)


@register("rank_artifact", f"select *, row_number() over (order by importance desc nulls last, col)::bigint as rank "
          f"from ({CORR_SQL})")
def q_rank_artifact(spark, sf_dir):
    return R.rank_importance(_corr(spark, sf_dir))


# --------------------------------------------------------------- cluster ---

@register("cluster_kmeans")
def q_cluster_kmeans(spark, sf_dir):
    out = KM.cluster_dataset(spark, table(spark, sf_dir, "embeddings"), "embedding",
                             scratch_path(spark, "clusters"), "embeddings", k=10, seed=42)
    return out.select("vec_id", "label", "cluster")


def _misplaced(spark, df, cols, k):
    """One row: rows, clusters, rows without a cluster, and rows whose
    nearest centre is another cluster's (by the assignment of K2)."""
    out, model = KM.kmeans_model(df, cols, k=k, seed=42)
    again = KM.assign(out.withColumn("_x", KM.features(out, cols)).withColumnRenamed("cluster", "mine"), "_x", KM.centres(spark, model))
    return again.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("mine").alias("n_clusters"),
                     F.count_if(F.col("mine").isNull()).alias("n_without"), F.count_if(F.col("mine") != F.col("cluster")).alias("n_misplaced"))


@register("cluster_kmeans_check", "select count(*) as n_rows, 10::bigint as n_clusters, 0::bigint as n_without, 0::bigint as n_misplaced from embeddings")
def q_cluster_kmeans_check(spark, sf_dir):
    return _misplaced(spark, table(spark, sf_dir, "embeddings"), "embedding", 10)


@register("cluster_numeric", "select count(*) as n_rows, 4::bigint as n_clusters, "
          "count_if(c_custkey % 7 = 0)::bigint as n_without, 0::bigint as n_misplaced from customer")
def q_cluster_numeric(spark, sf_dir):
    """Numeric columns; a row with a missing value stays without a cluster."""
    cust = table(spark, sf_dir, "customer").withColumn("bal", F.when(F.col("c_custkey") % 7 != 0, F.col("c_acctbal")))
    return _misplaced(spark, cust, ["bal", "c_nationkey"], 4)


ASSIGN_SQL = """
with e as (select vec_id, label, unnest(embedding)::double as x, unnest(range(len(embedding))) as d from embeddings),
c as (select label as cluster, d, avg(x) as m from e group by label, d),
dd as (select e.vec_id, e.label, c.cluster, sum((e.x - c.m) * (e.x - c.m)) as dist
       from e join c on e.d = c.d group by e.vec_id, e.label, c.cluster),
asg as (select vec_id, label, cluster::bigint as cluster, round(dist, 6) as dist from (
  select *, row_number() over (partition by vec_id order by dist, cluster) as rn from dd) where rn = 1)
"""


def _assign(spark, sf_dir):
    emb = table(spark, sf_dir, "embeddings")
    cents = KM.centroids_by(emb, "embedding", "label")
    return KM.assign(emb.select("vec_id", "label", "embedding"), "embedding", cents).drop("embedding")


register("cluster_assign", ASSIGN_SQL + "select * from asg")(_assign)


@register("cluster_report", ASSIGN_SQL + """
select cluster, count(*) as n, round(avg(dist), 6) as mean_dist,
  round(count(*) / (select count(*) from asg), 6) as share from asg group by cluster""")
def q_cluster_report(spark, sf_dir):
    return KM.cluster_report(_assign(spark, sf_dir))


# --------------------------------------------------------------- geocode ---

GAZ_RED = """red as (select key, kind, lat, lon, priority, n_candidates from (
  select upper(trim(place)) as key, kind, lat, lon, priority,
    count(*) over (partition by upper(trim(place))) as n_candidates,
    row_number() over (partition by upper(trim(place)) order by priority, kind, lat, lon) as rn
  from gazetteer) where rn = 1)"""


@register("geocode_forward", with_ctes(["gazetteer", "places"], [GAZ_RED]) + """
select p.c_custkey, p.place_raw, r.lat, r.lon from places p left join red r on upper(trim(p.place_raw)) = r.key""")
def q_geocode_forward(spark, sf_dir):
    return G.geocode_forward(derived(spark, sf_dir, "places"), "place_raw", derived(spark, sf_dir, "gazetteer"))


@register("geocode_ambiguous", with_ctes(["gazetteer"], [GAZ_RED]) + "select * from red")
def q_geocode_ambiguous(spark, sf_dir):
    return G.reduce_gazetteer(derived(spark, sf_dir, "gazetteer"))


@register("geocode_report", with_ctes(["gazetteer", "places"], [GAZ_RED]) + """
select 'place_raw' as col, coalesce(r.kind, 'unmatched') as kind, count(*) as n
from places p left join red r on upper(trim(p.place_raw)) = r.key group by 2""")
def q_geocode_report(spark, sf_dir):
    g = G.geocode_forward(derived(spark, sf_dir, "places"), "place_raw", derived(spark, sf_dir, "gazetteer"),
                          with_kind=True)
    return G.geocode_report(g, "place_raw")


# ----------------------------------------------------------------- batch ---

BATCH = {"customer": ["c_acctbal", "c_nationkey"], "supplier": ["s_acctbal", "s_nationkey"],
         "part": ["p_size", "p_retailprice"]}


@register("batch_profile", "\nunion all\n".join(profile_sql(t, cols, t) for t, cols in BATCH.items()))
def q_batch_profile(spark, sf_dir):
    return Y.profile_many({t: (table(spark, sf_dir, t), cols) for t, cols in BATCH.items()})


# ------------------------------------------------------------ end to end ---

MERGED_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority", "row_index",
               "c_name", "c_nationkey", "c_acctbal", "c_mktsegment", "n_name", "n_regionkey"]
MERGED_TEXT = ("o_orderstatus", "o_orderpriority", "c_name", "c_mktsegment", "n_name")


def _merged_ctes():
    """The merged table, its classification and verification."""
    from tessera.plans.sqlgen import best_sql, casts_sql, classify_sql, clean_expr, distinct_sql, scores_sql, verified_sql
    cells = ", ".join("(row_number() over (order by o_orderkey) - 1)::bigint as row_index" if c == "row_index" else
                      f"{clean_expr(c)} as {c}" if c in MERGED_TEXT else c for c in MERGED_COLS)
    merged = f"select {cells} from (select distinct * from orders) left join customer on o_custkey = c_custkey left join nation on c_nationkey = n_nationkey"
    return [f"merged AS ({merged})", f"scores AS ({scores_sql('merged', MERGED_COLS, 'd_orders')})",
            f"dist AS ({distinct_sql('merged', MERGED_COLS, 'd_orders')})", f"best AS ({best_sql('scores', 'dataset_id, col')})",
            f"cls AS ({classify_sql('best', 'dist', 'dataset_id, col')})", f"cc AS ({casts_sql('merged', MERGED_COLS, 'd_orders')})",
            f"ver AS ({verified_sql('cls', 'cc')})"]


def _prepare_sql():
    from tessera.plans.queries_classify import _declared_sql
    from tessera.plans.sqlgen import cast_expr
    num = "\nunion all\n".join(
        f"select {q(c)} as col, {i} as ord, corr({cast_expr(c, 'double')}, o_totalprice) as r, "
        f"min({cast_expr(c, 'double')}) as mn, max({cast_expr(c, 'double')}) as mx from merged"
        for i, c in enumerate(MERGED_COLS))
    return "WITH " + ",\n".join([*_merged_ctes(), f"decl AS ({_declared_sql('merged', MERGED_COLS)})", f"nums AS ({num})", """
v AS (select nums.col, nums.ord, decl.declared, ver.semantic_type as suggested, ver.probability,
        case when accepted then storage else decl.declared end as selected, nums.r, nums.mn, nums.mx
      from nums join decl using (col) join ver using (col))"""]) + """
select 'd_orders' as dataset_id, 'seed' as source, 'modelling' as dataset_type,
  (select count(*) from merged) as n_rows, col, ord, declared, suggested, probability, selected,
  case when selected in ('bigint', 'double') and col <> 'o_totalprice' then round(abs(r), 6) end as importance,
  case when selected in ('bigint', 'double') then mn end as min,
  case when selected in ('bigint', 'double') then mx end as max
from v"""


def _orders(spark, sf_dir) -> Dataset:
    t = lambda n: table(spark, sf_dir, n)
    rels = [M.Relation("customer", t("customer"), "o_custkey", "c_custkey"),
            M.Relation("nation", t("nation"), "c_nationkey", "n_nationkey")]
    return Dataset("orders", t("orders"), rels, ["o_orderkey"], "o_totalprice", ("o_orderkey", "o_orderstatus", "o_orderpriority"))


def _dirty(spark, sf_dir) -> Dataset:
    """With duplicate rows, and a type that verification rejects."""
    return Dataset("dirty", derived(spark, sf_dir, "dirty_customer"), [], ["c_custkey", "acctbal"])


@register("prepare_and_ingest", _prepare_sql())
def q_prepare_and_ingest(spark, sf_dir):
    cat = ingest(spark, _orders(spark, sf_dir), scratch_path(spark, "ingest"), endpoint="catalog", prefix="d_")
    return cat.select("dataset_id", "source", "dataset_type", "n_rows", F.inline("variables"))


DIRTY_INDEXED = """ded as (select distinct * from cleaned),
idx as (select *, (row_number() over (order by c_custkey, acctbal nulls first) - 1)::bigint as row_index from ded)
"""


@register("ingest_relational", with_ctes(["dirty_customer"]).rstrip() + ",\n" + DIRTY_INDEXED + """
select c_custkey, name, acctbal, segment, konst, empty_col, row_index, 'seed' as source from idx""")
def q_ingest_relational(spark, sf_dir):
    return ingest(spark, _dirty(spark, sf_dir), scratch_path(spark, "ingest"), endpoint="catalog", metadata_only=True, database="store")


def _metadata_sql():
    text = [c for c in MERGED_COLS if c in MERGED_TEXT]
    prof = profile_sql("merged", MERGED_COLS, "d_orders", timed=["o_orderdate"], text=text)
    return "WITH " + ",\n".join([*_merged_ctes(), f"prof AS ({prof})"]) + """
select dataset_id, col, semantic_type, n_non_null, n_cast, accepted, storage, n, n_null, n_distinct, mean, p50, min, max, min_text, max_text
from ver join prof using (dataset_id, col)"""


@register("metadata_tables", _metadata_sql())
def q_metadata_tables(spark, sf_dir):
    """Two datasets in the same metadata tables, one of them run again; the
    rows of one are read back, with none of the other's."""
    from tessera.sources import catalog as K
    root = scratch_path(spark, "ingest")
    for ds in (_orders(spark, sf_dir), _dirty(spark, sf_dir), _dirty(spark, sf_dir)):
        ingest(spark, ds, root, endpoint="catalog", prefix="d_")
    cls, prof = (K.read_metadata(spark, f"{root}/metadata", n).where("dataset_id = 'd_orders'") for n in ("classification", "profile"))
    return cls.join(prof, ["dataset_id", "col"]).select(
        "dataset_id", "col", "semantic_type", "n_non_null", "n_cast", "accepted", "storage", "n", "n_null", "n_distinct", "mean", "p50",
        "min", "max", "min_text", "max_text")


@register("model_catalog", with_ctes(["dirty_customer"]) + """
select 'd_dirty' as dataset_id, (select count(*) from (select distinct * from cleaned)) as n_rows, 0::bigint as n_models,
  'model_id,dataset_id,kind,params' as model_columns""")
def q_model_catalog(spark, sf_dir):
    """The model catalog is there, and empty, once a dataset is in the
    datasets catalog."""
    from tessera.sources import catalog as K
    root = scratch_path(spark, "ingest")
    cat = ingest(spark, _dirty(spark, sf_dir), root, endpoint="catalog", prefix="d_")
    models = spark.read.schema(K.MODELS_SCHEMA).parquet(f"{root}/models")
    n = models.groupBy("dataset_id").agg(F.count(F.lit(1)).alias("n"))
    return cat.select("dataset_id", "n_rows").join(n, "dataset_id", "left").select(
        "dataset_id", "n_rows", F.coalesce("n", F.lit(0).cast("bigint")).alias("n_models"), F.lit(",".join(models.columns)).alias("model_columns"))
