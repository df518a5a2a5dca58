"""Driver queries over the whole driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import merge as M
from tessera.operators import summary as Y
from tessera.plans.registry import register
from tessera.session import scratch_path
from tessera.sources.dataset import read_dataset, write_dataset
from tessera.sources.tables import table

# ---------------------------------------------------------------- merge ----

def star_relations(spark, sf_dir):
    t = lambda n: table(spark, sf_dir, n)
    return [
        M.Relation("orders", t("orders"), "l_orderkey", "o_orderkey"),
        M.Relation("customer", t("customer"), "o_custkey", "c_custkey"),
        M.Relation("nation", t("nation"), "c_nationkey", "n_nationkey"),
        M.Relation("region", t("region"), "n_regionkey", "r_regionkey"),
    ]


def star(spark, sf_dir):
    return M.star_merge(table(spark, sf_dir, "lineitem"), star_relations(spark, sf_dir))


STAR_SQL = """
select l.*, o.* exclude (o_orderkey), c.* exclude (c_custkey),
       n.* exclude (n_nationkey), r.* exclude (r_regionkey)
from lineitem l
left join orders o on l.l_orderkey = o.o_orderkey
left join customer c on o.o_custkey = c.c_custkey
left join nation n on c.c_nationkey = n.n_nationkey
left join region r on n.n_regionkey = r.r_regionkey"""

register("merge_star", STAR_SQL)(star)


@register("merge_document", """
select l.*, o.* exclude (o_orderkey), s.* exclude (s_suppkey), c.* exclude (c_custkey),
       sn.* exclude (n_nationkey), cn.n_name as c_nationkey_nation_n_name, cn.n_regionkey as c_nationkey_nation_n_regionkey,
       sr.* exclude (r_regionkey), cr.r_name as n_regionkey_region_r_name
from lineitem l
left join orders o on l.l_orderkey = o.o_orderkey
left join supplier s on l.l_suppkey = s.s_suppkey
left join customer c on o.o_custkey = c.c_custkey
left join nation sn on s.s_nationkey = sn.n_nationkey
left join nation cn on c.c_nationkey = cn.n_nationkey
left join region sr on sn.n_regionkey = sr.r_regionkey
left join region cr on cn.n_regionkey = cr.r_regionkey""")
def q_merge_document(spark, sf_dir):
    """A folder with six resources (the main one stored as Parquet, the
    others as CSV), merged by what its document says."""
    ref, folder = M.Reference, scratch_path(spark, "dataset")
    frames = {n: table(spark, sf_dir, n) for n in ("lineitem", "orders", "supplier", "customer", "nation", "region")}
    references = {
        "lineitem": [ref("l_orderkey", "orders", "o_orderkey"), ref("l_suppkey", "supplier", "s_suppkey")],
        "orders": [ref("o_custkey", "customer", "c_custkey")],
        "customer": [ref("c_nationkey", "nation", "n_nationkey")],
        "supplier": [ref("s_nationkey", "nation", "n_nationkey")],
        "nation": [ref("n_regionkey", "region", "r_regionkey")],
    }
    write_dataset(folder, "lineitem_dataset", "lineitem", frames, references, {"lineitem": f"{sf_dir}/lineitem.parquet"})
    return read_dataset(spark, folder).merged()


EXTREMA_COLS = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_shipdate", "o_totalprice", "o_orderdate",
                "c_acctbal"]


def extrema_sql(src: str, cols: list[str], whole=(), timed=()) -> str:
    """One row per column: fractions have no exact text, times no double."""
    def one(c):
        num = text = [f"min({c})", f"max({c})"]
        if c in timed:
            num, text = ["null"] * 2, [f"strftime({e}, '%Y-%m-%d %H:%M:%S')" for e in text]
        elif c not in whole:
            text = ["null"] * 2
        return (f"select '{c}' as col, {num[0]}::double as min_value, {num[1]}::double as max_value, "
                f"{text[0]}::varchar as min_text, {text[1]}::varchar as max_text from {src}")
    return "\nunion all\n".join(one(c) for c in cols)


@register("extrema", "with m as (select s.*, 9007199254740993::bigint as big from (" + STAR_SQL + ") s)\n" + extrema_sql(
    "m", [*EXTREMA_COLS, "big"], whole=("l_orderkey", "l_linenumber", "big"), timed=("l_shipdate", "o_orderdate")))
def q_extrema(spark, sf_dir):
    """Fractions, whole numbers, one beyond what doubles hold, and times."""
    df = star(spark, sf_dir).withColumn("big", F.lit(9007199254740993).cast("bigint"))
    return Y.extrema(df, [*EXTREMA_COLS, "big"])
