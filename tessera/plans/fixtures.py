"""Derived inputs built from the driver tables by SQL that both Spark and
DuckDB run identically (but for the few in ``DUCK``). In Spark each base table is passed as a DataFrame
argument of ``spark.sql``; in an oracle the same text becomes a CTE over the
registered views. All of them grow with the tables they read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.sources.tables import table

# The derived-input SQL (placeholders in braces name tables).
DERIVED = {
    "dirty_customer": """
select c_custkey,
  case when c_custkey%10=0 then '' when c_custkey%10=1 then 'NA'
       when c_custkey%10=2 then concat('  ',c_name,' ') else c_name end as name,
  case when c_custkey%11=0 then 'n/a' when c_custkey%13=0 then 'abc'
       else cast(c_acctbal as string) end as acctbal,
  c_mktsegment as segment, 'x' as konst, cast(null as string) as empty_col
from {customer}
union all
select c_custkey, c_name, cast(c_acctbal as string), c_mktsegment, 'x', cast(null as string)
from {customer} where c_custkey%50=3""",
    "bands": """
select distinct concat('img_',cast(user_id as string)) as image_id, event_type as band,
  concat('img_',cast(user_id as string),'_',event_type,'.tif') as image_file,
  cast(user_id%180-90 as double) as lat, cast(user_id%360-180 as double) as lon, user_id%7 as tile
from {events}""",
    "gazetteer": """
select n_name as place, 'nation' as kind, cast(n_nationkey*7-84 as double) as lat,
  cast(n_nationkey*14-168 as double) as lon, 1 as priority from {nation}
union all select r_name, 'region', cast(r_regionkey*10 as double), cast(r_regionkey*20 as double), 2 from {region}
union all select n_name, 'alias', cast(0 as double), cast(0 as double), 9 from {nation} where n_nationkey%5=0""",
    "places": """
select c_custkey, case when c_custkey%17=0 then 'Atlantis' else concat(' ',lower(n_name),' ') end as place_raw
from {customer} join {nation} on c_nationkey=n_nationkey""",
    "stamps": """
select o_orderkey,
  case when o_orderkey%100=7 then '2024-01-05 13:45:10' else '2024-01-05' end as some_times,
  case when o_orderkey%9=0 then '2024-01-05garbage' else '2024-01-05' end as tail_text,
  case when o_orderkey%1000<799 then '12' else 'abc' end as under_bar,
  case when o_orderkey%4000=1 then '1.5' else cast(o_orderkey as string) end as nearly_whole,
  case when o_orderkey%2=0 then concat(chr(9),'NA') else concat(cast(o_orderkey as string),chr(13)) end as odd_space
from {orders}""",
    "exact": """
select o_orderkey, lpad(cast(o_orderkey%1000 as string), 5, '0') as padded,
  case when o_orderkey%400=1 then '1e999' else cast(o_orderkey as string) end as overflows,
  concat('1', lpad(cast(o_orderkey%1000000 as string), 6, '0'), '12345678901.', lpad(cast(o_orderkey%100 as string), 2, '0')) as money,
  concat('9', lpad(cast(o_orderkey%1000000 as string), 6, '0'), '1234567890123') as beyond,
  concat(cast(o_orderkey%90 + 10 as string), 'e', cast(o_orderkey%3 as string)) as powers,
  case when o_orderkey%400=1 then '00.5' else cast(o_orderkey%7 as string) end as padded_once,
  cast(o_totalprice as string) as price
from {orders}""",
    "bands_mixed": """
select distinct concat('img_',cast(user_id as string)) as image_id, event_type as band,
  concat('img_',cast(user_id as string),'_',event_type,'.tif') as image_file,
  cast(user_id%180-90 as double) as lat, cast(user_id%360-180 as double) as lon,
  case when user_id%10=0 then 'abc' else cast(user_id as string) end as reading,
  lpad(cast(user_id as string), 8, '0') as scene
from {events}""",
    "contacts": """
select doc_id, explode_outer(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]{{2,}}', 0)) as contact, lang
from {documents}""",
    "declared": """
select 'c_custkey' as col, 'bigint' as declared, 0 as ord
union all select 'c_name','string',1 union all select 'c_nationkey','string',2
union all select 'c_phone','string',3 union all select 'c_mktsegment','string',4""",
}
# Where DuckDB spells a derived input another way.
DUCK = {
    "contacts": """
select doc_id, unnest(case when coalesce(len(l), 0) = 0 then [null] else l end) as contact, lang
from (select doc_id, lang, regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]{{2,}}') as l from {documents})""",
}
SOURCES = {
    "dirty_customer": ["customer"],
    "bands": ["events"],
    "gazetteer": ["nation", "region"],
    "places": ["customer", "nation"],
    "stamps": ["orders"],
    "exact": ["orders"],
    "bands_mixed": ["events"],
    "contacts": ["documents"],
    "declared": [],
}


def derived(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The derived input ``name`` as a lazy DataFrame."""
    return spark.sql(DERIVED[name], **{t: table(spark, sf_dir, t) for t in SOURCES[name]})


def duck_body(name: str) -> str:
    """The same input over the oracle's views."""
    return DUCK.get(name, DERIVED[name]).format(**{t: t for t in SOURCES[name]})


def cte(*names: str) -> str:
    """``WITH`` clause defining the derived inputs over the oracle's views."""
    return "WITH " + ",\n".join(f"{n} AS ({duck_body(n)})" for n in names) + "\n"
