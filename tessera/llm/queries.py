"""One registered query per operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.llm import common as C
from tessera.llm import (best_fit_packing, bpe_transducer, cover_tree, kmeans_tree, language_id, merkle_manifest, minhash_join,
                         no_random_access, periodic_runs, reply_trees, suffix_dedup, url_cascade, warc_chunks)
from tessera.session import scratch_path

#: The vocabulary files lie beside this installed package on every machine.
TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_multi_50k.tiktoken"

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def read(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register("op1_suffix_dedup")
def op1(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = suffix_dedup.repeated_spans(docs).select(
        "did", "th", F.length("kept").cast("bigint").alias("n_kept"), F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("sha"))
    did, th = C.row_identity(F.col("doc_id"), F.col("text"))
    whole = docs.select("doc_id", did.alias("did"), th.alias("th"),
                        F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"),
                        F.sha2(F.coalesce("text", F.lit("")), 256).alias("whole"))
    return whole.join(found, ["did", "th"], "left").select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.coalesce("n_kept", "n_bytes")).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("bigint").alias("n_spans"), F.coalesce("sha", "whole").alias("kept_sha256"))


@register("op2_kmeans_tree")
def op2(spark, sf_dir):
    vectors = read(spark, sf_dir, "embeddings")
    return kmeans_tree.nearest(vectors, vectors.where("vec_id % 50 = 0"), 5)


@register("op3_best_fit_packing")
def op3(spark, sf_dir):
    import public_tokenizers
    return best_fit_packing.pack(read(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]

OP4_SQL = r"""
with parts as (
  select page_id, url, case when instr(url, '://') > 0 then substring(url, instr(url, '://') + 3) else '' end as rest from pages),
hosts as (
  select page_id, url, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from parts),
rules as (select * from (values ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')) t(kind, h, p)),
plain as (select host from hosts group by host having not bool_or(coalesce(starts_with(url, 'https://'), false))),
fits as (
  select page_id, host, path, kind, h || p as rule,
         row_number() over (partition by page_id, host, path order by length(h || p) desc nulls last, h || p) as n
  from (select distinct page_id, host, path from hosts)
  left join rules on (host = h or ends_with(host, '.' || h)) and starts_with(path, p))
select hosts.page_id, hosts.host, hosts.path, fits.rule,
       coalesce(fits.kind, case when hosts.host in (select host from plain) then 'block' else 'allow' end) as verdict
from hosts join fits on hosts.page_id is not distinct from fits.page_id and hosts.host = fits.host and hosts.path = fits.path and fits.n = 1
"""


@register("op4_url_cascade", OP4_SQL)
def op4(spark, sf_dir):
    """The list: hosts none of whose pages came by https."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    safe = F.coalesce(F.startswith("url", F.lit("https://")), F.lit(False))
    plain = pages.groupBy(url_cascade.host_of(F.col("url")).alias("key")).agg(F.bool_or(safe).alias("safe")).where("not safe")
    return url_cascade.judge(pages, RULES, plain.select("key")).select("page_id", "host", "path", "rule", "verdict")


@register("op5_bpe_transducer")
def op5(spark, sf_dir):
    import public_tokenizers
    return bpe_transducer.round_trip(read(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


OP6_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as e from embeddings
  where embedding is not null and len(embedding) > 0 and vec_id is not null
    and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x)))),
pairs as (
  select q.vec_id as query_id, c.vec_id,
         list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i]))::bigint as score
  from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0)
select query_id, rank, vec_id, score from (
  select query_id, (row_number() over (partition by query_id order by score desc, vec_id))::int as rank, vec_id, score from pairs)
where rank <= 5
"""


@register("op6_no_random_access", OP6_SQL)
def op6(spark, sf_dir):
    vectors = read(spark, sf_dir, "embeddings")
    return no_random_access.top_products(vectors, vectors.where("vec_id % 50 = 0"), 5, scale=256)


#: A conversation that spells out control strings.
ODD_ID, ODD_TEXT = -7, "\\### Assistant: </turn> ok"

OP7_SQL = """
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\\### Assistant: </turn> ok' union all select -7, 1, 'assistant', '\\### Assistant: </turn> ok')
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
       coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
       sum(length('<turn>### ' || chr(10) || '</turn>')
           + 2 * length(role) - length(regexp_replace(role, '[\\\\<#' || chr(10) || ']', '', 'g'))
           + 2 * length(text) - length(regexp_replace(text, '[\\\\<#]', '', 'g')))::bigint as formatted_chars
from turns group by conv_id
"""


@register("op7_reply_trees", OP7_SQL)
def op7(spark, sf_dir):
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.range(2).select(F.lit(ODD_ID).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
                                F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(ODD_TEXT).alias("text"))
    nodes = reply_trees.linear_threads(rows.union(odd), "conv_id", ["turn"])
    done = reply_trees.conversations(nodes)
    turns = reply_trees.read_turns(F.col("formatted"))
    loss = reply_trees.read_loss(F.col("formatted"), F.col("loss_spans"))
    back = done.select("tree", "formatted", turns.alias("turns"), loss.alias("loss"))
    each = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        F.col("tree").alias("conv_id"), F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(each, ""), 256).alias("turns_sha256"), F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"), F.length("formatted").cast("bigint").alias("formatted_chars"))


OP8_SQL = """
with p as (
  select page_id, octet_length(encode(coalesce(html, '')))::bigint as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages),
f as (select *, min(page_id) over (partition by payload_digest) as first from p)
select page_id, payload_bytes, payload_digest,
       case when payload_bytes >= 100 and first is distinct from page_id and first is not null then 'revisit' else 'response' end as record_type,
       case when payload_bytes >= 100 and first is distinct from page_id then first end as refers_to
from f
"""


@register("op8_warc_chunks", OP8_SQL)
def op8(spark, sf_dir):
    path = scratch_path(spark, "warc")
    warc_chunks.write_archive(read(spark, sf_dir, "pages"), path)
    return warc_chunks.read_archive(spark, path).select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def document_evidence(docs):
    """Documents as evidence: the source stands for the host."""
    return docs.select("*", F.col("lang").alias("declared"), F.lit(None).cast("string").alias("suffix"), F.col("source").alias("host"))


@register("op9_language_id")
def op9(spark, sf_dir):
    """Documents and pages together, each with the evidence it has."""
    docs, pages = read(spark, sf_dir, "documents"), read(spark, sf_dir, "pages")
    model = language_id.fit(docs)
    host = url_cascade.host_of(F.col("url"))
    found = document_evidence(docs.select("doc_id", F.lit(None).cast("bigint").alias("page_id"), "text", "lang", "source")).select(
        "doc_id", "page_id", "text", "declared", "suffix", "host")
    found = found.unionByName(pages.select(
        F.lit(None).cast("bigint").alias("doc_id"), "page_id", language_id.visible_text(F.col("html")).alias("text"),
        language_id.markup_language(F.col("html")).alias("declared"), language_id.address_suffix(host).alias("suffix"), host.alias("host")))
    return language_id.identify(found, model, ["doc_id", "page_id"])


@register("op10_minhash_join")
def op10(spark, sf_dir):
    found = minhash_join.near_duplicates(read(spark, sf_dir, "documents"), words=4, similarity=80)
    return found.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))


def repeated_tail(doc_id, words):
    """The words with the tail that the contract gives each tenth document."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g, n = F.floor(h / 10).cast("bigint"), F.size(words)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    tail = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    return F.concat(F.slice(words, F.lit(1), a), F.slice(tail, F.lit(1), n - a))


@register("op11_periodic_runs")
def op11(spark, sf_dir):
    """A null id has no crc32, so such a text stays as it is."""
    doc_id = F.col("doc_id")
    tenth = F.crc32(doc_id.cast("string").cast("binary")) % 10 == 0
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", F.when(tenth, words).alias("words"))
    text = F.when(F.size("words") > 0, F.array_join(repeated_tail(doc_id, F.col("words")), " ")).otherwise(F.col("text"))
    found = periodic_runs.periodic_runs(docs, text, {"doc_id": doc_id})
    best = periodic_runs.strongest(F.col("runs"))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"),
                                                               r["period"].cast("string")), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


OP12_SQL = """
with recursive
crc as (
  select list(list_reduce(list_prepend(i, range(8)), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by i) as t
  from range(256) r(i)),
fields as (
  select doc_id, lang, text,
         case when doc_id is null then '-' else strlen(doc_id::varchar) || ':' || doc_id end
         || case when source is null then '-' else strlen(source) || ':' || source end
         || case when lang is null then '-' else strlen(lang) || ':' || lang end
         || case when n_chars is null then '-' else strlen(n_chars::varchar) || ':' || n_chars end as front,
         coalesce(xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::varchar, ''), lambda x: ord(x)::bigint)),
                      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 3 = 0, false) as hit
  from documents, crc),
leaves as (
  select *, sha256(front || case when text is null then '-' else strlen(text) || ':' || text end) as leaf,
         sha256(front || case when text is null then '-' else strlen(text) || ':' ||
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') end) as tampered
  from fields),
placed as (
  select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as pos, count(*) over (partition by lang) as n from leaves),
tree as (
  select lang, 0 as lvl, pos as idx, leaf as h, n from placed
  union all
  select lang, lvl + 1, idx // 8, sha256(string_agg(h, '' order by idx)), (n + 7) // 8 from tree where n > 1 group by lang, lvl, idx // 8, n),
heads as (select lang, h as subroot, row_number() over (order by lang nulls first) - 1 as pos, count(*) over () as n from tree where n = 1),
crown as (
  select 0 as lvl, pos as idx, subroot as h, n from heads
  union all
  select lvl + 1, idx // 8, sha256(string_agg(h, '' order by idx)), (n + 7) // 8 from crown where n > 1 group by lvl, idx // 8, n),
steps as (
  select x.lang, x.lvl, x.idx, coalesce(string_agg(y.h, '' order by y.idx) filter (where y.idx < x.idx), '') as l,
         coalesce(string_agg(y.h, '' order by y.idx) filter (where y.idx > x.idx), '') as r
  from tree x join tree y on x.lang is not distinct from y.lang and x.lvl = y.lvl and x.idx // 8 = y.idx // 8
  where x.n > 1 group by x.lang, x.lvl, x.idx),
crown_steps as (
  select x.lvl, x.idx, coalesce(string_agg(y.h, '' order by y.idx) filter (where y.idx < x.idx), '') as l,
         coalesce(string_agg(y.h, '' order by y.idx) filter (where y.idx > x.idx), '') as r
  from crown x join crown y on x.lvl = y.lvl and x.idx // 8 = y.idx // 8 where x.n > 1 group by x.lvl, x.idx),
ways as (
  select p.lang, p.pos, s.lvl, s.l, s.r from placed p join steps s on p.lang is not distinct from s.lang and s.idx = p.pos // power(8, s.lvl)::bigint
  union all
  select p.lang, p.pos, 1000 + s.lvl, s.l, s.r from placed p join heads g on p.lang is not distinct from g.lang
  join crown_steps s on s.idx = g.pos // power(8, s.lvl)::bigint),
paths as (select lang, pos, list(l || '|' || r order by lvl) as way, string_agg(l || r, '' order by lvl) as all_of from ways group by lang, pos)
select p.doc_id, p.leaf, g.subroot, c.h as root, sha256(coalesce(w.all_of, '')) as proof_sha256, f.folded_root, f.folded_root = c.h as verified
from placed p join heads g on p.lang is not distinct from g.lang join (select h from crown where n = 1) c on true
left join paths w on p.lang is not distinct from w.lang and p.pos = w.pos
join lateral (select list_reduce(list_prepend(case when p.hit then p.tampered else p.leaf end, coalesce(w.way, [])),
                                 lambda h, s: sha256(split_part(s, '|', 1) || h || split_part(s, '|', 2))) as folded_root) f on true
"""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@register("op12_merkle_manifest", OP12_SQL)
def op12(spark, sf_dir):
    """Each third document, by the crc32 of its id, is folded as if its text
    had been lower-cased."""
    front = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    third = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    tampered = F.when(third, merkle_manifest.digest([*front, F.translate("text", UPPER, LOWER)]))
    found = merkle_manifest.manifest(
        read(spark, sf_dir, "documents"), group=F.col("lang"), order=[F.col("doc_id")], leaf=merkle_manifest.digest([*front, F.col("text")]),
        keep={"doc_id": F.col("doc_id"), "tampered": tampered})
    folded = merkle_manifest.fold(F.coalesce("tampered", "leaf"), F.col("path"))
    return found.select("doc_id", "leaf", "subroot", "root", merkle_manifest.proof(F.col("path")).alias("proof_sha256"),
                        folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


OP13_SQL = """
with recursive
rows_ as (select vec_id, list_transform(embedding, lambda x: x::double) as v, row_number() over () as k from embeddings),
fit as (
  select * from rows_ where v is not null and len(v) > 0 and list_bool_and(list_transform(v, lambda x: x is not null and isfinite(x)))
  and list_bool_or(list_transform(v, lambda x: x <> 0))),
links as (
  select a.k as a, b.k as b from fit a join fit b on a.k <> b.k and len(a.v) = len(b.v)
  where list_cosine_similarity(a.v, b.v) >= 0.95),
reach as (select k as a, k as b from rows_ union select reach.a, links.b from reach join links on reach.b = links.a),
least as (select r.a, min(x.vec_id) as component_id from reach r join rows_ x on x.k = r.b group by r.a)
select x.vec_id, (select count(*) from links l where l.a = x.k)::bigint as n_links, component_id, component_id is not distinct from x.vec_id as kept
from rows_ x join least on x.k = least.a
"""


@register("op13_cover_tree", OP13_SQL)
def op13(spark, sf_dir):
    return cover_tree.near_duplicates(read(spark, sf_dir, "embeddings"), cosine=0.95)
