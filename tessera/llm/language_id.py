"""Language identification by Bayesian fusion of four kinds of evidence.

* text: byte-bigram likelihoods over the whole text, fitted on a sample of
  distinct labelled texts (``FIT_ROWS`` at most, a parameter, in equal parts
  for the languages: of each the texts of least hash, or all). The languages are the labels themselves, as they are written:
  each one that at least ``MIN_ROWS`` rows with text bear, but ``und``. Of a
  byte's probability the share ``FLOOR`` is the same for all bytes, so what a
  language's sample lacks costs little more than without a language. ``und``
  competes as bytes without any language. Neighbouring bytes are not
  independent, so a text of n bytes counts as n * CAP / (n + CAP) of its mean;
* declared language (of markup or metadata) and address suffix: how often
  each value goes with each language, from sums of the texts' posteriors
  over all rows, grouped by value;
* host: a prior for each host, smoothed by that of the domain above it, that
  by the next, up to the whole corpus; counts are the posteriors' sums over
  all rows below a domain, by grouped aggregation. A row's own text is
  taken out of the sums that it is judged by, so that no text counts twice.

The posterior over languages is the normalised product. Rows that no
language explains better than ``und``, or that have no text, are rejected;
but where the declared language is one that has no model (too few rows bear
it), its word stands: the row has that language and stays.

Texts are read once; what follows moves ids and a few numbers a row. Sums
are pre-aggregated, so a host with a third of the rows is one row per task.
Null and empty texts have lang ``und``; null or empty declarations, suffixes
and hosts are no evidence; repeated rows are judged alike; an empty table
gives an empty result. Where no label has ``MIN_ROWS`` rows there is nothing
to judge by: all rows are ``und``, and only those without text are rejected.
A model has 256 KB a language.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm import common as C

FIT_ROWS = 20_000
MIN_ROWS = 5
FLOOR = 0.1
CAP = 200.0
SMOOTH = 0.1
KAPPA = 5.0
UND_PRIOR = 0.01
MAX_LABELS = 127  # a host name of the DNS has no more
_CHUNK = 1 << 18
_COLUMNS = 8
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


# -- text --------------------------------------------------------------------

def _bigrams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bigram codes of each byte but the first of a row (0 before it)."""
    low = _LOWER[data].astype(np.int32)
    codes = low.copy()
    codes[1:] += low[:-1] << 8
    first = offsets[:-1][np.diff(offsets) > 0]
    codes[first] = low[first]
    return codes


def _count_bigrams(batches):
    for b in batches:
        langs = np.array(b.column("lang").to_pylist(), object)
        data, offs = C.text_buffer(b.column("text"))
        for lo, hi in C.batches_of(offs, _CHUNK):
            codes = _bigrams(data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo])
            by_row = np.repeat(langs[lo:hi], np.diff(offs[lo:hi + 1]))
            for lang in set(langs[lo:hi]):
                n = np.bincount(codes[by_row == lang], minlength=1 << 16)
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(n[at])],
                                                 names=["lang", "code", "n"])


class Model(np.ndarray):
    """Log-probabilities of a byte after another (65536 x languages + und)
    that know the names of their languages."""

    languages: tuple = ()

    def __array_finalize__(self, other):
        self.languages = getattr(other, "languages", ())

    def __reduce__(self):
        return _model, (np.asarray(self), self.languages)


def _model(logs: np.ndarray, languages) -> Model:
    out = logs.view(Model)
    out.languages = tuple(languages)
    return out


def _least(share: float) -> int:
    """The signed 64-bit hash that this share of all hashes doesn't pass."""
    return min(-(1 << 63) + int(share * (1 << 64)), (1 << 63) - 1)


def _by_language(limits: dict[str, int]) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in limits.items() for x in pair]), F.col("lang"))


def _draw(labelled: DataFrame, text_col: str, lang_col: str, languages, rows: int) -> tuple[list[str], DataFrame]:
    """The languages, and (lang, text) of the texts that they are fitted on.
    Only the drawn texts are shuffled; copies are met by their hashes."""
    some = labelled.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    some = some.where((F.trim("lang") != "") & (F.col("lang") != "und") & (F.col("text") != ""))
    if languages is not None:
        some = some.where(F.col("lang").isin(*languages))
    some = some.withColumn("h", F.xxhash64("text"))
    hashes = C.stage(some.select("lang", "h"), "language-labels")
    sizes = {r["lang"]: r["d"] for r in hashes.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("h").alias("d"))
             .where(F.col("n") >= MIN_ROWS).collect()}
    names = sorted(sizes) if languages is None else list(languages)
    if not sizes:
        return names, some.select("lang", "text").limit(0)
    each = max(rows // len(names), MIN_ROWS)
    about = {lang: _least(min(2 * each / max(d, 1), 1)) for lang, d in sizes.items()}
    found: dict[str, list[int]] = {lang: [] for lang in sizes}
    for r in hashes.where(F.col("h") <= _by_language(about)).distinct().toLocalIterator():  # about 2 * rows
        found[r["lang"]].append(r["h"])
    limits = {lang: sorted(h)[:each][-1] for lang, h in found.items()}
    return names, some.where(F.col("h") <= _by_language(limits)).dropDuplicates(["lang", "h"]).select("lang", "text")


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", languages=None, rows: int = FIT_ROWS) -> Model:
    """A model of each label that ``MIN_ROWS`` rows bear, or of ``languages``
    only, on ``rows`` distinct texts at most (but ``MIN_ROWS`` a language)."""
    names, some = _draw(labelled, text_col, lang_col, languages, rows)
    counted = some.mapInArrow(_count_bigrams, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    counts = np.zeros((len(names), 1 << 16))
    number = {lang: k for k, lang in enumerate(names)}
    for r in counted.toLocalIterator():  # at most 65536 rows a language
        counts[number[r["lang"]], r["code"]] = r["n"]
    logs = np.full((1 << 16, len(names) + 1), -np.log(256), np.float32)
    for k in range(len(names)):
        c = counts[k].reshape(256, 256)
        single = c.sum(0) / max(c.sum(), 1)
        p = (c + 2 * single[None, :]) / (c.sum(1, keepdims=True) + 2)
        logs[:, k] = np.log((1 - FLOOR) * p + FLOOR / 256).reshape(-1)
    return _model(logs, names)


def _score(sent, cap: float):
    """Adds ``ll``: tempered log-likelihoods, and ``post``: the languages'
    posteriors by the text alone (zeros without text)."""
    def run(batches):
        logs = sent.value
        for b in batches:
            data, offs = C.text_buffer(b.column("text"))
            n = np.diff(offs)
            ll = np.zeros((len(n), logs.shape[1]))
            for lo, hi in C.batches_of(offs, _CHUNK):
                for a in range(int(offs[lo]), int(offs[hi]), _CHUNK):  # a long row is several slices
                    e = min(a + _CHUNK, int(offs[hi]))
                    part = data[max(a - 1, 0):e]
                    o = np.clip(offs[lo:hi + 1], a, e) - a
                    codes = _bigrams(part, np.clip(offs[lo:hi + 1] - max(a - 1, 0), 0, len(part)))[a - max(a - 1, 0):]
                    full = np.flatnonzero(np.diff(o))
                    for k in range(0, logs.shape[1], _COLUMNS):  # memory is bounded however many languages there are
                        ll[lo + full, k:k + _COLUMNS] += np.add.reduceat(logs[:, k:k + _COLUMNS][codes].astype(np.float64), o[full], axis=0)
            mean = ll / np.maximum(n, 1)[:, None]
            ll = mean * (n * cap / (n + cap))[:, None]
            post = np.exp(ll[:, :-1] - ll[:, :-1].max(1, keepdims=True, initial=-np.inf))
            post /= post.sum(1, keepdims=True)
            post[n == 0] = 0
            lists = lambda m: pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1, dtype=np.int32) * m.shape[1]), pa.array(m.reshape(-1)))
            keep = [c for c in b.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(n), lists(ll), lists(post)],
                                             names=[*keep, "n_bytes", "ll", "post"])
    return C.tidy(run)


# -- fusion ------------------------------------------------------------------

def _sums(rows: DataFrame, key: str, k: int) -> DataFrame:
    """(key, c): sums of the posteriors of all rows of a key."""
    return (rows.groupBy(key).agg(*[F.sum(F.element_at("post", i + 1)).alias(f"c{i}") for i in range(k)])
            .select(key, F.array(*[f"c{i}" for i in range(k)]).alias("c")))


def _domains(host: Column) -> Column:
    """The host, the domains above it (those of ``MAX_LABELS`` labels at
    most), and '' for all: (depth, name)."""
    labels = F.split(host, "\\.")
    n = F.size(labels)
    depths = F.when(n <= MAX_LABELS, F.sequence(F.lit(0), n)).otherwise(F.concat(F.sequence(F.lit(0), F.lit(MAX_LABELS)), F.array(n)))
    cut = lambda d: F.array_join(F.slice(labels, F.size(labels) - d + 1, d), ".")
    return F.transform(depths, lambda d: F.struct(d.alias("depth"), F.when(d > 0, cut(F.greatest(d, F.lit(1)))).otherwise("").alias("domain")))


def _fuse(total: list[float], languages):
    total = np.array(total)
    modelled = {re.split("[-_]", x.strip().lower())[0] for x in languages} | {"und"}

    def run(batches):
        names = np.array([*languages, "und"])
        for b in batches:
            out = []
            for n, ll, post, chain, said, declared, suffix in zip(*(
                    b.column(c).to_pylist() for c in ("n_bytes", "ll", "post", "chain", "declared", "by_declared", "by_suffix"))):
                own = np.array(post)
                everyone = np.maximum(total - own, 0)
                prior = (everyone + SMOOTH) / (everyone + SMOOTH).sum()
                for d in sorted(chain or [], key=lambda d: d["depth"]):
                    c = np.maximum(np.array(d["c"]) - own, 0)
                    prior = (c + KAPPA * prior) / (c.sum() + KAPPA)
                logp = np.array(ll) + np.append(np.log(prior * (1 - UND_PRIOR)), np.log(UND_PRIOR))
                for c in (declared, suffix):
                    if c is not None:
                        c = np.maximum(np.array(c) - own, 0)
                        share = (c.sum() + SMOOTH) / (everyone.sum() + SMOOTH)  # of the value among all rows
                        logp[:-1] += np.log((c + KAPPA * share) / (everyone + KAPPA))
                        logp[-1] += np.log(share)
                p = np.exp(logp - logp.max())
                p /= p.sum()
                best = int(p.argmax()) if n else len(languages)
                if n and best == len(languages) and said is not None and said not in modelled:
                    out.append((said, float(p[best]), True))
                    continue
                out.append((str(names[best]), float(p[best]) if n else 1.0, bool(n) and best < len(languages)))
            keep = [c for c in b.schema.names if c not in ("n_bytes", "ll", "post", "chain", "declared", "by_declared", "by_suffix")]
            lang, prob, kept = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(lang, pa.string()), pa.array(prob, pa.float64()), pa.array(kept, pa.bool_())],
                                             names=[*keep, "lang", "posterior", "kept"])
    return C.tidy(run)


def identify(rows: DataFrame, model: np.ndarray, keys: list[str], languages=None, cap: float = CAP) -> DataFrame:
    """``keys`` of each row with ``lang``, ``posterior`` and ``kept``.

    ``rows`` has the ``keys`` and text, declared, suffix and host (strings).
    ``languages`` names the model's columns where it does not itself.
    """
    languages = model.languages if languages is None else languages
    k = len(languages)
    if not k:
        text = F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0))
        return rows.select(*keys, F.lit("und").alias("lang"), F.lit(1.0).alias("posterior"), (text > 0).alias("kept"))
    clean = lambda c: F.when(F.trim(c) != "", F.lower(F.trim(c)))
    declared = clean(F.split(F.col("declared"), "[-_]")[0])
    rows = rows.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keys)], F.col("text").cast("string").alias("text"),
                       declared.alias("declared"), clean(F.col("suffix")).alias("suffix"), clean(F.col("host")).alias("host"))
    key_schema = ", ".join(f"k{i} {rows.schema[f'k{i}'].dataType.simpleString()}" for i in range(len(keys)))
    sent = rows.sparkSession.sparkContext.broadcast(np.asarray(model))
    scored = C.stage(rows.mapInArrow(_score(sent, cap), f"{key_schema}, declared string, suffix string, host string, n_bytes long, "
                                                        "ll array<double>, post array<double>"), "language-scores")
    total = scored.agg(*[F.coalesce(F.sum(F.element_at("post", i + 1)), F.lit(0.0)) for i in range(k)]).first()
    by_value = {c: C.stage(_sums(scored.where(F.col(c).isNotNull()), c, k), f"language-{c}").withColumnRenamed("c", f"by_{c}")
                for c in ("declared", "suffix")}
    hosts = C.stage(_sums(scored.where("host is not null"), "host", k), "language-hosts")
    below = hosts.select("host", "c", F.explode(_domains(F.col("host"))).alias("d")).select("host", "c", "d.depth", "d.domain").where("depth > 0")
    domains = (below.groupBy("domain").agg(*[F.sum(F.element_at("c", i + 1)).alias(f"c{i}") for i in range(k)])
               .select("domain", F.array(*[f"c{i}" for i in range(k)]).alias("c")))
    chains = C.stage(below.drop("c").join(C.stage(domains, "language-domains"), "domain").groupBy("host")
                     .agg(F.collect_list(F.struct("depth", "c")).alias("chain")), "language-chains")
    fused = scored.join(chains, "host", "left").join(by_value["declared"], "declared", "left").join(by_value["suffix"], "suffix", "left")
    fused = fused.select(*[f"k{i}" for i in range(len(keys))], "n_bytes", "ll", "post", "chain", "declared", "by_declared", "by_suffix")
    out = fused.mapInArrow(_fuse([float(x) for x in total], languages), f"{key_schema}, lang string, posterior double, kept boolean")
    return out.withColumnsRenamed({f"k{i}": c for i, c in enumerate(keys)})


# -- pages -------------------------------------------------------------------

def visible_text(html: Column) -> Column:
    """A page's text: without scripts, styles and tags."""
    bare = F.regexp_replace(html, "(?is)<(script|style)\\b.*?</\\1\\s*>", " ")
    return F.regexp_replace(F.regexp_replace(bare, "<[^>]*>", " "), "\\s+", " ")


def markup_language(html: Column) -> Column:
    return F.regexp_extract(html, "(?i)<html\\b[^>]*\\blang\\s*=\\s*[\"']?([a-z]{2,8})", 1)


def address_suffix(host: Column) -> Column:
    return F.when(F.contains(host, F.lit(".")), F.substring_index(host, ".", -1))


def drop_rejected(docs: DataFrame, model: np.ndarray, text_col: str = "text", declared: str | None = None, suffix: str | None = None,
                  host: str | None = None, id_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` without the rows that ``identify`` rejects. The names of the
    evidence columns may be None where there is none."""
    evidence = [F.col(c).cast("string") if c else F.lit(None).cast("string") for c in (declared, suffix, host)]
    text = F.col(text_col).cast("string")
    names = [C.fresh_name(docs.columns, x) for x in ("did", "th", "eh")]
    did, th = C.row_identity(F.col(id_col), text)
    key = [did.alias(names[0]), th.alias(names[1]), F.xxhash64(*evidence).alias(names[2])]
    rows = docs.select(*key, text.alias("text"), *[e.alias(n) for e, n in zip(evidence, ("declared", "suffix", "host"))])
    gone = identify(rows, model, names, **options).where("not kept").select(*names).distinct()
    return docs.select("*", *key).join(C.stage(gone, "language-rejected"), names, "left_anti").drop(*names)
