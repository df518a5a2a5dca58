import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import language_id as L

WORDS = {"en": "the and of to that with house water from which over time", "fr": "le la les et de dans une maison eau avec pour être où",
         "de": "der die das und ist nicht haus wasser über schön groß", "es": "el los las una casa agua con niño está más qué porque"}


def texts(lang, n, seed, low=3, high=40):
    rng = np.random.default_rng(seed)
    w = WORDS[lang].split()
    return [" ".join(rng.choice(w, rng.integers(low, high))) for _ in range(n)]


@pytest.fixture(scope="module")
def model(spark):
    rows = [(t, lang) for lang in WORDS for t in texts(lang, 60, 1)]
    return L.fit(spark.createDataFrame(rows + [(None, "en"), ("x", None), ("x", "xx")], "text string, lang string"))


def evidence(spark, rows):
    return spark.createDataFrame(rows, "id long, text string, declared string, suffix string, host string").repartition(3)


def test_held_out_accuracy(spark, model):
    want = {}
    rows = []
    for k, lang in enumerate(WORDS):
        for t in texts(lang, 60, 2 + k):
            want[len(rows)] = lang
            rows.append((len(rows), t, None, None, None))
    got = {r["id"]: r for r in L.identify(evidence(spark, rows), model, ["id"]).collect()}
    assert all(r["kept"] for r in got.values())
    assert sum(got[i]["lang"] == x for i, x in want.items()) >= 0.97 * len(want)


def test_host_and_declaration_settle_short_texts(spark, model):
    """A text that any language could have is judged by where it stands."""
    rows = [(i, t, lang, None, f"w.{lang}.example.com") for lang in ("fr", "de") for i, t in enumerate(texts(lang, 200, 7), 1000 if lang == "fr" else 2000)]
    rows += [(1, "u", None, None, "w.fr.example.com"), (2, "u", None, None, "w.de.example.com"), (3, "u", "FR-ca", None, None),
             (4, "u", None, None, "new.fr.example.com"), (5, "u", " de_AT", "", "")]
    got = {r["id"]: r["lang"] for r in L.identify(evidence(spark, rows), model, ["id"]).collect()}
    assert {i: got[i] for i in range(1, 6)} == {1: "fr", 2: "de", 3: "fr", 4: "fr", 5: "de"}


def test_rejects_and_edge_cases(spark, model):
    noise = "".join(chr(c) for c in np.random.default_rng(3).integers(0x2500, 0x25FF, 400))
    rows = [(1, None, "en", None, None), (2, "", None, None, "h"), (3, noise, None, None, "h"), (4, "the water and the house", "xx", "org", "a.b.c.d.e.f.g.h.i.j.k"),
            (4, "the water and the house", "xx", "org", "a.b.c.d.e.f.g.h.i.j.k"), (None, "la maison et les eaux", None, None, "...")]
    got = sorted((str(r["id"]), r["lang"], r["kept"]) for r in L.identify(evidence(spark, rows), model, ["id"]).collect())
    assert got == [("1", "und", False), ("2", "und", False), ("3", "und", False), ("4", "en", True), ("4", "en", True), ("None", "fr", True)]
    assert L.identify(evidence(spark, rows).limit(0), model, ["id"]).count() == 0


def test_long_rows_in_slices(spark, model, monkeypatch):
    import pyarrow as pa
    b = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array([" ".join(texts("de", 30, 1)), "", "the end"])], names=["k0", "text"])

    class Sent:
        value = model
    whole = next(L._score(Sent, 200.0)([b]))
    monkeypatch.setattr(L, "_CHUNK", 37)
    parts = next(L._score(Sent, 200.0)([b]))
    assert np.allclose(whole.column("ll").flatten(), parts.column("ll").flatten())


def test_drop_rejected_keeps_columns(spark, model):
    df = spark.createDataFrame([(1, "the water", "x", "u"), (1, None, "x", "u"), (2, "", None, None), (None, "das haus und der", "x", None)],
                               "doc_id long, text string, did string, `e.h` string")
    out = L.drop_rejected(df, model, host="did")
    assert out.columns == df.columns
    assert sorted((r["doc_id"] or 0, r["text"]) for r in out.collect()) == [(0, "das haus und der"), (1, "the water")]


def test_fit_on_a_share_of_the_rows(spark):
    rows = [(f"{t} {i}", lang) for lang in WORDS for i, t in enumerate(texts(lang, 300, 4))]
    m = L.fit(spark.createDataFrame(rows, "text string, lang string"), rows=200)
    assert m.shape == (65536, 5) and np.isfinite(m).all()


def test_page_evidence(spark):
    html = "<html class=x LANG='de-AT'><script>var a='<p>';</script><style>p{}</style ><p title='x'>Guten <b>Tag</b></p></html>"
    r = spark.createDataFrame([(html, "a.b.at"), ("plain", "localhost"), (None, None)], "html string, host string").select(
        L.visible_text(F.col("html")), L.markup_language(F.col("html")), L.address_suffix(F.col("host"))).collect()
    assert [(x and x.strip(), y, z) for x, y, z in map(tuple, r)] == [("Guten Tag", "de", "at"), ("plain", "", None), (None, None, None)]


MORE = {"it": "il gli delle una casa acqua con non è sono che perché città", "ru": "и в не на дом вода что это как большой",
        "ja": "これ は 水 の 家 です 私 と 大きい", "sw": "na ya wa nyumba maji kubwa hii hilo kwa"}


def test_languages_are_the_labels(spark):
    """Labelled documents of any language stay, and are named as labelled."""
    rng = np.random.default_rng(5)
    words = WORDS | MORE
    rows = [(n, " ".join(rng.choice(words[lang].split(), 30)), lang) for n, lang in enumerate([*words] * 12)]
    rows += [(1000, "z", "xx"), (1001, "und " * 9, "und"), (1002, "blank", " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    m = L.fit(docs)
    assert m.languages == tuple(sorted(words)) and m.shape == (65536, len(words) + 1)
    stay = {r["doc_id"] for r in L.drop_rejected(docs, m, declared="lang").collect()}
    assert stay >= set(range(12 * len(words)))
    plain = docs.where("doc_id < 1000").selectExpr("doc_id", "text", "cast(null as string) declared", "cast(null as string) suffix", "cast(null as string) host")
    got = {r["doc_id"]: (r["lang"], r["kept"]) for r in L.identify(plain, m, ["doc_id"]).collect()}
    assert got == {i: (lang, True) for i, _, lang in rows if i < 1000}


def test_unseen_bytes_cost_little(spark, model):
    """Marks, digits and capitals that the sample lacks don't make a text und."""
    rows = [(1, "the house (no. 17) and the water: 25% of it; over 1990-2024!", None, None, None)]
    assert L.identify(evidence(spark, rows), model, ["id"]).first()["kept"]
    assert model[:, :-1].min() >= np.log(L.FLOOR / 256) - 1e-4


def test_no_label_rejects_no_text(spark):
    docs = spark.createDataFrame([(1, "abc", None), (2, "", "en"), (3, None, "en")], "doc_id long, text string, lang string")
    m = L.fit(docs)
    assert m.languages == () and [r["doc_id"] for r in L.drop_rejected(docs, m, declared="lang").collect()] == [1]


def test_draw_is_bounded(spark):
    """Copies, rare languages and any number of rows: the bound holds."""
    rows = [("the water and the house", "en")] * 400 + [(f"{t} {i}", lang) for lang in ("en", "fr") for i, t in enumerate(texts(lang, 300, 4))]
    rows += [(t, "de") for t in texts("de", 8, 9, 20)]
    names, drawn = L._draw(spark.createDataFrame(rows, "text string, lang string").repartition(5), "text", "lang", None, 60)
    got = [tuple(r) for r in drawn.collect()]
    assert names == ["de", "en", "fr"] and len(got) == len(set(got))
    assert {x: sum(lang == x for lang, _ in got) for x in names} == {"de": 8, "en": 20, "fr": 20}
    copies = spark.createDataFrame([(f"text {i} ", "en") for i in range(50) for _ in range(1 + 200 * (i % 7 == 0))], "text string, lang string")
    assert L._draw(copies, "text", "lang", None, 30)[1].count() == 30
    assert L._least(20_000 / 1e13) > L._least(0) == -(1 << 63) and L._least(1) == (1 << 63) - 1


@pytest.mark.parametrize("labels", [8, 9, 30, 200])
def test_deep_hosts_have_their_own_prior(spark, model, labels):
    above = ".".join(["a"] * (labels - 1))
    rows = [(i, t, None, None, f"{lang}.{above}") for lang in ("fr", "de") for i, t in enumerate(texts(lang, 100, 7), 1000 if lang == "fr" else 2000)]
    rows += [(1, "u", None, None, f"fr.{above}"), (2, "u", None, None, f"de.{above}")]
    got = {r["id"]: r["lang"] for r in L.identify(evidence(spark, rows), model, ["id"]).collect()}
    assert (got[1], got[2]) == ("fr", "de")


def test_rare_declared_languages_stay(spark, model):
    """A label that too few rows bear for a model is never a reason to go."""
    text = "добрый день, вода и дом стоят у реки, а лес шумит за ней " * 4
    docs = spark.createDataFrame([(1, text, "ru"), (2, text, "RU-latn"), (3, text, "und"), (4, text, None), (5, "", "ru"), (6, None, "ru")],
                                 "doc_id long, text string, lang string")
    rows = docs.selectExpr("doc_id", "text", "lang as declared", "cast(null as string) suffix", "cast(null as string) host")
    got = {r["doc_id"]: (r["lang"], r["kept"]) for r in L.identify(rows, model, ["doc_id"]).collect()}
    assert got == {1: ("ru", True), 2: ("ru", True), **{i: ("und", False) for i in (3, 4, 5, 6)}}
    assert sorted(r["doc_id"] for r in L.drop_rejected(docs, model, declared="lang").collect()) == [1, 2]
