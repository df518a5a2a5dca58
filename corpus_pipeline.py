"""The corpus pipeline: four of the operators in a chain over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is
written as Parquet and read again as the next stage's documents. All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import best_fit_packing, language_id, minhash_join, suffix_dedup
from tessera.llm import common as C
from tessera.llm.queries import TOKENIZER


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without text, or that no language explains, go. The declared
    language is the column ``lang``; the source stands for the host."""
    return language_id.drop_rejected(docs, language_id.fit(docs), declared="lang", host="source")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles,
    similarity 0.8 or more, linked directly or through others) stays."""
    return minhash_join.one_per_group(docs, words=5, similarity=80)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes under a string of 200 bytes that occurs twice are cut;
    ``n_chars`` follows. Documents with nothing left go."""
    cut = suffix_dedup.remove_repeats(docs)
    return cut.where("text is null or text <> ''").withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in sequences of 2048, a row per piece."""
    import public_tokenizers
    return best_fit_packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [("language ID", identify_language), ("MinHash near-dedup", drop_near_duplicates),
          ("suffix-array dedup", cut_repeats), ("best-fit packing", pack_sequences)]

#: SQL can't express the language model, the grouping and the packing; tests
#: hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = C.stage(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
