"""Training-corpus pipeline over ``documents``: language ID, line dedup, SimHash near-dedup, packing.

Each stage works on all that its predecessor kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cargolens.llm import language_id, line_dedup, packing, simhash
from cargolens.llm.columns import columns_of
from cargolens.storage import scratch_path


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents for which the PPM trees have a language; a missing ``lang`` is filled in.

    The trees learn from the labelled two thirds. Texts without a letter and null texts go; if there is nothing to learn
    from, that is all of them. No document goes for a low score: short clean texts, such as a name, spread over the
    languages.
    """
    found = language_id.identify(docs, language_id.learnable(docs))
    kept = found.where(F.col("lang_pred") != language_id.UNKNOWN)
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*columns_of(docs))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines found in ten or more documents; ``n_chars`` follows the text."""
    cleaned = line_dedup.dedup_lines(docs)
    return cleaned.withColumn("n_chars", F.length("text").cast("long")).select(*columns_of(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: three-word shingles, at most three differing bits."""
    return simhash.one_of_each_group(docs, shingle=3, max_distance=3)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens, with their ids."""
    return packing.pack(docs)


STAGES = [
    ("language_id", keep_known_languages),
    ("line_dedup", drop_repeated_lines),
    ("simhash_dedup", drop_near_copies),
    ("packing", pack_sequences),
]

#: Language ID, SimHash and packing are not SQL; the tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet to the shared folder and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
