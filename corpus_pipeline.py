"""A corpus pipeline: language, near duplicates, secrets, mixing, packing; each stage is one operator of the library.

All stages but the last give the five columns of documents and leave other columns out. Each row is worked on by
itself whatever its doc_id, null and repeated ones too; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.llm import langid, mixing, packing, secrets, simhash
from sievework.shared import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that language identification rejects; it learns from those that are not held out.

    A null or empty text, or one without a letter, is rejected. Repeated rows all stay or all go.
    """
    return langid.drop_unidentified(docs.select(COLUMNS), langid.fit(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates: of the smallest doc_id (null last), then of the smallest hash.

    Rows alike in doc_id and text are one document, of which one stays. All empty and null texts are one group.
    """
    return simhash.drop_near_duplicates(docs.select(COLUMNS))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps every document, with its secrets replaced and its length counted anew; a null text stays null, as its length."""
    clean = secrets.redact(docs.select(COLUMNS), secrets.fit(spark))
    return clean.withColumn("n_chars", F.length("text").cast("long"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, twice at most; those that it does not take go.

    Rows of equal doc_id and size have one place in the mix's order; a null source is a source of its own.
    """
    mixed = mixing.mix(docs.select(COLUMNS))
    times = F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("time")  # 2 at most, none for 0
    return mixed.select(*COLUMNS, times).select(COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in sequences; a null text is the one closing id."""
    return packing.pack(docs.select("doc_id", "text"))


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("secrets", secret_scan), ("mix", mixture), ("pack", packed)]

#: Stages with models and hash functions have no SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
