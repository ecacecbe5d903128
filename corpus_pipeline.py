"""Corpus pipeline: quality, near duplicates, personal data, packing, in this order.

Each stage works on all that its predecessor kept and returns the columns of documents,
but for the last, which returns where each piece of each document lies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintagemill.llm import bottomk, disclosure, packing, pu_quality
from vintagemill.session import fresh_path

#: Bytes of words a packing worker holds; workers live on beside the other stages, so fewer than for packing alone.
WORD_BYTES = 80 << 20


def keep_good_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier scores at least 0.5.

    A NULL text scores as an empty one; repeated rows have one score; NULL doc_ids stay; an
    empty table gives an empty table; columns of any name stay as they are.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    quality = next(x for x in (f"_quality{i}" for i in range(len(docs.columns) + 1)) if x not in docs.columns)
    scored = pu_quality.score(docs, pu_quality.fit(docs, labels), "text", quality)
    return scored.where(f"{quality} >= 0.5").select(*[f"`{c}`" for c in docs.columns])


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each near-duplicate group, and all that are in none.

    Rows go by doc_id and text; of repeated rows one stays, unless they have no words; NULL
    texts and doc_ids stay; an empty table gives an empty table; columns of any name stay as they are.
    """
    return bottomk.without_near_duplicates(docs)


def remove_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data and terms that disclose it replaced; n_chars follows the text.

    NULL texts stay NULL with their n_chars; repeated rows and NULL doc_ids stay; an empty
    table gives an empty table; columns of any name stay as they are.
    """
    clean = disclosure.sanitise(docs)
    return clean.withColumn("n_chars", F.coalesce(F.char_length("text").cast("long"), "n_chars")).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and offset.

    A NULL text is packed as an empty one; repeated rows are packed each by themselves; an
    empty table gives an empty table; other columns than doc_id and text are not looked at.
    """
    return packing.pack(docs, memory_bytes=WORD_BYTES)


STAGES = [
    ("quality", keep_good_text),
    ("near_duplicates", keep_one_of_near_duplicates),
    ("personal_data", remove_personal_data),
    ("packing", pack_sequences),
]

ORACLE_SQL = None  # a trained classifier, patterns with checksums and tokenizers have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies all stages to ``documents``; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
