"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintagemill.llm import (
    addressable_codes,
    alignment,
    bottomk,
    cap_filters,
    disclosure,
    merge_dropout,
    oracles,
    order_minhash,
    packing,
    pu_quality,
    tree_bpe,
    trie_counts,
    url_filter,
    whitening,
)
from vintagemill.session import fresh_path

Query = Callable[[SparkSession, str], DataFrame]

URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
             ("block", "net/es/"), ("block", "net/fr/")]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    judged = url_filter.judge_urls(table(spark, folder, "pages"), url_filter.rule_table(spark, URL_RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op2_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return order_minhash.edited_by_next(table(spark, folder, "documents"))


def op3_trie_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return trie_counts.token_counts(table(spark, folder, "documents"))


def op4_addressable_codes(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "codes")
    addressable_codes.write_codes(table(spark, folder, "documents"), path)
    return addressable_codes.read_documents(spark, path)


def op5_disclosure_pii(spark: SparkSession, folder: str) -> DataFrame:
    return disclosure.digest(disclosure.find_personal_data(table(spark, folder, "documents")))


def op6_bottomk_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return bottomk.near_duplicates(table(spark, folder, "documents"))


def op7_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


def op8_pu_quality(spark: SparkSession, folder: str) -> DataFrame:
    return pu_quality.quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op9_cap_filters(spark: SparkSession, folder: str) -> DataFrame:
    return cap_filters.near_vectors(table(spark, folder, "embeddings"))


def op10_merge_dropout(spark: SparkSession, folder: str) -> DataFrame:
    """Encoded and decoded again: the checksum is of the decoded text."""
    back = merge_dropout.decode(merge_dropout.encode(table(spark, folder, "documents")))
    return back.select("doc_id", "n_tokens", "ids_crc32", F.sha2("text", 256).alias("decoded_sha256"))


def op11_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align(table(spark, folder, "documents"))


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    whitened = whitening.whiten(table(spark, folder, "embeddings"))
    return whitened.withColumn("deviation", F.col("deviation").cast("long"))


def op13_segment_tree_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Encoded and decoded again: the second digest is of the decoded text."""
    back = tree_bpe.decode(tree_bpe.encode(table(spark, folder, "documents")))
    return back.select("doc_id", "n_tokens", "ids_sha256", F.sha2("text", 256).alias("decoded_sha256"))


QUERIES: dict[str, Query] = {
    "op1_url_filter": op1_url_filter,
    "op2_order_minhash": op2_order_minhash,
    "op3_trie_token_counts": op3_trie_token_counts,
    "op4_addressable_codes": op4_addressable_codes,
    "op5_disclosure_pii": op5_disclosure_pii,
    "op6_bottomk_near_dedup": op6_bottomk_near_dedup,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_pu_quality": op8_pu_quality,
    "op9_cap_filters": op9_cap_filters,
    "op10_merge_dropout": op10_merge_dropout,
    "op11_tokenizer_alignment": op11_tokenizer_alignment,
    "op12_whitening": op12_whitening,
    "op13_segment_tree_bpe": op13_segment_tree_bpe,
}

#: The other operators have no SQL form: tokenizers, sketches in text order, patterns with checksums, a fitted model.
ORACLES: dict[str, str] = {
    "op1_url_filter": oracles.url_filter(URL_RULES),
    "op6_bottomk_near_dedup": oracles.near_duplicates(bottomk.WORDS, bottomk.PERCENT),
    "op9_cap_filters": oracles.near_vectors(cap_filters.COSINE),
}
