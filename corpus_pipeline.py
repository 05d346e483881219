"""From raw documents to token ids: five stages, each one operator of ``clicktide.llm``.

Every stage takes all rows that its predecessor kept, with all columns of ``documents``
(extra ones too), and is written to the shared folder before the next one reads it. The
last returns the ids. Rows with nulls pass every stage that has nothing against them: a
text that is null or has no letter is rejected by the first.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from clicktide.llm import byte_bpe, decontamination, language_id, ngram_join, pii
from clicktide.llm.common import read_table, written

BYTE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that are far from every language's centroids."""
    added = ("language: name", "language: cosine", "language: accepted")
    model = language_id.fit(docs)
    return language_id.predict(docs, model, added).where(F.col(f"`{added[2]}`")).drop(*added)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of the smallest id, then text hash.

    Of rows equal in id and text one stays. Texts without words are in no group and stay.
    """
    columns = docs.columns
    row = F.struct(F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash"))
    keyed = docs.withColumn("near copies: row", row)
    texts = keyed.select(F.col("`near copies: row`").alias("row"), "text")
    groups = ngram_join.near_copies(texts, "row").where(F.col("group").isNotNull())
    first = written(
        groups.where(F.col("row") == F.col("component_id")).groupBy("row").agg(F.count("*").alias("copies")),
        "first-copies",
    )
    same_row = F.col("`near copies: row`").eqNullSafe(F.col("row"))
    has_words = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    worded = keyed.where(has_words)
    kept = worded.join(first.where("copies = 1"), same_row, "left_semi").select(columns)
    if not (repeated := first.where("copies > 1")).isEmpty():
        one_of_each = worded.join(repeated, same_row, "left_semi").dropDuplicates(["near copies: row"])
        kept = kept.unionByName(one_of_each.select(columns))
    return kept.unionByName(docs.where(~has_words))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold an item of the benchmark."""
    hits = "benchmark: hits"
    found = decontamination.find_items(docs, read_table(spark, sf_dir, "benchmark"), into=hits)
    return found.where(~decontamination.contaminated(f"`{hits}`")).drop(hits)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind in brackets; ``n_chars`` follows the new text."""
    found = pii.find_pii(docs, into="pii: findings")
    masked = found.withColumn("text", pii.masked(F.col("text"), F.col("`pii: findings`")))
    changed = F.size("`pii: findings`") > 0
    length = F.when(changed, F.length("text")).otherwise(F.col("n_chars"))
    return masked.withColumn("n_chars", length.cast("long")).drop("pii: findings")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and the digest of what they decode to."""
    coded = byte_bpe.encode_decode(docs, BYTE_RANKS, public_tokenizers.PATTERN)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language", keep_known_languages),
    ("near_copies", keep_one_of_near_copies),
    ("decontamination", drop_contaminated),
    ("pii", mask_personal_data),
    ("byte_bpe", encode),
]

# Centroids, an index search and merges are not expressed in SQL; tests/llm has brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
