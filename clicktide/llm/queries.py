"""The operators over the whole test tables, with the columns that their contracts name."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clicktide.llm import byte_bpe, conversations, decontamination, html_extraction, language_id, lm_scoring, ngram_join, pii, quality_classifier, quality_rules, simhash, token_counts, vector_codes
from clicktide.llm.common import in_fold, read_table
from clicktide.llm.oracle import ORACLE_SQL

BYTE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
TOKEN_LIMIT = 4096
QUALITY_BAR = 0.3


def _texts(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "documents").select("doc_id", "text")


def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counts = token_counts.token_counts(_texts(spark, folder), PIECE_MODEL)
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op10_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    coded = byte_bpe.encode_decode(_texts(spark, folder), BYTE_RANKS, public_tokenizers.PATTERN)
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op1_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find_pii(_texts(spark, folder)).select("doc_id", "findings")

    def of_kind(kind: str) -> Column:
        return F.filter("findings", lambda f: f["kind"] == kind)

    base = F.filter("findings", lambda f: f["kind"].isin(*pii.BASE_KINDS))
    return found.select(
        "doc_id",
        *(F.size(of_kind(kind)).cast("long").alias(f"n_{kind}") for kind in pii.BASE_KINDS),
        F.sha2(pii.span_list(base), 256).alias("base_sha256"),
        pii.span_list(F.col("findings")).alias("spans"),
        pii.score_list(F.col("findings")).alias("scores"),
    )


def op4_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.near_copies(_texts(spark, folder)).select(
        "doc_id", "n_shingles", "component_id"
    )


def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.quality_rules(read_table(spark, folder, "documents"))


def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    documents = read_table(spark, folder, "documents")
    model = language_id.fit(documents.where(~in_fold("doc_id", 4, 2)))
    texts = documents.select("doc_id", "text", in_fold("doc_id", 4, 2).alias("held_out"))
    return language_id.predict(texts, model, ("lang_pred", "score", "accepted")).drop("text")


def op9_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    documents = _texts(spark, folder)
    labels = read_table(spark, folder, "labels").where(~in_fold("doc_id", 5, 0))
    scores = quality_classifier.classify(documents, quality_classifier.fit(documents, labels))
    return scores.select(
        "doc_id",
        in_fold("doc_id", 5, 0).alias("held_out"),
        "score",
        (F.col("score") >= QUALITY_BAR).cast("int").alias("predicted"),
    )


def op3_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return lm_scoring.score_texts(_texts(spark, folder), in_fold("doc_id", 7, 2)).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"
    )


def op6_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    texts = html_extraction.extract_main_text(read_table(spark, folder, "pages"))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.find_items(
        _texts(spark, folder), read_table(spark, folder, "benchmark")
    )
    verified = F.filter("hits", lambda hit: hit["contaminated"])
    return found.select(
        "doc_id",
        decontamination.contaminated().alias("contaminated"),
        F.array_sort(F.transform(verified, lambda hit: hit["item"])).alias("items"),
        F.size("hits").cast("long").alias("n_retrieved"),
        F.coalesce(F.array_max(F.transform(verified, lambda hit: hit["score"])), F.lit(0.0)).alias("score"),
    )


def op11_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_copies(_texts(spark, folder)).select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id", "n_rows"
    )


def op12_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    codes = vector_codes.compress(read_table(spark, folder, "embeddings"))
    numbers = (str(v) for part in codes.codebooks for entry in part for v in entry)
    return codes.rows.select(
        "vec_id", "code", "error", "label_error",
        F.lit(hashlib.sha256(",".join(numbers).encode()).hexdigest()).alias("codebooks_sha256"),
    )


def damaged(turns: DataFrame) -> DataFrame:
    """Conversations with faults by the checksum of conversation and turn, as the contract has them."""
    key = [F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("conv_id", "turn")]
    fault = F.crc32(F.concat_ws(":", *key).cast("binary")) % 20
    role, text = (F.coalesce(F.col(name), F.lit(" ")) for name in ("role", "text"))
    return (
        turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), fault.alias("damage"))
        .where(F.col("damage") != 0)
        .select(
            "conv_id",
            "turn",
            F.when(F.col("damage") == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(F.col("damage") == 1, "")
            .when(F.col("damage") == 2, F.translate("text", ".!?", ""))
            .otherwise(F.col("text"))
            .alias("text"),
            F.explode(F.array_repeat(F.lit(0), F.when(F.col("damage") == 3, 2).otherwise(1))),
        )
        .drop("col")
    )


def _conversation_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The row of each conversation, with a hash over the turns that follow it."""
    head, digest = None, None
    columns = ["place", "role", "text"]
    for batch in batches:
        done = []
        fields = batch.drop_columns([*columns, "edit"])
        rows = zip(*(batch.column(batch.schema.get_field_index(name)).to_pylist() for name in columns))
        for number, (place, role, text) in enumerate(rows):
            if place == 0:
                if head is not None:
                    done.append({**head, "repaired_sha256": digest.hexdigest()})
                head, digest = fields.slice(number, 1).to_pylist()[0], hashlib.sha256()
            else:
                digest.update(f"{chr(10) if place > 1 else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
        schema = fields.schema.append(pa.field("repaired_sha256", pa.string()))
        yield pa.RecordBatch.from_pylist(done, schema=schema)
    if head is not None:
        yield pa.RecordBatch.from_pylist([{**head, "repaired_sha256": digest.hexdigest()}], schema=schema)


def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    original = read_table(spark, folder, "conversations")
    turns = damaged(original)
    repaired = conversations.repaired(turns, conversations.audits(turns, original))
    kept = [field for field in repaired.schema if field.name not in ("place", "role", "text", "edit")]
    layout = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in kept)
    return repaired.mapInArrow(_conversation_digests, f"{layout}, repaired_sha256 string")


QUERIES = {
    "op1_pii": op1_pii,
    "op2_quality_rules": op2_quality_rules,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_ngram_join": op4_ngram_join,
    "op5_token_counts": op5_token_counts,
    "op6_html_extraction": op6_html_extraction,
    "op7_language_id": op7_language_id,
    "op8_decontamination": op8_decontamination,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_simhash": op11_simhash,
    "op12_vector_codes": op12_vector_codes,
    "op13_conversation_repair": op13_conversation_repair,
}

__all__ = ["ORACLE_SQL", "QUERIES"]
