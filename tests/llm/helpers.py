"""Tables of texts for the corpus operators, with the awkward rows that all must take."""

import random

import pytest
from pyspark.sql import DataFrame, SparkSession

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"


def documents_of(spark: SparkSession, texts: list) -> DataFrame:
    rows = [(i, t, "en", "src0", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCUMENTS)


def awkward(spark: SparkSession, long_text: str = "word and more " * 20_000) -> DataFrame:
    """Nulls in every column, empty and very long texts, repeated rows, clashing extra columns."""
    rows = [
        (1, None, None, None, None, "x"),
        (2, "", "en", "src0", 0, "x"),
        (3, "  \n\t ", "en", None, 5, "x"),
        (None, "A text without an id, and some words more.", "en", "src0", 40, None),
        (4, long_text, "en", "src0", 1, "x"),
        (5, "The same row twice, with enough words in it.", "en", "src0", 44, "x"),
        (5, "The same row twice, with enough words in it.", "en", "src0", 44, "x"),
        (6, "Größe, naïve café 😀 日本語 \x00 end", "de", "src1", 1, "x"),
    ]
    clash = ("key", "ids", "n_tokens", "findings", "n_words", "score", "lang_pred", "component_id",
             "n_shingles", "items", "kept", "value", "fragment", "at")
    frame = spark.createDataFrame(rows, f"{DOCUMENTS}, key string")
    for name in clash[1:]:
        frame = frame.withColumn(name, frame["key"])
    return frame


def empty(frame: DataFrame) -> DataFrame:
    return frame.limit(0)


def random_texts(n: int, words: list[str], most: int, seed: int = 0) -> list[str]:
    rnd = random.Random(seed)
    return ["".join(rnd.choice(words) for _ in range(rnd.randint(0, most))) for _ in range(n)]


def rows_of(frame: DataFrame) -> list[dict]:
    return [row.asDict(recursive=True) for row in frame.collect()]


needs_data = pytest.mark.skipif(
    not __import__("os").path.isdir(SF), reason="the test tables are not here"
)
