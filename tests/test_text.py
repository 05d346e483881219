import numpy as np
import pytest

from clicktide.functions import guarded_ratio, pad_left, pad_right, percent_label, percent_text
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def ratios(spark):
    pairs = spark.range(0, 301).crossJoin(spark.range(1, 401).withColumnRenamed("id", "views"))
    table = pairs.select((F.col("id") / F.col("views")).alias("rate"))
    return table.select(
        "rate", percent_text("rate").alias("text"), percent_label(F.col("rate") * 100).alias("label")
    ).toPandas()


def test_percent_text_is_what_numpy_prints(ratios):
    expected = (ratios["rate"] * 100).round(2).astype(str) + "%"
    assert (ratios["text"] == expected).all()


def test_percent_label_is_what_python_prints(ratios):
    expected = [f"{rate * 100:.1f}%" for rate in ratios["rate"]]
    assert ratios["label"].tolist() == expected


@pytest.mark.parametrize("rate", [0.0, 0.00125, 0.285, 1e-9, 0.02675, 123456.789, 2.5e6, 1e9])
def test_percent_texts_of_single_values(spark, rate):
    row = spark.range(1).select(
        percent_text(F.lit(rate)).alias("text"), percent_label(F.lit(rate)).alias("label")
    ).first()
    assert row.text == str(np.round(np.float64(rate) * 100, 2)) + "%"
    assert row.label == f"{rate:.1f}%"


def test_ratio_guard(spark):
    table = spark.createDataFrame([(1, 2), (1, 0), (0, 5)], "part BIGINT, whole BIGINT")
    rows = table.select(guarded_ratio("part", "whole")).collect()
    assert [row[0] for row in rows] == [0.5, 0.0, 0.0]


def test_padding_never_cuts(spark):
    row = spark.range(1).select(
        pad_left(F.lit("ab"), 4), pad_right(F.lit("ab"), 4), pad_left(F.lit("abcdef"), 4),
        pad_right(F.lit("abcdef"), 4), pad_left(F.lit(None).cast("string"), 4),
    ).first()
    assert tuple(row) == ("  ab", "ab  ", "abcdef", "abcdef", None)
