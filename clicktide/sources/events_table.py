"""The test tables' generic ``events`` as shop events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from clicktide.functions import utc_date
from clicktide.schemas import CATALOGUE


def as_clickstream(events: DataFrame) -> DataFrame:
    """Map ``ts, user_id, event_type, props`` to the archive layout.

    ``click`` stands in for ``add_to_cart``, the product is picked by ``k``, the one
    number in ``props``, and types the shop does not know stay as they are. A
    pattern finds ``k`` at a tenth of the cost of a JSON parser.
    """
    k = F.regexp_extract("props", r'"k"\s*:\s*(\d+)', 1).try_cast("int")
    user_text = F.col("user_id").cast("string")
    four_digits = F.lpad(user_text, F.greatest(F.length(user_text), F.lit(4)), F.lit("0"))
    product_number = k % len(CATALOGUE) + 1
    return events.select(
        F.concat(F.lit("U"), four_digits).alias("user_id"),
        F.try_element_at(F.array(*map(F.lit, CATALOGUE)), product_number).alias("product_id"),
        F.try_element_at(F.array(*map(F.lit, CATALOGUE.values())), product_number).alias("category"),
        F.when(F.col("event_type") == "click", "add_to_cart")
        .otherwise(F.col("event_type")).alias("event_type"),
        F.col("ts").cast("timestamp_ltz").alias("timestamp"),
    ).withColumn("event_date", utc_date("timestamp"))


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    return as_clickstream(spark.read.parquet(f"{folder}/events.parquet"))
