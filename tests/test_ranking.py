"""Long lists per group: what reaches the task that ranks them."""

import pytest
from pyspark.sql import functions as F

from clicktide.operators import ranking


def order():
    return [F.desc("points"), F.asc("id")]


@pytest.fixture(params=["200", "2000"])
def partitions(spark, request):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", request.param)
    yield request.param
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_the_last_task_gets_a_small_multiple_of_k(spark, partitions, monkeypatch):
    k = 2000
    monkeypatch.setattr(ranking, "FIRST_PARTS", 64)  # parts of 3,000 rows, so that both cuts cut
    rows = spark.range(200_000).select(
        F.lit("one day").alias("day"), "id", F.pmod(F.xxhash64("id"), F.lit(5000)).alias("points")
    )
    assert ranking.best_of_parts(rows, k, order(), ["day"]).count() <= ranking.LAST_PARTS * k
    top = [row.id for row in ranking.top_rows(rows, k, order(), ["day"]).collect()]
    expected = [row.id for row in rows.orderBy(*order()).limit(k).collect()]
    assert sorted(top) == sorted(expected)


def test_ties_and_small_groups_stay_whole(spark):
    rows = spark.range(3000).select((F.col("id") % 3).alias("day"), "id", F.lit(1).alias("points"))
    top = ranking.top_rows(rows, 1500, order(), ["day"], rank="place")
    assert top.count() == 3000
    assert top.where("day = 0 and place = 2").first().id == 3
