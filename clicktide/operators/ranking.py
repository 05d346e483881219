"""Top-k with a pinned order, over a whole table or per day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

# Parts of a long list per group: a group of a billion rows leaves 250,000 to a task of the
# first cut, and the second one 256 times ``k`` at most.
FIRST_PARTS, LAST_PARTS = 4096, 16


def top_rows(
    rows: DataFrame,
    k: int,
    order: Sequence[Column],
    by: Sequence[str] = (),
    rank: str | None = None,
) -> DataFrame:
    """The first ``k`` rows in ``order``, of the table or of each ``by`` group.

    Without ``by`` this is a limit under a sort, and the rank is numbered over the
    ``k`` rows left. With ``by`` only the best ``k`` rows of a group and task are
    shuffled. Either way no task sorts all rows of a large group.
    """
    if not by:
        best = rows.orderBy(*order).limit(k)
        if rank is None:
            return best
        return best.select(F.row_number().over(Window.orderBy(*order)).alias(rank), *rows.columns)

    if k > group_limit_threshold(rows):
        rows = best_of_parts(rows, k, order, by)
    position = rank or "_position"
    best = first_in_group(rows, k, order, by, position)
    if rank is None:
        return best.drop(position)
    rest = [name for name in rows.columns if name not in by]
    return best.select(*by, rank, *rest)


def group_limit_threshold(rows: DataFrame) -> int:
    """Largest ``k`` for which the optimizer limits groups before their shuffle."""
    return int(rows.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))


def first_in_group(
    rows: DataFrame, k: int, order: Sequence[Column], by: Sequence[str], position: str
) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return rows.withColumn(position, place).where(F.col(position) <= k)


def best_of_parts(
    rows: DataFrame, k: int, order: Sequence[Column], by: Sequence[str]
) -> DataFrame:
    """Cut each group into parts by row hash and keep the first ``k`` rows of each, twice.

    What is kept contains the first ``k`` of the group. The numbers of parts are fixed,
    whatever the shuffle settings: no task sorts more than a part of a group, and the
    last one gets at most ``LAST_PARTS * k`` rows of it.
    """
    cut = rows.withColumn("_part", F.pmod(F.xxhash64(*rows.columns), F.lit(FIRST_PARTS)))
    for parts in (FIRST_PARTS, LAST_PARTS):
        cut = cut.withColumn("_part", F.pmod("_part", F.lit(parts)))
        cut = first_in_group(cut, k, order, [*by, "_part"], "_position").drop("_position")
    return cut.drop("_part")
