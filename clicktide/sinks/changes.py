"""Alerts as they begin and end, from the window counts of an update-mode stream."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from clicktide.operators.alerts import flash_sale_rule, with_alert_texts
from clicktide.schemas import ALERT_COLUMNS, ALERT_PURCHASES_UNDER, ALERT_VIEWS_OVER
from clicktide.sinks.alerts import BatchSink, table_sink
from clicktide.sinks.current import CurrentTable

RAISED, WITHDRAWN = "raised", "withdrawn"


@dataclass(frozen=True)
class AlertChanges:
    """A sink for window counts that tells when a window becomes an alert and when it no longer is.

    Every batch is compared with the counts that ``table`` holds from the batches before it,
    in the slices that the batch touches. A change goes to ``root``, one folder per batch, and
    to the sinks: the alert's columns, with the counts that made the change, and ``change``.
    Each window is raised and withdrawn in turn, beginning with raised.

    The changes of a batch are written before the batch joins the table. A batch that is
    delivered again gives the same changes: while the table has not merged it, as they are
    computed from the batches before it; later, as they are read from their folder. Sinks
    may see them twice.
    """

    table: CurrentTable
    root: str
    sinks: Sequence[BatchSink] = field(default_factory=list)
    views_over: int = ALERT_VIEWS_OVER
    purchases_under: int = ALERT_PURCHASES_UNDER

    def deliver(self, batch: DataFrame, batch_id: int) -> None:
        """A sink of ``write_to_sinks`` in update mode."""
        spark = batch.sparkSession
        if not self.table.holds(spark, batch_id):
            table_sink(self.root)(self._changes(batch, batch_id), batch_id)
            self.table.deliver(batch, batch_id)
        if self.sinks:
            changes = spark.read.parquet(f"{self.root}/batch_id={batch_id}")
            if changes.count():
                for sink in self.sinks:
                    sink(changes, batch_id)

    def _changes(self, batch: DataFrame, batch_id: int) -> DataFrame:
        before = self.table.read(batch.sparkSession, batch_id, like=batch)
        keys = [F.col(key) for key in self.table.keys]
        rest = [name for name in self.table.schema.names if name not in self.table.keys]
        now = batch.select(*keys, F.struct(*rest).alias("_now"), F.lit(False).alias("_was"))
        was = before.where(self._rule()).select(
            *keys, F.lit(None).cast(now.schema["_now"].dataType).alias("_now"), F.lit(True).alias("_was")
        )
        # one shuffle by window compares them; a window outside the batch has not changed
        compared = (
            now.unionByName(was)
            .groupBy(*self.table.keys)
            .agg(F.first("_now", ignorenulls=True).alias("_now"), F.max("_was").alias("_was"))
            .where(F.col("_now").isNotNull())
            .select(*self.table.keys, "_now.*", "_was")
        )
        change = F.when(self._rule(), RAISED).otherwise(WITHDRAWN).alias("change")
        changed = compared.where(F.col("_was") != self._rule())
        return with_alert_texts(changed).select(*ALERT_COLUMNS, change)

    def _rule(self) -> Column:
        return flash_sale_rule(self.views_over, self.purchases_under)
