"""Streams into keyed tables.

Both streams write through ``foreachBatch`` into a ``KeyedTable``. A replayed micro-batch brings
the same keys and order values again and therefore leaves the table as it was.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.ids import uuid5
from ..functions.numbers import exact_sum, num_of
from ..operators.ingest import Rules, null_out_of_range
from ..plans.shapes import latest
from ..sources.keyed import KeyedTable


class NewestTable(KeyedTable):
    """A keyed table in which the greatest order value of a key wins, whatever the order in which
    batches arrive."""

    def __init__(self, spark: SparkSession, root: str, keys: list[str], order: list[str],
                 fold: int = 16):
        super().__init__(spark, root, keys, fold)
        self.order = order

    def _order(self) -> list[Column]:
        return [F.col(o) for o in self.order]

    def add(self, rows: DataFrame) -> None:
        """Stage and commit one batch. Adding it again changes nothing that readers see."""
        self._write(latest(rows, self.keys, self._order()))


def ingest_stream(source: DataFrame, target: NewestTable, checkpoint: str, *,
                  natural_key: list[str], rules: Rules | None = None) -> StreamingQuery:
    """Range check, deterministic id and last-write-wins upsert of a stream.

    No rows are deduplicated before the upsert: the newest version of a row must win, not the
    first one seen."""
    rows = source.withColumn("row_uid", uuid5(*natural_key))
    if rules:
        rows = null_out_of_range(rows, rules)
    return (rows.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
            .foreachBatch(lambda df, _: target.add(df)).trigger(availableNow=True).start())


def event_time(df: DataFrame, column: str) -> Column:
    """A timestamp fit for a watermark (zone-less timestamps are read in the session zone)."""
    kind = df.schema[column].dataType
    return F.col(column) if isinstance(kind, T.TimestampType) else F.col(column).cast("timestamp")


def daily_stream(source: DataFrame, *, keys: list[str], ts: str, value: str,
                 late: str = "2 days") -> DataFrame:
    """Session best, daily total and row count per key and day of a stream, within a watermark."""
    rows = source.select(*keys, event_time(source, ts).alias("_ts"),
                         num_of(source, value).alias("_value")).where(F.col("_value").isNotNull())
    return (rows.withWatermark("_ts", late).groupBy(F.window("_ts", "1 day"), *keys)
            .agg(F.max("_value").alias("best"),
                 exact_sum("_value").alias("load"),
                 F.count(F.lit(1)).alias("n"))
            .select(*keys, F.to_date("window.start").alias("date"), "best", "load", "n"))


def keep_daily(daily: DataFrame, target: NewestTable, checkpoint: str) -> StreamingQuery:
    """Keep the daily table current: each update carries the day's row count, and the count of a
    day only grows, so the greatest count is the newest state."""
    return (daily.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
            .foreachBatch(lambda df, _: target.add(df)).trigger(availableNow=True).start())
