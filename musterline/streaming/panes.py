"""Metrics over event-time windows of several widths from one state, with late trades kept aside.

The state is one table of panes, windows of the greatest width that divides all wanted ones. A batch adds the parts of its
panes; when the watermark passes the end of a wider window, its metrics are put together from the panes below it. So a
trade is aggregated once for any number of widths, and narrow windows always add up to the wide ones.

The watermark is the latest trade time of earlier batches less a delay, kept per batch, so it is the same when a batch is
replayed. A trade whose pane had ended by then is late: it goes to a table of its own and changes no window.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.trades import metrics_of_parts, trade_parts
from ..policy import TradePolicy
from ..session import exists
from ..sinks.tables import METRICS, append_batch
from ..sources.files import LANDED
from .jobs import Trigger, once, start_batches

_DAY = 86_400_000


class PaneState:
    """Panes, watermarks, late trades and finished windows below one folder; times are epoch milliseconds."""

    def __init__(self, spark: SparkSession, folder: str, widths: Sequence[int] = (60, 300), delay: int = 600, policy: TradePolicy = TradePolicy()):
        self.spark, self.folder, self.policy = spark, folder.rstrip("/"), policy
        self.widths = [1000 * w for w in widths]
        self.pane, self.delay = math.gcd(*self.widths), 1000 * delay

    def _table(self, name: str, schema: str) -> DataFrame:
        """A table of the state; empty until a batch wrote to it."""
        where = f"{self.folder}/{name}"
        return self.spark.read.schema(schema).parquet(where) if exists(self.spark, where) else self.spark.createDataFrame([], schema)

    def watermark(self, batch_id: int) -> int | None:
        """Watermark of the batches below ``batch_id``."""
        marks = self._table("marks", "newest bigint, batch_id bigint")
        newest = marks.where(F.col("batch_id") < batch_id).agg(F.max("newest")).first()[0]
        return None if newest is None else newest - self.delay

    def late(self) -> DataFrame:
        return self._table("late", f"{LANDED}, batch_id bigint")

    def windows(self) -> DataFrame:
        """Finished windows of all widths."""
        return self._table("windows", f"width int, {METRICS}")

    def take(self, batch: DataFrame, batch_id: int) -> None:
        """Add a batch of trades and finish the windows that the watermark has passed."""
        before = self.watermark(batch_id)
        batch = batch.persist()
        try:
            start = F.floor(F.col("trade_time") / self.pane) * self.pane
            late = F.lit(False) if before is None else start + self.pane <= before
            # A trade without a time belongs to no window.
            late = F.col("trade_time").isNull() | late
            append_batch(batch.where(late), batch_id, f"{self.folder}/late")
            parts = trade_parts(batch.where(~late), [start.alias("pane"), "symbol"], self.policy)
            day = F.floor(F.col("pane") / _DAY).alias("day")
            parts.select("*", day, F.lit(batch_id).cast("bigint").alias("batch_id")).write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic"
            ).partitionBy("batch_id", "day").parquet(f"{self.folder}/panes")
            append_batch(batch.agg(F.max("trade_time").alias("newest")).where("newest IS NOT NULL"), batch_id, f"{self.folder}/marks")
        finally:
            batch.unpersist()
        after = self.watermark(batch_id + 1)
        if after is not None and (before is None or after > before) and exists(self.spark, f"{self.folder}/panes"):
            append_batch(self._finished(before, after, batch_id), batch_id, f"{self.folder}/windows")

    def _finished(self, before: int | None, after: int, batch_id: int) -> DataFrame:
        """Windows that end after ``before`` and not after ``after``."""
        panes = self.spark.read.parquet(f"{self.folder}/panes").where(F.col("batch_id") <= batch_id)
        oldest = 0 if before is None else before - max(self.widths)
        if before is not None:
            panes = panes.where((F.col("day") >= oldest // _DAY) & (F.col("pane") >= oldest))
        panes = panes.where((F.col("day") <= after // _DAY) & (F.col("pane") < after))
        # One row per width that a pane counts for, before the only shuffle.
        each = panes.withColumn("width", F.explode(F.array(*[F.lit(w) for w in self.widths])))
        begin = F.floor(F.col("pane") / F.col("width")) * F.col("width")
        ended = begin + F.col("width") <= after
        if before is not None:
            ended = ended & (begin + F.col("width") > before)
        done = metrics_of_parts(each.where(ended), [(F.col("width") / 1000).cast("int").alias("width"), begin.alias("begin"), "symbol"], self.policy)
        return done.select(
            "width",
            F.timestamp_millis("begin").alias("window_start"),
            F.timestamp_millis(F.col("begin") + F.col("width").cast("bigint") * 1000).alias("window_end"),
            *done.columns[2:],
        )


def windows_of_widths(stream: DataFrame, state: PaneState, checkpoint: str, trigger: Trigger = once(), name: str | None = None) -> StreamingQuery:
    """Finished windows of all widths, and late trades, of a stream of trades."""
    return start_batches(stream, state.take, checkpoint, trigger, name)
