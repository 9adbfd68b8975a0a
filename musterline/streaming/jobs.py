"""Trade streams: files to raw trades, raw trades to metrics and alerts, event-time windows, de-duplication."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StructType

from ..operators.trades import trade_alerts, trade_metrics, with_times
from ..policy import TradePolicy
from ..sinks.tables import append_batch, append_batch_table
from ..sources.files import table_stream, trade_stream
from ..sources.rescue import CORRUPT, RESCUED, parse_lines
from ..sources.schemas import Schema, SchemaLedger, VersionedTable, infer_json
from .counters import RunCounters, counted

Trigger = Mapping[str, object]


def once() -> Trigger:
    """Process what is there, then stop."""
    return {"availableNow": True}


def every(interval: str = "5 seconds") -> Trigger:
    """Keep running, one batch per interval."""
    return {"processingTime": interval}


def write_files(stream: DataFrame, path: str, checkpoint: str, trigger: Trigger = once(), name: str | None = None) -> StreamingQuery:
    """Append a stream to a parquet folder. The sink's log makes every batch visible once,
    to batch readers and to streams that read the folder in turn."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", path)
    return _start(writer, checkpoint, trigger, name)


def write_batches(
    stream: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    target: str,
    checkpoint: str,
    trigger: Trigger = once(),
    name: str | None = None,
    counters: RunCounters | None = None,
) -> StreamingQuery:
    """Apply ``build`` to every micro-batch and write the result as that batch's partition.

    The target is a folder or, without a slash in it, a catalog table. With ``counters`` and a name the written rows are
    counted on the way.
    """
    write = append_batch if "/" in target else append_batch_table

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = build(batch)
        if counters and name:
            counters.write(name, batch_id, rows, lambda df: write(df, batch_id, target))
        else:
            write(rows, batch_id, target)

    return start_batches(stream, handle, checkpoint, trigger, name)


def start_batches(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, trigger: Trigger = once(), name: str | None = None
) -> StreamingQuery:
    """Call ``handle`` with every micro-batch and its id."""
    return _start(stream.writeStream.foreachBatch(handle), checkpoint, trigger, name)


def _start(writer, checkpoint: str, trigger: Trigger, name: str | None) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint).trigger(**trigger)
    return (writer.queryName(name) if name else writer).start()


def enrich(stream: DataFrame) -> DataFrame:
    """Add the trade's timestamp and the time of processing; stateless, so part of the stream itself."""
    return with_times(stream).withColumn("processing_time", F.current_timestamp())


def ingest_trades(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    trigger: Trigger = once(),
    name: str = "trades_raw",
    counters: RunCounters | None = None,
):
    """Landed trades to the raw table that the other streams read."""
    rows = enrich(stream)
    return write_files(counted(rows) if counters else rows, path, checkpoint, trigger, name)


def ingest_batches(stream: DataFrame, path: str, checkpoint: str, trigger: Trigger = once(), name: str = "trades_raw"):
    """Landed trades to a raw table with one partition per batch, for batch readers."""
    return write_batches(stream, enrich, path, checkpoint, trigger, name)


#: Columns beside the inferred ones.
BESIDE = f"{RESCUED} string, {CORRUPT} string, _source_file string"


def inferred_table(spark: SparkSession, path: str, ledger: str, hints: Schema | None = None) -> VersionedTable:
    """Table that ``ingest_inferred`` fills; ``read()`` gives all rows under the latest schema."""
    reserved = (RESCUED, CORRUPT, "_source_file")
    return VersionedTable(SchemaLedger(spark, ledger, hints, reserved), path, BESIDE)


def ingest_inferred(
    lines: DataFrame,
    table: VersionedTable,
    checkpoint: str,
    trigger: Trigger = once(),
    infer: bool = True,
    name: str | None = None,
) -> StreamingQuery:
    """Lines of NDJSON to a table whose schema is found on the way.

    With ``infer`` each batch's types are joined with those known and the batch is stored under the version that holds
    both, so new and widened fields need no restart. Without it the hints alone are the schema. Either way values
    that do not fit and lines that are no object are kept beside the columns. A batch is read twice with ``infer``, else once.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        version, schema = table.ledger.merge(infer_json(batch) if infer else StructType([]))
        table.write_batch(parse_lines(batch, schema), version, batch_id)

    return start_batches(lines, handle, checkpoint, trigger, name)


def batch_metrics(batch: DataFrame, policy: TradePolicy = TradePolicy()) -> DataFrame:
    """Metrics of one batch with the span of trade times they cover."""
    span = {
        "window_start": F.timestamp_millis(F.min("trade_time")),
        "window_end": F.timestamp_millis(F.max("trade_time")),
    }
    return trade_metrics(batch, policy=policy, extra=span)


def stream_metrics(stream, path, checkpoint, trigger: Trigger = once(), name="trades_analytics", policy=TradePolicy()):
    """Metrics per batch and symbol."""
    return write_batches(stream, lambda b: batch_metrics(b, policy), path, checkpoint, trigger, name)


def stream_alerts(
    stream, path, checkpoint, trigger: Trigger = once(), name="price_alerts", policy=TradePolicy(), counters: RunCounters | None = None
):
    """Alerts per batch and symbol."""
    return write_batches(stream, lambda b: trade_alerts(b, policy=policy), path, checkpoint, trigger, name, counters)


def windowed_metrics(
    stream: DataFrame, width: str = "1 minute", watermark: str = "10 minutes", policy: TradePolicy = TradePolicy()
) -> DataFrame:
    """Metrics per event-time window and symbol. In append mode a window is final, and written,
    once the watermark has passed its end."""
    source = stream if "trade_timestamp" in stream.columns else with_times(stream)
    timed = source.withWatermark("trade_timestamp", watermark)
    keyed = trade_metrics(timed, keys=[F.window("trade_timestamp", width).alias("window"), "symbol"], policy=policy)
    return keyed.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keyed.columns[1:]
    )


def dedup_trades(
    stream: DataFrame, key: str = "trade_id", watermark: str = "10 minutes", spread: int = 1
) -> DataFrame:
    """One row per trade among copies that arrive within the watermark of each other.

    With ``spread`` above 1, copies are first reduced within that many slices and only
    then by the key alone, so one trade with very many copies does not load one task.
    """
    source = stream if "trade_timestamp" in stream.columns else with_times(stream)
    timed = source.withWatermark("trade_timestamp", watermark)
    if spread > 1:
        # Seeded, so a repeated task puts its rows into the same slices again.
        sliced = timed.withColumn("_slice", F.floor(F.rand(7) * spread))
        timed = sliced.dropDuplicatesWithinWatermark([key, "_slice"]).drop("_slice")
    return timed.dropDuplicatesWithinWatermark([key])


def chain(
    spark: SparkSession,
    landing: str,
    out: str,
    checkpoints: str,
    trigger: Trigger = once(),
    max_files: int | None = None,
    policy: TradePolicy = TradePolicy(),
    counters: RunCounters | None = None,
) -> dict[str, StreamingQuery]:
    """Files to raw trades, then raw trades to metrics and to alerts.

    With an available-now trigger each hop ends before the next starts, so nothing
    that was landed is missed downstream. ``counters`` take up the counts of earlier runs
    first and go on with those of trades and alerts.
    """
    drain = bool(trigger.get("availableNow"))
    queries: dict[str, StreamingQuery] = {}
    if counters:
        counters.restore("trades_raw", f"{checkpoints}/trades_raw", f"{out}/trades_raw")
        counters.restore("price_alerts", f"{checkpoints}/price_alerts")
        spark.streams.addListener(counters)

    def run(name: str, start: Callable[[str, str], StreamingQuery]) -> None:
        queries[name] = start(f"{out}/{name}", f"{checkpoints}/{name}")
        if drain:
            queries[name].awaitTermination()
            if counters:
                counters.settle(queries[name])

    def landed(path: str, checkpoint: str) -> StreamingQuery:
        return ingest_trades(trade_stream(spark, landing, max_files=max_files), path, checkpoint, trigger, counters=counters)

    run("trades_raw", landed)
    raw = f"{out}/trades_raw"
    run("trades_analytics", lambda p, c: stream_metrics(table_stream(spark, raw), p, c, trigger, policy=policy))
    run("price_alerts", lambda p, c: stream_alerts(table_stream(spark, raw), p, c, trigger, policy=policy, counters=counters))
    if drain and counters:
        spark.streams.removeListener(counters)
    return queries


def active_names(spark: SparkSession) -> list[str]:
    return [q.name or str(q.id) for q in spark.streams.active]


def stop_all(spark: SparkSession, wait: int = 30) -> list[str]:
    """Stop every running stream and wait for each; returns their names."""
    stopped = []
    for query in spark.streams.active:
        query.stop()
        query.awaitTermination(wait)
        stopped.append(query.name or str(query.id))
    return stopped


def progress_counts(query: StreamingQuery) -> dict[str, int]:
    """Batches with input and rows read, as far as the query still remembers them."""
    done = [p for p in query.recentProgress if p["numInputRows"] > 0]
    return {"batches": len(done), "rows": sum(p["numInputRows"] for p in done)}


class ProgressCounter(StreamingQueryListener):
    """Running totals per query name over a session: ``spark.streams.addListener(counter)``."""

    def __init__(self):
        self._lock = Lock()
        self.totals: dict[str, dict[str, int]] = {}

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        progress = event.progress
        if not progress.numInputRows:
            return
        with self._lock:
            entry = self.totals.setdefault(progress.name or str(progress.id), {"batches": 0, "rows": 0})
            entry["batches"] += 1
            entry["rows"] += progress.numInputRows

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass
