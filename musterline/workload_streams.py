"""Registered queries over streams that stop, start again and meet copies, late trades and replays."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .plans.bindings import Bindings
from .session import discard, scratch
from .sinks import tables
from .sources import files, wire
from .streaming import jobs
from .streaming.counters import RunCounters
from .streaming.panes import PaneState, windows_of_widths
from .streaming.seen import SeenIndex, ingest_once


def _land(rows: DataFrame, landing: str) -> None:
    tables.write_ndjson(rows, landing, max_rows=1_000_000)


def _stream_once(b: Bindings) -> DataFrame:
    """Most trades; days later the rest and copies of the first; the last batch run twice; then copies of all."""
    base = scratch(b.spark, "once")
    trades, key = b.trades(), F.col("trade_id")
    index = SeenIndex(b.spark, f"{base}/seen", fan_in=2)

    def run() -> None:
        stream = files.trade_stream(b.spark, f"{base}/landing")
        ingest_once(stream, f"{base}/trades", index, f"{base}/ckpt").awaitTermination()

    _land(trades.where(key % 5 != 0), f"{base}/landing")
    run()
    _land(trades.where((key % 5 == 0) | (key % 3 == 0)), f"{base}/landing")
    run()
    # Without the note that it was committed, the batch runs again.
    discard(b.spark, f"{base}/ckpt/commits/1", f"{base}/ckpt/commits/.1.crc")
    run()
    _land(trades.where(key % 4 != 1), f"{base}/landing")
    run()
    discard(b.spark, f"{base}/landing", f"{base}/ckpt", f"{base}/seen")
    stored = b.spark.read.schema(f"{files.RAW}, batch_id bigint").parquet(f"{base}/trades")
    return stored.select(*wire.WIRE_FIELDS, "trade_value", "batch_id")


WIDTHS = (60, 300)


def _widths(b: Bindings, base: str) -> PaneState:
    """Trades but for every ninth, then those: some are late by then."""
    trades, held = b.trades(), F.col("trade_id") % 9 == 0
    state = PaneState(b.spark, f"{base}/state", WIDTHS, delay=600)
    for wave in (trades.where(~held), trades.where(held)):
        _land(wave, f"{base}/landing")
        windows_of_widths(files.trade_stream(b.spark, f"{base}/landing"), state, f"{base}/ckpt").awaitTermination()
    discard(b.spark, f"{base}/landing", f"{base}/ckpt")
    return state


def _stream_widths(b: Bindings) -> DataFrame:
    """Finished windows of one and of five minutes."""
    windows = _widths(b, scratch(b.spark, "widths")).windows().drop("batch_id")
    return windows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


def _stream_late(b: Bindings) -> DataFrame:
    """Trades whose window had ended when they came."""
    return _widths(b, scratch(b.spark, "late")).late().select("trade_id", "symbol", "trade_time", "price", "quantity")


def _stream_totals(b: Bindings) -> DataFrame:
    """Batches, trades and alerts of a chain of streams, counted over a stop and a restart."""
    base = scratch(b.spark, "totals")
    trades, even = b.trades(), F.col("trade_id") % 2 == 0
    for wave in (trades.where(even), trades.where(~even)):
        _land(wave, f"{base}/landing")
        counters = RunCounters(b.spark, f"{base}/counts")  # a new process knows nothing
        jobs.chain(b.spark, f"{base}/landing", f"{base}/out", f"{base}/ckpt", counters=counters)
    totals = counters.totals()
    discard(b.spark, base)
    counts: Sequence[tuple[str, int]] = (
        ("batches", totals["trades_raw"]["batches"]),
        ("trades", totals["trades_raw"]["rows"]),
        ("alerts", totals["price_alerts"]["rows"]),
    )
    return b.spark.createDataFrame(list(counts), "name string, total bigint")


QUERIES: dict[str, Callable[[Bindings], DataFrame]] = {
    "stream_once": _stream_once,
    "stream_widths": _stream_widths,
    "stream_late": _stream_late,
    "stream_totals": _stream_totals,
}
