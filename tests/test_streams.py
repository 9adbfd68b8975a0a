import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from musterline.operators.trades import trade_alerts, trade_metrics
from musterline.sinks import tables
from musterline.sources import files
from musterline.streaming import jobs


@pytest.fixture()
def landing(bound, tmp_path):
    """Trades in several files."""
    tables.write_ndjson(bound.trades(), str(tmp_path / "landing"), max_rows=300)
    return str(tmp_path / "landing")


def test_chain_equals_batch(spark, bound, landing, tmp_path):
    queries = jobs.chain(spark, landing, str(tmp_path / "out"), str(tmp_path / "ckpt"))
    raw = spark.read.schema(files.RAW).parquet(f"{tmp_path}/out/trades_raw")
    assert raw.count() == bound.trades().count()
    metrics = spark.read.schema(tables.METRICS).parquet(f"{tmp_path}/out/trades_analytics")
    want = trade_metrics(bound.trades())
    assert sorted(rows(metrics, *want.columns)) == sorted(rows(want))
    alerts = spark.read.schema(tables.ALERTS).parquet(f"{tmp_path}/out/price_alerts")
    want = trade_alerts(bound.trades())
    assert sorted(rows(alerts, *want.columns)) == sorted(rows(want))
    assert jobs.progress_counts(queries["trades_raw"]) == {"batches": 1, "rows": bound.trades().count()}


def test_batches_add_up_and_restart_adds_nothing(spark, bound, landing, tmp_path):
    args = (str(tmp_path / "out"), str(tmp_path / "ckpt"))
    jobs.chain(spark, landing, *args, max_files=1)
    read = lambda: spark.read.schema(files.RAW).parquet(f"{tmp_path}/out/trades_raw")
    total = bound.trades().count()
    assert read().count() == total
    jobs.chain(spark, landing, *args, max_files=1)
    assert read().count() == total
    metrics = spark.read.schema(tables.METRICS).parquet(f"{tmp_path}/out/trades_analytics")
    assert metrics.agg(F.sum("trade_count")).first()[0] == total
    # New files only, in a new batch.
    tables.write_ndjson(bound.trades().limit(10), landing)
    jobs.chain(spark, landing, *args)
    assert read().count() == total + 10
    metrics = spark.read.schema(tables.METRICS).parquet(f"{tmp_path}/out/trades_analytics")
    assert metrics.agg(F.sum("trade_count")).first()[0] == total + 10
    assert metrics.select("batch_id").distinct().count() == 2


def test_replayed_batch_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("A", 1), ("B", 2)], "symbol string, n int")
    tables.append_batch(df, 0, path)
    tables.append_batch(df, 1, path)
    tables.append_batch(df, 1, path)
    tables.append_batch(df.filter("false"), 2, path)
    assert sorted(rows(spark.read.parquet(path), "symbol", "batch_id")) == [("A", 0), ("A", 1), ("B", 0), ("B", 1)]


def test_raw_batches_are_partitioned(spark, bound, landing, tmp_path):
    stream = files.trade_stream(spark, landing, max_files=1)
    jobs.ingest_batches(stream, str(tmp_path / "raw"), str(tmp_path / "c"), name=None).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "raw"))
    assert got.count() == bound.trades().count() and got.select("batch_id").distinct().count() > 1
    assert {"processing_time", "trade_timestamp"} <= set(got.columns)


def test_closed_windows_equal_batch_windows(spark, bound, landing, tmp_path):
    result = jobs.windowed_metrics(files.trade_stream(spark, landing), "1 hour", "10 minutes")
    jobs.write_files(result, str(tmp_path / "w"), str(tmp_path / "c")).awaitTermination()
    got = spark.read.schema(result.schema).parquet(str(tmp_path / "w"))
    batch = jobs.windowed_metrics(bound.trades(), "1 hour", "10 minutes")
    last = bound.trades().agg(F.max("trade_time")).first()[0]
    closed = batch.filter(F.unix_millis("window_end") <= last - 600_000)
    assert got.count() > 0 and sorted(rows(got)) == sorted(rows(closed))
    assert batch.count() > closed.count()


@pytest.mark.parametrize("spread", [1, 4])
def test_copies_are_dropped(spark, bound, landing, tmp_path, spread):
    one = bound.trades().limit(1)
    for _ in range(3):
        tables.write_ndjson(one, landing)
    result = jobs.dedup_trades(files.trade_stream(spark, landing), watermark="40 days", spread=spread)
    jobs.write_files(result, str(tmp_path / "u"), str(tmp_path / "c")).awaitTermination()
    got = spark.read.schema(result.schema).parquet(str(tmp_path / "u"))
    assert got.count() == got.select("trade_id").distinct().count() == bound.trades().count()


def test_late_trade_is_not_added_to_a_closed_window(spark, tmp_path):
    landing = tmp_path / "l"
    trade = lambda i, t: json.dumps({"symbol": "A", "trade_id": i, "price": 1.0, "quantity": 1.0, "trade_time": t, "is_buyer_maker": True, "trade_value": 1.0})
    landing.mkdir()
    args = (str(tmp_path / "w"), str(tmp_path / "c"))

    def run():
        result = jobs.windowed_metrics(files.trade_stream(spark, str(landing)), "1 minute", "1 minute")
        jobs.write_files(result, *args).awaitTermination()
        return spark.read.schema(result.schema).parquet(args[0]).orderBy("window_start")

    (landing / "a.json").write_text("\n".join([trade(1, 0), trade(2, 600_000)]))
    assert rows(run(), "trade_count") == [(1,)]
    (landing / "b.json").write_text("\n".join([trade(3, 1_000), trade(4, 1_200_000)]))
    assert rows(run(), "trade_count") == [(1,), (1,)]


def test_catalog_table_feeds_two_streams(spark, bound, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS feed")
    tables.write_table(bound.trades(), "feed.trades")
    for i in range(2):
        out, ckpt = str(tmp_path / f"m{i}"), str(tmp_path / f"c{i}")
        jobs.stream_metrics(files.catalog_stream(spark, "feed.trades"), out, ckpt, name=None).awaitTermination()
        assert spark.read.parquet(out).agg(F.sum("trade_count")).first()[0] == bound.trades().count()


def test_batches_go_to_declared_tables_too(spark, bound, landing, tmp_path):
    tables.create_stream_tables(spark, "streams_test", replace=True)
    stream = lambda: files.trade_stream(spark, landing, max_files=1)
    ckpt = lambda n: str(tmp_path / n)
    jobs.ingest_batches(stream(), "streams_test.trades_raw", ckpt("r"), name=None).awaitTermination()
    jobs.stream_metrics(stream(), "streams_test.trades_analytics", ckpt("m"), name=None).awaitTermination()
    jobs.stream_alerts(stream(), "streams_test.price_alerts", ckpt("a"), name=None).awaitTermination()
    total = bound.trades().count()
    metrics = spark.table("streams_test.trades_analytics")
    assert spark.table("streams_test.trades_raw").count() == total
    assert metrics.agg(F.sum("trade_count")).first()[0] == total
    assert metrics.select("batch_id").distinct().count() > 1
    assert spark.table("streams_test.price_alerts").count() > 0
    before = sorted(rows(metrics), key=str)
    again = spark.createDataFrame(
        metrics.filter("batch_id = 1").drop("batch_id").collect(), metrics.drop("batch_id").schema
    )
    tables.append_batch_table(again, 1, "streams_test.trades_analytics")
    assert sorted(rows(spark.table("streams_test.trades_analytics")), key=str) == before


def test_live_chain_catches_up(spark, bound, landing, tmp_path):
    queries = jobs.chain(spark, landing, str(tmp_path / "o"), str(tmp_path / "c"), jobs.every("1 second"))
    try:
        assert set(jobs.active_names(spark)) == {"trades_raw", "trades_analytics", "price_alerts"}
        for query in queries.values():
            query.processAllAvailable()
        metrics = spark.read.schema(tables.METRICS).parquet(f"{tmp_path}/o/trades_analytics")
        assert metrics.agg(F.sum("trade_count")).first()[0] == bound.trades().count()
    finally:
        assert len(jobs.stop_all(spark)) == 3


def test_names_stop_and_counter(spark, landing, tmp_path):
    counter = jobs.ProgressCounter()
    spark.streams.addListener(counter)
    try:
        stream = jobs.enrich(files.trade_stream(spark, landing))
        query = jobs.write_files(stream, str(tmp_path / "o"), str(tmp_path / "c"), jobs.every("1 second"), "live_raw")
        query.processAllAvailable()
        assert jobs.active_names(spark) == ["live_raw"]
        assert jobs.stop_all(spark) == ["live_raw"] and jobs.active_names(spark) == []
    finally:
        spark.streams.removeListener(counter)
    assert jobs.every() == {"processingTime": "5 seconds"} and jobs.once() == {"availableNow": True}


def test_malformed_lines_are_kept_aside(spark, tmp_path):
    (tmp_path / "l").mkdir()
    (tmp_path / "l" / "a.json").write_text('{"symbol": "A", "price": 1.0}\n{broken\n')
    got = files.read_ndjson(spark, str(tmp_path / "l"), "symbol string, price double", corrupt_col="_bad").cache()
    assert sorted(rows(got), key=str) == [("A", 1.0, None), (None, None, "{broken")]
    stream = files.trade_stream(spark, str(tmp_path / "l"), "symbol string, price double", corrupt_col="_bad")
    jobs.write_files(stream, str(tmp_path / "o"), str(tmp_path / "c")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "o")).filter("_bad is not null").count() == 1
