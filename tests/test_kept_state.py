"""What streams keep beside their checkpoint: ids seen, panes, counts."""

import json

from conftest import rows
from pyspark.sql import functions as F

from musterline.operators.trades import metrics_of_parts, trade_metrics, trade_parts
from musterline.sinks import tables
from musterline.sources import files
from musterline.streaming import jobs
from musterline.streaming.counters import RunCounters
from musterline.streaming.panes import PaneState
from musterline.streaming.seen import SeenIndex, ingest_once


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "trade_id bigint")


def test_index_knows_earlier_batches_only(spark, tmp_path):
    index = SeenIndex(spark, str(tmp_path / "i"), buckets=4)
    assert index.seen(ids(spark, 1, 2), 0, str(tmp_path / "o")) is None
    index.add(ids(spark, *range(1000)), 0)
    index.add(ids(spark, *range(2000, 2500)), 1)
    asked = ids(spark, 5, 999, 1000, 2001, 9999)
    assert sorted(rows(index.seen(asked, 2, str(tmp_path / "a")))) == [(5,), (999,), (2001,)]
    # A batch does not see itself, nor those after it.
    assert sorted(rows(index.seen(asked, 1, str(tmp_path / "b")))) == [(5,), (999,)]
    assert index.seen(asked, 0, str(tmp_path / "c")) is None


def test_filters_keep_most_unseen_ids_from_the_runs(spark, tmp_path):
    index = SeenIndex(spark, str(tmp_path / "i"), buckets=4)
    index.add(ids(spark, *range(0, 40_000, 2)), 0)
    odd = ids(spark, *range(1, 20_001, 2))
    assert index.candidates(odd, 1).count() < 300
    assert index.candidates(ids(spark, *range(0, 2000, 2)), 1).select("trade_id").distinct().count() == 1000
    assert index.seen(ids(spark, 40_001), 1, str(tmp_path / "o")) is None or index.candidates(ids(spark, 40_001), 1).count() == 1


def test_runs_merge_by_tiers_and_a_replay_takes_its_place(spark, tmp_path):
    index = SeenIndex(spark, str(tmp_path / "i"), buckets=2, fan_in=2)
    for batch in range(5):
        index.merge(batch)
        index.add(ids(spark, batch, 100 + batch), batch)
    assert [(r.tier, r.first, r.last) for r in index.runs()] == [(2, 0, 3), (0, 4, 4)]
    index.add(ids(spark, 7), 4)
    found = index.seen(ids(spark, *range(200)), 5, str(tmp_path / "o"))
    assert sorted(rows(found)) == [(i,) for i in [0, 1, 2, 3, 7, 100, 101, 102, 103]]


def test_an_unfinished_run_does_not_count(spark, tmp_path):
    index = SeenIndex(spark, str(tmp_path / "i"))
    run = index.add(ids(spark, 1), 0)
    discard_success = tmp_path / "i" / "runs" / run.name / "_SUCCESS"
    discard_success.unlink()
    assert index.runs() == []


TRADE = {"symbol": "A", "price": 1.0, "quantity": 1.0, "is_buyer_maker": True, "trade_value": 1.0, "event_type": "trade"}


def land(folder, name, *trades):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps({**TRADE, **t}) for t in trades))


def test_late_copies_and_replays_change_nothing(spark, tmp_path):
    landing = tmp_path / "l"
    index = SeenIndex(spark, str(tmp_path / "i"), fan_in=2)

    def run():
        ingest_once(files.trade_stream(spark, str(landing)), str(tmp_path / "t"), index, str(tmp_path / "c")).awaitTermination()
        return sorted(rows(spark.read.parquet(str(tmp_path / "t")), "trade_id", "batch_id"), key=str)

    day = 86_400_000
    land(landing, "0.json", *[{"trade_id": 1, "trade_time": 0}] * 3, {"trade_id": 2, "trade_time": 5}, {"trade_id": None, "trade_time": 1})
    first = [(1, 0), (2, 0), (None, 0)]
    assert run() == first
    land(landing, "1.json", {"trade_id": 1, "trade_time": 0}, {"trade_id": 3, "trade_time": 40 * day})
    second = [*first[:2], (3, 1), first[2]]
    assert run() == second
    for name in ("1", ".1.crc"):
        (tmp_path / "c" / "commits" / name).unlink(missing_ok=True)
    assert run() == second
    land(landing, "2.json", {"trade_id": 3, "trade_time": 40 * day}, {"trade_id": 2, "trade_time": 90 * day})
    assert run() == second
    land(landing, "3.json", {"trade_id": 4, "trade_time": 1})
    assert run() == [*second[:3], (4, 3), second[3]]


def test_parts_add_up_to_the_metrics(spark, bound):
    trades = bound.trades()
    slices = trade_parts(trades, [(F.col("trade_id") % 7).alias("slice"), "symbol"])
    got = metrics_of_parts(slices, ["symbol"])
    want = trade_metrics(trades)
    assert sorted(rows(got, *want.columns)) == sorted(rows(want))
    odd = spark.createDataFrame([("A", float("nan"), 1.0, True, 1.0), ("A", None, 1e300, None, 2.0)], "symbol string, price double, quantity double, is_buyer_maker boolean, trade_value double")
    assert str(rows(metrics_of_parts(trade_parts(odd, ["symbol"]), ["symbol"]))) == str(rows(trade_metrics(odd)))


def test_widths_agree_and_late_trades_are_kept(spark, tmp_path):
    state = PaneState(spark, str(tmp_path / "s"), (60, 300), delay=60)
    assert state.windows().count() == 0 and state.late().count() == 0 and state.watermark(0) is None
    at = lambda i, seconds: (i, "A", 1000 * seconds if seconds is not None else None)
    make = lambda *ts: spark.createDataFrame(list(ts), "trade_id bigint, symbol string, trade_time bigint").select("*", *[F.lit(v).alias(k) for k, v in TRADE.items() if k != "symbol"])
    state.take(make(at(1, 10), at(2, 70), at(3, 400)), 0)  # watermark 340
    state.take(make(at(4, 20), at(5, 310), at(6, None), at(7, 700)), 1)  # 4 is late, 5 is not: its minute is open
    state.take(make(at(5, 310)), 2)
    shown = lambda: sorted(rows(state.windows().select("width", F.unix_seconds("window_start"), "trade_count", "batch_id")))
    want = [(60, 0, 1, 0), (60, 60, 1, 0), (60, 300, 1, 1), (60, 360, 1, 1), (300, 0, 2, 0), (300, 300, 2, 1)]
    assert shown() == want
    assert sorted(rows(state.late(), "trade_id", "batch_id")) == [(4, 1), (5, 2), (6, 1)]
    # Replayed batches, also after later ones, give the same again.
    state.take(make(at(4, 20), at(5, 310), at(6, None), at(7, 700)), 1)
    assert shown() == want and state.late().count() == 3


def test_counts_go_on_after_a_restart(spark, bound, tmp_path):
    landing, trades = str(tmp_path / "l"), bound.trades()
    for wave in (trades.where("trade_id % 2 = 0"), trades.where("trade_id % 2 = 1")):
        tables.write_ndjson(wave, landing, max_rows=100_000)
        counters = RunCounters(spark, str(tmp_path / "n"))
        jobs.chain(spark, landing, str(tmp_path / "o"), str(tmp_path / "c"), counters=counters)
    alerts = spark.read.schema(tables.ALERTS).parquet(str(tmp_path / "o" / "price_alerts")).count()
    want = {"trades_raw": {"batches": 2, "rows": trades.count()}, "price_alerts": {"batches": 2, "rows": alerts}}
    assert counters.totals() == want
    # A run without new files adds nothing.
    again = RunCounters(spark, str(tmp_path / "n"))
    jobs.chain(spark, landing, str(tmp_path / "o"), str(tmp_path / "c"), counters=again)
    assert again.totals() == want


def test_a_committed_batch_without_a_note_is_counted_from_the_sink(spark, bound, tmp_path):
    landing, trades = str(tmp_path / "l"), bound.trades()
    tables.write_ndjson(trades, landing, max_rows=100_000)
    jobs.chain(spark, landing, str(tmp_path / "o"), str(tmp_path / "c"), counters=RunCounters(spark, str(tmp_path / "n")))
    discard_note = tmp_path / "n" / "trades_raw" / "0.json"
    discard_note.unlink()
    late = RunCounters(spark, str(tmp_path / "n"))
    late.note("trades_raw", 7, 99)
    late.restore("trades_raw", str(tmp_path / "c" / "trades_raw"), str(tmp_path / "o" / "trades_raw"))
    # The note of a batch that was never committed does not count.
    assert late.totals()["trades_raw"] == {"batches": 1, "rows": trades.count()}
