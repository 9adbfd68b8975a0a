import datetime as dt
import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from musterline.operators import market as M
from musterline.operators import trades as T
from musterline.policy import TradePolicy
from musterline.sources import wire

SCHEMA = "symbol string, trade_id bigint, price double, quantity double, trade_time bigint, is_buyer_maker boolean"


@pytest.fixture()
def trades(spark):
    def make(data):
        return spark.createDataFrame(data, SCHEMA).withColumn("trade_value", F.col("price") * F.col("quantity"))

    return make


def test_metrics_of_an_all_buy_batch(trades):
    got = T.trade_metrics(trades([("A", 1, 10.0, 1.0, 5, False), ("A", 2, 20.0, 3.0, 6, False)])).first()
    assert (got["trade_count"], got["vwap"], got["avg_price"]) == (2, 17.5, 15.0)
    assert (got["buy_volume"], got["sell_volume"], got["buy_sell_ratio"]) == (4.0, 0.0, 40000.0)
    assert got["price_range_pct"] == 66.6667


def test_vwap_of_no_volume_is_unknown(trades):
    assert T.trade_metrics(trades([("A", 1, 10.0, 0.0, 5, True)])).first()["vwap"] is None


def test_single_trade_raises_no_alert(trades):
    assert T.trade_alerts(trades([("A", 1, 10.0, 1.0, 5, True)])).count() == 0


@pytest.mark.parametrize(
    "last, count, want",
    [
        (100.1, 2, None),
        (100.11, 2, ("PRICE_UP", "MEDIUM")),
        (99.0, 2, ("PRICE_DOWN", "HIGH")),
        (100.5, 3, ("PRICE_UP", "MEDIUM")),
        (100.51, 3, ("PRICE_UP", "HIGH")),
        (100.0, 3, ("VOLUME_SPIKE", "MEDIUM")),
    ],
)
def test_alert_thresholds(trades, last, count, want):
    data = [("A", i, 100.0, 1.0, i, True) for i in range(count - 1)] + [("A", 9, last, 1.0, 9, True)]
    got = rows(T.trade_alerts(trades(data)), "alert_type", "severity")
    assert got == ([want] if want else [])


def test_alert_messages(trades):
    data = [("A", 1, 1000.0, 1.0, 1, True), ("A", 2, 1250.5, 1.0, 2, True), ("B", 1, 5.0, 1.0, 1, True)]
    data += [("B", i, 5.0, 1.0, i, True) for i in (2, 3)]
    got = sorted(r[0] for r in rows(T.trade_alerts(trades(data)), "message"))
    assert got == ["A price moved UP 25.05% ($1,000.00 → $1,250.50)", "B volume spike: 3 trades in batch"]


def test_first_and_last_do_not_depend_on_row_order(trades):
    data = [("A", 3, 3.0, 1.0, 7, True), ("A", 1, 1.0, 1.0, 7, True), ("A", 2, 2.0, 1.0, 6, True)]
    for order in (data, data[::-1]):
        got = T.trade_alerts(trades(order)).first()
        assert (got["previous_price"], got["current_price"]) == (2.0, 3.0)


def test_thresholds_are_parameters(trades):
    data = [("A", 1, 100.0, 1.0, 1, True), ("A", 2, 100.3, 1.0, 2, True)]
    assert T.trade_alerts(trades(data), policy=TradePolicy(move_pct=0.5, busy_trades=100)).count() == 0


def test_aggregates_stay_hash_based_and_latest_row_is_cut_before_the_shuffle(bound):
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan(T.trade_alerts(bound.trades()))
    assert "SortAggregate" not in plan(M.market_summary(bound.trades()))
    latest = plan(M.latest_per_key(bound.trades(), ["symbol"], F.desc("trade_time"), F.desc("trade_id")))
    assert "WindowGroupLimit" in latest and "Partial" in latest


def test_no_sales_gives_no_ratio(trades):
    assert M.pressure(trades([("A", 1, 10.0, 1.0, 5, False)])).first()["buy_sell_ratio"] is None


def test_recent_is_a_total_order(trades):
    data = [("A", i, 1.0, 1.0, 5, i % 2 == 0) for i in range(9)]
    got = rows(M.recent_trades(T.with_times(trades(data)), 2), "trade_id", "trade_side")
    assert got == [(8, "SELL"), (7, "BUY")]


EVENT = {"e": "trade", "E": 2, "s": "A", "t": 7, "p": "1.5", "q": "2", "b": 1, "a": 2, "T": 1, "m": True}


def test_normalise(spark):
    texts = [
        json.dumps(EVENT),
        json.dumps({"stream": "a@trade", "data": {**EVENT, "t": 8}}),
        json.dumps({**EVENT, "e": "ticker"}),
        json.dumps({**EVENT, "p": "oops"}),
        "{not json",
    ]
    messages = spark.createDataFrame([(t,) for t in texts], "message string")
    now = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    got = wire.normalise_trades(messages, now=now, producer="p1").orderBy("trade_id").collect()
    assert [r["trade_id"] for r in got] == [7, 8]
    first = got[0].asDict()
    assert (first["event_time"], first["trade_time"], first["trade_value"]) == (2, 1, 3.0)
    assert (first["ingestion_time"], first["producer_id"]) == (1704067200000, "p1")
    assert rows(wire.malformed(messages)) == [("{not json",)]


def test_rejected_messages_are_listed(spark):
    from musterline.sources import wire

    sent = [
        '{"e":"trade","p":"1.5","q":"2"}', '{"e":"trade","p":"x","q":"2"}', '{"data":{"e":"trade","p":"1","q":null}}',
        '{"e":"aggTrade","p":"x"}', "not json", '{"p":"1","q":"1"}',
    ]
    got = spark.createDataFrame([(m,) for m in sent], "message string")
    assert sorted(r["reason"] for r in wire.rejected(got).collect()) == [
        "no event type", "not JSON", "unreadable price", "unreadable quantity",
    ]
    assert wire.normalise_trades(got).count() == 1
