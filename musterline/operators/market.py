"""Dashboard queries over stored trades, metrics and alerts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import numeric as N
from ..policy import TradePolicy
from .trades import order_key


def latest_per_key(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """The first row of every key in the given order.

    Filtering the row number lets Spark keep one row per key and task before the
    shuffle, so a hot key is not gathered in one task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def _value_where(condition: Column, policy: TradePolicy) -> Column:
    return N.total(F.when(condition, F.col("trade_value")).otherwise(0.0), policy.places)


def market_summary(trades: DataFrame, policy: TradePolicy = TradePolicy()) -> DataFrame:
    """Latest price, change since the first trade, totals and buy / sell ratio per symbol, from one aggregation."""
    key = order_key()
    maker, quantity = F.col("is_buyer_maker"), F.col("quantity")
    per_symbol = trades.groupBy("symbol").agg(
        C.closing(F.col("price"), key).alias("last"),
        C.opening(F.col("price"), key).alias("open"),
        F.count(F.lit(1)).alias("total_trades"),
        N.total(F.col("trade_value"), policy.places).alias("value"),
        F.min("price").alias("low"),
        F.max("price").alias("high"),
        N.total(F.when(~maker, quantity).otherwise(0.0), policy.places).alias("bought"),
        N.total(F.when(maker, quantity).otherwise(0.0), policy.places).alias("sold"),
    )
    return per_symbol.select(
        "symbol",
        F.round("last", 2).alias("current_price"),
        N.rounded(N.safe_div(F.col("last") - F.col("open"), F.col("open")) * 100, 2).alias("change_pct"),
        "total_trades",
        F.round("value", 2).alias("volume_value"),
        F.round("low", 2).alias("session_low"),
        F.round("high", 2).alias("session_high"),
        N.rounded(N.safe_div(F.col("bought"), F.col("sold")), 2).alias("buy_sell_ratio"),
    ).orderBy(F.desc("volume_value"), "symbol")


def market_lite(trades: DataFrame, policy: TradePolicy = TradePolicy()) -> DataFrame:
    """Totals and price range per symbol."""
    return (
        trades.groupBy("symbol")
        .agg(
            F.count(F.lit(1)).alias("total_trades"),
            F.round(N.total(F.col("trade_value"), policy.places), 2).alias("total_volume_value"),
            F.round(F.min("price"), 2).alias("low"),
            F.round(F.max("price"), 2).alias("high"),
            N.rounded(N.average(F.col("price"), policy.places), 2).alias("avg_price"),
        )
        .orderBy(F.desc("total_volume_value"), "symbol")
    )


def session_rollup(metrics: DataFrame, policy: TradePolicy = TradePolicy()) -> DataFrame:
    """Stored per-batch metrics rolled up per symbol; averages are over batches, not trades."""
    return (
        metrics.groupBy("symbol")
        .agg(
            F.sum("trade_count").alias("total_trades"),
            F.round(N.total(F.col("total_value"), policy.places), 2).alias("total_volume_value"),
            N.mean(F.col("vwap"), 2, stored=4).alias("avg_vwap"),
            F.round(F.min("min_price"), 2).alias("session_low"),
            F.round(F.max("max_price"), 2).alias("session_high"),
            N.mean(F.col("buy_sell_ratio"), 2, stored=4).alias("avg_buy_sell_ratio"),
        )
        .orderBy(F.desc("total_volume_value"), "symbol")
    )


def volume_over_time(trades: DataFrame, unit: str = "minute", policy: TradePolicy = TradePolicy()) -> DataFrame:
    """Trades, value and mean price per symbol and time unit."""
    return trades.groupBy(F.date_trunc(unit, "trade_timestamp").alias(unit), "symbol").agg(
        F.count(F.lit(1)).alias("trades"),
        F.round(N.total(F.col("trade_value"), policy.places), 2).alias("volume_value"),
        N.rounded(N.average(F.col("price"), policy.places), 2).alias("avg_price"),
    )


def live_activity(trades: DataFrame, minutes: int, now: dt.datetime | Column, policy: TradePolicy = TradePolicy()) -> DataFrame:
    """Trades and mean price per second over the last minutes, newest first."""
    return (
        C.since(trades, "trade_timestamp", minutes, now)
        .groupBy(F.date_trunc("second", "trade_timestamp").alias("second"), "symbol")
        .agg(
            F.count(F.lit(1)).alias("trades"),
            N.rounded(N.average(F.col("price"), policy.places), 2).alias("price"),
        )
        .orderBy(F.desc("second"), "symbol")
    )


def pressure(trades: DataFrame, policy: TradePolicy = TradePolicy()) -> DataFrame:
    """Buying against selling per symbol; no ratio without sales."""
    maker = F.col("is_buyer_maker")
    return (
        trades.groupBy("symbol")
        .agg(
            F.count(F.lit(1)).alias("total_trades"),
            N.count_where(~maker).alias("buy_trades"),
            N.count_where(maker).alias("sell_trades"),
            _value_where(~maker, policy).alias("bought"),
            _value_where(maker, policy).alias("sold"),
        )
        .select(
            "symbol",
            "total_trades",
            "buy_trades",
            "sell_trades",
            F.round("bought", 2).alias("buy_value"),
            F.round("sold", 2).alias("sell_value"),
            N.rounded(N.safe_div(F.col("bought"), F.col("sold")), 2).alias("buy_sell_ratio"),
        )
        .orderBy(F.desc("total_trades"), "symbol")
    )


def recent_trades(trades: DataFrame, n: int = 50) -> DataFrame:
    """The latest ``n`` trades with their side."""
    return (
        trades.orderBy(F.desc("trade_timestamp"), F.desc("trade_id"))
        .limit(n)
        .select(
            "trade_timestamp",
            "symbol",
            "trade_id",
            "price",
            "quantity",
            "trade_value",
            F.when(F.col("is_buyer_maker"), "SELL").otherwise("BUY").alias("trade_side"),
        )
    )


def recent_alerts(alerts: DataFrame, n: int = 20) -> DataFrame:
    """The latest ``n`` alerts."""
    return (
        alerts.orderBy(F.desc("alert_time"), "symbol")
        .limit(n)
        .select("alert_time", "symbol", "alert_type", "severity", "message", "price_change_pct")
    )
