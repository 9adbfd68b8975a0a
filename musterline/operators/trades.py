"""Trade metrics and alerts as plain DataFrame logic, shared by batch and stream."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import numeric as N
from ..policy import TradePolicy


def with_times(df: DataFrame) -> DataFrame:
    """Add the trade's timestamp next to its epoch milliseconds."""
    return df.withColumn("trade_timestamp", F.timestamp_millis("trade_time"))


def order_key() -> Column:
    return C.event_key(F.col("trade_time"), F.col("trade_id"))


def trade_metrics(
    df: DataFrame,
    keys: Sequence[Column | str] = ("symbol",),
    policy: TradePolicy = TradePolicy(),
    extra: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Count, volume, value, VWAP, price range and buy / sell volume per symbol (or other keys).

    ``extra`` names further aggregates to take along.
    A trade whose buyer is the market maker is a sale. Symbols are few and one may
    hold most trades; all measures combine on the map side, so only one row per
    task and symbol is shuffled.
    """
    price, quantity, maker = F.col("price"), F.col("quantity"), F.col("is_buyer_maker")
    places = policy.places
    grouped = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("trade_count"),
        N.total(quantity, places).alias("volume"),
        N.total(F.col("trade_value"), places).alias("value"),
        N.weighted_avg(price, quantity, places).alias("vwap_raw"),
        N.average(price, places).alias("avg_raw"),
        F.min("price").alias("low"),
        F.max("price").alias("high"),
        N.total(F.when(~maker, quantity).otherwise(0.0), places).alias("bought"),
        N.total(F.when(maker, quantity).otherwise(0.0), places).alias("sold"),
        *[measure.alias(name) for name, measure in (extra or {}).items()],
    )
    return _shown(grouped, len(keys), policy, extra)


def _shown(grouped: DataFrame, keys: int, policy: TradePolicy, extra: Mapping[str, Column] | None = None) -> DataFrame:
    """Rounded metrics from the totals of every group."""
    return grouped.select(
        *grouped.columns[:keys],
        "trade_count",
        F.round("volume", 6).alias("total_volume"),
        F.round("value", 2).alias("total_value"),
        N.rounded(F.col("vwap_raw"), 4).alias("vwap"),
        N.rounded(F.col("avg_raw"), 4).alias("avg_price"),
        F.round("low", 4).alias("min_price"),
        F.round("high", 4).alias("max_price"),
        N.rounded(N.safe_div(F.col("high") - F.col("low"), F.col("avg_raw")) * 100, 4).alias("price_range_pct"),
        F.round("bought", 6).alias("buy_volume"),
        F.round("sold", 6).alias("sell_volume"),
        N.rounded(N.safe_div(F.col("bought"), F.col("sold"), policy.ratio_guard), 4).alias("buy_sell_ratio"),
        *(extra or {}),
    )


def trade_parts(df: DataFrame, keys: Sequence[Column | str], policy: TradePolicy = TradePolicy()) -> DataFrame:
    """What the metrics of a group need of some of its trades; parts of a group can be stored and put together later."""
    price, quantity, maker = F.col("price"), F.col("quantity"), F.col("is_buyer_maker")
    part = lambda value: N.part_of_total(value, policy.places)
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("trade_count"),
        F.count("price").alias("priced"),
        part(quantity).alias("volume"),
        part(F.col("trade_value")).alias("value"),
        part(price * quantity).alias("weighted"),
        part(price).alias("prices"),
        F.min("price").alias("low"),
        F.max("price").alias("high"),
        part(F.when(~maker, quantity).otherwise(0.0)).alias("bought"),
        part(F.when(maker, quantity).otherwise(0.0)).alias("sold"),
    )


def metrics_of_parts(parts: DataFrame, keys: Sequence[Column | str], policy: TradePolicy = TradePolicy()) -> DataFrame:
    """``trade_metrics`` over the trades behind ``parts``."""
    total = lambda name: N.total_of_parts(F.col(name), policy.places)
    grouped = parts.groupBy(*keys).agg(
        F.sum("trade_count").alias("trade_count"),
        total("volume").alias("volume"),
        total("value").alias("value"),
        F.try_divide(total("weighted"), total("volume")).alias("vwap_raw"),
        F.try_divide(total("prices"), F.sum("priced").cast("double")).alias("avg_raw"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        total("bought").alias("bought"),
        total("sold").alias("sold"),
    )
    return _shown(grouped, len(keys), policy)


def trade_alerts(df: DataFrame, keys: Sequence[str] = ("symbol",), policy: TradePolicy = TradePolicy()) -> DataFrame:
    """At most one alert per symbol: a price move beyond the threshold or else a volume spike.

    The move is from the first to the last trade by time, ties by trade id.
    """
    key = order_key()
    moves = (
        df.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("trade_count"),
            C.opening(F.col("price"), key).alias("previous_price"),
            C.closing(F.col("price"), key).alias("current_price"),
            N.total(F.col("quantity"), policy.places).alias("volume_in_window"),
            F.max("trade_time").alias("last_trade_time"),
        )
        .withColumn(
            "price_change_pct",
            N.rounded(N.safe_div(F.col("current_price") - F.col("previous_price"), F.col("previous_price")) * 100, 4),
        )
    )
    change = F.col("price_change_pct")
    moved = F.coalesce(F.abs(change) > policy.move_pct, F.lit(False))
    busy = F.col("trade_count") > policy.busy_trades
    direction = F.when(change > 0, "UP").otherwise("DOWN")
    text_move = F.format_string(
        "%s price moved %s %.2f%% ($%,.2f → $%,.2f)",
        F.col("symbol"),
        direction,
        F.abs(change),
        F.col("previous_price"),
        F.col("current_price"),
    )
    text_busy = F.format_string("%s volume spike: %d trades in batch", F.col("symbol"), F.col("trade_count"))
    return moves.filter(moved | busy).select(
        *keys,
        F.when(moved, F.concat(F.lit("PRICE_"), direction)).otherwise("VOLUME_SPIKE").alias("alert_type"),
        "current_price",
        "previous_price",
        "price_change_pct",
        "volume_in_window",
        "trade_count",
        F.when(moved & (F.abs(change) > policy.high_move_pct), "HIGH").otherwise("MEDIUM").alias("severity"),
        F.when(moved, text_move).otherwise(text_busy).alias("message"),
        F.timestamp_millis("last_trade_time").alias("alert_time"),
    )
