"""Exchange messages to landed trades."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# One-letter keys of the feed and their JSON types, by landed column.
WIRE_FIELDS = {
    "event_type": ("e", "string"),
    "event_time": ("E", "bigint"),
    "symbol": ("s", "string"),
    "trade_id": ("t", "bigint"),
    "price": ("p", "string"),
    "quantity": ("q", "string"),
    "buyer_order_id": ("b", "bigint"),
    "seller_order_id": ("a", "bigint"),
    "trade_time": ("T", "bigint"),
    "is_buyer_maker": ("m", "boolean"),
}
NUMBERS_AS_TEXT = ("price", "quantity")
TRADE = "trade"


def parse_event(message: Column) -> Column:
    """Event as a map of its keys, out of the envelope if there is one; null for text that is not JSON."""
    body = F.coalesce(F.get_json_object(message, "$.data"), message)
    return F.from_json(body, "map<string,string>")


def _events(messages: DataFrame, column: str) -> DataFrame:
    """Typed events, enveloped or not, from one parse of each message.

    The feed has keys that differ only in case, so the parsed structs are turned
    into columns and renamed by position. As generated columns they are computed
    once, however often later filters and projections use them.
    """
    keys = list(WIRE_FIELDS.values())
    inner = ", ".join(f"{key}: {kind}" for key, kind in keys)
    outer = ", ".join(f"{key} {kind}" for key, kind in keys)
    parsed = F.from_json(F.col(column), f"data struct<{inner}>, {outer}")
    bare = [f"bare_{name}" for name in WIRE_FIELDS]
    top = messages.select(F.inline(F.array(parsed))).toDF("data", *bare)
    both = top.select("data", *bare, F.inline(F.array("data"))).toDF("data", *bare, *WIRE_FIELDS)
    enveloped = F.col("data").isNotNull()
    return both.select(
        *[F.when(enveloped, F.col(n)).otherwise(F.col(b)).alias(n) for n, b in zip(WIRE_FIELDS, bare)]
    )


def normalise_trades(
    messages: DataFrame, column: str = "message", now: dt.datetime | Column | None = None, producer: str | None = None
) -> DataFrame:
    """Trades with named, typed columns and their value.

    Other events are left out, as is text that is not JSON or has no readable price and quantity; ``rejected`` lists those.
    """
    numbers = {name: F.col(name).try_cast("double") for name in NUMBERS_AS_TEXT}
    out = (
        _events(messages, column)
        .filter(F.col("event_type") == TRADE)
        .withColumns(numbers)
        .filter(F.col("price").isNotNull() & F.col("quantity").isNotNull())
        .withColumn("trade_value", F.col("price") * F.col("quantity"))
    )
    if now is not None:
        out = out.withColumn("ingestion_time", F.unix_millis(now if isinstance(now, Column) else F.lit(now)))
    return out.withColumn("producer_id", F.lit(producer)) if producer is not None else out


def rejected(messages: DataFrame, column: str = "message") -> DataFrame:
    """Messages that ``normalise_trades`` leaves out although they are trades or cannot be read, with the reason."""
    event = parse_event(F.col(column))
    number = lambda key: event[key].try_cast("double")
    reason = (
        F.when(event.isNull(), "not JSON")
        .when(event["e"] != TRADE, None)
        .when(event["e"].isNull(), "no event type")
        .when(number(WIRE_FIELDS["price"][0]).isNull(), "unreadable price")
        .when(number(WIRE_FIELDS["quantity"][0]).isNull(), "unreadable quantity")
    )
    return messages.withColumn("reason", reason).filter(F.col("reason").isNotNull())


def malformed(messages: DataFrame, column: str = "message") -> DataFrame:
    """Messages that are not a JSON object."""
    return messages.filter(parse_event(F.col(column)).isNull())
