"""Registered queries over files whose schema is found on the way, and over input that does not fit."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .plans.bindings import Bindings
from .session import discard, scratch
from .sources import files
from .sources.schemas import VersionedTable
from .streaming import jobs


def _lines(rows: DataFrame, path: str) -> None:
    """One JSON object per row; fields without a value are left out."""
    rows.select(F.to_json(F.struct("*")).alias("value")).write.mode("append").text(path)


def _two_waves(b: Bindings, base: str) -> VersionedTable:
    """Trades of even ids, then those of odd ids: prices become fractional, notes text, and a field is new."""
    even, common = F.col("trade_id") % 2 == 0, ["trade_id", "symbol", "trade_time", "quantity"]
    trades = b.trades()
    waves = (
        trades.where(even).select(*common, F.floor("price").alias("price"), F.col("trade_id").alias("note")),
        trades.where(~even).select(
            *common, "price", F.concat(F.lit("n"), F.col("trade_id").cast("string")).alias("note"), "is_buyer_maker"
        ),
    )
    table = jobs.inferred_table(b.spark, f"{base}/table", f"{base}/schemas", hints="quantity double")
    for wave in waves:
        _lines(wave, f"{base}/landing")
        jobs.ingest_inferred(files.line_stream(b.spark, f"{base}/landing"), table, f"{base}/ckpt").awaitTermination()
    discard(b.spark, f"{base}/landing", f"{base}/ckpt")
    return table


def _schema_waves(b: Bindings) -> DataFrame:
    """All rows of both waves under the schema found in the end."""
    return _two_waves(b, scratch(b.spark, "waves")).read().drop("_rescued", "_corrupt", "_source_file")


def _schema_versions(b: Bindings) -> DataFrame:
    """Fields of every version with their type, and how many values were stored under it."""
    table = _two_waves(b, scratch(b.spark, "versions"))
    parts = []
    for version in table.stored_versions():
        rows, schema = table.of_version(version), table.ledger.at(version)
        for field in schema.fields:
            parts.append(
                rows.agg(F.count(F.col(f"`{field.name}`")).alias("values")).select(
                    F.lit(version).cast("bigint").alias("version"),
                    F.lit(field.name).alias("field"),
                    F.lit(field.dataType.simpleString()).alias("type"),
                    "values",
                )
            )
    return reduce(DataFrame.unionByName, parts)


EXPECTED = "trade_id bigint, price double, quantity bigint, seen struct<symbol:string,at:bigint>"


def _rescued_fields(b: Bindings) -> DataFrame:
    """Messages with added and mistyped fields, some cut short, under a fixed schema."""
    base = scratch(b.spark, "rescue")
    key = F.col("trade_id")
    whole = F.col("quantity").cast("bigint")
    line = F.to_json(
        F.struct(
            "trade_id",
            F.when(key % 7 != 0, F.col("price")).alias("price"),
            F.when(key % 11 == 0, whole + 0.5).alias("half"),
            F.when(key % 11 != 0, whole).alias("quantity"),
            F.struct(F.col("symbol"), F.col("trade_time").alias("at"), F.when(key % 5 == 0, F.lit("floor")).alias("desk")).alias("seen"),
            F.when(key % 3 == 0, F.array(key, key + 1)).alias("route"),
        )
    )
    # Every seventh price is text, and half quantities stand where whole ones are wanted.
    price = F.concat(F.lit('{"price":"none",'), F.substring(line, 2, 1 << 20))
    mistyped = F.replace(F.when(key % 7 == 0, price).otherwise(line), F.lit('"half":'), F.lit('"quantity":'))
    cut = F.when(key % 40 == 0, F.concat(F.lit("{"), F.lit('"trade_id":'), key.cast("string"))).otherwise(mistyped)
    b.trades().select(cut.alias("value")).write.text(f"{base}/landing")
    table = jobs.inferred_table(b.spark, f"{base}/table", f"{base}/schemas", hints=EXPECTED)
    lines = files.line_stream(b.spark, f"{base}/landing")
    jobs.ingest_inferred(lines, table, f"{base}/ckpt", infer=False).awaitTermination()
    discard(b.spark, f"{base}/landing", f"{base}/ckpt")
    return table.read().select(
        "trade_id",
        "price",
        "quantity",
        F.col("seen.symbol").alias("symbol"),
        F.col("seen.at").alias("trade_time"),
        F.col("_rescued").alias("rescued"),
        F.col("_corrupt").alias("corrupt"),
    )


QUERIES: dict[str, Callable[[Bindings], DataFrame]] = {
    "schema_waves": _schema_waves,
    "schema_versions": _schema_versions,
    "rescued_fields": _rescued_fields,
}
