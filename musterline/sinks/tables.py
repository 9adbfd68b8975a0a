"""Writers and catalog helpers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AUDIT = "_ingestion_timestamp TIMESTAMP DEFAULT current_timestamp(), _source_file STRING DEFAULT '{file}'"

# Columns of the raw tables as (name, columns, file the rows come from, comment).
RAW_TABLES = (
    (
        "organisations",
        "org_id STRING, name STRING, registration_no STRING, sector STRING, size STRING, region STRING, total INT, "
        "nationals INT, non_nationals INT, rate DOUBLE, tier STRING, registration_date DATE, last_updated TIMESTAMP",
        "organisations.csv",
        "Organisations as reported",
    ),
    (
        "people",
        "person_id STRING, org_id STRING, nationality STRING, job_title STRING, department STRING, salary INT, "
        "contract_type STRING, hire_date DATE, contract_end DATE, is_remote BOOLEAN, gender STRING",
        "people.csv",
        "People employed by the organisations",
    ),
    (
        "tier_rules",
        "rule_id STRING, sector STRING, size STRING, platinum_pct DOUBLE, high_green_pct DOUBLE, mid_green_pct DOUBLE, "
        "low_green_pct DOUBLE, effective_date DATE, last_updated DATE",
        "tier_rules.csv",
        "Tier thresholds per sector and size",
    ),
    (
        "sector_benchmarks",
        "benchmark_id STRING, sector STRING, avg_pct DOUBLE, median_pct DOUBLE, top_quartile_pct DOUBLE, "
        "bottom_quartile_pct DOUBLE, orgs INT, trend STRING, period STRING, generated_date DATE",
        "sector_benchmarks.csv",
        "Published rates per sector",
    ),
    (
        "alerts",
        "alert_id STRING, org_id STRING, org_name STRING, alert_type STRING, severity STRING, message STRING, "
        "recommended_action STRING, created TIMESTAMP, is_read BOOLEAN",
        "alerts.csv",
        "Compliance alerts",
    ),
)

METRICS = (
    "symbol STRING, trade_count BIGINT, total_volume DOUBLE, total_value DOUBLE, vwap DOUBLE, avg_price DOUBLE, "
    "min_price DOUBLE, max_price DOUBLE, price_range_pct DOUBLE, buy_volume DOUBLE, sell_volume DOUBLE, "
    "buy_sell_ratio DOUBLE, window_start TIMESTAMP, window_end TIMESTAMP, batch_id BIGINT"
)
ALERTS = (
    "symbol STRING, alert_type STRING, current_price DOUBLE, previous_price DOUBLE, price_change_pct DOUBLE, "
    "volume_in_window DOUBLE, trade_count BIGINT, severity STRING, message STRING, alert_time TIMESTAMP, batch_id BIGINT"
)
TRADES = (
    "event_type STRING, event_time BIGINT, symbol STRING, trade_id BIGINT, price DOUBLE, quantity DOUBLE, "
    "buyer_order_id BIGINT, seller_order_id BIGINT, trade_time BIGINT, is_buyer_maker BOOLEAN, trade_value DOUBLE, "
    "ingestion_time BIGINT, producer_id STRING, trade_timestamp TIMESTAMP, processing_time TIMESTAMP, batch_id BIGINT"
)
STREAM_TABLES = (
    ("trades_raw", TRADES, "Trades as ingested"),
    ("trades_analytics", METRICS, "Metrics per symbol and batch"),
    ("price_alerts", ALERTS, "Price and volume alerts"),
)


def ensure_db(spark: SparkSession, *names: str, location: str | None = None) -> None:
    """Create databases that are missing; ``location`` is where a new one keeps its tables."""
    place = f" LOCATION '{location}'" if location else ""
    for name in names:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{place}")


def create_raw_tables(spark: SparkSession, db: str = "bronze") -> None:
    """Raw tables whose two provenance columns fill themselves."""
    ensure_db(spark, db)
    for name, columns, file, comment in RAW_TABLES:
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {db}.{name} ({columns}, {AUDIT.format(file=file)}) "
            f"USING parquet COMMENT '{comment}'"
        )


def create_stream_tables(spark: SparkSession, db: str = "streams", suffix: str = "", replace: bool = False) -> None:
    """Tables of the trade streams, partitioned by batch; ``replace`` drops what is there."""
    ensure_db(spark, db)
    for name, columns, comment in STREAM_TABLES:
        if replace:
            spark.sql(f"DROP TABLE IF EXISTS {db}.{name}{suffix}")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {db}.{name}{suffix} ({columns}) USING parquet "
            f"PARTITIONED BY (batch_id) COMMENT '{comment}'"
        )


def with_provenance(df: DataFrame) -> DataFrame:
    """Add the file a row came from and the time it was read."""
    return df.withColumns(
        {"_ingestion_timestamp": F.current_timestamp(), "_source_file": F.col("_metadata.file_name")}
    )


def write_table(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> None:
    """Replace a table, its schema included. The frame must not read the table it replaces."""
    df.write.mode("overwrite").format("parquet").saveAsTable(name, partitionBy=list(partition_by) or None)


def append_rows(df: DataFrame, name: str) -> None:
    """Append to a declared table by column name; columns left out take their defaults."""
    view = f"_append_{abs(hash(name))}"
    df.createOrReplaceTempView(view)
    columns = ", ".join(df.columns)
    df.sparkSession.sql(f"INSERT INTO {name} ({columns}) SELECT {columns} FROM {view}")


def append_batch(df: DataFrame, batch_id: int, path: str) -> None:
    """Write one micro-batch as its own partition.

    A replayed batch overwrites that partition and no other, so rows are never
    doubled; an empty batch writes nothing.
    """
    (
        df.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(path)
    )


def append_batch_table(df: DataFrame, batch_id: int, table: str) -> None:
    """Same for a catalog table partitioned by ``batch_id``; columns go by name, those left out are null.

    The partition is named in the statement, so no other one is touched.
    """
    spark = df.sparkSession
    declared = [f for f in spark.table(table).schema.fields if f.name != "batch_id"]
    columns = [F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in declared]
    view = f"_batch_of_{table.replace('.', '_')}"
    df.select(*columns).createOrReplaceTempView(view)
    spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION (batch_id = {int(batch_id)}) SELECT * FROM {view}")


def create_view(spark: SparkSession, name: str, sql: str) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {sql}")


def write_ndjson(df: DataFrame, path: str, max_rows: int = 1000, mode: str = "append") -> None:
    """NDJSON files of at most ``max_rows`` records."""
    df.write.mode(mode).option("maxRecordsPerFile", max_rows).json(path)


def layer_counts(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """Rows per table or view in one job; one that cannot be resolved is reported with its error."""
    parts = []
    for name in names:
        try:
            counted = spark.table(name).agg(F.count(F.lit(1)).alias("rows"))
            part = counted.select(F.lit(name).alias("name"), "rows", F.lit(None).cast("string").alias("error"))
        except PySparkException as e:
            part = spark.range(1).select(
                F.lit(name).alias("name"),
                F.lit(None).cast("bigint").alias("rows"),
                F.lit(e.getCondition() or type(e).__name__).alias("error"),
            )
        parts.append(part)
    return reduce(DataFrame.unionByName, parts)
