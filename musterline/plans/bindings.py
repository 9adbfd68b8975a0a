"""Raw tables of both domains derived from the star-schema test tables.

The bindings give every operator realistic input of any size: all columns come
from the given tables; only the rule and benchmark lookups are small fixed lists.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..policy import Policy

AS_OF = dt.date(2000, 1, 1)
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
POLICY = replace(Policy(), national="N", sectors=SEGMENTS)


# Columns of the test tables that are used. A reader with a schema opens no file to infer one.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


class Bindings:
    """Raw frames over one folder of test tables."""

    def __init__(self, spark: SparkSession, folder: str):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.folder}/{name}.parquet")

    def rules(self) -> DataFrame:
        """Thresholds for 5 sectors x 4 sizes: a base plus a step per size and per sector.

        Written as VALUES, so the planner knows the size and can choose a broadcast.
        """
        rows = []
        for s, sector in enumerate(SEGMENTS):
            for z, size in enumerate(POLICY.sizes):
                bounds = ", ".join(f"{base + 2 * z + s + z / 8}D" for base in (48, 38, 28, 18))
                rows.append(f"('R{s}{z}', '{sector}', '{size}', {bounds}, DATE'1992-01-01', DATE'1992-01-01')")
        columns = ", ".join(["rule_id", "sector", "size", *map(POLICY.threshold, POLICY.graded)])
        return self.spark.sql(
            f"SELECT * FROM VALUES {', '.join(rows)} AS rules({columns}, effective_date, last_updated)"
        )

    def benchmarks(self) -> DataFrame:
        """Benchmarks of all sectors but one, so the left join has an unmatched side."""
        return self.spark.sql(
            """
            SELECT * FROM VALUES
              ('B1', 'AUTOMOBILE', 31.5D, 30.0D, 41.0D, 20.5D, 300, 'up', '1999', DATE'1999-12-31'),
              ('B2', 'BUILDING', 33.25D, 32.0D, 43.5D, 22.0D, 280, 'flat', '1999', DATE'1999-12-31'),
              ('B3', 'FURNITURE', 29.0D, 28.5D, 39.0D, 18.0D, 310, 'down', '1999', DATE'1999-12-31'),
              ('B4', 'HOUSEHOLD', 35.75D, 34.0D, 45.25D, 24.5D, 290, 'up', '1999', DATE'1999-12-31')
            AS benchmarks(benchmark_id, sector, avg_pct, median_pct, top_quartile_pct, bottom_quartile_pct, orgs,
                          trend, period, generated_date)
            """
        )

    def orgs(self) -> DataFrame:
        """One organisation per customer; its workforce is the customer's orders."""
        work = (
            self.table("orders")
            .groupBy(F.col("o_custkey").alias("org_id"))
            .agg(
                F.count("o_orderkey").alias("total"),
                F.count_if(F.col("o_orderstatus") == "F").alias("nationals"),
                F.min("o_orderdate").alias("first_order"),
                F.max("o_orderdate").alias("last_updated"),
            )
        )
        place = (
            self.table("nation")
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select("n_nationkey", F.col("r_name").alias("region"))
        )
        total = F.coalesce(F.col("total"), F.lit(0))
        base = (
            self.table("customer")
            .join(work, F.col("c_custkey") == F.col("org_id"), "left")
            .join(place, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("c_custkey").alias("org_id"),
                F.col("c_name").alias("name"),
                F.concat(F.lit("CR-"), F.col("c_custkey").cast("string")).alias("registration_no"),
                F.col("c_mktsegment").alias("sector"),
                F.when(total < 8, "Micro").when(total < 10, "Small").when(total < 12, "Medium").otherwise("Large").alias("size"),
                "region",
                total.cast("int").alias("total"),
                F.coalesce(F.col("nationals"), F.lit(0)).cast("int").alias("nationals"),
                F.col("first_order").cast("date").alias("registration_date"),
                "last_updated",
            )
            .withColumn("non_nationals", F.col("total") - F.col("nationals"))
            .withColumn("rate", F.try_divide(F.col("nationals").cast("double"), F.col("total").cast("double")))
        )
        thresholds = [POLICY.threshold(t) for t in POLICY.graded]
        rate = F.col("rate") * 100
        tier = F.when(rate >= F.col(thresholds[0]), POLICY.graded[0])
        for name, bound in list(zip(POLICY.graded, thresholds))[1:]:
            tier = tier.when(rate >= F.col(bound), name)
        tier = tier.when(rate >= POLICY.floor_pct, POLICY.floor_tier).otherwise(POLICY.bottom_tier)
        return base.join(self.rules().select("sector", "size", *thresholds), ["sector", "size"], "left").select(
            "org_id",
            "name",
            "registration_no",
            "sector",
            "size",
            "region",
            "total",
            "nationals",
            "non_nationals",
            "rate",
            tier.alias("tier"),
            "registration_date",
            "last_updated",
        )

    def reported_orgs(self) -> DataFrame:
        """Organisations as reported: some rows break each of the quality checks."""
        key = F.col("org_id")
        every = lambda n: key % n == 0
        return self.orgs().withColumns(
            {
                "org_id": F.when(every(67), None).when(every(61), key - 1).otherwise(key),
                "name": F.when(~every(97), F.col("name")),
                "sector": F.when(every(89), "MINING").otherwise(F.col("sector")),
                "size": F.when(every(83), "Huge").otherwise(F.col("size")),
                "tier": F.when(every(79), "Blue").otherwise(F.col("tier")),
                "total": F.when(every(71), 0).otherwise(F.col("total")),
                "nationals": F.when(every(73), -1).otherwise(F.col("nationals")),
                "rate": F.when(every(59), 1.5)
                .when(every(50), (F.floor(F.col("rate") * 100) + 5) / 100.0)
                .otherwise(F.col("rate")),
                "non_nationals": F.col("non_nationals") + F.when(every(75), 1).otherwise(0),
            }
        )

    def reported_people(self) -> DataFrame:
        """People as reported: missing and repeated ids, unknown organisations, values off the lists."""
        key = F.col("person_id")
        every = lambda n: key % n == 0
        return self.people().withColumns(
            {
                "person_id": F.when(every(101), None).when(every(103), 1).otherwise(key),
                "nationality": F.when(~every(107), F.col("nationality")),
                "org_id": F.when(every(109), F.col("org_id") + 1_000_000_000)
                .when(every(113), None)
                .otherwise(F.col("org_id")),
                "contract_type": F.when(every(127), "Casual").otherwise(F.col("contract_type")),
                "gender": F.when(every(131), "?").otherwise(F.col("gender")),
            }
        )

    def people(self) -> DataFrame:
        """One person per order, employed by the customer who placed it."""
        key = F.col("o_orderkey")
        hired = F.col("o_orderdate").cast("date")
        end = F.when(key % 5 != 0, F.date_add(hired, 1095))
        return self.table("orders").select(
            key.alias("person_id"),
            F.col("o_custkey").alias("org_id"),
            F.when(F.col("o_orderstatus") == "F", "N").otherwise(F.col("o_orderstatus")).alias("nationality"),
            F.col("o_orderpriority").alias("job_title"),
            F.concat(F.lit("Dept "), (key % 7).cast("string")).alias("department"),
            F.floor("o_totalprice").cast("int").alias("salary"),
            F.when(end.isNull(), "Permanent").otherwise("Fixed-term").alias("contract_type"),
            hired.alias("hire_date"),
            end.alias("contract_end"),
            (key % 3 == 0).alias("is_remote"),
            F.when(key % 2 == 0, "Male").otherwise("Female").alias("gender"),
        )

    def alerts(self) -> DataFrame:
        """One alert per event, raised for the customer behind it."""
        kind = F.col("event_type")
        named = self.table("customer").select("c_custkey", F.col("c_name").alias("org_name"))
        return (
            self.table("events")
            .join(named, F.col("user_id") == F.col("c_custkey"), "left")
            .select(
                F.col("event_id").alias("alert_id"),
                F.col("user_id").alias("org_id"),
                "org_name",
                kind.alias("alert_type"),
                F.when(kind == "error", "High").when(kind == "purchase", "Medium").otherwise("Low").alias("severity"),
                F.concat(kind, F.lit(" reported")).alias("message"),
                F.concat(F.lit("Review "), kind).alias("recommended_action"),
                F.col("ts").alias("created"),
                (F.col("event_id") % 3 == 0).alias("is_read"),
            )
        )

    def wire_messages(self) -> DataFrame:
        """Exchange messages as they arrive: JSON text, every second one in an envelope, some not trades."""
        ms = F.unix_millis(F.col("ts").cast("timestamp"))
        event = F.struct(
            F.when(F.col("event_id") % 7 == 0, "aggTrade").otherwise("trade").alias("e"),
            ms.alias("E"),
            F.col("event_type").alias("s"),
            F.col("event_id").alias("t"),
            F.col("value").cast("string").alias("p"),
            F.get_json_object("props", "$.k").alias("q"),
            (F.col("event_id") * 2).alias("b"),
            (F.col("event_id") * 2 + 1).alias("a"),
            ms.alias("T"),
            (F.col("user_id") % 2 == 0).alias("m"),
        )
        stream = F.concat(F.col("event_type"), F.lit("@trade"))
        wrapped = F.to_json(F.struct(stream.alias("stream"), event.alias("data")))
        return self.table("events").select(
            F.when(F.col("event_id") % 2 == 0, wrapped).otherwise(F.to_json(event)).alias("message")
        )

    def faulty_messages(self) -> DataFrame:
        """Exchange messages of which some are no JSON or hold a price or quantity that is no number."""
        key = F.get_json_object(F.coalesce(F.get_json_object("message", "$.data"), F.col("message")), "$.t").cast("bigint")
        price, quantity = r'"p":"[^"]*"', r'"q":"[^"]*"'
        return self.wire_messages().select(
            F.when(key % 23 == 0, F.concat(F.lit("garbage "), key.cast("string")))
            .when(key % 17 == 0, F.regexp_replace("message", price, '"p":"n/a"'))
            .when(key % 19 == 0, F.regexp_replace("message", quantity, '"q":null'))
            .otherwise(F.col("message"))
            .alias("message")
        )

    def trades(self) -> DataFrame:
        """Trades as they land in files, one per event."""
        ms = F.unix_millis(F.col("ts").cast("timestamp"))
        quantity = F.get_json_object("props", "$.k").cast("double")
        return self.table("events").select(
            F.lit("trade").alias("event_type"),
            ms.alias("event_time"),
            F.col("event_type").alias("symbol"),
            F.col("event_id").alias("trade_id"),
            F.col("value").alias("price"),
            quantity.alias("quantity"),
            (F.col("event_id") * 2).alias("buyer_order_id"),
            (F.col("event_id") * 2 + 1).alias("seller_order_id"),
            ms.alias("trade_time"),
            (F.col("user_id") % 2 == 0).alias("is_buyer_maker"),
            (F.col("value") * quantity).alias("trade_value"),
            ms.alias("ingestion_time"),
            F.lit("bindings").alias("producer_id"),
        )
