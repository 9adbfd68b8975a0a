"""Expectations applied while rows are written: one scan gives kept rows, rejected rows with the rules they break, and counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import exists
from .quality import Expectation

BROKEN, REJECTED = "_broken_rules", "_is_rejected"
COUNTS = "expectation string, policy string, rows_checked bigint, violations bigint"


class Gate:
    """Row expectations for batches and streams alike.

    Every row gets the names of the rules it breaks; rows that break a ``drop`` rule are rejected. The counts are taken from
    the rows on their way to the table, so nothing is read twice.
    """

    def __init__(self, rules: Sequence[Expectation]):
        self.rules = tuple(rules)

    def marked(self, rows: DataFrame) -> DataFrame:
        """Rows with the names of the rules they break, in the order of the rules, and whether they are rejected."""
        names = [F.when(~r.met(), F.lit(r.name)) for r in self.rules]
        broken = F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")
        drops = [r.name for r in self.rules if r.policy == "drop"]
        hit = F.arrays_overlap(F.col(BROKEN), F.array(*map(F.lit, drops))) if drops else F.lit(False)
        # Generated, so that a rule is evaluated once however often its outcome is used.
        return rows.select("*", F.explode(F.array(broken)).alias(BROKEN)).withColumn(REJECTED, F.coalesce(hit, F.lit(False)))

    def measures(self) -> list[Column]:
        """Counts over marked rows: all of them, and those that break each rule."""
        each = [F.count_if(F.array_contains(BROKEN, r.name)).alias(f"v{i}") for i, r in enumerate(self.rules)]
        return [F.count(F.lit(1)).alias("total"), *each]

    def counts(self, spark: SparkSession, seen: Mapping[str, int]) -> DataFrame:
        """Violations per rule."""
        rows = [(r.name, r.policy, int(seen["total"] or 0), int(seen[f"v{i}"] or 0)) for i, r in enumerate(self.rules)]
        return spark.createDataFrame(rows, COUNTS)

    def write(self, rows: DataFrame, path: str, batch_id: int = 0) -> DataFrame:
        """Write a batch in one pass; returns its counts, which are stored beside the rows.

        Kept and rejected rows are partitions of one table. A batch that runs again takes its own place.
        """
        seen = Observation()
        marked = self.marked(rows).withColumn("batch_id", F.lit(batch_id).cast("bigint")).observe(seen, *self.measures())
        marked.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id", REJECTED).parquet(f"{path}/rows")
        counts = self.counts(rows.sparkSession, seen.get)
        counts.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("batch_id").parquet(f"{path}/counts")
        return counts


class Gated:
    """What a gate has written to a folder, over all batches. ``schema`` is that of the rows."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path, schema

    def _rows(self) -> DataFrame:
        shape = f"{self.schema}, {BROKEN} array<string>, batch_id bigint, {REJECTED} boolean"
        where = f"{self.path}/rows"
        return self.spark.read.schema(shape).parquet(where) if exists(self.spark, where) else self.spark.createDataFrame([], shape)

    def kept(self) -> DataFrame:
        """Rows that passed; those with warnings keep their names."""
        return self._rows().where(~F.col(REJECTED)).drop(REJECTED)

    def rejected(self) -> DataFrame:
        return self._rows().where(F.col(REJECTED)).drop(REJECTED)

    def counts(self) -> DataFrame:
        """Violations per rule over all batches."""
        stored = self.spark.read.schema(f"{COUNTS}, batch_id bigint").parquet(f"{self.path}/counts")
        return stored.groupBy("expectation", "policy").agg(*[F.sum(c).alias(c) for c in ("rows_checked", "violations")])
