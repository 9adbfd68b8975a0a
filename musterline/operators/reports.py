"""Distributions and grouped statistics behind the charts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import numeric as N


def value_counts(df: DataFrame, column: str, share_places: int = 1) -> DataFrame:
    """Rows per value with their share in percent, most frequent first; nulls are left out.

    The total is a scalar subquery, so a column of very many values is not gathered for it.
    """
    known = df.filter(F.col(column).isNotNull())
    counts = known.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    return (
        counts.withColumn("total", known.agg(F.count(F.lit(1))).scalar())
        .select(column, "count", N.pct(F.col("count"), F.col("total"), share_places).alias("share_pct"))
        .orderBy(F.desc("count"), column)
    )


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """Rows per equal-width bin between lowest and highest value, empty bins included, with the overall mean.

    The highest value belongs to the last bin. Lowest, highest and mean come from one
    scalar subquery, which runs once.
    """
    values = df.select(F.col(column).cast("double").alias("v")).filter(F.col("v").isNotNull())
    facts = values.agg(
        F.struct(F.min("v").alias("low"), F.max("v").alias("high"), N.average(F.col("v"), 10).alias("mean"))
    ).scalar()
    low, high = F.col("facts.low"), F.col("facts.high")
    place = F.floor(F.try_divide((F.col("v") - low) * bins, high - low))
    counted = (
        values.withColumn("facts", facts)
        .select(F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1)).cast("bigint").alias("bin"))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    width = (high - low) / F.lit(float(bins))
    every = df.sparkSession.range(bins).withColumnRenamed("id", "bin")
    return every.join(counted, "bin", "left").withColumn("facts", facts).select(
        "bin",
        N.rounded(low + F.col("bin") * width, 4).alias("bin_start"),
        N.rounded(low + (F.col("bin") + 1) * width, 4).alias("bin_end"),
        F.coalesce(F.col("n"), F.lit(0)).alias("count"),
        N.rounded(F.col("facts.mean"), 4).alias("mean"),
    )


def crosstab(df: DataFrame, rows: str, columns: str, values: Sequence[str], rest: str = "other") -> DataFrame:
    """Rows counted per pair of categories, one column per value, missing pairs as 0.

    Values that are not listed, null included, are counted in the column ``rest``.
    """
    kind = F.when(F.col(columns).isin(list(values)), F.col(columns)).otherwise(F.lit(rest))
    counted = df.select(rows, kind.alias(columns))
    return counted.groupBy(rows).pivot(columns, [*values, rest]).agg(F.count(F.lit(1))).na.fill(0, [*values, rest])


def describe_by(df: DataFrame, key: str, value: str, places: int = 0) -> DataFrame:
    """Mean, sample standard deviation, lowest and highest value per group of rows."""
    v = F.col(value).cast("double")
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            N.rounded(N.average(v, 6), places).alias("mean"),
            N.rounded(F.stddev_samp(v), places).alias("std"),
            F.min(value).alias("min"),
            F.max(value).alias("max"),
        )
    )


#: Decimals of a salary that count.
CENTS = 2


def salary_by_sector(people: DataFrame, orgs: DataFrame, places: int = 0) -> DataFrame:
    """Salary statistics per sector. People are summed per organisation first, so the
    join carries one row per organisation instead of one per person."""
    s, s2 = N.squares(F.col("salary"), CENTS)
    per_org = people.groupBy("org_id").agg(
        F.count("salary").alias("n"), s.alias("s"), s2.alias("s2"), F.min("salary").alias("min"), F.max("salary").alias("max")
    )
    sums = (
        per_org.join(orgs.select("org_id", "sector"), "org_id")
        .filter(F.col("sector").isNotNull())
        .groupBy("sector")
        .agg(
            F.sum("n").alias("n"),
            F.sum("s").cast("decimal(38,0)").alias("s"),
            F.sum("s2").cast("decimal(38,0)").alias("s2"),
            F.min("min").alias("min"),
            F.max("max").alias("max"),
        )
    )
    mean = F.col("s").cast("double") / F.col("n") / F.lit(float(10**CENTS))
    return sums.select(
        "sector",
        N.rounded(F.when(F.col("n") > 0, mean), places).alias("mean"),
        N.rounded(N.std_from_sums(F.col("n"), F.col("s"), F.col("s2"), CENTS), places).alias("std"),
        "min",
        "max",
    )


def mean_by(df: DataFrame, key: str, value: str, times: int = 1, places: int = 2) -> DataFrame:
    """Mean of a double per group, lowest first."""
    mean = N.average(F.col(value) * times, 10)
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(N.rounded(mean, places).alias("mean"))
        .orderBy("mean", key)
    )
