"""Feature table, encodings, splits and class weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StringIndexer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import numeric as N
from ..policy import Policy
from .silver import distinct_counts


#: Decimals of a salary that count.
CENTS = 2


def people_features(people: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """Pay, mix and diversity of people per organisation."""
    known = people.filter(F.col("org_id").isNotNull())
    pay, pay2 = N.squares(F.col("salary"), CENTS)
    per_org = known.groupBy("org_id").agg(
        F.count("person_id").alias("employee_count"),
        F.count(F.lit(1)).alias("rows"),
        F.count("salary").alias("paid"),
        pay.alias("pay"),
        pay2.alias("pay2"),
        F.min("salary").alias("min_salary"),
        F.max("salary").alias("max_salary"),
        N.count_where(F.col("nationality") == policy.national).alias("national_people"),
        N.count_where(F.col("gender") == "Female").alias("female"),
        N.count_where(F.col("contract_type") == "Permanent").alias("permanent"),
        F.count("is_remote").alias("remote_known"),
        N.count_where(F.col("is_remote")).alias("remote"),
    )

    def share(part: str, of: str):
        return F.try_divide(F.col(part).cast("double"), F.col(of).cast("double"))

    features = per_org.select(
        "org_id",
        "employee_count",
        F.try_divide(F.col("pay").cast("double") / F.lit(float(10**CENTS)), F.col("paid").cast("double")).alias("avg_salary"),
        N.std_from_sums(F.col("paid"), F.col("pay"), F.col("pay2"), CENTS).alias("salary_std"),
        "min_salary",
        "max_salary",
        (F.col("max_salary") - F.col("min_salary")).alias("salary_range"),
        "national_people",
        share("female", "rows").alias("female_ratio"),
        share("permanent", "rows").alias("permanent_ratio"),
        share("remote", "remote_known").alias("remote_ratio"),
    )
    diversity = {
        "department_diversity": "department",
        "job_title_diversity": "job_title",
        "nationality_diversity": "nationality",
    }
    return features.join(distinct_counts(known, "org_id", diversity), "org_id")


def alert_features(alerts: DataFrame) -> DataFrame:
    """Alerts, read or not, per organisation."""
    return (
        alerts.filter(F.col("org_id").isNotNull())
        .groupBy("org_id")
        .agg(F.count("alert_id").alias("total_alerts"), N.count_where(F.col("severity") == "High").alias("high_alerts"))
    )


def org_features(orgs: DataFrame, people: DataFrame, alerts: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """Organisations with features of their people and alerts and the risk label.

    Without alerts the counts are 0; without people the features stay null.
    """
    out = (
        orgs.join(people_features(people, policy), "org_id", "left")
        .join(alert_features(alerts), "org_id", "left")
        .fillna(0, subset=["total_alerts", "high_alerts"])
    )
    risky = (F.col("high_alerts") > 0) | F.coalesce(F.col("tier").isin(*policy.high_risk_tiers), F.lit(False))
    return out.withColumn("at_risk", risky.cast("int"))


def indexer(columns: Sequence[str], suffix: str = "_encoded") -> StringIndexer:
    """Codes per category, in alphabetical order from 0; null and values not seen get a code of their own.

    For columns with few values: their list is gathered when it is fitted.
    """
    return StringIndexer(
        inputCols=list(columns),
        outputCols=[f"{c}{suffix}" for c in columns],
        stringOrderType="alphabetAsc",
        handleInvalid="keep",
    )


def encode(df: DataFrame, columns: Sequence[str], suffix: str = "_encoded") -> DataFrame:
    """Add the codes that these rows give; to code other rows alike, keep the fitted ``indexer``."""
    return indexer(columns, suffix).fit(df).transform(df)


def hash_codes(df: DataFrame, columns: Sequence[str], suffix: str = "_encoded", codes: int = 1024) -> DataFrame:
    """Add a code per value from a hash: nothing to fit and the same for any table; null is code 0."""
    return df.withColumns({f"{c}{suffix}": F.when(F.col(c).isNull(), 0).otherwise(F.pmod(F.xxhash64(c), F.lit(codes - 1)) + 1) for c in columns})


def _draw(key: str, seed: int):
    return F.xxhash64(F.col(key), F.lit(seed))


def split(df: DataFrame, key: str, fraction: float = 0.2, seed: int = 42) -> DataFrame:
    """Mark about ``fraction`` of the rows as test rows, by the MD5 of their key: no shuffle, always the same rows, in any engine."""
    digest = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))).cast("binary"))
    draw = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return df.withColumn("is_test", draw % 10_000 < round(fraction * 10_000))


def stratified_split(
    df: DataFrame, key: str, label: str, fraction: float = 0.2, seed: int = 42, slices: int = 1024
) -> DataFrame:
    """Mark exactly ``round(fraction * n)`` rows of every label as test rows.

    Each label's rows are cut into hash slices. Counting the slices tells which lie
    wholly on one side; only the one slice where the quota ends is ranked row by row,
    in a pass of its own. No task ever holds a whole label. Rows without a label are left out.
    """
    sliced = df.filter(F.col(label).isNotNull()).withColumn("_slice", F.pmod(_draw(key, seed), F.lit(slices)))
    counts = sliced.groupBy(label, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(label)
    # At most ``slices`` rows per label.
    edges = (
        counts.withColumn("_quota", F.round(F.sum("_n").over(whole) * fraction, 0).cast("bigint"))
        .withColumn("_upto", F.sum("_n").over(whole.orderBy("_slice")))
        .select(label, "_slice", "_n", (F.col("_quota") - F.col("_upto") + F.col("_n")).alias("_left"))
    )
    placed = sliced.join(edges, [label, "_slice"])
    cut = (F.col("_left") > 0) & (F.col("_left") < F.col("_n"))
    settled = placed.filter(~cut).withColumn("is_test", F.col("_left") > 0)
    rank = F.row_number().over(Window.partitionBy(label, "_slice").orderBy(_draw(key, seed), key))
    ranked = placed.filter(cut).withColumn("is_test", rank <= F.col("_left"))
    return settled.unionByName(ranked).select(*df.columns, "is_test")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Rows per label with the balanced weight n / (k * n_label) and, over the whole, its share of the others."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))
    # One row per label.
    everything = Window.partitionBy()
    total = F.sum("count").over(everything).cast("double")
    labels = F.count(F.lit(1)).over(everything).cast("double")
    return counts.select(
        label,
        "count",
        (total / (labels * F.col("count"))).alias("balanced_weight"),
        ((total - F.col("count")) / F.col("count")).alias("rest_ratio"),
    )
