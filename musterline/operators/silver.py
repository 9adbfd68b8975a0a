"""Cleaned and joined layer: organisations, people, tier gaps and attrition."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import numeric as N
from ..policy import Policy


def compliance_status(tier: Column, policy: Policy) -> Column:
    groups = [(policy.good_tiers, "Compliant"), (policy.middle_tiers, "At Risk")]
    return C.label_groups(tier, groups, "Non-Compliant")


def rate_pct(rate: Column) -> Column:
    return F.round(rate * 100, 2)


def org_clean(orgs: DataFrame, as_of: dt.date, policy: Policy = Policy(), now=None) -> DataFrame:
    """Organisations with a key, trimmed text, rate in percent, status, age and headcount bucket."""
    out = (
        C.trimmed(C.require_keys(orgs, "org_id"), "name", "sector", "region")
        .withColumns(
            {
                "rate_pct": rate_pct(F.col("rate")),
                "compliance_status": compliance_status(F.col("tier"), policy),
                "registration_year": F.year("registration_date"),
                "days_since_registration": C.days_between(C.as_date(as_of), F.col("registration_date")),
                "headcount_bucket": C.bucketize(
                    F.col("total"), policy.headcount_edges, policy.headcount_labels, policy.headcount_rest
                ),
            }
        )
        .select(
            "org_id",
            "name",
            "registration_no",
            "sector",
            "size",
            "region",
            "total",
            "nationals",
            "non_nationals",
            "rate_pct",
            "tier",
            "compliance_status",
            "registration_date",
            "registration_year",
            "days_since_registration",
            "headcount_bucket",
            "last_updated",
        )
    )
    return C.stamp(out, "processed_at", now)


def contract_status(end: Column, as_of: dt.date, policy: Policy) -> Column:
    """Status by contract end; the bounds are exclusive, so day 30 is already 'in 90 Days'."""
    today = C.as_date(as_of)
    return (
        F.when(end.isNull(), "No End Date")
        .when(end < today, "Expired")
        .when(end < F.date_add(today, policy.soon_days), "Expiring Soon")
        .when(end < F.date_add(today, policy.later_days), "Expiring in 90 Days")
        .otherwise("Active")
    )


def person_clean(people: DataFrame, as_of: dt.date, policy: Policy = Policy(), now=None) -> DataFrame:
    """People with both keys, trimmed text, national flag, tenure, contract status and salary band."""
    days = C.days_between(C.as_date(as_of), F.col("hire_date"))
    out = (
        C.trimmed(C.require_keys(people, "person_id", "org_id"), "nationality", "job_title", "department")
        .withColumns(
            {
                "is_national": C.flag_eq(F.col("nationality"), policy.national),
                "tenure_days": days,
                "tenure_years": C.tenure_years(days),
                "contract_status": contract_status(F.col("contract_end"), as_of, policy),
                "salary_band": C.bucketize(
                    F.col("salary"), policy.salary_edges, policy.salary_labels, policy.salary_rest
                ),
            }
        )
        .select(
            "person_id",
            "org_id",
            "nationality",
            "is_national",
            "job_title",
            "department",
            "salary",
            "salary_band",
            "contract_type",
            "hire_date",
            "contract_end",
            "contract_status",
            "tenure_days",
            "tenure_years",
            "is_remote",
            "gender",
        )
    )
    return C.stamp(out, "processed_at", now)


def org_people_summary(orgs: DataFrame, people: DataFrame, now=None) -> DataFrame:
    """Every cleaned organisation with headcounts, pay, tenure and expiring contracts of its people.

    People are reduced to one row per organisation before the join, so an
    organisation with very many people costs the join no more than any other.
    """
    national, salary, tenure = F.col("is_national"), F.col("salary"), F.col("tenure_years")
    expiring = lambda status: N.count_where(national & (F.col("contract_status") == status))
    measures = people.groupBy("org_id").agg(
        F.count(F.lit(1)).alias("people"),
        N.count_where(national).alias("national_people"),
        N.count_where(~national).alias("other_people"),
        N.mean(salary, 0).alias("avg_salary"),
        N.mean(F.when(national, salary), 0).alias("avg_national_salary"),
        N.mean(F.when(~national, salary), 0).alias("avg_other_salary"),
        N.mean(tenure, 1, stored=1).alias("avg_tenure_years"),
        expiring("Expiring Soon").alias("national_expiring_30d"),
        expiring("Expiring in 90 Days").alias("national_expiring_90d"),
    )
    variety = distinct_counts(people, "org_id", {"departments": "department", "job_titles": "job_title"})
    out = (
        orgs.select("org_id", "name", "sector", "size", "region", "tier", "compliance_status", "rate_pct")
        .join(measures, "org_id", "left")
        .join(variety, "org_id", "left")
    )
    return C.stamp(out, "processed_at", now)


def distinct_counts(df: DataFrame, key: str, columns: Mapping[str, str]) -> DataFrame:
    """Distinct values per key of several columns, by the name of the result.

    For several distinct counts Spark copies its input once per column, with all
    that other aggregates need. Kept apart from those, the copies hold a key and a
    value only, and the results meet again on the key without another shuffle.
    """
    return df.groupBy(key).agg(*[F.count_distinct(column).alias(name) for name, column in columns.items()])


def org_gap(orgs: DataFrame, rules: DataFrame, policy: Policy = Policy(), now=None) -> DataFrame:
    """Distance of every organisation to each graded tier, and hires to reach the next one.

    A gap is threshold minus rate: positive means short of it. Hires are not
    clamped: a tier label above the true rate shows as a negative number.
    """
    thresholds = [policy.threshold(t) for t in policy.graded]
    joined = orgs.join(rules.select("sector", "size", *thresholds), ["sector", "size"], "left")
    tier = F.col("tier")
    target = policy.next_tier
    hires = F.when(tier == policy.graded[0], F.lit(0).cast("bigint"))
    for name, aim in target.items():
        if aim != policy.graded[-1]:
            hires = hires.when(tier == name, _hires(policy, aim))
    out = joined.select(
        "org_id",
        "name",
        "sector",
        "size",
        "region",
        "total",
        "nationals",
        "rate_pct",
        "tier",
        "compliance_status",
        *thresholds,
        *[
            N.rounded(F.col(policy.threshold(t)) - F.col("rate_pct"), 2).alias(f"gap_to_{t.lower()}")
            for t in policy.graded
        ],
        hires.otherwise(_hires(policy, policy.graded[-1])).alias("hires_for_next_tier"),
        C.map_values(
            tier, {policy.graded[0]: f"Already at {policy.graded[0]}", **target}, policy.graded[-1]
        ).alias("next_tier"),
    )
    return C.stamp(out, "processed_at", now)


def _hires(policy: Policy, tier: str) -> Column:
    return N.hires_needed(F.col("total"), F.col("nationals"), F.col(policy.threshold(tier)))


def attrition_risk(people: DataFrame, orgs: DataFrame, policy: Policy = Policy(), now=None) -> DataFrame:
    """Risk that a person leaves and the organisation's rate without that person."""
    national = F.col("is_national")
    status = F.col("contract_status")
    level = (
        F.when(national & status.isin("Expiring Soon", "Expired"), "Critical")
        .when(national & (status == "Expiring in 90 Days"), "High")
        .when(national & F.col("tier").isin(*policy.exposed_tiers), "Medium")
        .otherwise("Low")
    )
    org = orgs.select(
        "org_id", F.col("name").alias("org_name"), "sector", "tier", "rate_pct", "nationals", "total"
    )
    without = N.pct(F.col("nationals") - 1, F.col("total"), 2)
    out = people.join(C.unaligned(org), "org_id", "inner").select(
        "person_id",
        "org_id",
        "org_name",
        "sector",
        "tier",
        "nationality",
        "is_national",
        "job_title",
        "department",
        "salary",
        "salary_band",
        "hire_date",
        "contract_end",
        "contract_status",
        "tenure_years",
        level.alias("risk_level"),
        F.when(national, without).otherwise(F.col("rate_pct")).alias("rate_pct_if_leaves"),
    )
    return C.stamp(out, "processed_at", now)
