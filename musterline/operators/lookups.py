"""Parameterised lookups, as DataFrames; ``plans.sql_functions`` registers the same as SQL functions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import numeric as N
from ..policy import Policy
from . import planning
from .silver import compliance_status, rate_pct


def first_match(df: DataFrame, condition: Column, *order: str) -> DataFrame:
    """One row that meets the condition; the order makes the choice repeatable."""
    return df.filter(condition).orderBy(*order).limit(1)


def find_org(orgs: DataFrame, name: str) -> DataFrame:
    return first_match(orgs, C.name_like(F.col("name"), name), "name", "org_id")


def people_of(people: DataFrame, orgs: DataFrame, name: str) -> DataFrame:
    """People of all organisations whose name contains ``name``, once each.

    One join for any number of matches: the planner broadcasts few ids and splits a heavy one when there are many.
    """
    matching = orgs.filter(C.name_like(F.col("name"), name)).select("org_id").distinct()
    return people.join(C.unaligned(matching), "org_id", "left_semi")


def _status_columns(policy: Policy) -> list:
    return [
        "org_id",
        "name",
        "sector",
        "size",
        "region",
        "total",
        "nationals",
        "non_nationals",
        rate_pct(F.col("rate")).alias("rate_pct"),
        "tier",
        compliance_status(F.col("tier"), policy).alias("compliance_status"),
    ]


def org_status(orgs: DataFrame, name: str, policy: Policy = Policy()) -> DataFrame:
    """Rate, tier and status of the first organisation whose name contains ``name``."""
    return find_org(orgs, name).select(*_status_columns(policy))


def orgs_in_tier(orgs: DataFrame, tier: str) -> DataFrame:
    """Organisations in a tier, in any spelling, lowest rate first."""
    return (
        orgs.filter(C.norm_eq(F.col("tier"), tier))
        .orderBy("rate", "org_id")
        .select("name", "sector", "region", "total", "nationals", rate_pct(F.col("rate")).alias("rate_pct"), "tier")
    )


def _sector_measures(policy: Policy) -> list:
    tier = F.col("tier")
    return [
        F.count(F.lit(1)).alias("orgs"),
        F.sum("total").alias("workforce"),
        F.sum("nationals").alias("nationals"),
        N.rounded(N.average(F.col("rate") * 100, 10), 2).alias("avg_rate_pct"),
        N.count_where(tier == policy.graded[0]).alias("platinum_orgs"),
        N.count_where(tier.contains(policy.family)).alias("green_orgs"),
        N.count_where(tier == policy.floor_tier).alias("yellow_orgs"),
        N.count_where(tier == policy.bottom_tier).alias("red_orgs"),
    ]


def sector_summary(orgs: DataFrame, sector: str, policy: Policy = Policy()) -> DataFrame:
    """Counts, workforce and tiers of every sector whose name contains ``sector``."""
    return orgs.filter(C.name_like(F.col("sector"), sector)).groupBy("sector").agg(*_sector_measures(policy))


def sector_profile(orgs: DataFrame, benchmarks: DataFrame, sector: str, policy: Policy = Policy()) -> DataFrame:
    """One sector, named exactly, with its compliance rate and benchmark; no row for an unknown sector."""
    bench = benchmarks.select(
        "sector",
        F.col("avg_pct").alias("industry_avg_pct"),
        F.col("median_pct").alias("industry_median_pct"),
        "trend",
    )
    return (
        orgs.filter(F.col("sector") == sector)
        .groupBy("sector")
        .agg(*_sector_measures(policy))
        .withColumn("compliance_rate_pct", N.pct(F.col("platinum_orgs") + F.col("green_orgs"), F.col("orgs"), 1))
        .join(bench, "sector", "left")
    )


def expiring_nationals(
    people: DataFrame, orgs: DataFrame, name: str, days: int, as_of: dt.date, policy: Policy = Policy()
) -> DataFrame:
    """Nationals of matching organisations whose contract ends from today to ``days`` ahead, both days included."""
    today = C.as_date(as_of)
    ending = (F.col("nationality") == policy.national) & F.col("contract_end").between(today, F.date_add(today, days))
    return (
        people_of(people.filter(ending), orgs, name)
        .select(
            "person_id",
            "job_title",
            "department",
            "salary",
            "contract_end",
            C.days_between(F.col("contract_end"), today).cast("bigint").alias("days_left"),
        )
        .orderBy("contract_end", "person_id")
    )


def org_alerts(
    alerts: DataFrame,
    name: str | None = None,
    severity: str | None = None,
    unread_only: bool = False,
    policy: Policy = Policy(),
) -> DataFrame:
    """Alerts by any of name, severity and read state; most severe first, then newest."""
    wanted = [
        C.name_like(F.col("org_name"), name) if name is not None else None,
        F.col("severity") == severity if severity is not None else None,
        ~F.col("is_read") if unread_only else None,
    ]
    ordered = C.order_by_rank(
        C.where_all(alerts, wanted), "severity", policy.alert_ranking, F.desc("created"), "alert_id"
    )
    return ordered.select("org_name", "alert_type", "severity", "message", "recommended_action", "created")


def overall_summary(orgs: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """Totals, overall rate and organisations per tier in one row."""
    tier = F.col("tier")
    return orgs.agg(
        F.count(F.lit(1)).alias("orgs"),
        F.sum("total").alias("workforce"),
        F.sum("nationals").alias("nationals"),
        N.pct(F.sum("nationals"), F.sum("total"), 2).alias("overall_rate_pct"),
        *[N.count_where(tier == t).alias(f"{t.lower()}_orgs") for t in policy.tiers],
        N.count_where(tier.isin(*policy.graded)).alias("compliant_orgs"),
        N.count_where(tier.isin(*policy.high_risk_tiers)).alias("non_compliant_orgs"),
    )


def tier_thresholds(rules: DataFrame, sector: str, size: str, policy: Policy = Policy()) -> DataFrame:
    """Thresholds of sectors whose name contains ``sector``, for one size."""
    hit = C.name_like(F.col("sector"), sector) & (F.lower("size") == F.lit(size.lower()))
    return rules.filter(hit).select("sector", "size", *map(policy.threshold, policy.graded))


def _with_rules(org: DataFrame, rules: DataFrame, policy: Policy) -> DataFrame:
    keys = rules.select("sector", "size", *map(policy.threshold, policy.graded))
    return org.withColumn("rate_pct", rate_pct(F.col("rate"))).join(keys, ["sector", "size"])


def hires_needed(orgs: DataFrame, rules: DataFrame, name: str, target: str, policy: Policy = Policy()) -> DataFrame:
    """Hires that bring the first matching organisation to a target tier."""
    one = _with_rules(find_org(orgs, name), rules, policy)
    return planning.with_hires(one.withColumn("target_pct", planning.target_threshold(target, policy))).select(
        "name",
        F.col("tier").alias("current_tier"),
        F.col("rate_pct").alias("current_rate_pct"),
        F.col("nationals").alias("current_nationals"),
        F.col("total").alias("current_total"),
        F.lit(target).alias("target_tier"),
        "target_pct",
        "hires",
        "projected_rate_pct",
    )


def simulate_change(
    orgs: DataFrame,
    rules: DataFrame,
    name: str,
    nat_hires: int = 0,
    nat_leaves: int = 0,
    other_hires: int = 0,
    other_leaves: int = 0,
    policy: Policy = Policy(),
) -> DataFrame:
    """Rate and tier of the first matching organisation after a workforce change."""
    change = {
        "nat_hires": nat_hires,
        "nat_leaves": nat_leaves,
        "other_hires": other_hires,
        "other_leaves": other_leaves,
    }
    one = _with_rules(find_org(orgs, name), rules, policy).withColumns(
        {k: F.lit(v).cast("bigint") for k, v in change.items()}
    )
    return planning.simulate(one, policy).select("name", *planning.SIMULATED)


def org_people(
    people: DataFrame,
    orgs: DataFrame,
    name: str,
    nationals_only: bool = False,
    expiring_days: int | None = None,
    as_of: dt.date | None = None,
    policy: Policy = Policy(),
) -> DataFrame:
    """People of matching organisations, optionally only nationals or contracts ending within some days."""
    conditions = [F.col("nationality") == policy.national if nationals_only else None]
    if expiring_days is not None:
        today = C.as_date(as_of)
        conditions.append(F.col("contract_end").between(today, F.date_add(today, expiring_days)))
    return (
        people_of(C.where_all(people, conditions), orgs, name)
        .select(
            "person_id",
            "nationality",
            F.when(F.col("nationality") == policy.national, "Yes").otherwise("No").alias("is_national"),
            "job_title",
            "department",
            "salary",
            "contract_type",
            "hire_date",
            "contract_end",
            "gender",
        )
        .orderBy(F.desc("nationality"), "department", "job_title", "person_id")
    )


def list_orgs(orgs: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """All organisations with rate and status, highest rate first."""
    return orgs.orderBy(F.desc("rate"), "org_id").select(
        "name",
        "sector",
        "region",
        "size",
        "total",
        "nationals",
        rate_pct(F.col("rate")).alias("rate_pct"),
        "tier",
        compliance_status(F.col("tier"), policy).alias("compliance_status"),
    )


def compare(orgs: DataFrame, names: Sequence[str], policy: Policy = Policy()) -> DataFrame:
    """The first match of every name, side by side, with the best and the worst of them.

    All names are tried in one pass over the organisations. On equal rates the
    name asked for first wins.
    """
    asked = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(n).alias("asked")) for i, n in enumerate(names, 1)])
    hits = F.filter(asked, lambda a: C.name_like(F.col("name"), a["asked"]))
    order = Window.partitionBy("position").orderBy("name", "org_id")
    found = (
        orgs.select(*_status_columns(policy), F.inline(hits))
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") == 1)
    )
    # At most one row per name is left.
    everyone = Window.partitionBy()
    by_best = F.struct(F.col("rate_pct"), -F.col("position"))
    by_worst = F.struct(F.col("rate_pct"), F.col("position"))
    return found.select(
        "position",
        "name",
        "sector",
        "total",
        "nationals",
        "rate_pct",
        "tier",
        "compliance_status",
        F.max_by("name", by_best).over(everyone).alias("best_performer"),
        F.min_by("name", by_worst).over(everyone).alias("worst_performer"),
    )
