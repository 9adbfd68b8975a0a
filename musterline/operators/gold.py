"""Business layer: tier, sector and region figures, composite risk and the one-row report."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import numeric as N
from ..policy import Policy


def kpi_tier(gap: DataFrame, policy: Policy = Policy(), now=None) -> DataFrame:
    """Organisations, workforce, rates and hires needed per tier, best tier first."""
    rate = F.col("rate_pct")
    per_tier = gap.groupBy("tier").agg(
        F.count(F.lit(1)).alias("orgs"),
        F.sum("total").alias("workforce"),
        F.sum("nationals").alias("nationals"),
        N.mean(rate, 1, stored=2).alias("avg_rate_pct"),
        F.round(F.min(rate), 1).alias("min_rate_pct"),
        F.round(F.max(rate), 1).alias("max_rate_pct"),
        F.sum("hires_for_next_tier").alias("hires_to_upgrade"),
    )
    # One row per tier by now, so the unpartitioned window is over a handful of rows.
    share = N.pct(F.col("orgs"), F.sum("orgs").over(Window.partitionBy()), 1)
    out = C.stamp(per_tier.withColumn("pct_of_total", share), "calculated_at", now)
    return C.order_by_rank(out, "tier", policy.tiers)


def _tier_mix(policy: Policy) -> list:
    tier = F.col("tier")
    return [
        N.count_where(tier == policy.graded[0]).alias("platinum_orgs"),
        N.count_where(tier.isin(*policy.greens)).alias("green_orgs"),
        N.count_where(tier == policy.floor_tier).alias("yellow_orgs"),
        N.count_where(tier == policy.bottom_tier).alias("red_orgs"),
    ]


def _summary_measures() -> list:
    return [
        F.count_distinct("org_id").alias("orgs"),
        F.sum("people").alias("people"),
        F.sum("national_people").alias("national_people"),
        # Means over organisations, not weighted by headcount: that is the definition.
        N.mean(F.col("rate_pct"), 1, stored=2).alias("avg_org_rate_pct"),
        N.mean(F.col("avg_salary"), 0).alias("avg_salary"),
    ]


def kpi_sector(summary: DataFrame, benchmarks: DataFrame, policy: Policy = Policy(), now=None) -> DataFrame:
    """Sector figures next to the sector's benchmark; a sector without one keeps nulls."""
    per_sector = summary.groupBy("sector").agg(
        *_summary_measures(),
        N.mean(F.col("avg_tenure_years"), 1, stored=1).alias("avg_tenure_years"),
        *_tier_mix(policy),
    )
    bench = benchmarks.select(
        "sector",
        F.col("avg_pct").alias("benchmark_avg_pct"),
        F.col("median_pct").alias("benchmark_median_pct"),
        F.col("top_quartile_pct").alias("benchmark_top_quartile_pct"),
        F.col("trend").alias("sector_trend"),
    )
    out = per_sector.withColumn("overall_rate_pct", N.pct(F.col("national_people"), F.col("people"), 1))
    return C.stamp(out.join(bench, "sector", "left"), "calculated_at", now)


def kpi_region(summary: DataFrame, policy: Policy = Policy(), now=None) -> DataFrame:
    """Region figures with the share of compliant organisations, largest region first."""
    out = (
        summary.groupBy("region")
        .agg(
            *_summary_measures(),
            *_tier_mix(policy),
            N.count_where(F.col("compliance_status") == "Compliant").alias("compliant"),
        )
        .withColumn("overall_rate_pct", N.pct(F.col("national_people"), F.col("people"), 1))
        .withColumn("compliance_rate_pct", N.pct(F.col("compliant"), F.col("orgs"), 1))
        .drop("compliant")
    )
    return C.stamp(out, "calculated_at", now).orderBy(F.desc("orgs"), "region")


def risk_counts(attrition: DataFrame) -> DataFrame:
    """People at risk per organisation, from rows that already carry a risk level."""
    level = F.col("risk_level")
    soon = F.col("is_national") & (F.col("contract_status") == "Expiring Soon")
    return attrition.groupBy("org_id").agg(
        N.count_where(level == "Critical").alias("critical_people"),
        N.count_where(level == "High").alias("high_people"),
        N.count_where(soon).alias("national_expiring_30d"),
    )


def risk_counts_from_people(people: DataFrame) -> DataFrame:
    """Same counts straight from cleaned people.

    Critical and High depend on the person alone, so people need not be joined
    to their organisation first: only per-organisation counts are shuffled.
    """
    national = F.col("is_national")
    status = F.col("contract_status")
    return people.groupBy("org_id").agg(
        N.count_where(national & status.isin("Expiring Soon", "Expired")).alias("critical_people"),
        N.count_where(national & (status == "Expiring in 90 Days")).alias("high_people"),
        N.count_where(national & (status == "Expiring Soon")).alias("national_expiring_30d"),
    )


def alert_counts(alerts: DataFrame) -> DataFrame:
    """Unread alerts per organisation."""
    return (
        alerts.filter(~F.col("is_read"))
        .groupBy("org_id")
        .agg(
            F.count(F.lit(1)).alias("active_alerts"),
            N.count_where(F.col("severity") == "High").alias("high_alerts"),
        )
    )


_COUNTS = ["critical_people", "high_people", "national_expiring_30d", "active_alerts", "high_alerts"]


def risk_score(
    gap: DataFrame, people_counts: DataFrame, alerts: DataFrame, policy: Policy = Policy(), now=None
) -> DataFrame:
    """Composite score (0 to 100, higher is worse) and category of every organisation.

    Both children come as one row per organisation (``risk_counts*`` and
    ``alert_counts``); organisations without any count as zero.
    """
    tier = F.col("tier")
    gap_points = N.clamp(F.coalesce(F.col(f"gap_to_{policy.graded[-1].lower()}"), F.lit(0.0)), 0, policy.gap_cap)
    score = F.round(
        C.map_values(tier, policy.tier_points, 0)
        + N.clamp(F.col("critical_people") * policy.critical_weight, high=policy.critical_cap)
        + N.clamp(F.col("high_alerts") * policy.alert_weight, high=policy.alert_cap)
        + gap_points,
        0,
    )
    category = (
        F.when(tier == policy.bottom_tier, "Critical")
        .when((tier == policy.floor_tier) | (F.col("critical_people") > policy.many_critical), "High")
        .when((tier == policy.graded[-1]) | (F.col("high_alerts") > 0), "Medium")
        .otherwise("Low")
    )
    out = (
        gap.join(people_counts, "org_id", "left")
        .join(alert_counts(alerts), "org_id", "left")
        .fillna(0, subset=_COUNTS)
        .select(
            "org_id",
            "name",
            "sector",
            "region",
            "tier",
            "total",
            "nationals",
            "rate_pct",
            "hires_for_next_tier",
            f"gap_to_{policy.graded[-1].lower()}",
            *_COUNTS,
            score.alias("risk_score"),
            category.alias("risk_category"),
        )
    )
    return C.stamp(out, "calculated_at", now)


def at_risk(risk: DataFrame, categories: tuple[str, ...] = ("Critical", "High")) -> DataFrame:
    """Organisations in the given categories, highest score first."""
    return (
        risk.filter(F.col("risk_category").isin(*categories))
        .select(
            "org_id",
            "name",
            "sector",
            "region",
            "tier",
            "rate_pct",
            "risk_score",
            "risk_category",
            "hires_for_next_tier",
            "critical_people",
            "active_alerts",
        )
        .orderBy(F.desc("risk_score"), "org_id")
    )


def exec_dashboard(risk: DataFrame, as_of: dt.date, policy: Policy = Policy(), now=None) -> DataFrame:
    """One row for the whole portfolio, from a single aggregation over the scored organisations."""
    tier = F.col("tier")
    category = F.col("risk_category")
    hires = F.sum(F.when(tier != policy.graded[0], F.col("hires_for_next_tier")))
    out = risk.agg(
        F.count(F.lit(1)).alias("orgs"),
        F.sum("total").alias("workforce"),
        F.sum("nationals").alias("nationals"),
        N.count_where(tier == policy.graded[0]).alias("platinum_orgs"),
        N.count_where(tier.contains(policy.family)).alias("green_orgs"),
        N.count_where(tier == policy.floor_tier).alias("yellow_orgs"),
        N.count_where(tier == policy.bottom_tier).alias("red_orgs"),
        N.count_where(category == "Critical").alias("critical_risk_orgs"),
        N.count_where(category == "High").alias("high_risk_orgs"),
        F.coalesce(N.mean(F.col("risk_score"), 1), F.lit(0.0)).alias("avg_risk_score"),
        F.coalesce(hires, F.lit(0)).alias("hires_to_upgrade"),
    ).select(
        F.lit("Overall").alias("report_level"),
        F.date_format(C.as_date(as_of), "yyyy-MM-dd").alias("report_date"),
        "orgs",
        "workforce",
        "nationals",
        F.coalesce(N.pct(F.col("nationals"), F.col("workforce"), 1), F.lit(0.0)).alias("overall_rate_pct"),
        "platinum_orgs",
        "green_orgs",
        "yellow_orgs",
        "red_orgs",
        "critical_risk_orgs",
        "high_risk_orgs",
        "avg_risk_score",
        "hires_to_upgrade",
    )
    return C.stamp(out, "generated_at", now)


def department_share(people: DataFrame, orgs: DataFrame) -> DataFrame:
    """Headcount, national share, pay and tenure per organisation and department.

    People are reduced per organisation and department before the join; the
    second aggregation keeps duplicate organisation rows merged as one group.
    """
    partial = people.groupBy("org_id", "department").agg(
        F.count(F.lit(1)).alias("people"),
        N.count_where(F.col("is_national")).alias("national_people"),
        F.sum(N.fixed(F.col("salary"), 2)).alias("salary_sum"),
        F.count("salary").alias("salary_n"),
        F.sum(N.fixed(F.col("tenure_years"), 1)).alias("tenure_sum"),
        F.count("tenure_years").alias("tenure_n"),
    )
    org = orgs.select("org_id", F.col("name").alias("org_name"), "sector")
    sums = ["people", "national_people", "salary_sum", "salary_n", "tenure_sum", "tenure_n"]
    merged = (
        partial.join(org, "org_id", "inner")
        .groupBy("org_id", "org_name", "sector", "department")
        .agg(*[F.sum(c).alias(c) for c in sums])
    )
    return merged.select(
        "org_id",
        "org_name",
        "sector",
        "department",
        "people",
        "national_people",
        N.pct(F.col("national_people"), F.col("people"), 1).alias("department_rate_pct"),
        N.ratio(F.col("salary_sum"), F.col("salary_n") * 100, 0).alias("avg_salary"),
        N.ratio(F.col("tenure_sum"), F.col("tenure_n") * 10, 1).alias("avg_tenure_years"),
    )
