"""Stored layers: raw tables to cleaned, business and quality tables and views.

Each stage reads the tables of the stage before it, so nothing is computed twice
and a lost job is repeated from stored tables. Every stage writes once and counts
nothing; ``sinks.tables.layer_counts`` reports sizes from the stored tables.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..operators import gold, quality, silver
from ..policy import Policy, QualityPolicy
from ..sinks.tables import create_view, ensure_db, write_table


@dataclass(frozen=True)
class Layers:
    """Database names of the layers."""

    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"
    quality: str = "data_quality"


SILVER = ("organisations", "people", "org_people_summary", "org_gap", "attrition_risk")
GOLD = ("kpi_tier", "kpi_sector", "kpi_region", "risk_score", "exec_dashboard")
GOLD_VIEWS = ("at_risk_orgs", "department_share")
QUALITY = ("rules_catalog", "validation_results", "summary_metrics", "anomalies")
QUALITY_VIEWS = ("dashboard", "by_check_type", "failed_rules")


def show(spark: SparkSession, name: str, df: DataFrame, order: str) -> None:
    """Store a report and put a sorted view in front of it; what it says is defined once, by the operator."""
    write_table(df, f"{name}_stored")
    create_view(spark, name, f"SELECT * FROM {name}_stored ORDER BY {order}")


def build_silver(spark: SparkSession, as_of: dt.date, policy: Policy = Policy(), now=None, at: Layers = Layers()) -> None:
    ensure_db(spark, at.silver)
    raw = lambda name: spark.table(f"{at.bronze}.{name}")
    done = lambda name: spark.table(f"{at.silver}.{name}")
    put = lambda df, name: write_table(df, f"{at.silver}.{name}")
    put(silver.org_clean(raw("organisations"), as_of, policy, now), "organisations")
    put(silver.person_clean(raw("people"), as_of, policy, now), "people")
    put(silver.org_people_summary(done("organisations"), done("people"), now), "org_people_summary")
    put(silver.org_gap(done("organisations"), raw("tier_rules"), policy, now), "org_gap")
    put(silver.attrition_risk(done("people"), done("organisations"), policy, now), "attrition_risk")


def build_gold(spark: SparkSession, as_of: dt.date, policy: Policy = Policy(), now=None, at: Layers = Layers()) -> None:
    ensure_db(spark, at.gold)
    raw = lambda name: spark.table(f"{at.bronze}.{name}")
    base = lambda name: spark.table(f"{at.silver}.{name}")
    put = lambda df, name: write_table(df, f"{at.gold}.{name}")
    put(gold.kpi_tier(base("org_gap"), policy, now), "kpi_tier")
    put(gold.kpi_sector(base("org_people_summary"), raw("sector_benchmarks"), policy, now), "kpi_sector")
    put(gold.kpi_region(base("org_people_summary"), policy, now), "kpi_region")
    counts = gold.risk_counts(base("attrition_risk"))
    put(gold.risk_score(base("org_gap"), counts, raw("alerts"), policy, now), "risk_score")
    put(gold.exec_dashboard(spark.table(f"{at.gold}.risk_score"), as_of, policy, now), "exec_dashboard")
    people, orgs = base("people"), base("organisations")
    show(spark, f"{at.gold}.at_risk_orgs", gold.at_risk(spark.table(f"{at.gold}.risk_score")), "risk_score DESC, org_id")
    show(spark, f"{at.gold}.department_share", gold.department_share(people, orgs), "org_name, department_rate_pct, department")


def build_quality(
    spark: SparkSession,
    as_of: dt.date,
    policy: Policy = Policy(),
    bounds: QualityPolicy = QualityPolicy(),
    now: dt.datetime | None = None,
    at: Layers = Layers(),
) -> None:
    ensure_db(spark, at.quality)
    rules = quality.checks(quality.declaration(as_of, policy, bounds))
    orgs, people = spark.table(f"{at.bronze}.organisations"), spark.table(f"{at.bronze}.people")
    names = {quality.ORGS: f"{at.bronze}.organisations", quality.PEOPLE: f"{at.bronze}.people"}
    done = lambda name: spark.table(f"{at.quality}.{name}")
    put = lambda df, name: write_table(df, f"{at.quality}.{name}")
    put(quality.rules_catalog(spark, rules, now, names), "rules_catalog")
    put(quality.validate({quality.ORGS: orgs, quality.PEOPLE: people}, rules, now, names), "validation_results")
    put(quality.summary(done("validation_results"), now), "summary_metrics")
    put(quality.anomalies(orgs, people, bounds, now, names), "anomalies")
    results = done("validation_results")
    graded = quality.dashboard(done("summary_metrics"), done("anomalies"), bounds, as_of=now)
    show(spark, f"{at.quality}.dashboard", graded, "metric_name")
    show(spark, f"{at.quality}.by_check_type", quality.by_check_type(results), "avg_pass_rate, check_type")
    show(spark, f"{at.quality}.failed_rules", quality.failed_rules(results), "failed_records DESC, rule_id")


def build_all(spark: SparkSession, as_of: dt.date, policy: Policy = Policy(), now=None, at: Layers = Layers()) -> list[str]:
    """Build every layer from the raw tables; returns the names of all tables and views."""
    build_silver(spark, as_of, policy, now, at)
    build_gold(spark, as_of, policy, now, at)
    build_quality(spark, as_of, policy, now=now, at=at)
    return [
        *(f"{at.silver}.{n}" for n in SILVER),
        *(f"{at.gold}.{n}" for n in (*GOLD, *GOLD_VIEWS)),
        *(f"{at.quality}.{n}" for n in (*QUALITY, *QUALITY_VIEWS)),
    ]
