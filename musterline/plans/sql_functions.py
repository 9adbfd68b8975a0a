"""SQL table functions over the raw tables.

Parameters carry a ``p_`` prefix: a column of the same name would otherwise hide
the parameter inside the body, and the filter would compare the column with itself.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ..operators.quality import sql_list, sql_value
from ..policy import Policy

_STATUS = "CASE WHEN tier IN {good} THEN 'Compliant' WHEN tier IN {middle} THEN 'At Risk' ELSE 'Non-Compliant' END"
_RATE = "round(rate * 100, 2)"
_MATCH = "contains(lower({0}), lower({1}))"
_FOLD = "lower(replace({0}, '_', ' '))"

# Smallest whole x with (nationals + x) / (total + x) >= target, in whole numbers.
_SHORT = "(CAST(target_pct * 10000 + 0.5 AS BIGINT) * total - 1000000L * nationals)"
_LEFT = "nullif(1000000L - CAST(target_pct * 10000 + 0.5 AS BIGINT), 0L)"
_HIRES = f"""CASE WHEN {_SHORT} <= 0 THEN 0L
        ELSE ({_SHORT} + {_LEFT} - 1) DIV {_LEFT} END"""
_PCT = "round(CAST({0} AS DECIMAL(20, 0)) * 100 / nullif({1}, 0), 2)"


#: Columns whose type differs from table to table, and the type of each where nothing is known of the tables.
_VARYING = {
    ("orgs", "org_id"): "bigint",
    ("people", "person_id"): "bigint",
    ("people", "salary"): "int",
    ("alerts", "created"): "timestamp_ntz",
}


def column_types(spark: SparkSession, names: Mapping[str, str]) -> dict[tuple[str, str], str]:
    """Types of the varying columns in the named tables."""
    found = {}
    for (table, column), usual in _VARYING.items():
        kinds = {f.name: f.dataType.simpleString() for f in spark.table(names[table]).schema.fields}
        found[table, column] = kinds.get(column, usual)
    return found


def definitions(
    names: Mapping[str, str], as_of: dt.date, policy: Policy, types: Mapping[tuple[str, str], str] | None = None
) -> dict[str, str]:
    """Signature and body per function; ``names`` maps orgs, people, rules and alerts to tables or views."""
    types = {**_VARYING, **(types or {})}
    org_id, person_id, salary, created = (types[k] for k in _VARYING)
    orgs, people, rules, alerts = (names[k] for k in ("orgs", "people", "rules", "alerts"))
    status = _STATUS.format(good=sql_list(policy.good_tiers), middle=sql_list(policy.middle_tiers))
    today = sql_value(as_of)
    bounds = ", ".join(map(policy.threshold, policy.graded))
    nat = sql_list([policy.national])
    found = f"SELECT * FROM {orgs} WHERE {_MATCH.format('name', 'p_name')} ORDER BY name, org_id LIMIT 1"
    matching = f"SELECT DISTINCT org_id FROM {orgs} WHERE {_MATCH.format('name', 'p_name')}"
    ranking = " ".join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(policy.alert_ranking, 1))
    per_tier = ", ".join(f"count_if(tier = '{t}') AS {t.lower()}_orgs" for t in policy.tiers)
    targets = " ".join(
        f"WHEN '{t.lower().replace('_', '')}' THEN {policy.threshold(t)}" for t in policy.graded
    )
    projected = " ".join(f"WHEN raw >= {policy.threshold(t)} THEN '{t}'" for t in policy.graded)
    return {
        "org_status": f"""(p_name STRING) RETURNS TABLE (org_id {org_id}, name STRING, sector STRING, size STRING,
            region STRING, total INT, nationals INT, non_nationals INT, rate_pct DOUBLE, tier STRING,
            compliance_status STRING)
          RETURN SELECT org_id, name, sector, size, region, total, nationals, non_nationals, {_RATE}, tier, {status}
          FROM ({found})""",
        "orgs_in_tier": f"""(p_tier STRING) RETURNS TABLE (name STRING, sector STRING, region STRING, total INT,
            nationals INT, rate_pct DOUBLE, tier STRING)
          RETURN SELECT name, sector, region, total, nationals, {_RATE}, tier FROM {orgs}
          WHERE {_FOLD.format('tier')} = {_FOLD.format('p_tier')} ORDER BY rate, org_id""",
        "sector_summary": f"""(p_sector STRING) RETURNS TABLE (sector STRING, orgs BIGINT, workforce BIGINT,
            nationals BIGINT, avg_rate_pct DOUBLE, platinum_orgs BIGINT, green_orgs BIGINT, yellow_orgs BIGINT,
            red_orgs BIGINT)
          RETURN SELECT sector, count(*), sum(total), sum(nationals), round(CAST(sum(CAST(rate * 100 AS DECIMAL(28, 10))) AS DOUBLE) / count(rate), 2),
            count_if(tier = '{policy.graded[0]}'), count_if(contains(tier, '{policy.family}')),
            count_if(tier = '{policy.floor_tier}'), count_if(tier = '{policy.bottom_tier}')
          FROM {orgs} WHERE {_MATCH.format('sector', 'p_sector')} GROUP BY sector""",
        "expiring_nationals": f"""(p_name STRING, p_days INT) RETURNS TABLE (person_id {person_id}, job_title STRING,
            department STRING, salary {salary}, contract_end DATE, days_left BIGINT)
          RETURN SELECT p.person_id, p.job_title, p.department, p.salary, p.contract_end,
            CAST(datediff(p.contract_end, {today}) AS BIGINT)
          FROM {people} p JOIN ({matching}) o ON p.org_id = o.org_id
          WHERE p.nationality IN {nat}
            AND p.contract_end BETWEEN {today} AND date_add({today}, p_days)
          ORDER BY p.contract_end, p.person_id""",
        "org_alerts": f"""(p_name STRING) RETURNS TABLE (org_name STRING, alert_type STRING, severity STRING,
            message STRING, recommended_action STRING, created {created})
          RETURN SELECT org_name, alert_type, severity, message, recommended_action, created FROM {alerts}
          WHERE {_MATCH.format('org_name', 'p_name')}
          ORDER BY CASE severity {ranking} ELSE {len(policy.alert_ranking) + 1} END, created DESC, alert_id""",
        "overall_summary": f"""() RETURNS TABLE (orgs BIGINT, workforce BIGINT, nationals BIGINT,
            overall_rate_pct DOUBLE, {', '.join(f'{t.lower()}_orgs BIGINT' for t in policy.tiers)},
            compliant_orgs BIGINT, non_compliant_orgs BIGINT)
          RETURN SELECT count(*), sum(total), sum(nationals),
            CAST({_PCT.format('sum(nationals)', 'sum(total)')} AS DOUBLE), {per_tier},
            count_if(tier IN {sql_list(policy.graded)}), count_if(tier IN {sql_list(policy.high_risk_tiers)})
          FROM {orgs}""",
        "tier_thresholds": f"""(p_sector STRING, p_size STRING) RETURNS TABLE (sector STRING, size STRING,
            {', '.join(f'{policy.threshold(t)} DOUBLE' for t in policy.graded)})
          RETURN SELECT sector, size, {bounds} FROM {rules}
          WHERE {_MATCH.format('sector', 'p_sector')} AND lower(size) = lower(p_size)""",
        "hires_needed": f"""(p_name STRING, p_target STRING) RETURNS TABLE (name STRING, current_tier STRING,
            current_rate_pct DOUBLE, current_nationals INT, current_total INT, target_tier STRING,
            target_pct DOUBLE, hires BIGINT, projected_rate_pct DOUBLE)
          RETURN WITH org AS ({found}),
            aimed AS (
              SELECT o.*, {_RATE} AS rate_pct,
                CASE lower(replace(replace(p_target, '_', ''), ' ', '')) {targets}
                  ELSE {policy.threshold(policy.graded[-1])} END AS target_pct
              FROM org o JOIN {rules} r ON r.sector = o.sector AND r.size = o.size),
            solved AS (SELECT *, {_HIRES} AS hires FROM aimed)
          SELECT name, tier, rate_pct, nationals, total, p_target, target_pct, hires,
            CASE WHEN hires = 0 THEN rate_pct
              ELSE CAST({_PCT.format('(nationals + hires)', '(total + hires)')} AS DOUBLE) END
          FROM solved""",
        "simulate_change": f"""(p_name STRING, p_nat_hires INT, p_nat_leaves INT, p_other_hires INT,
            p_other_leaves INT) RETURNS TABLE (name STRING, current_nationals INT, current_others INT,
            current_total INT, current_rate_pct DOUBLE, current_tier STRING, new_nationals BIGINT, new_others BIGINT,
            new_total BIGINT, new_rate_pct DOUBLE, projected_tier STRING, rate_impact STRING)
          RETURN WITH org AS ({found}),
            moved AS (
              SELECT o.*, {_RATE} AS rate_pct, {bounds},
                CAST(greatest(0, nationals + p_nat_hires - p_nat_leaves) AS BIGINT) AS new_nationals,
                CAST(greatest(0, non_nationals + p_other_hires - p_other_leaves) AS BIGINT) AS new_others
              FROM org o JOIN {rules} r ON r.sector = o.sector AND r.size = o.size),
            rated AS (
              SELECT *, new_nationals + new_others AS new_total,
                coalesce(try_divide(new_nationals * 100D, CAST(new_nationals + new_others AS DOUBLE)), 0D) AS raw
              FROM moved)
          SELECT name, nationals, non_nationals, total, rate_pct, tier, new_nationals, new_others, new_total,
            coalesce(CAST({_PCT.format('new_nationals', 'new_total')} AS DOUBLE), 0D),
            CASE {projected} WHEN raw >= {policy.floor_pct} THEN '{policy.floor_tier}' ELSE '{policy.bottom_tier}' END,
            CASE sign(new_nationals * greatest(total, 1L) - nationals * greatest(new_total, 1L))
              WHEN 1 THEN 'IMPROVEMENT' WHEN -1 THEN 'DECLINE' ELSE 'NO_CHANGE' END
          FROM rated""",
        "org_people": f"""(p_name STRING) RETURNS TABLE (person_id {person_id}, nationality STRING, is_national STRING,
            job_title STRING, department STRING, salary {salary}, contract_type STRING, hire_date DATE, contract_end DATE,
            gender STRING)
          RETURN SELECT p.person_id, p.nationality, CASE WHEN p.nationality IN {nat} THEN 'Yes' ELSE 'No' END,
            p.job_title, p.department, p.salary, p.contract_type, p.hire_date, p.contract_end, p.gender
          FROM {people} p JOIN ({matching}) o ON p.org_id = o.org_id
          ORDER BY p.nationality DESC, p.department, p.job_title, p.person_id""",
        "list_orgs": f"""() RETURNS TABLE (name STRING, sector STRING, region STRING, size STRING, total INT,
            nationals INT, rate_pct DOUBLE, tier STRING, compliance_status STRING)
          RETURN SELECT name, sector, region, size, total, nationals, {_RATE}, tier, {status} FROM {orgs}
          ORDER BY rate DESC, org_id""",
    }


def register(
    spark: SparkSession, names: Mapping[str, str], as_of: dt.date, policy: Policy = Policy(), db: str | None = None
) -> list[str]:
    """Create the functions, in database ``db`` or, without one, for this session only.

    Table functions are called by plain name, so run ``USE`` on their database first.
    """
    kind = "FUNCTION" if db else "TEMPORARY FUNCTION"
    prefix = f"{db}." if db else ""
    created = []
    for name, rest in definitions(names, as_of, policy, column_types(spark, names)).items():
        spark.sql(f"CREATE OR REPLACE {kind} {prefix}{name}{rest}")
        created.append(f"{prefix}{name}")
    return created


def list_functions(spark: SparkSession, db: str) -> DataFrame:
    """Functions registered in a database."""
    return spark.sql(f"SHOW USER FUNCTIONS IN {db}")
