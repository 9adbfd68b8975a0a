"""Lookups."""

from .parts import AS_OF, big, count_if, hires, pct, query, rnd

_NAME = "contains(lower({0}), lower('{1}'))"
_FIRST = "one AS (SELECT * FROM orgc WHERE contains(lower(name), lower('{0}')) ORDER BY name, org_id LIMIT 1)"
_TIERS = ", ".join(
    count_if(f"tier = '{t}'") + f" AS {t.lower()}_orgs"
    for t in ("Platinum", "High_Green", "Mid_Green", "Low_Green", "Yellow", "Red")
)
_SECTOR = f"""sector, count(*) AS orgs, {big('sum(total)')} AS workforce, {big('sum(nationals)')} AS nationals,
  {rnd('avg(rate * 100)', 2)} AS avg_rate_pct, {count_if("tier = 'Platinum'")} AS platinum_orgs,
  {count_if("tier LIKE '%Green%'")} AS green_orgs, {count_if("tier = 'Yellow'")} AS yellow_orgs,
  {count_if("tier = 'Red'")} AS red_orgs"""

_SIM = f"""SELECT name, nationals AS current_nationals, non_nationals AS current_others, total AS current_total,
  rate_pct AS current_rate_pct, tier AS current_tier, {big('nn')} AS new_nationals, {big('no')} AS new_others,
  {big('nn + no')} AS new_total, {pct('nn', 'nn + no', 2)} AS new_rate_pct,
  CASE WHEN nn * 100.0 / (nn + no) >= platinum_pct THEN 'Platinum' WHEN nn * 100.0 / (nn + no) >= high_green_pct THEN 'High_Green'
    WHEN nn * 100.0 / (nn + no) >= mid_green_pct THEN 'Mid_Green' WHEN nn * 100.0 / (nn + no) >= low_green_pct THEN 'Low_Green'
    WHEN nn * 100.0 / (nn + no) >= 6 THEN 'Yellow' ELSE 'Red' END AS projected_tier,
  CASE WHEN nn * total > nationals * (nn + no) THEN 'IMPROVEMENT' WHEN nn * total < nationals * (nn + no) THEN 'DECLINE'
    ELSE 'NO_CHANGE' END AS rate_impact
FROM (SELECT o.*, r.* EXCLUDE (sector, size), greatest(0, nationals + 5 - 0) AS nn, greatest(0, non_nationals + 0 - 3) AS no
      FROM one o JOIN rules r ON r.sector = o.sector AND r.size = o.size)"""

_HIRES = f"""SELECT name, current_tier, current_rate_pct, current_nationals, current_total, target_tier, target_pct, hires,
  CASE WHEN hires = 0 THEN current_rate_pct
    ELSE {pct('current_nationals + hires', 'current_total + hires', 2)} END AS projected_rate_pct
FROM (SELECT o.name, o.tier AS current_tier, o.rate_pct AS current_rate_pct, o.nationals AS current_nationals,
        o.total AS current_total, 'High Green' AS target_tier, r.high_green_pct AS target_pct,
        greatest(0, {hires('o.total', 'o.nationals', 'r.high_green_pct')}) AS hires
      FROM one o JOIN rules r ON r.sector = o.sector AND r.size = o.size)"""

_ASKED = """asked(position, asked) AS (VALUES (1, '#000000007'), (2, '#00000001'), (3, '#000000042'), (4, 'nobody')),
found AS (SELECT position, name, sector, total, nationals, rate_pct, tier, compliance_status FROM (
  SELECT a.position, o.*, row_number() OVER (PARTITION BY a.position ORDER BY o.name, o.org_id) AS rn
  FROM asked a JOIN orgc o ON contains(lower(o.name), lower(a.asked))) WHERE rn = 1)"""
_COMPARE = """SELECT *, (SELECT name FROM found ORDER BY rate_pct DESC, position LIMIT 1) AS best_performer,
  (SELECT name FROM found ORDER BY rate_pct, position LIMIT 1) AS worst_performer FROM found"""

_PEOPLE = """SELECT p.person_id, p.nationality, CASE WHEN p.nationality = 'N' THEN 'Yes' ELSE 'No' END AS is_national,
  p.job_title, p.department, p.salary, p.contract_type, p.hire_date, p.contract_end, p.gender
FROM person p JOIN orgc o ON o.org_id = p.org_id WHERE """

_RAW = f"""SELECT 'org' AS kind, CAST(org_id AS VARCHAR) AS id, name AS label FROM one UNION ALL
SELECT 'person', CAST(person_id AS VARCHAR), job_title FROM person
WHERE org_id IN (SELECT org_id FROM org WHERE {_NAME.format('name', '#000000010')}) UNION ALL
SELECT 'expiring', CAST(person_id AS VARCHAR), department FROM person
WHERE org_id IN (SELECT org_id FROM org WHERE {_NAME.format('name', 'customer#')}) AND nationality = 'N'
  AND contract_end BETWEEN {AS_OF} AND {AS_OF} + 60"""

SQL = {
    "tvf_on_raw_tables": query(_RAW, "orgc", "person", extra=_FIRST.format("#00000001")),
    "tvf_org_status": query(
        "SELECT org_id, name, sector, size, region, total, nationals, non_nationals, rate_pct, tier, compliance_status FROM one",
        "orgc", extra=_FIRST.format("CUSTOMER#00000001"),
    ),
    "tvf_orgs_in_tier": query(
        "SELECT name, sector, region, total, nationals, rate_pct, tier FROM orgc WHERE tier = 'High_Green'", "orgc"
    ),
    "tvf_sector_summary": query(
        f"SELECT {_SECTOR} FROM orgc WHERE {_NAME.format('sector', 'u')} GROUP BY sector", "orgc"
    ),
    "tvf_sector_profile": query(
        f"""SELECT s.*, {pct('platinum_orgs + green_orgs', 'orgs', 1)} AS compliance_rate_pct,
          b.avg_pct AS industry_avg_pct, b.median_pct AS industry_median_pct, b.trend
        FROM (SELECT {_SECTOR} FROM orgc WHERE sector = 'BUILDING' GROUP BY sector) s LEFT JOIN bench b ON b.sector = s.sector""",
        "orgc", "bench",
    ),
    "tvf_expiring_nationals": query(
        f"""SELECT person_id, job_title, department, salary, contract_end,
          date_diff('day', {AS_OF}, contract_end) AS days_left
        FROM person p JOIN orgc o ON o.org_id = p.org_id
        WHERE {_NAME.format('o.name', 'customer#')} AND nationality = 'N'
          AND contract_end BETWEEN {AS_OF} AND {AS_OF} + 60""",
        "orgc", "person",
    ),
    "tvf_org_alerts": query(
        f"""SELECT org_name, alert_type, severity, message, recommended_action, created FROM alert
        WHERE {_NAME.format('org_name', '#00000001')}""",
        "alert",
    ),
    "tvf_alerts_filtered": query(
        f"""SELECT org_name, alert_type, severity, message, recommended_action, created FROM alert
        WHERE {_NAME.format('org_name', '#0000000')} AND severity = 'High' AND NOT is_read""",
        "alert",
    ),
    "tvf_overall_summary": query(
        f"""SELECT count(*) AS orgs, {big('sum(total)')} AS workforce, {big('sum(nationals)')} AS nationals,
          {pct('sum(nationals)', 'sum(total)', 2)} AS overall_rate_pct, {_TIERS},
          {count_if("tier IN ('Platinum', 'High_Green', 'Mid_Green', 'Low_Green')")} AS compliant_orgs,
          {count_if("tier IN ('Yellow', 'Red')")} AS non_compliant_orgs FROM orgc""",
        "orgc",
    ),
    "tvf_tier_thresholds": query(
        """SELECT r.sector, r.size, r.platinum_pct, r.high_green_pct, r.mid_green_pct, r.low_green_pct, s.orgs FROM (
          SELECT sector, size, count(*) AS orgs FROM orgc GROUP BY sector, size) s
        JOIN rules r ON r.sector = s.sector AND r.size = s.size""",
        "orgc",
    ),
    "tvf_hires_needed": query(_HIRES, "orgc", extra=_FIRST.format("#000000010")),
    "tvf_simulate_change": query(_SIM, "orgc", extra=_FIRST.format("#000000010")),
    "tvf_org_people": query(_PEOPLE + _NAME.format("o.name", "customer#0000001"), "orgc", "person"),
    "tvf_people_filtered": query(
        _PEOPLE + f"{_NAME.format('o.name', '#')} AND p.nationality = 'N' AND p.contract_end BETWEEN {AS_OF} AND {AS_OF} + 30",
        "orgc", "person",
    ),
    "tvf_list_orgs": query(
        "SELECT name, sector, region, size, total, nationals, rate_pct, tier, compliance_status FROM orgc", "orgc"
    ),
    "tvf_compare": query(_COMPARE, "orgc", extra=_ASKED),
}

_CALLED = {name: SQL[f"tvf_{name}"] for name in (
    "org_status", "orgs_in_tier", "sector_summary", "expiring_nationals", "org_alerts", "overall_summary", "hires_needed",
    "simulate_change", "org_people", "list_orgs",
)} | {"tier_thresholds": query("SELECT * FROM rules WHERE sector = 'BUILDING' AND size = 'Small'", "rules")}
SQL["functions_listed"] = " UNION ALL ".join(f"SELECT '{name}' AS function, count(*) AS rows FROM ({sql})" for name, sql in _CALLED.items())
