"""Workforce layers, KPIs and planning."""

from .parts import AS_OF, big, count_if, hires, mean, pct, query, rnd

_ORG_CLEAN = f"""SELECT org_id, name, registration_no, sector, size, region, total, nationals, non_nationals, rate_pct,
  tier, compliance_status, registration_date, CAST(year(registration_date) AS INT) AS registration_year,
  CAST(date_diff('day', registration_date, {AS_OF}) AS INT) AS days_since_registration,
  CASE WHEN total < 10 THEN '1-9' WHEN total < 50 THEN '10-49' WHEN total < 200 THEN '50-199'
    WHEN total < 500 THEN '200-499' ELSE '500+' END AS headcount_bucket, last_updated
FROM orgc"""

_PERSON_CLEAN = """SELECT person_id, org_id, nationality, is_national, job_title, department, salary, salary_band,
  contract_type, hire_date, contract_end, contract_status, tenure_days, tenure_years, is_remote, gender
FROM personc"""

_KPI_TIER = f"""SELECT tier, count(*) AS orgs, {big('sum(total)')} AS workforce, {big('sum(nationals)')} AS nationals,
  {mean('rate_pct', 1, 2)} AS avg_rate_pct, {rnd('min(rate_pct)', 1)} AS min_rate_pct,
  {rnd('max(rate_pct)', 1)} AS max_rate_pct, {big('sum(hires_for_next_tier)')} AS hires_to_upgrade,
  {pct('count(*)', '(SELECT count(*) FROM gap)', 1)} AS pct_of_total
FROM gap GROUP BY tier"""

_MIX = ", ".join(
    [
        count_if("tier = 'Platinum'") + " AS platinum_orgs",
        count_if("tier IN ('High_Green', 'Mid_Green', 'Low_Green')") + " AS green_orgs",
        count_if("tier = 'Yellow'") + " AS yellow_orgs",
        count_if("tier = 'Red'") + " AS red_orgs",
    ]
)
_MEASURES = f"""count(DISTINCT org_id) AS orgs, {big('sum(people)')} AS people,
  {big('sum(national_people)')} AS national_people, {mean('rate_pct', 1, 2)} AS avg_org_rate_pct,
  {mean('avg_salary', 0)} AS avg_salary, {_MIX}, {pct('sum(national_people)', 'sum(people)', 1)} AS overall_rate_pct"""

_KPI_SECTOR = f"""SELECT s.*, b.avg_pct AS benchmark_avg_pct, b.median_pct AS benchmark_median_pct,
  b.top_quartile_pct AS benchmark_top_quartile_pct, b.trend AS sector_trend
FROM (SELECT sector, {_MEASURES}, {mean('avg_tenure_years', 1, 1)} AS avg_tenure_years FROM summary GROUP BY sector) s
LEFT JOIN bench b ON b.sector = s.sector"""

_KPI_REGION = f"""SELECT region, {_MEASURES},
  {pct(count_if("compliance_status = 'Compliant'"), 'count(DISTINCT org_id)', 1)} AS compliance_rate_pct
FROM summary GROUP BY region"""

_AT_RISK = """SELECT org_id, name, sector, region, tier, rate_pct, risk_score, risk_category, hires_for_next_tier,
  critical_people, active_alerts FROM risk WHERE risk_category IN ('Critical', 'High')"""

_EXEC = f"""SELECT 'Overall' AS report_level, '2000-01-01' AS report_date, count(*) AS orgs,
  {big('sum(total)')} AS workforce, {big('sum(nationals)')} AS nationals,
  {pct('sum(nationals)', 'sum(total)', 1)} AS overall_rate_pct,
  {count_if("tier = 'Platinum'")} AS platinum_orgs, {count_if("tier LIKE '%Green%'")} AS green_orgs,
  {count_if("tier = 'Yellow'")} AS yellow_orgs, {count_if("tier = 'Red'")} AS red_orgs,
  {count_if("risk_category = 'Critical'")} AS critical_risk_orgs, {count_if("risk_category = 'High'")} AS high_risk_orgs,
  {mean('risk_score', 1)} AS avg_risk_score,
  {big("sum(CASE WHEN tier <> 'Platinum' THEN hires_for_next_tier ELSE 0 END)")} AS hires_to_upgrade
FROM risk"""

_DEPT = f"""SELECT o.org_id, o.name AS org_name, o.sector, p.department, count(*) AS people,
  {count_if('is_national')} AS national_people, {pct(count_if('is_national'), 'count(*)', 1)} AS department_rate_pct,
  {mean('salary', 0)} AS avg_salary, {mean('tenure_years', 1, 1)} AS avg_tenure_years
FROM personc p JOIN orgc o ON o.org_id = p.org_id GROUP BY o.org_id, o.name, o.sector, p.department"""

# One row per organisation and graded tier to reach.
HIRES = f"""plan AS (
  SELECT o.org_id, o.name, o.sector, o.tier AS current_tier, o.rate_pct AS current_rate_pct, o.nationals, o.total,
    t.target_tier, t.target_pct,
    CASE WHEN t.target_pct IS NULL THEN 0
      ELSE greatest(0, {hires('o.total', 'o.nationals', 't.target_pct')}) END AS hires
  FROM orgc o LEFT JOIN (
    SELECT sector, size, unnest(['Platinum', 'High_Green', 'Mid_Green', 'Low_Green']) AS target_tier,
      unnest([platinum_pct, high_green_pct, mid_green_pct, low_green_pct]) AS target_pct FROM rules) t
    ON t.sector = o.sector AND t.size = o.size)"""

_HIRES = f"""SELECT *, CASE WHEN hires = 0 THEN current_rate_pct
  ELSE {pct('nationals + hires', 'total + hires', 2)} END AS projected_rate_pct FROM plan"""

_HIRING_PLAN = f"""SELECT org_id, target_tier, m AS month, (hires + 2) // 3 AS months_to_complete,
  hires AS total_hires, least(3, hires - 3 * (m - 1)) AS hires_this_month,
  sum(least(3, hires - 3 * (m - 1))) OVER w AS cumulative_hires,
  {pct('nationals + sum(least(3, hires - 3 * (m - 1))) OVER w', 'total + sum(least(3, hires - 3 * (m - 1))) OVER w', 2)}
    AS projected_rate_pct,
  least(3, hires - 3 * (m - 1)) * 8000 AS new_payroll,
  sum(least(3, hires - 3 * (m - 1)) * 8000) OVER w AS cumulative_payroll,
  hires * 8000 * 12 AS annual_cost
FROM (SELECT *, unnest(generate_series(1, (hires + 2) // 3)) AS m FROM plan
      WHERE target_tier = 'Mid_Green' AND hires > 0)
WINDOW w AS (PARTITION BY org_id ORDER BY m)"""
_HIRING_PLAN = f"""SELECT org_id, target_tier, {big('month')} AS month, {big('months_to_complete')} AS months_to_complete,
  {big('total_hires')} AS total_hires, {big('hires_this_month')} AS hires_this_month,
  {big('cumulative_hires')} AS cumulative_hires, projected_rate_pct, {big('new_payroll')} AS new_payroll,
  {big('cumulative_payroll')} AS cumulative_payroll, {big('annual_cost')} AS annual_cost FROM ({_HIRING_PLAN})"""

SCENARIOS = """scenario(scenario, nh, nd, oh, od) AS (VALUES
  ('grow', 5, 0, 0, 0), ('swap', 3, 0, 0, 3), ('shrink', 0, 4, 0, 1), ('idle', 0, 0, 0, 0))"""

_WHAT_IF = f"""SELECT w.* EXCLUDE (new_rate_raw), {rnd('new_rate_pct - current_rate_pct', 2)} AS pct_change,
  CASE WHEN rank_new < rank_old THEN 'UPGRADE' WHEN rank_new > rank_old THEN 'DOWNGRADE' ELSE 'NO_CHANGE' END AS tier_impact,
  CASE sign(new_nationals * greatest(current_total, 1) - current_nationals * greatest(new_total, 1))
    WHEN 1 THEN 'IMPROVEMENT' WHEN -1 THEN 'DECLINE' ELSE 'NO_CHANGE' END AS rate_impact
FROM (
  SELECT *, list_position(['Platinum', 'High_Green', 'Mid_Green', 'Low_Green', 'Yellow', 'Red'], current_tier) AS rank_old,
    list_position(['Platinum', 'High_Green', 'Mid_Green', 'Low_Green', 'Yellow', 'Red'], projected_tier) AS rank_new
  FROM (
    SELECT org_id, name, scenario, nationals AS current_nationals, non_nationals AS current_others,
      total AS current_total, rate_pct AS current_rate_pct, tier AS current_tier, new_nationals, new_others,
      CAST(new_nationals + new_others AS BIGINT) AS new_total,
      coalesce({pct('new_nationals', 'new_nationals + new_others', 2)}, 0) AS new_rate_pct,
      coalesce(new_nationals * 100.0 / nullif(new_nationals + new_others, 0), 0) AS new_rate_raw,
      CASE WHEN coalesce(new_nationals * 100.0 / nullif(new_nationals + new_others, 0), 0) >= platinum_pct THEN 'Platinum'
        WHEN coalesce(new_nationals * 100.0 / nullif(new_nationals + new_others, 0), 0) >= high_green_pct THEN 'High_Green'
        WHEN coalesce(new_nationals * 100.0 / nullif(new_nationals + new_others, 0), 0) >= mid_green_pct THEN 'Mid_Green'
        WHEN coalesce(new_nationals * 100.0 / nullif(new_nationals + new_others, 0), 0) >= low_green_pct THEN 'Low_Green'
        WHEN coalesce(new_nationals * 100.0 / nullif(new_nationals + new_others, 0), 0) >= 6 THEN 'Yellow'
        ELSE 'Red' END AS projected_tier
    FROM (
      SELECT o.*, s.scenario, r.platinum_pct, r.high_green_pct, r.mid_green_pct, r.low_green_pct,
        CAST(greatest(0, o.nationals + nh - nd) AS BIGINT) AS new_nationals,
        CAST(greatest(0, o.non_nationals + oh - od) AS BIGINT) AS new_others
      FROM orgc o CROSS JOIN scenario s LEFT JOIN rules r ON r.sector = o.sector AND r.size = o.size))) w"""
_WHAT_IF = f"SELECT * EXCLUDE (rank_old, rank_new) FROM ({_WHAT_IF})"

_TOP = """SELECT org_id, substring(name, 1, 20) AS name, current_tier, hires FROM plan
WHERE target_tier = 'Mid_Green' AND hires > 0 ORDER BY hires DESC, org_id LIMIT 10"""

_BY_TIER = f"""SELECT current_tier, count(*) AS orgs, {big('sum(hires)')} AS hires FROM plan
WHERE target_tier = 'Mid_Green' AND hires > 0 GROUP BY current_tier"""

_DOCUMENTS = f"""SELECT org_id, target_tier, {big('hires')} AS total_hires, {big('hires * 8000 * 12')} AS annual_cost,
  {big('(hires + 2) // 3')} AS months, {big('hires - 3 * ((hires + 2) // 3 - 1)')} AS last_hires,
  {pct('nationals + hires', 'total + hires', 2)} AS final_rate_pct, {big('hires * 8000')} AS final_payroll
FROM plan WHERE target_tier = 'Mid_Green' AND hires > 0"""

SQL = {
    "org_clean": query(_ORG_CLEAN, "orgc"),
    "person_clean": query(_PERSON_CLEAN, "personc"),
    "org_people_summary": query("SELECT * FROM summary", "summary"),
    "org_gap": query("SELECT * FROM gap", "gap"),
    "attrition_risk": query("SELECT * FROM attrition", "attrition"),
    "kpi_tier": query(_KPI_TIER, "gap"),
    "kpi_sector": query(_KPI_SECTOR, "summary", "bench"),
    "kpi_region": query(_KPI_REGION, "summary"),
    "risk_score": query("SELECT * FROM risk", "risk"),
    "at_risk_orgs": query(_AT_RISK, "risk"),
    "layers_at_risk": query(_AT_RISK, "risk"),
    "layers_departments": query(_DEPT, "orgc", "personc"),
    "exec_dashboard": query(_EXEC, "risk"),
    "department_share": query(_DEPT, "orgc", "personc"),
    "hires_to_target": query(_HIRES, "orgc", extra=HIRES),
    "hiring_plan": query(_HIRING_PLAN, "orgc", extra=HIRES),
    "hiring_plan_documents": query(_DOCUMENTS, "orgc", extra=HIRES),
    "what_if": query(_WHAT_IF, "orgc", extra=SCENARIOS),
    "top_hires": query(_TOP, "orgc", extra=HIRES),
    "hires_by_tier": query(_BY_TIER, "orgc", extra=HIRES),
}
