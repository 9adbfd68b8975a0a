"""Building blocks: raw tables as CTEs and exact rounding."""

from __future__ import annotations

AS_OF = "DATE '2000-01-01'"

_SECTORS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
_SIZES = ["Micro", "Small", "Medium", "Large"]

_RULES = "rules(sector, size, platinum_pct, high_green_pct, mid_green_pct, low_green_pct) AS (VALUES " + ", ".join(
    f"('{sector}', '{size}', " + ", ".join(f"CAST({base + 2 * z + s + z / 8} AS DOUBLE)" for base in (48, 38, 28, 18)) + ")"
    for s, sector in enumerate(_SECTORS)
    for z, size in enumerate(_SIZES)
) + ")"

_BENCH = """bench(sector, avg_pct, median_pct, top_quartile_pct, trend) AS (VALUES
  ('AUTOMOBILE', CAST(31.5 AS DOUBLE), CAST(30 AS DOUBLE), CAST(41 AS DOUBLE), 'up'),
  ('BUILDING', 33.25, 32, 43.5, 'flat'),
  ('FURNITURE', 29, 28.5, 39, 'down'),
  ('HOUSEHOLD', 35.75, 34, 45.25, 'up'))"""

_ORG = """org AS (
  SELECT b.*, CAST(b.nationals AS DOUBLE) / nullif(b.total, 0) AS rate,
    CASE WHEN CAST(b.nationals AS DOUBLE) / nullif(b.total, 0) * 100 >= r.platinum_pct THEN 'Platinum'
         WHEN CAST(b.nationals AS DOUBLE) / nullif(b.total, 0) * 100 >= r.high_green_pct THEN 'High_Green'
         WHEN CAST(b.nationals AS DOUBLE) / nullif(b.total, 0) * 100 >= r.mid_green_pct THEN 'Mid_Green'
         WHEN CAST(b.nationals AS DOUBLE) / nullif(b.total, 0) * 100 >= r.low_green_pct THEN 'Low_Green'
         WHEN CAST(b.nationals AS DOUBLE) / nullif(b.total, 0) * 100 >= 6 THEN 'Yellow'
         ELSE 'Red' END AS tier
  FROM (
    SELECT c_custkey AS org_id, c_name AS name, 'CR-' || c_custkey AS registration_no, c_mktsegment AS sector,
      CASE WHEN count(o_orderkey) < 8 THEN 'Micro' WHEN count(o_orderkey) < 10 THEN 'Small'
           WHEN count(o_orderkey) < 12 THEN 'Medium' ELSE 'Large' END AS size,
      r_name AS region, CAST(count(o_orderkey) AS INT) AS total,
      CAST(count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS INT) AS nationals,
      CAST(count(CASE WHEN o_orderstatus <> 'F' THEN 1 END) AS INT) AS non_nationals,
      CAST(min(o_orderdate) AS DATE) AS registration_date, max(o_orderdate) AS last_updated
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
      LEFT JOIN orders ON o_custkey = c_custkey
    GROUP BY ALL) b
  LEFT JOIN rules r ON r.sector = b.sector AND r.size = b.size)"""

_ORGC = """orgc AS (
  SELECT *, CAST(round(CAST(rate * 100 AS DECIMAL(18,10)), 2) AS DOUBLE) AS rate_pct,
    CASE WHEN tier IN ('Platinum', 'High_Green') THEN 'Compliant'
         WHEN tier IN ('Mid_Green', 'Low_Green') THEN 'At Risk' ELSE 'Non-Compliant' END AS compliance_status
  FROM org)"""

_PERSON = """person AS (
  SELECT o_orderkey AS person_id, o_custkey AS org_id,
    CASE WHEN o_orderstatus = 'F' THEN 'N' ELSE o_orderstatus END AS nationality,
    o_orderpriority AS job_title, 'Dept ' || (o_orderkey % 7) AS department, CAST(floor(o_totalprice) AS INT) AS salary,
    CASE WHEN o_orderkey % 5 = 0 THEN 'Permanent' ELSE 'Fixed-term' END AS contract_type,
    CAST(o_orderdate AS DATE) AS hire_date,
    CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderdate AS DATE) + 1095 END AS contract_end,
    o_orderkey % 3 = 0 AS is_remote,
    CASE WHEN o_orderkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender
  FROM orders)"""

_PERSONC = f"""personc AS (
  SELECT *, nationality = 'N' AS is_national,
    CAST(date_diff('day', hire_date, {AS_OF}) AS INT) AS tenure_days,
    CAST(round(CAST(date_diff('day', hire_date, {AS_OF}) / 365.25 AS DECIMAL(18,10)), 1) AS DOUBLE) AS tenure_years,
    CASE WHEN contract_end IS NULL THEN 'No End Date' WHEN contract_end < {AS_OF} THEN 'Expired'
         WHEN contract_end < {AS_OF} + 30 THEN 'Expiring Soon'
         WHEN contract_end < {AS_OF} + 90 THEN 'Expiring in 90 Days' ELSE 'Active' END AS contract_status,
    CASE WHEN salary < 5000 THEN 'Entry Level' WHEN salary < 10000 THEN 'Mid Level'
         WHEN salary < 20000 THEN 'Senior Level' ELSE 'Executive' END AS salary_band
  FROM person)"""

_ALERT = """alert AS (
  SELECT event_id AS alert_id, user_id AS org_id, c_name AS org_name, event_type AS alert_type,
    CASE event_type WHEN 'error' THEN 'High' WHEN 'purchase' THEN 'Medium' ELSE 'Low' END AS severity,
    event_type || ' reported' AS message, 'Review ' || event_type AS recommended_action,
    ts AS created, event_id % 3 = 0 AS is_read
  FROM events LEFT JOIN customer ON user_id = c_custkey)"""

# Prices have two decimals and quantities none, so hundredths are whole numbers.
_TRADE = """trade AS (
  SELECT event_type AS symbol, event_id AS trade_id, value AS price,
    CAST(json_extract(props, '$.k') AS BIGINT) AS q, CAST(round(value * 100) AS BIGINT) AS p100,
    CAST(round(value * 100) AS BIGINT) * CAST(json_extract(props, '$.k') AS BIGINT) AS v100,
    epoch_us(ts) // 1000 AS ms, user_id % 2 = 0 AS maker, ts
  FROM events)"""


def ratio(n: str, d: str, places: int, times: int = 1) -> str:
    """round(times * n / d, places) of whole numbers, half away from zero, without floating point."""
    scale = times * 10**places
    n, d = f"CAST({n} AS HUGEINT)", f"nullif(CAST({d} AS HUGEINT), 0)"
    return f"(CAST(sign({n}) * ((2 * {scale} * abs({n}) + {d}) // (2 * {d})) AS DOUBLE) / {10**places})"


def pct(n: str, d: str, places: int = 2) -> str:
    return ratio(n, d, places, 100)


def mean(x: str, places: int, stored: int = 0) -> str:
    return ratio(f"sum(CAST(round({x} * {10**stored}) AS BIGINT))", f"count({x}) * {10**stored}", places)


def rnd(x: str, places: int) -> str:
    """Half-up rounding of a double, with its binary noise removed first."""
    return f"CAST(round(CAST({x} AS DECIMAL(28,10)), {places}) AS DOUBLE)"


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def count_if(p: str) -> str:
    return f"count(CASE WHEN {p} THEN 1 END)"


def hires(n: str, s: str, t: str) -> str:
    """ceil((t*n - 100*s) / (100 - t)) for a threshold t in percent of at most three decimals."""
    t = f"CAST(round({t} * 1000) AS BIGINT)"
    short = f"({t} * {n} - 100000 * {s})"
    left = f"(100000 - {t})"
    return f"CAST(CASE WHEN {short} > 0 THEN ({short} + {left} - 1) // {left} ELSE {short} // {left} END AS BIGINT)"


_GAP = f"""gap AS (
  SELECT c.org_id, c.name, c.sector, c.size, c.region, c.total, c.nationals, c.rate_pct, c.tier, c.compliance_status,
    r.platinum_pct, r.high_green_pct, r.mid_green_pct, r.low_green_pct,
    {rnd('r.platinum_pct - c.rate_pct', 2)} AS gap_to_platinum,
    {rnd('r.high_green_pct - c.rate_pct', 2)} AS gap_to_high_green,
    {rnd('r.mid_green_pct - c.rate_pct', 2)} AS gap_to_mid_green,
    {rnd('r.low_green_pct - c.rate_pct', 2)} AS gap_to_low_green,
    CASE c.tier WHEN 'Platinum' THEN 0
      WHEN 'High_Green' THEN {hires('c.total', 'c.nationals', 'r.platinum_pct')}
      WHEN 'Mid_Green' THEN {hires('c.total', 'c.nationals', 'r.high_green_pct')}
      WHEN 'Low_Green' THEN {hires('c.total', 'c.nationals', 'r.mid_green_pct')}
      ELSE {hires('c.total', 'c.nationals', 'r.low_green_pct')} END AS hires_for_next_tier,
    CASE c.tier WHEN 'Platinum' THEN 'Already at Platinum' WHEN 'High_Green' THEN 'Platinum'
      WHEN 'Mid_Green' THEN 'High_Green' WHEN 'Low_Green' THEN 'Mid_Green' ELSE 'Low_Green' END AS next_tier
  FROM orgc c LEFT JOIN rules r ON r.sector = c.sector AND r.size = c.size)"""

_SUMMARY = f"""summary AS (
  SELECT c.org_id, c.name, c.sector, c.size, c.region, c.tier, c.compliance_status, c.rate_pct, s.* EXCLUDE (org_id)
  FROM orgc c LEFT JOIN (
    SELECT org_id, count(*) AS people, {count_if('is_national')} AS national_people,
      {count_if('NOT is_national')} AS other_people, {mean('salary', 0)} AS avg_salary,
      {mean('CASE WHEN is_national THEN salary END', 0)} AS avg_national_salary,
      {mean('CASE WHEN NOT is_national THEN salary END', 0)} AS avg_other_salary,
      {mean('tenure_years', 1, 1)} AS avg_tenure_years,
      count(DISTINCT department) AS departments, count(DISTINCT job_title) AS job_titles,
      {count_if("is_national AND contract_status = 'Expiring Soon'")} AS national_expiring_30d,
      {count_if("is_national AND contract_status = 'Expiring in 90 Days'")} AS national_expiring_90d
    FROM personc GROUP BY org_id) s ON s.org_id = c.org_id)"""

_ATTRITION = f"""attrition AS (
  SELECT p.person_id, p.org_id, o.name AS org_name, o.sector, o.tier, p.nationality, p.is_national, p.job_title,
    p.department, p.salary, p.salary_band, p.hire_date, p.contract_end, p.contract_status, p.tenure_years,
    CASE WHEN is_national AND contract_status IN ('Expiring Soon', 'Expired') THEN 'Critical'
      WHEN is_national AND contract_status = 'Expiring in 90 Days' THEN 'High'
      WHEN is_national AND tier IN ('Yellow', 'Red', 'Low_Green') THEN 'Medium' ELSE 'Low' END AS risk_level,
    CASE WHEN is_national THEN {pct('o.nationals - 1', 'o.total', 2)} ELSE o.rate_pct END AS rate_pct_if_leaves
  FROM personc p JOIN orgc o ON o.org_id = p.org_id)"""

_RISK = """risk AS (
  SELECT *,
    floor(CASE tier WHEN 'Red' THEN 40 WHEN 'Yellow' THEN 30 WHEN 'Low_Green' THEN 20 WHEN 'Mid_Green' THEN 10
      WHEN 'High_Green' THEN 5 ELSE 0 END + least(critical_people * 10, 30) + least(high_alerts * 10, 20)
      + least(greatest(coalesce(gap_to_low_green, 0), 0), 10) + 0.5) AS risk_score,
    CASE WHEN tier = 'Red' THEN 'Critical' WHEN tier = 'Yellow' OR critical_people > 2 THEN 'High'
      WHEN tier = 'Low_Green' OR high_alerts > 0 THEN 'Medium' ELSE 'Low' END AS risk_category
  FROM (
    SELECT g.org_id, g.name, g.sector, g.region, g.tier, g.total, g.nationals, g.rate_pct, g.hires_for_next_tier,
      g.gap_to_low_green, coalesce(a.critical_people, 0) AS critical_people, coalesce(a.high_people, 0) AS high_people,
      coalesce(a.national_expiring_30d, 0) AS national_expiring_30d, coalesce(l.active_alerts, 0) AS active_alerts,
      coalesce(l.high_alerts, 0) AS high_alerts
    FROM gap g LEFT JOIN (
      SELECT org_id, count(CASE WHEN risk_level = 'Critical' THEN 1 END) AS critical_people,
        count(CASE WHEN risk_level = 'High' THEN 1 END) AS high_people,
        count(CASE WHEN is_national AND contract_status = 'Expiring Soon' THEN 1 END) AS national_expiring_30d
      FROM attrition GROUP BY org_id) a ON a.org_id = g.org_id
    LEFT JOIN (
      SELECT org_id, count(*) AS active_alerts, count(CASE WHEN severity = 'High' THEN 1 END) AS high_alerts
      FROM alert WHERE NOT is_read GROUP BY org_id) l ON l.org_id = g.org_id))"""

_PARTS = {
    "rules": (_RULES, ()),
    "bench": (_BENCH, ()),
    "org": (_ORG, ("rules",)),
    "orgc": (_ORGC, ("org",)),
    "person": (_PERSON, ()),
    "personc": (_PERSONC, ("person",)),
    "alert": (_ALERT, ()),
    "trade": (_TRADE, ()),
    "gap": (_GAP, ("orgc",)),
    "summary": (_SUMMARY, ("orgc", "personc")),
    "attrition": (_ATTRITION, ("orgc", "personc")),
    "risk": (_RISK, ("gap", "attrition", "alert")),
}


def query(select: str, *names: str, extra: str = "") -> str:
    """SELECT with the named parts, and what they need, as CTEs in front."""
    order: list[str] = []

    def add(name: str) -> None:
        for need in _PARTS[name][1]:
            add(need)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    ctes = [_PARTS[n][0] for n in order] + ([extra] if extra else [])
    return f"WITH {', '.join(ctes)} {select}" if ctes else select
