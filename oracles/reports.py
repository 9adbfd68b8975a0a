"""Reports, feature tables, files and layer counts."""

from .parts import count_if, pct, query, ratio, rnd

_STATS = f"""{ratio('sum(salary)', 'count(salary)', 0)} AS mean, round(stddev_samp(salary)) AS std,
  min(salary) AS min, max(salary) AS max"""

_HISTOGRAM = f"""SELECT b.bin, {rnd('lo + b.bin * ((hi - lo) / 20)', 4)} AS bin_start,
  {rnd('lo + (b.bin + 1) * ((hi - lo) / 20)', 4)} AS bin_end, coalesce(n, 0) AS count, {rnd('mean', 4)} AS mean
FROM (SELECT unnest(generate_series(0, 19)) AS bin) b
CROSS JOIN (SELECT min(rate * 100) AS lo, max(rate * 100) AS hi, avg(rate * 100) AS mean FROM org) s
LEFT JOIN (
  SELECT CAST(least(floor((rate * 100 - lo) * 20 / (hi - lo)), 19) AS BIGINT) AS bin, count(*) AS n
  FROM org, (SELECT min(rate * 100) AS lo, max(rate * 100) AS hi FROM org) WHERE rate IS NOT NULL
  GROUP BY 1) c ON c.bin = b.bin"""

_SIZES = ", ".join(count_if(f"size = '{s}'") + f' AS "{s}"' for s in ("Micro", "Small", "Medium", "Large"))
_SIZES += ", " + count_if("size IS NULL OR size NOT IN ('Micro', 'Small', 'Medium', 'Large')") + " AS other"

_FEATURES = """SELECT o.*, p.* EXCLUDE (org_id), coalesce(a.total_alerts, 0) AS total_alerts,
  coalesce(a.high_alerts, 0) AS high_alerts,
  CAST(coalesce(a.high_alerts, 0) > 0 OR tier IN ('Yellow', 'Red') AS INT) AS at_risk
FROM org o LEFT JOIN (
  SELECT org_id, n AS employee_count, s / n AS avg_salary,
    CASE WHEN n > 1 THEN sqrt(CAST(n * s2 - hs * hs AS DOUBLE) / (CAST(n AS DOUBLE) * (n - 1))) / 100 END AS salary_std, min_salary, max_salary,
    max_salary - min_salary AS salary_range, national_people, CAST(female AS DOUBLE) / n AS female_ratio,
    CAST(permanent AS DOUBLE) / n AS permanent_ratio, CAST(remote AS DOUBLE) / n AS remote_ratio,
    department_diversity, job_title_diversity, nationality_diversity
  FROM (
    SELECT org_id, count(*) AS n, CAST(sum(salary) AS DOUBLE) AS s,
      CAST(sum(salary) AS HUGEINT) * 100 AS hs, sum(CAST(salary AS HUGEINT) * salary) * 10000 AS s2, min(salary) AS min_salary, max(salary) AS max_salary,
      count(CASE WHEN nationality = 'N' THEN 1 END) AS national_people,
      count(CASE WHEN gender = 'Female' THEN 1 END) AS female,
      count(CASE WHEN contract_type = 'Permanent' THEN 1 END) AS permanent,
      count(CASE WHEN is_remote THEN 1 END) AS remote, count(DISTINCT department) AS department_diversity,
      count(DISTINCT job_title) AS job_title_diversity, count(DISTINCT nationality) AS nationality_diversity
    FROM person GROUP BY org_id)) p ON p.org_id = o.org_id
LEFT JOIN (
  SELECT org_id, count(*) AS total_alerts, count(CASE WHEN severity = 'High' THEN 1 END) AS high_alerts
  FROM alert GROUP BY org_id) a ON a.org_id = o.org_id"""

_ENCODED = ", ".join(
    f"CAST(dense_rank() OVER (ORDER BY {c}) - 1 AS DOUBLE) AS {c}_encoded" for c in ("sector", "size", "region", "tier")
)

_RAW = [("organisations", "org"), ("people", "person"), ("alerts", "alert")]
_AUDIT = " UNION ALL ".join(f"SELECT '{n}' AS name, '{n}.csv' AS mark, count(*) AS rows FROM {t}" for n, t in _RAW)
_AUDIT += " UNION ALL SELECT 'silver people', '2000-01-01', count(*) FROM personc"
_DRAW = "CAST('0x' || substr(md5(org_id || ':42'), 1, 8) AS BIGINT) % 10000"

SQL = {
    "describe_fractional": query(
        f"""SELECT sector, {rnd('avg(rate * 100)', 2)} AS mean, {rnd('stddev_samp(rate * 100)', 2)} AS std
        FROM org GROUP BY sector""",
        "org",
    ),
    "layers_audit": query(_AUDIT, "org", "personc", "alert"),
    "ndjson_malformed": (
        "SELECT event_id % 40 = 0 AS is_broken, count(*) AS lines, count(*) FILTER (WHERE event_id % 40 <> 0) AS trades "
        "FROM events GROUP BY 1"
    ),
    "hash_split": query(f"SELECT {_DRAW} < 2000 AS is_test, count(*) AS count FROM org GROUP BY 1", "org"),
    "tier_test_rows": query(
        "SELECT tier, CAST(floor(count(*) * 0.2 + 0.5) AS BIGINT) AS orgs FROM org GROUP BY tier", "org"
    ),
    "csv_roundtrip": query("SELECT * FROM org", "org"),
    "layer_counts": query(
        """SELECT 'layer_orgs' AS name, count(*) AS rows FROM org UNION ALL SELECT 'layer_people', count(*) FROM person
        UNION ALL SELECT 'layer_gap', count(*) FROM gap UNION ALL SELECT 'layer_alerts', count(*) FROM alert
        UNION ALL SELECT 'layer_missing', NULL""",
        "org", "person", "gap", "alert",
    ),
    "value_counts": query(
        f"""SELECT tier, count(*) AS count, {pct('count(*)', '(SELECT count(*) FROM org WHERE tier IS NOT NULL)', 1)}
        AS share_pct FROM org WHERE tier IS NOT NULL GROUP BY tier""",
        "org",
    ),
    "histogram": query(_HISTOGRAM, "org"),
    "crosstab": query(f"SELECT sector, {_SIZES} FROM org GROUP BY sector", "org"),
    "salary_by_sector": query(
        f"SELECT sector, {_STATS} FROM person p JOIN org o ON o.org_id = p.org_id GROUP BY sector", "org", "person"
    ),
    "salary_by_department": query(f"SELECT department, {_STATS} FROM person GROUP BY department", "person"),
    "sector_rate": query(f"SELECT sector, {rnd('avg(rate * 100)', 2)} AS mean FROM org GROUP BY sector", "org"),
    "org_features": query(_FEATURES, "org", "person", "alert"),
    "encoded": query(f"SELECT org_id, {_ENCODED} FROM org", "org"),
    "class_weights": query(
        """SELECT tier, count(*) AS count,
          CAST((SELECT count(*) FROM org) AS DOUBLE)
            / (CAST((SELECT count(DISTINCT tier) FROM org) AS DOUBLE) * count(*)) AS balanced_weight,
          CAST((SELECT count(*) FROM org) - count(*) AS DOUBLE) / count(*) AS rest_ratio FROM org GROUP BY tier""",
        "org",
    ),
    "stratified_split": query(
        """SELECT tier, is_test, CAST(orgs AS BIGINT) AS orgs FROM (
          SELECT tier, true AS is_test, floor(count(*) * 0.2 + 0.5) AS orgs FROM org GROUP BY tier
          UNION ALL SELECT tier, false, count(*) - floor(count(*) * 0.2 + 0.5) FROM org GROUP BY tier)""",
        "org",
    ),
}
