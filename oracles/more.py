"""Gates, stored distinct counts and score curves."""

from .parts import big, query, ratio
from .quality import _BREAKS, _REPORTED

_ORDER = ("contract_type.listed", "gender.listed", "hire_date.within", "nationality.present", "person_id.present", "salary.within")
_RULES = {name: _BREAKS[("people", *name.split("."))] for name in _ORDER}
_DROPS = ("hire_date.within", "salary.within")
_BROKEN = "array_to_string(list_filter([" + ", ".join(
    f"CASE WHEN {p} THEN 'people.{n}' END" for n, p in _RULES.items()
) + "], lambda x: x IS NOT NULL), ',')"
_REJECTED = "coalesce(" + " OR ".join(f"({_RULES[n]})" for n in _DROPS) + ", false)"

_COUNTS = " UNION ALL ".join(
    f"""SELECT 'people.{n}' AS expectation, '{'drop' if n in _DROPS else 'warn'}' AS policy, count(*) AS rows_checked,
  count(CASE WHEN {p} THEN 1 END) AS violations FROM rperson"""
    for n, p in _RULES.items()
)

_DISTINCT = """SELECT symbol, count(DISTINCT trade_id) AS trades, count(DISTINCT trade_id * 2 // 100) AS order_blocks,
  count(DISTINCT ms // 60000) AS minutes FROM trade GROUP BY symbol"""

_CELLS = """cells AS (SELECT CAST(risk_score AS BIGINT) AS cell, count(*) AS n, sum(risk_score) AS scores,
  count(CASE WHEN high_alerts > 0 OR tier IN ('Yellow', 'Red') THEN 1 END) AS p FROM risk GROUP BY 1),
run AS (SELECT *, sum(n) OVER w AS called, sum(p) OVER w AS hits, sum(n) OVER () AS alln, sum(p) OVER () AS allp FROM cells
  WINDOW w AS (ORDER BY cell DESC))"""

SQL = {
    "dq_gate_rejected": query(
        f"SELECT person_id, salary, hire_date, {_BROKEN} AS broken FROM rperson WHERE {_REJECTED}", "org", "person", extra=_REPORTED
    ),
    "dq_gate_kept": query(
        f"SELECT {_BROKEN} AS broken, count(*) AS people, {big('sum(salary)')} AS salaries FROM rperson WHERE NOT {_REJECTED} GROUP BY 1",
        "org", "person", extra=_REPORTED,
    ),
    "dq_gate_stream": query(_COUNTS, "org", "person", extra=_REPORTED),
    "distinct_rollup": query(_DISTINCT, "trade"),
    "rule_risk_cutoffs": query(
        f"""SELECT CAST(cell AS DOUBLE) AS cutoff, {big('called')} AS called, {big('hits')} AS hits, {ratio('hits', 'called', 6)} AS precision,
          {ratio('hits', 'allp', 6)} AS recall, {ratio('called - hits', 'alln - allp', 6)} AS false_alarms FROM run""",
        "risk", extra=_CELLS,
    ),
    "rule_risk_areas": query(
        f"""SELECT {big('sum(n)')} AS rows, {big('sum(p)')} AS positives,
          round(CAST(sum((n - p) * (2 * hits - p)) AS DOUBLE) / nullif(2.0 * sum(p) * (sum(n) - sum(p)), 0), 6) AS roc_area,
          round(sum(p * hits / CAST(called AS DOUBLE)) / nullif(sum(p), 0), 6) AS average_precision FROM run""",
        "risk", extra=_CELLS,
    ),
    "rule_risk_calibration": query(
        f"""SELECT CAST(least(cell // 10, 9) AS BIGINT) AS band, {big('sum(n)')} AS rows, round(CAST(sum(scores) AS DOUBLE) / sum(n), 6) AS mean_score,
          {ratio('sum(p)', 'sum(n)', 6)} AS positive_share FROM cells GROUP BY 1""",
        "risk", extra=_CELLS,
    ),
}
