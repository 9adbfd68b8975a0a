"""Row expectations, the rule catalogue and its validation, anomaly log and quality views."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import numeric as N
from ..policy import Policy, QualityPolicy

#: Short names of the checked tables; callers say which stored table each stands for.
ORGS, PEOPLE = "organisations", "people"


def sql_list(values: Sequence[str]) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


def sql_value(value) -> str:
    return f"DATE'{value.isoformat()}'" if isinstance(value, dt.date) else str(value)


# --- what valid values are ------------------------------------------------------------------


@dataclass(frozen=True)
class Valid:
    """What is known of a column's valid values; every part that is given becomes a check of its own.

    Nulls are judged by ``required`` alone. ``key`` and ``known_in`` concern the whole table: no value twice, and every row's
    value, null included, among the other table's.
    """

    column: str
    required: bool = False
    among: Sequence[str] | None = None
    least: object = None
    most: object = None
    agrees: str | None = None
    key: bool = False
    known_in: str | None = None
    weight: str = "medium"

    def checks(self, table: str) -> list[Check]:
        col = self.column
        limits = [f"{col} {op} {sql_value(v)}" for op, v in ((">=", self.least), ("<=", self.most)) if v is not None]
        parts = [
            ("present", self.required, f"{col} IS NOT NULL"),
            ("listed", self.among is not None, f"{col} IN {sql_list(self.among or ())}"),
            ("within", bool(limits), " AND ".join(limits)),
            ("agrees", self.agrees is not None, self.agrees or ""),
            ("single", self.key, f"{col} IS UNIQUE"),
            ("known", self.known_in is not None, f"{col} IN TABLE {self.known_in}"),
        ]
        return [Check(table, col, part, text, self.weight, self.known_in) for part, given, text in parts if given]


#: Kind of every part and how a catalogue describes it.
PARTS = {
    "present": ("completeness", "no value is missing"),
    "listed": ("validity", "values come from the list"),
    "within": ("validity", "values lie within the bounds"),
    "agrees": ("consistency", "the value follows from the other columns"),
    "single": ("uniqueness", "no value occurs twice"),
    "known": ("consistency", "the value exists in the other table"),
}


@dataclass(frozen=True)
class Check:
    """One generated check; its id is table, column and part."""

    table: str
    column: str
    part: str
    condition: str
    weight: str
    known_in: str | None = None
    is_active: bool = True

    @property
    def id(self) -> str:
        return f"{self.table}.{self.column}.{self.part}"

    @property
    def by_row(self) -> bool:
        return self.part not in ("single", "known")


def declaration(
    as_of: dt.date, policy: Policy = Policy(), bounds: QualityPolicy = QualityPolicy()
) -> dict[str, tuple[Valid, ...]]:
    """Valid values of both raw tables."""
    near = f"abs(rate - try_divide(nationals, total)) <= {bounds.rate_tolerance}"
    return {
        PEOPLE: (
            Valid("contract_type", among=policy.contract_types),
            Valid("gender", among=policy.genders),
            Valid("hire_date", most=as_of, weight="high"),
            Valid("nationality", required=True, weight="critical"),
            Valid("org_id", known_in=ORGS, weight="critical"),
            Valid("person_id", required=True, key=True, weight="critical"),
            Valid("salary", least=bounds.salary_min, most=bounds.salary_max),
        ),
        ORGS: (
            Valid("name", required=True, weight="high"),
            Valid("nationals", least=0),
            Valid("org_id", required=True, key=True, weight="critical"),
            Valid("rate", least=0, most=1, agrees=near, weight="high"),
            Valid("sector", among=policy.sectors, weight="high"),
            Valid("size", among=policy.sizes),
            Valid("tier", among=policy.tiers, weight="critical"),
            Valid("total", least=1, agrees="total = nationals + non_nationals", weight="critical"),
        ),
    }


def checks(declared: Mapping[str, Sequence[Valid]]) -> list[Check]:
    return [c for table, columns in declared.items() for valid in columns for c in valid.checks(table)]


# --- expectations ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Expectation:
    """A named condition on rows; ``warn`` only counts violations, ``drop`` also removes the rows.

    A condition that is null is met unless ``null_passes`` is turned off.
    """

    name: str
    condition: str
    policy: str = "warn"
    null_passes: bool = True

    def met(self) -> Column:
        return F.coalesce(F.expr(self.condition), F.lit(self.null_passes))


def add_expectation(rules: Sequence[Expectation], rule: Expectation) -> tuple[Expectation, ...]:
    """Rules with ``rule`` in; a rule of that name that is already there stays as it is."""
    return tuple(rules) if any(r.name == rule.name for r in rules) else (*rules, rule)


def expectations(rules: Sequence[Check], table: str) -> tuple[Expectation, ...]:
    """The row checks of a table as expectations."""
    return tuple(Expectation(c.id, c.condition) for c in rules if c.table == table and c.by_row)


def violations(df: DataFrame, rules: Sequence[Expectation]) -> DataFrame:
    """Violations per rule from one pass over the rows."""
    counts = df.agg(
        F.count(F.lit(1)).alias("total"), *[N.count_where(~r.met()).alias(f"v{i}") for i, r in enumerate(rules)]
    )
    rows = [
        F.struct(
            F.lit(r.name).alias("expectation"),
            F.lit(r.policy).alias("policy"),
            F.col("total").alias("rows_checked"),
            F.col(f"v{i}").alias("violations"),
        )
        for i, r in enumerate(rules)
    ]
    return counts.select(F.inline(F.array(*rows)))


def check(df: DataFrame, rules: Sequence[Expectation]) -> tuple[DataFrame, DataFrame]:
    """Rows that stay (all but those a ``drop`` rule rejects) and the violation counts."""
    return C.where_all(df, [r.met() for r in rules if r.policy == "drop"]), violations(df, rules)


# --- rule catalogue -------------------------------------------------------------------------


def rules_catalog(
    spark: SparkSession, rules: Sequence[Check], now: dt.datetime | None = None, names: Mapping[str, str] | None = None
) -> DataFrame:
    """The checks as a table; ``names`` are the stored tables they concern."""
    rows = [
        (c.id, f"{c.column}: {PARTS[c.part][1]}", c.condition, _named(names, c.table), c.column, PARTS[c.part][0], c.weight, c.is_active)
        for c in rules
    ]
    schema = (
        "rule_id string, rule_name string, rule_expression string, target_table string, target_column string, "
        "rule_type string, severity string, is_active boolean"
    )
    df = spark.createDataFrame(rows, schema)
    return C.stamp(C.stamp(df, "created_date", now), "last_updated", now)


def _named(names: Mapping[str, str] | None, table: str) -> str:
    return (names or {}).get(table, table)


def _result(rule: Check, total: Column, failed: Column) -> Column:
    return F.struct(
        F.lit(rule.id).alias("rule_id"),
        F.lit(f"{rule.column}: {PARTS[rule.part][1]}").alias("rule_name"),
        F.lit(rule.table).alias("table_name"),
        F.lit(rule.column).alias("column_name"),
        F.lit(PARTS[rule.part][0]).alias("check_type"),
        total.alias("total_records"),
        failed.alias("failed_records"),
    )


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows of ``child`` whose key is not in ``parent``; a null key counts as not found."""
    return child.join(C.unaligned(parent.select(key)), key, "left_anti")


def _row_results(df: DataFrame, rules: Sequence[Check]) -> DataFrame:
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[N.count_where(~F.expr(r.condition)).alias(f"c{i}") for i, r in enumerate(rules)],
    )
    return counts.select(F.inline(F.array(*[_result(r, F.col("total"), F.col(f"c{i}")) for i, r in enumerate(rules)])))


def _unique_result(df: DataFrame, rule: Check) -> DataFrame:
    """Own pass over the key column alone, so only keys are shuffled, not the other counts with them."""
    counts = df.agg(F.count(F.lit(1)).alias("total"), F.count_distinct(rule.column).alias("distinct_ids"))
    row = _result(rule, F.col("total"), F.col("total") - F.col("distinct_ids"))
    return counts.select(F.inline(F.array(row)))


def _reference_result(child: DataFrame, parent: DataFrame, rule: Check) -> DataFrame:
    """Keys are counted before the join, so a key with very many rows joins as one row."""
    key = rule.column
    counted = child.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    known = parent.select(F.col(key).alias("known_key")).distinct()
    counts = counted.join(known, counted[key] == known["known_key"], "left").agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.when(F.col("known_key").isNull(), F.col("rows"))), F.lit(0)).alias("missing"),
    )
    return counts.select(F.inline(F.array(_result(rule, F.col("total"), F.col("missing")))))


def _shown(names: Mapping[str, str] | None) -> Column:
    table = F.col("table_name")
    return C.map_values(table, names or {}, table).alias("table_name")


def validate(
    tables: Mapping[str, DataFrame], rules: Sequence[Check], now=None, names: Mapping[str, str] | None = None
) -> DataFrame:
    """Result row of every active check: at most three reads of a table, for its row, key and reference checks.

    ``tables`` go by their short names; ``names`` are the stored names shown in the result.
    """
    active = [r for r in rules if r.is_active]
    parts = []
    for name, df in tables.items():
        mine = [r for r in active if r.table == name]
        if row_rules := [r for r in mine if r.by_row]:
            parts.append(_row_results(df, row_rules))
        parts += [_unique_result(df, r) for r in mine if r.part == "single"]
        parts += [_reference_result(df, tables[r.known_in], r) for r in mine if r.part == "known"]
    total, failed = F.col("total_records"), F.col("failed_records")
    out = reduce(DataFrame.unionByName, parts).select(
        "rule_id",
        "rule_name",
        _shown(names),
        "column_name",
        "check_type",
        "total_records",
        (total - failed).alias("passed_records"),
        "failed_records",
        F.coalesce(N.pct(total - failed, total, 2), F.lit(100.0)).alias("pass_rate"),
        F.when(failed == 0, "PASSED").otherwise("FAILED").alias("status"),
    )
    return C.stamp(out, "check_timestamp", now)


def summary(results: DataFrame, now=None) -> DataFrame:
    """Rule and record counts, mean and lowest pass rate per table."""
    passed, failed = (F.col("status") == s for s in ("PASSED", "FAILED"))
    out = results.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("total_rules_checked"),
        N.count_where(passed).alias("rules_passed"),
        N.count_where(failed).alias("rules_failed"),
        F.sum("total_records").alias("total_records_checked"),
        F.sum("passed_records").alias("total_records_passed"),
        F.sum("failed_records").alias("total_records_failed"),
        N.mean(F.col("pass_rate"), 2, stored=2).alias("avg_record_pass_rate"),
        F.min("pass_rate").alias("min_pass_rate"),
    )
    out = out.withColumns(
        {
            "rule_pass_rate": N.pct(F.col("rules_passed"), F.col("total_rules_checked"), 1),
            "weighted_dq_score": F.col("avg_record_pass_rate"),
        }
    )
    return C.stamp(out, "last_check_time", now)


# --- anomalies ------------------------------------------------------------------------------


def _anomaly(when: Column, kind: str, record: str, table: str, column: str, value: Column, text: Column, severity) -> Column:
    return F.when(
        when,
        F.struct(
            F.lit(kind).alias("anomaly_type"),
            F.col(record).cast("string").alias("record_id"),
            F.lit(table).alias("table_name"),
            F.lit(column).alias("column_name"),
            value.alias("value"),
            text.alias("anomaly_description"),
            (severity if isinstance(severity, Column) else F.lit(severity)).alias("severity"),
        ),
    )


# Kinds, texts and severities of anomalies must equal the published ones.
SALARY_KIND, RATE_KIND, SIZE_KIND = "salary_anomaly", "calculation_mismatch", "employee_count_outlier"
RATE_TEXT = "Stored rate does not match calculated value"


def salary_anomaly(bounds: QualityPolicy = QualityPolicy()) -> Column:
    """Salary outside the usual range; severe outside the wider one."""
    pay = F.col("salary")
    low, high = bounds.odd_salary
    text = F.concat(
        F.lit("Salary "),
        F.when(pay < low, "unusually low").otherwise("unusually high"),
        F.lit(" for "),
        F.col("job_title"),
    )
    severity = F.when((pay < bounds.severe_salary[0]) | (pay > bounds.severe_salary[1]), "High").otherwise("Medium")
    odd = (pay < low) | (pay > high)
    return _anomaly(odd, SALARY_KIND, "person_id", PEOPLE, "salary", pay.cast("string"), text, severity)


def rate_anomaly(bounds: QualityPolicy = QualityPolicy()) -> Column:
    """Stored rate away from nationals / total."""
    actual = F.try_divide(F.col("nationals").cast("double"), F.col("total").cast("double"))
    value = F.concat(
        F.col("rate").cast("string"), F.lit(" vs calculated: "), F.round(actual, 4).cast("string")
    )
    text = F.lit(RATE_TEXT)
    off = F.abs(F.col("rate") - actual) > bounds.rate_tolerance
    return _anomaly(off, RATE_KIND, "org_id", ORGS, "rate", value, text, "High")


def size_anomaly(bounds: QualityPolicy = QualityPolicy()) -> Column:
    """Headcount that does not fit the size category."""
    total = F.col("total")
    cases = [
        (F.col("size") == size) & (total < bound if op == "<" else total > bound) for size, op, bound in bounds.size_bounds
    ]
    text = F.concat(
        F.lit("Organisation has "),
        F.when(total < bounds.few_below, "very few").otherwise("unusually many"),
        F.lit(" employees for size category: "),
        F.col("size"),
    )
    odd = reduce(lambda a, b: a | b, cases)
    return _anomaly(odd, SIZE_KIND, "org_id", ORGS, "total", total.cast("string"), text, "Low")


def detect(df: DataFrame, *detectors: Column) -> DataFrame:
    """Anomalies of all ``detectors`` from one pass; a row may raise several."""
    return df.select(F.inline(F.filter(F.array(*detectors), lambda a: a.isNotNull())))


def anomalies(
    orgs: DataFrame, people: DataFrame, bounds: QualityPolicy = QualityPolicy(), now=None, names: Mapping[str, str] | None = None
) -> DataFrame:
    """Anomaly log over both tables."""
    out = detect(people, salary_anomaly(bounds)).unionByName(detect(orgs, rate_anomaly(bounds), size_anomaly(bounds)))
    out = out.withColumn("table_name", _shown(names))
    return C.stamp(out, "detected_at", now)


# --- views ----------------------------------------------------------------------------------


def _metric(name: str, value: Column, unit: str, status: Column | str) -> Column:
    return F.struct(
        F.lit(name).alias("metric_name"),
        value.cast("double").alias("metric_value"),
        F.lit(unit).alias("metric_unit"),
        (status if isinstance(status, Column) else F.lit(status)).alias("status"),
    )


def dashboard(
    dq_summary: DataFrame, anomaly_log: DataFrame, bounds: QualityPolicy = QualityPolicy(), as_of=None
) -> DataFrame:
    """Four headline metrics with grades and, if given, the time they hold for; the summary is aggregated once for three."""
    score = F.col("weighted_dq_score")
    totals = dq_summary.agg(
        N.mean(score, 1, stored=2).alias("score"),
        F.sum(N.fixed(score, 2)).alias("score_sum"),
        F.count(score).alias("score_n"),
        F.sum("total_records_checked").alias("checked"),
        F.sum("total_records_failed").alias("failed"),
    )
    grade = F.when(F.lit(False), F.lit(None))
    for bound, label in bounds.grades:
        grade = grade.when(F.col("score_sum") >= F.col("score_n") * bound * 100, label)
    head = totals.select(
        F.inline(
            F.array(
                _metric("Overall Data Quality Score", F.col("score"), "%", grade.otherwise(bounds.lowest_grade)),
                _metric("Total Records Validated", F.col("checked"), "records", "Info"),
                _metric(
                    "Failed Records", F.col("failed"), "records",
                    F.when(F.col("failed") == 0, "Good").otherwise("Action Needed"),
                ),
            )
        )
    )
    found = anomaly_log.agg(F.count(F.lit(1)).alias("n")).select(
        F.inline(
            F.array(
                _metric(
                    "Anomalies Detected", F.col("n"), "issues",
                    F.when(F.col("n") == 0, "Good").otherwise("Review Needed"),
                )
            )
        )
    )
    return C.stamp(head.unionByName(found), "as_of", as_of)


def by_check_type(results: DataFrame) -> DataFrame:
    """Rules and mean pass rate per check type, worst first."""
    return (
        results.groupBy("check_type")
        .agg(
            F.count(F.lit(1)).alias("rules_count"),
            N.count_where(F.col("status") == "PASSED").alias("passed"),
            N.count_where(F.col("status") == "FAILED").alias("failed"),
            N.mean(F.col("pass_rate"), 1, stored=2).alias("avg_pass_rate"),
        )
        .orderBy("avg_pass_rate", "check_type")
    )


def failed_rules(results: DataFrame) -> DataFrame:
    """Rules with failures and, where it was recorded, the time of the check; most failures first."""
    time = [c for c in ("check_timestamp",) if c in results.columns]
    return (
        results.filter(F.col("status") == "FAILED")
        .select("rule_id", "rule_name", "table_name", "column_name", "check_type", "failed_records", "pass_rate", *time)
        .orderBy(F.desc("failed_records"), "rule_id")
    )
