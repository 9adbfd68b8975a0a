"""Registered queries of gates, stored distinct counts and score curves."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .operators import curves, distinct, gold, models, quality, silver, trades
from .operators.features import org_features
from .operators.gate import BROKEN, Gate, Gated
from .plans.bindings import AS_OF, POLICY, Bindings
from .session import discard, scratch
from .sources import files
from .streaming import jobs


def _gate() -> Gate:
    """Row checks of people; salaries out of bounds and hire dates to come are rejected, the others only named."""
    rules = quality.expectations(quality.checks(quality.declaration(AS_OF, POLICY)), quality.PEOPLE)
    return Gate([replace(r, policy="drop") if r.name.endswith(("salary.within", "hire_date.within")) else r for r in rules])


def _gated(b: Bindings, path: str) -> Gated:
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in b.reported_people().schema.fields)
    return Gated(b.spark, path, schema)


def _gate_rejected(b: Bindings) -> DataFrame:
    base = scratch(b.spark, "gate")
    _gate().write(b.reported_people(), base)
    return _gated(b, base).rejected().select("person_id", "salary", "hire_date", F.array_join(BROKEN, ",").alias("broken"))


def _gate_kept(b: Bindings) -> DataFrame:
    """Kept rows by the rules they break."""
    base = scratch(b.spark, "gate")
    _gate().write(b.reported_people(), base)
    kept = _gated(b, base).kept()
    return kept.groupBy(F.array_join(BROKEN, ",").alias("broken")).agg(F.count(F.lit(1)).alias("people"), F.sum("salary").alias("salaries"))


def _gate_stream(b: Bindings) -> DataFrame:
    """Counts of the same gate on a stream of two batches."""
    base = scratch(b.spark, "gate")
    people, gate = b.reported_people(), _gate()
    for wave in (F.col("salary") % 2 == 0, F.col("salary") % 2 == 1):
        people.where(wave).write.mode("append").parquet(f"{base}/landing")
        stream = files.table_stream(b.spark, f"{base}/landing", people.schema)
        jobs.start_batches(stream, lambda rows, i: gate.write(rows, f"{base}/out", i) and None, f"{base}/ckpt").awaitTermination()
    discard(b.spark, f"{base}/landing", f"{base}/ckpt", f"{base}/out/rows")
    return _gated(b, f"{base}/out").counts()


def _distinct_rollup(b: Bindings) -> DataFrame:
    """Distinct ids per symbol from the bitmaps of each day, stored apart."""
    base = scratch(b.spark, "bitmaps")
    ids = {"trades": "trade_id", "order_blocks": F.expr("buyer_order_id div 100"), "minutes": F.expr("trade_time div 60000")}
    daily = trades.with_times(b.trades()).withColumn("batch_id", F.expr("trade_time div 86400000"))
    distinct.bitmaps(daily, ["batch_id", "symbol"], ids).write.partitionBy("batch_id").parquet(base)
    stored = b.spark.read.schema("symbol string, measure string, stretch bigint, bitmap binary, batch_id bigint").parquet(base)
    return distinct.united(stored, ["symbol"], list(ids))


def _rule_cells(b: Bindings) -> DataFrame:
    """Scores of the rules against whether an organisation has a high alert or a low tier."""
    org = silver.org_clean(b.orgs(), AS_OF, POLICY)
    counts = gold.risk_counts_from_people(silver.person_clean(b.people(), AS_OF, POLICY))
    scored = gold.risk_score(silver.org_gap(org, b.rules(), POLICY), counts, b.alerts(), POLICY)
    risky = (F.coalesce("high_alerts", F.lit(0)) > 0) | F.col("tier").isin(*POLICY.high_risk_tiers)
    return curves.score_cells(scored, "risk_score", risky.cast("int"), 0, 100, 100)


def _risk_report(b: Bindings) -> DataFrame:
    """Precision and recall of the fitted risk model at every cut-off, on the organisations it has not seen."""
    path = scratch(b.spark, "features")
    org_features(b.orgs(), b.people(), b.alerts(), POLICY).write.parquet(path)
    fitted = models.fit_risk_model(b.spark.read.parquet(path))
    return curves.cutoffs(curves.score_cells(models.held_back_probabilities(fitted), "risk_probability", "at_risk"))


QUERIES: dict[str, Callable[[Bindings], DataFrame]] = {
    "dq_gate_rejected": _gate_rejected,
    "dq_gate_kept": _gate_kept,
    "dq_gate_stream": _gate_stream,
    "distinct_rollup": _distinct_rollup,
    "rule_risk_cutoffs": lambda b: curves.cutoffs(_rule_cells(b), 0, 100, 100),
    "rule_risk_areas": lambda b: curves.areas(_rule_cells(b)),
    "rule_risk_calibration": lambda b: curves.calibration(_rule_cells(b), 10, 100),
    "risk_report": _risk_report,
}
