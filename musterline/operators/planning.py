"""Hires to reach a tier, monthly plans and what-if scenarios for whole tables at once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import numeric as N
from ..policy import Policy


def target_threshold(target: Column | str, policy: Policy = Policy()) -> Column:
    """Threshold of a named tier, spelled with underscore, space or neither, in any case.

    Any other name aims for the lowest graded tier.
    """
    name = F.lit(target) if isinstance(target, str) else target
    folded = F.replace(F.replace(F.lower(name), F.lit("_"), F.lit("")), F.lit(" "), F.lit(""))
    aliases = {t.lower().replace("_", ""): F.col(policy.threshold(t)) for t in policy.graded}
    out = F.when(F.lit(False), F.lit(None))
    for alias, threshold in aliases.items():
        out = out.when(folded == alias, threshold)
    return out.otherwise(F.col(policy.threshold(policy.graded[-1])))


def with_hires(df: DataFrame, target_pct: str = "target_pct") -> DataFrame:
    """Add hires to reach ``target_pct`` and the rate after hiring; 0 once there or without a rule.

    The head counts decide, not the rounded rate: 6,999 of 25,000 are not yet 28 %.
    """
    total, part, now = F.col("total"), F.col("nationals"), F.col("rate_pct")
    needed = F.greatest(F.lit(0).cast("bigint"), N.hires_needed(total, part, F.col(target_pct)))
    out = df.withColumn("hires", F.when(F.col(target_pct).isNull(), 0).otherwise(needed).cast("bigint"))
    after = N.pct(part + F.col("hires"), total + F.col("hires"), 2)
    return out.withColumn("projected_rate_pct", F.when(F.col("hires") == 0, now).otherwise(after))


def hires_to_target(
    orgs: DataFrame, rules: DataFrame, target: str | None = None, policy: Policy = Policy()
) -> DataFrame:
    """Hires for every organisation to reach ``target``, or every graded tier when none is given.

    The rules are unpivoted first, so the organisations are read once for all targets.
    An unknown target stands for the policy's default percentage; an organisation
    without a rule gets 0.
    """
    graded = policy.graded if target is None else tuple(t for t in policy.graded if t == target)
    keys = rules.select("sector", "size", *map(policy.threshold, policy.graded))
    if graded:
        pairs = ", ".join(f"'{t}', {policy.threshold(t)}" for t in graded)
        targets = keys.select(
            "sector", "size", F.expr(f"stack({len(graded)}, {pairs}) AS (target_tier, target_pct)")
        )
    else:
        targets = keys.select(
            "sector",
            "size",
            F.lit(target).alias("target_tier"),
            F.lit(policy.unknown_target_pct).alias("target_pct"),
        )
    joined = orgs.select(
        "org_id", "name", "sector", "size", F.col("tier").alias("current_tier"), "rate_pct", "nationals", "total"
    ).join(targets, ["sector", "size"], "left")
    return with_hires(joined).select(
        "org_id",
        "name",
        "sector",
        "current_tier",
        F.col("rate_pct").alias("current_rate_pct"),
        "nationals",
        "total",
        "target_tier",
        "target_pct",
        "hires",
        "projected_rate_pct",
    )


def _month(month: Column, capacity: int, salary: int) -> dict[str, Column]:
    """One month of an organisation's plan.

    All months but the last hire at full capacity, so the running totals have a
    closed form: every month is computed from its own row, without a window or shuffle.
    """
    need = F.col("hires")
    done = F.least(month * capacity, need)
    now = F.least(F.lit(capacity).cast("bigint"), need - (month - 1) * capacity)
    return {
        "month": month,
        "hires_this_month": now,
        "cumulative_hires": done,
        "projected_rate_pct": N.pct(F.col("nationals") + done, F.col("total") + done, 2),
        "new_payroll": now * salary,
        "cumulative_payroll": done * salary,
    }


def _to_plan(hires: DataFrame, capacity: int) -> tuple[DataFrame, Column]:
    months = N.ceil_div(F.col("hires"), F.lit(capacity))
    planned = hires.filter(F.col("hires") > 0).withColumn("months_to_complete", months)
    return planned, F.sequence(F.lit(1).cast("bigint"), F.col("months_to_complete"))


#: Months written from one array.
BLOCK = 1024


def hiring_plan(hires: DataFrame, capacity: int = 3, salary: int = 8000) -> DataFrame:
    """Month-by-month plan of every organisation that has to hire."""
    planned, _ = _to_plan(hires, capacity)
    rows = _month(F.col("month"), capacity, salary)
    # Months come in blocks, so that a long plan is never one array.
    last = F.col("months_to_complete") - 1
    blocks = planned.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor(last / BLOCK))))
    first = F.col("_block") * BLOCK
    months = F.sequence(first + 1, F.least(first + BLOCK, F.col("months_to_complete")))
    return blocks.withColumn("month", F.explode(months)).select(
        "org_id",
        "target_tier",
        "months_to_complete",
        F.col("hires").alias("total_hires"),
        *[value.alias(name) for name, value in rows.items()],
        (F.col("hires") * salary * 12).alias("annual_cost"),
    )


def plan_documents(hires: DataFrame, capacity: int = 3, salary: int = 8000) -> DataFrame:
    """The same plan as one nested document per organisation and target, months in order."""
    planned, months = _to_plan(hires, capacity)
    as_struct = lambda m: F.struct(*[value.alias(name) for name, value in _month(m, capacity, salary).items()])
    return planned.select(
        "org_id",
        "target_tier",
        "months_to_complete",
        F.col("hires").alias("total_hires"),
        (F.col("hires") * salary * 12).alias("annual_cost"),
        F.transform(months, as_struct).alias("monthly_plan"),
    )


def projected_tier(rate: Column, policy: Policy) -> Column:
    """Tier by thresholds; below the lowest graded tier the policy's floor decides."""
    out = F.when(F.lit(False), F.lit(None))
    for tier in policy.graded:
        out = out.when(rate >= F.col(policy.threshold(tier)), tier)
    return out.when(rate >= policy.floor_pct, policy.floor_tier).otherwise(policy.bottom_tier)


def what_if(
    orgs: DataFrame,
    rules: DataFrame,
    scenarios: Sequence[Mapping[str, int | str]],
    policy: Policy = Policy(),
) -> DataFrame:
    """Rate and tier of every organisation under each workforce scenario.

    A scenario has a name and any of ``nat_hires``, ``nat_leaves``, ``other_hires``,
    ``other_leaves``. Scenarios are written into the plan as an array and exploded,
    so the organisations are neither joined to them nor shuffled.
    """
    fields = ("nat_hires", "nat_leaves", "other_hires", "other_leaves")
    rows = [
        F.struct(
            F.lit(str(s["scenario"])).alias("scenario"), *[F.lit(int(s.get(f, 0))).cast("bigint").alias(f) for f in fields]
        )
        for s in scenarios
    ]
    base = orgs.join(
        rules.select("sector", "size", *map(policy.threshold, policy.graded)), ["sector", "size"], "left"
    ).select("*", F.inline(F.array(*rows)))
    return simulate(base, policy).select(
        "org_id",
        "name",
        "scenario",
        *SIMULATED,
    )


SIMULATED = (
    "current_nationals",
    "current_others",
    "current_total",
    "current_rate_pct",
    "current_tier",
    "new_nationals",
    "new_others",
    "new_total",
    "new_rate_pct",
    "projected_tier",
    "tier_impact",
    "rate_impact",
    "pct_change",
)


def simulate(df: DataFrame, policy: Policy) -> DataFrame:
    """Apply the workforce change on each row; thresholds and change columns are part of the row."""
    order = {t: len(policy.tiers) - i for i, t in enumerate(policy.tiers)}
    zero = F.lit(0).cast("bigint")
    moved = df.withColumns(
        {
            "new_nationals": F.greatest(zero, F.col("nationals") + F.col("nat_hires") - F.col("nat_leaves")),
            "new_others": F.greatest(zero, F.col("non_nationals") + F.col("other_hires") - F.col("other_leaves")),
        }
    ).withColumn("new_total", F.col("new_nationals") + F.col("new_others"))
    raw = F.coalesce(
        F.try_divide(F.col("new_nationals") * 100.0, F.col("new_total").cast("double")), F.lit(0.0)
    )
    rated = moved.withColumns(
        {
            "raw_rate": raw,
            "new_rate_pct": F.coalesce(N.pct(F.col("new_nationals"), F.col("new_total"), 2), F.lit(0.0)),
        }
    ).withColumn("projected_tier", projected_tier(F.col("raw_rate"), policy))
    old_rank, new_rank = (C.map_values(F.col(c), order, 0) for c in ("tier", "projected_tier"))
    now = F.col("rate_pct")
    # Both rates as products of head counts, so that no change is no change.
    after = F.col("new_nationals") * F.greatest(F.col("total"), F.lit(1))
    before = F.col("nationals") * F.greatest(F.col("new_total"), F.lit(1))
    return rated.withColumns(
        {
            "current_nationals": F.col("nationals"),
            "current_others": F.col("non_nationals"),
            "current_total": F.col("total"),
            "current_rate_pct": now,
            "current_tier": F.col("tier"),
            "tier_impact": _impact(new_rank, old_rank, "UPGRADE", "DOWNGRADE"),
            "rate_impact": _impact(after, before, "IMPROVEMENT", "DECLINE"),
            "pct_change": F.round(F.col("new_rate_pct") - now, 2),
        }
    )


def _impact(new: Column, old: Column, better: str, worse: str) -> Column:
    return F.when(new > old, better).when(new < old, worse).otherwise("NO_CHANGE")


def top_hires(hires: DataFrame, k: int = 10, width: int = 20) -> DataFrame:
    """The ``k`` organisations with most hires to make, names cut to ``width`` for the chart."""
    return (
        hires.filter(F.col("hires") > 0)
        .select("org_id", F.substring("name", 1, width).alias("name"), "current_tier", "hires")
        .orderBy(F.desc("hires"), "org_id")
        .limit(k)
    )


def hires_by_tier(hires: DataFrame) -> DataFrame:
    """Hires to make per current tier."""
    return (
        hires.filter(F.col("hires") > 0)
        .groupBy("current_tier")
        .agg(F.count(F.lit(1)).alias("orgs"), F.sum("hires").alias("hires"))
    )
