"""Column helpers for buckets, labels, text matching, dates and event order."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .numeric import ratio


def bucketize(col: Column, edges: Sequence[float], labels: Sequence[str], rest: str, null_label: str | None = None) -> Column:
    """Label of the first edge above ``col``; ``rest`` beyond the last edge and, unless told otherwise, for null."""
    pairs = zip(edges, labels)
    out = reduce(lambda c, p: c.when(col < F.lit(p[0]), F.lit(p[1])), pairs, F.when(F.lit(False), F.lit(None)))
    if null_label is not None:
        out = out.when(col.isNull(), F.lit(null_label))
    return out.otherwise(F.lit(rest))


def map_values(col: Column, mapping: Mapping, default, null_label=None) -> Column:
    """Replace values by ``mapping``; anything else, null included, becomes ``default``."""
    out = F.when(F.lit(False), F.lit(None))
    for key, value in mapping.items():
        out = out.when(col == F.lit(key), F.lit(value))
    if null_label is not None:
        out = out.when(col.isNull(), F.lit(null_label))
    return out.otherwise(default if isinstance(default, Column) else F.lit(default))


def label_groups(col: Column, groups: Sequence[tuple[Sequence[str], str]], default: str) -> Column:
    """Label of the first group that lists the value."""
    out = reduce(lambda c, g: c.when(col.isin(*g[0]), F.lit(g[1])), groups, F.when(F.lit(False), F.lit(None)))
    return out.otherwise(F.lit(default))


def flag_eq(col: Column, value) -> Column:
    """Equality as a flag that is never null."""
    return F.coalesce(col == F.lit(value), F.lit(False))


def rank_of(col: Column, ranking: Sequence[str]) -> Column:
    """Position of the value in ``ranking``, from 1; values not listed come last."""
    return map_values(col, {v: i for i, v in enumerate(ranking, 1)}, len(ranking) + 1)


def order_by_rank(df: DataFrame, column: str, ranking: Sequence[str], *ties: Column | str) -> DataFrame:
    """Sort by a custom order of categories."""
    return df.orderBy(rank_of(F.col(column), ranking), *ties)


def require_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Rows whose keys are all known; plain null checks, which reach the file scan."""
    return where_all(df, [F.col(k).isNotNull() for k in keys])


def unaligned(df: DataFrame) -> DataFrame:
    """``df`` dealt out evenly, by no key. The small side of a join on a hot key goes through this.

    If that side came partitioned by the key, only the other side would be shuffled for the join, and the adaptive skew join
    splits a key only where both sides are.
    """
    return df.hint("rebalance")


def trimmed(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.trim(F.col(c)) for c in columns})


def where_all(df: DataFrame, conditions: Iterable[Column | None]) -> DataFrame:
    """Keep rows that meet every given condition; None means not asked for."""
    given = [c for c in conditions if c is not None]
    return df.filter(reduce(lambda a, b: a & b, given)) if given else df


def name_like(col: Column, text: str | Column, wildcards: bool = False) -> Column:
    """Case-insensitive substring match; with ``wildcards`` the text may hold ``%`` and ``_``."""
    text = text if isinstance(text, Column) else F.lit(text)
    if wildcards:
        return F.like(F.lower(col), F.concat(F.lit("%"), F.lower(text), F.lit("%")))
    return F.contains(F.lower(col), F.lower(text))


def norm_eq(col: Column, text: str | Column) -> Column:
    """Equality that ignores case and treats underscore and space alike."""
    text = text if isinstance(text, Column) else F.lit(text)

    def fold(c):
        return F.lower(F.replace(c, F.lit("_"), F.lit(" ")))

    return fold(col) == fold(text)


def stamp(df: DataFrame, column: str, now: dt.datetime | Column | None) -> DataFrame:
    """Add an audit timestamp; without a clock the frame is left as it is."""
    if now is None:
        return df
    return df.withColumn(column, now if isinstance(now, Column) else F.lit(now))


def as_date(day: dt.date | Column) -> Column:
    return day if isinstance(day, Column) else F.lit(day)


def tenure_years(days: Column) -> Column:
    """Days as years of 365.25 days, to one decimal; whole-number arithmetic costs a fraction of ``round``."""
    return ratio(days * 100, F.lit(36525), 1)


def days_between(end: Column, start: Column) -> Column:
    return F.datediff(end, start)


def since(df: DataFrame, column: str, minutes: int, now: dt.datetime | Column) -> DataFrame:
    """Rows of the last ``minutes`` before ``now``."""
    now = now if isinstance(now, Column) else F.lit(now)
    return df.filter(F.col(column) > now - F.make_dt_interval(mins=F.lit(minutes)))


def event_key(time: Column, tie: Column) -> Column:
    """One decimal that orders events by a whole-number time, then by id; an event without id comes first of its time.

    A single fixed-width key keeps ``min_by`` / ``max_by`` in a hash aggregation;
    a struct key would make Spark sort every partition first.
    """
    spread = F.lit("20000000000000000000").cast("decimal(20,0)")
    return time.cast("decimal(18,0)") * spread + F.coalesce(tie.cast("bigint"), F.lit(-1).cast("bigint"))


def opening(value: Column, key: Column) -> Column:
    return F.min_by(value, key)


def closing(value: Column, key: Column) -> Column:
    return F.max_by(value, key)
