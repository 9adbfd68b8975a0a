"""How well scores tell two classes apart, from a histogram with exact counts.

Scores are counted by cell and class, which any number of tasks can do apart and add up; precision, recall and areas for
all cut-offs follow from the few cells, without a sort of the scores. Scores within a cell count as equal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import numeric as N


def score_cells(rows: DataFrame, score: str, label: Column | str, low: float = 0.0, high: float = 1.0, cells: int = 1000) -> DataFrame:
    """Rows and positives per cell; cell i holds scores from low + i * (high - low) / cells on. Rows without score or label are left out."""
    label = F.col(label) if isinstance(label, str) else label
    at = F.floor((F.col(score) - F.lit(low)) * F.lit(cells) / F.lit(high - low))
    inside = F.least(F.greatest(at, F.lit(0)), F.lit(cells)).cast("bigint")
    known = rows.where(F.col(score).isNotNull() & label.isNotNull())
    return known.groupBy(inside.alias("cell")).agg(
        F.count(F.lit(1)).alias("rows"), N.count_where(label == 1).alias("positives"), F.sum(F.col(score)).alias("score_sum")
    )


def _from_above() -> Window:
    # At most one row per cell.
    return Window.orderBy(F.desc("cell")).rowsBetween(Window.unboundedPreceding, 0)


def cutoffs(cells: DataFrame, low: float = 0.0, high: float = 1.0, count: int = 1000) -> DataFrame:
    """One row per cell that occurs: precision, recall and false alarms if scores from its lower end on are called positive."""
    above = _from_above()
    run = cells.select(
        "cell",
        F.sum("positives").over(above).alias("hits"),
        F.sum("rows").over(above).alias("called"),
        F.sum("positives").over(Window.partitionBy()).alias("all_positives"),
        F.sum("rows").over(Window.partitionBy()).alias("all_rows"),
    )
    return run.select(
        (F.lit(low) + F.col("cell") * F.lit(high - low) / F.lit(count)).alias("cutoff"),
        "called",
        "hits",
        N.ratio(F.col("hits"), F.col("called"), 6).alias("precision"),
        N.ratio(F.col("hits"), F.col("all_positives"), 6).alias("recall"),
        N.ratio(F.col("called") - F.col("hits"), F.col("all_rows") - F.col("all_positives"), 6).alias("false_alarms"),
    )


def areas(cells: DataFrame) -> DataFrame:
    """Rows, positives, area under the ROC curve and average precision; null where a class is missing."""
    above = _from_above()
    rest = F.col("rows") - F.col("positives")
    run = cells.select(
        "rows", "positives", rest.alias("negatives"), F.sum("positives").over(above).alias("hits"), F.sum("rows").over(above).alias("called")
    )
    # Pairs of a positive above a negative count whole, those within a cell half; twice the count stays whole.
    pairs = F.sum((F.col("negatives") * (2 * F.col("hits") - F.col("positives"))).cast("decimal(38,0)"))
    total = run.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("positives"), F.lit(0)).alias("positives"),
        pairs.cast("double").alias("pairs"),
        F.sum(F.col("positives") * F.col("hits") / F.col("called")).alias("gain"),
    )
    p, n = F.col("positives").cast("double"), (F.col("rows") - F.col("positives")).cast("double")
    return total.select(
        "rows",
        "positives",
        F.round(F.try_divide(F.col("pairs"), 2 * p * n), 6).alias("roc_area"),
        F.round(F.try_divide(F.col("gain"), p), 6).alias("average_precision"),
    )


def calibration(cells: DataFrame, bands: int = 10, count: int = 1000) -> DataFrame:
    """Mean score and share of positives per band of scores."""
    band = F.least(F.floor(F.col("cell") * bands / count), F.lit(bands - 1)).cast("bigint")
    return cells.groupBy(band.alias("band")).agg(
        F.sum("rows").alias("rows"),
        F.round(F.sum("score_sum") / F.sum("rows"), 6).alias("mean_score"),
        N.ratio(F.sum("positives"), F.sum("rows"), 6).alias("positive_share"),
    )
