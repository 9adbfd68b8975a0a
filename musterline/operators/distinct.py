"""Exact distinct counts that can be stored per batch and added up later.

Counts of several batches cannot be summed, as a value may occur in more than one. Stored are bitmaps instead: one row per
batch, group and stretch of 32,768 ids, a bit for every id. Bitmaps of any batches are united without reading a trade again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bitmaps(df: DataFrame, keys: Sequence[Column | str], ids: Mapping[str, Column | str]) -> DataFrame:
    """Bitmaps of whole-number ids per group: (keys, measure, stretch, bitmap). Ids that are null do not count.

    All measures are taken in one pass. What is shuffled is one bitmap per task, group and stretch; a group with very
    many ids is spread by its stretches.
    """
    values = [F.struct(F.lit(name).alias("measure"), (F.col(c) if isinstance(c, str) else c).cast("bigint").alias("id")) for name, c in ids.items()]
    each = df.select(*keys, F.inline(F.array(*values)))
    names = each.columns[:-2]
    stretch = F.bitmap_bucket_number("id").alias("stretch")
    return each.where("id IS NOT NULL").groupBy(*names, "measure", stretch).agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bitmap"))


def united(stored: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Distinct ids per group over all stored bitmaps, one column per measure; groups without an id of a measure have 0."""
    one = stored.groupBy(*keys, "measure", "stretch").agg(F.bitmap_count(F.bitmap_or_agg("bitmap")).alias("ids"))
    counts = [F.coalesce(F.sum(F.when(F.col("measure") == m, F.col("ids"))), F.lit(0)).alias(m) for m in measures]
    return one.groupBy(*keys).agg(*counts)
