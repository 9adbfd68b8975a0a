"""Labelled documents for fitting: which rows may be learnt from, and a bounded sample of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample

#: Labelled documents a classifier is fitted on at most; the sample is the same for the same labels.
SAMPLE = 12_000


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the fold that is kept for judging: crc32 of doc_id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample_of(docs: DataFrame, labels: DataFrame, label: str, size: int = SAMPLE) -> DataFrame:
    """At most ``size`` labelled ids with their texts: rows (doc_id, text, y, lang if there is one).

    Labels other than 0 and 1 and null ids are left out; of several labels of one id the larger counts. Ids are taken in
    order of a hash, so that the choice does not depend on how rows are dealt out.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    some = bounded_sample(known, size, "doc_id")
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), lang.cast("string").alias("lang"))
    # The sample has at most ``size`` rows of two numbers, so it may be sent to every task.
    return texts.join(F.broadcast(some), "doc_id")
