"""Corpus pipeline: quality, near-duplicates, repeated strings, personal data, packing.

Every stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and returns a DataFrame; what it returns is written
as Parquet and read again as the next one's documents. All but the last return the columns they got.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from musterline.llm import gbt, packing, pii, repeats, simhash
from musterline.llm.common import forget, stored, table
from musterline.llm.labelled import held_out


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality trees score at least 0.7; the trees learn from the labelled rows outside the held-out fold.

    Null and empty texts are scored like any other. Without labels every document stays.
    """
    return gbt.accepted(docs, table(spark, sf_dir, "labels").where(~held_out()), threshold=0.7)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of smallest doc_id, of each group whose SimHash fingerprints are chained by at most 4 bits."""
    return simhash.keep_one(docs, shingle=4, distance=4)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of any 200-byte string that also starts elsewhere; a text may become empty."""
    return repeats.without_repeats(docs, width=200)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind."""
    return pii.redact(docs, pii.fit(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 tokens, each with the check sum of its ids."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack_documents(docs, path, length=1024, separator=0).withColumn("ids_crc32", F.crc32("ids"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_strings),
    ("PII", personal_data),
    ("packing", packed),
]

#: No SQL expresses fitted trees; the pipeline is tested against a brute-force version instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        done = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        forget(docs)
        docs = done
    return STAGES[-1][1](spark, docs, sf_dir)
