"""Helpers that several operators share: tables, batches, stored steps, connected components."""

from __future__ import annotations

import contextlib
import gc
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import discard, scratch

#: Bytes of one Arrow batch handed to Python, so that very long texts do not add up.
BATCH_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by size as well as by rows, unless the session already does."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) in (None, "-1"):
        spark.conf.set(key, str(BATCH_BYTES))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    folder = scratch(spark, label)
    df.write.parquet(folder)
    back = spark.read.schema(df.schema).parquet(folder)
    back.musterline_folder = folder
    return back


def forget(*frames: DataFrame) -> None:
    """Remove the folders of ``stored`` frames that nothing reads any more."""
    for df in frames:
        folder = getattr(df, "musterline_folder", None)
        if folder:
            with contextlib.suppress(ValueError):
                discard(df.sparkSession, folder)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark remove shuffle files of finished jobs now; it does so once the driver has let their plans go.

    Python's references go first; Spark itself keeps the newest finished job until the next one.
    """
    gc.collect()
    spark.range(1).count()
    spark.sparkContext._jvm.System.gc()


def bounded_sample(df: DataFrame, size: int, *key: str) -> DataFrame:
    """At most ``size`` rows in order of a hash of ``key``: the same ones however the rows are dealt out.

    A count settles what share of the hashes can matter, so that only about twice ``size`` rows are ordered.
    """
    draw = F.pmod(F.xxhash64(*key), F.lit(1 << 30))
    share = min(1.0, 2 * size / max(1, df.count()))
    return df.where(draw <= int(share * (1 << 30))).orderBy(draw, *key).limit(size)


def components(edges: DataFrame, label: str = "links") -> DataFrame:
    """Connected components of undirected links (a, b) as rows (node, root); root is the smallest node reachable.

    Rounds of hooking and pointer jumping over stored tables. In each round every root takes its smallest
    neighbour below it, chains are shortened to their ends, and links are re-drawn between the ends; links within
    one component vanish. Both sides of a join are read from tables, so that a node with very many links can be
    split by the adaptive skew join; minima are formed before the shuffle. Nodes without a link are not returned.
    """
    spark = edges.sparkSession
    links = stored(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), label
    )
    parts: list[DataFrame] = []
    while True:
        hooks = stored(links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")), label)
        if hooks.isEmpty():
            forget(links, hooks)
            break
        while True:
            up = hooks.select(F.col("node").alias("mid"), F.col("root").alias("top"))
            jumped = stored(
                hooks.join(up, hooks.root == up.mid, "left").select(
                    "node", F.coalesce("top", "root").alias("root"), F.col("top").isNotNull().alias("moved")
                ),
                label,
            )
            moved = not jumped.where("moved").isEmpty()
            forget(hooks)
            hooks = jumped
            if not moved:
                break
        parts.append(jumped)
        up = jumped.select(F.col("node").alias("mid"), F.col("root").alias("top"))
        step = links.join(up, links.a == up.mid, "left").select(F.coalesce("top", "a").alias("a"), "b")
        step = step.join(up, step.b == up.mid, "left").select("a", F.coalesce("top", "b").alias("b"))
        redrawn = stored(
            step.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label
        )
        forget(links)
        links = redrawn
    if not parts:
        kind = edges.schema["a"].dataType
        return spark.createDataFrame([], "node long, root long").select(
            F.col("node").cast(kind).alias("node"), F.col("root").cast(kind).alias("root")
        )
    # A node hooked in an early round follows the roots of the later rounds; every step is stored, so the plan stays small.
    known = parts[-1]
    for earlier in reversed(parts[:-1]):
        up = known.select(F.col("node").alias("mid"), F.col("root").alias("top"))
        followed = earlier.join(up, earlier.root == up.mid, "left").select("node", F.coalesce("top", "root").alias("root"))
        step = stored(followed.unionByName(known.select("node", "root")), label)
        forget(earlier, known)
        known = step
    known = known.select("node", "root")
    ends = known.select(F.col("root").alias("node"), "root").distinct()
    return known.unionByName(ends)


def portions(texts: list[str], most: int = 1 << 20) -> Iterator[list[str]]:
    """``texts`` in order, in runs of about ``most`` characters, so that what is made of them stays small."""
    run: list[str] = []
    size = 0
    for text in texts:
        if run and size + len(text) > most:
            yield run
            run, size = [], 0
        run.append(text)
        size += len(text)
    if run:
        yield run


def strings(column) -> Iterator[str]:
    """Texts of an Arrow column; null counts as empty."""
    for value in column.to_pylist():
        yield value or ""
