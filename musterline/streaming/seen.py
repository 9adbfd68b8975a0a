"""Each trade once, for good: an index of the ids seen so far, beside the stream.

A watermark forgets; a copy that arrives days later would pass. The index keeps every id in sorted runs, dealt into
buckets by a hash, one run per batch and later merged by tiers. Each run has Bloom filters, so that a batch reads only
the buckets of runs that may hold one of its ids. Everything is named by batch: a batch that is replayed does not see its
own earlier run, and takes its place again.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.market import latest_per_key
from ..session import discard, exists, hadoop, names_in, scratch
from ..sinks.tables import append_batch
from .jobs import Trigger, enrich, once, start_batches

#: Bits of one bitmap of ``bitmap_construct_agg``.
BITMAP = 4096 * 8


@dataclass(frozen=True)
class Run:
    """Ids of the batches ``first`` to ``last``; ``bits`` is the size of each bucket's filter."""

    tier: int
    first: int
    last: int
    bits: int

    @property
    def name(self) -> str:
        return f"t{self.tier}-{self.first}-{self.last}-{self.bits}"


class SeenIndex:
    """Ids of ``key`` seen by earlier batches, in a shared folder.

    ``buckets`` bounds what one task sorts and what a lookup reads per run. With ``per_id`` bits and ``hashes`` probes
    about one in a hundred unseen ids makes a lookup read a bucket in vain. ``fan_in`` runs of a tier become one of the next.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        key: str = "trade_id",
        kind: str = "bigint",
        buckets: int = 16,
        per_id: int = 10,
        hashes: int = 6,
        fan_in: int = 8,
    ):
        self.spark, self.folder, self.key, self.kind = spark, folder.rstrip("/"), key, kind
        self.buckets, self.per_id, self.hashes, self.fan_in = buckets, per_id, hashes, fan_in

    # Runs

    def runs(self, before: int | None = None) -> list[Run]:
        """Finished runs that no merged one replaces, of batches below ``before``."""
        found = []
        for name in names_in(self.spark, f"{self.folder}/runs"):
            match = re.fullmatch(r"t(\d+)-(\d+)-(\d+)-(\d+)", name)
            if match and exists(self.spark, f"{self.folder}/runs/{name}/_SUCCESS"):
                found.append(Run(*map(int, match.groups())))
        live = [r for r in found if before is None or r.last < before]
        return sorted((r for r in live if not any(o.tier > r.tier and o.first <= r.first <= r.last <= o.last for o in live)), key=lambda r: r.first)

    def _drop(self, *runs: Run) -> None:
        fs, path = hadoop(self.spark, self.folder)
        for run in runs:
            for kind in ("runs", "filters"):
                fs.delete(path(f"{self.folder}/{kind}/{run.name}"), True)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int").alias("bucket")

    def _probes(self, bits: int) -> Column:
        """Places of an id in a filter."""
        return F.transform(F.sequence(F.lit(1), F.lit(self.hashes)), lambda i: F.pmod(F.xxhash64(F.col(self.key), i), F.lit(bits)))

    def _write(self, ids: DataFrame, tier: int, first: int, last: int) -> Run:
        """A run of distinct ids with its filters; it counts from the moment its last file is there."""
        keyed = ids.select(self.key, self._bucket())
        most = keyed.groupBy("bucket").count().agg(F.max("count")).first()[0] or 1
        run = Run(tier, first, last, BITMAP * -(-most * self.per_id // BITMAP))
        at = keyed.select("bucket", F.explode(self._probes(run.bits)).alias("at"))
        filters = at.groupBy("bucket", F.expr(f"at div {BITMAP}").alias("part")).agg(F.bitmap_construct_agg(F.col("at") % BITMAP).alias("bitmap"))
        filters.write.mode("overwrite").parquet(f"{self.folder}/filters/{run.name}")
        ordered = keyed.repartition(self.buckets, "bucket").sortWithinPartitions("bucket", self.key)
        ordered.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.folder}/runs/{run.name}")
        return run

    def add(self, ids: DataFrame, batch_id: int) -> Run:
        """Store the ids of a batch; an earlier run of the same batch goes."""
        stale = [r for r in self.runs() if r.first == r.last == batch_id]
        run = self._write(ids.select(self.key).distinct(), 0, batch_id, batch_id)
        self._drop(*[r for r in stale if r != run])
        return run

    def merge(self, before: int) -> None:
        """Merge runs of batches below ``before`` wherever a tier has enough of them that follow each other."""
        tier = 0
        while True:
            runs = self.runs(before)
            same = [r for r in runs if r.tier == tier]
            if len(same) >= self.fan_in:
                some = same[: self.fan_in]
                ids = reduce(DataFrame.unionByName, [self._ids(r) for r in some])
                self._write(ids, tier + 1, some[0].first, some[-1].last)
                self._drop(*some)
            elif not any(r.tier > tier for r in runs):
                return
            tier += 1

    def _ids(self, run: Run, buckets: list[int] | None = None) -> DataFrame:
        where = f"{self.folder}/runs/{run.name}"
        if buckets is None:
            return self.spark.read.schema(f"{self.key} {self.kind}, bucket int").parquet(where).select(self.key)
        return self.spark.read.schema(f"{self.key} {self.kind}").parquet(*[f"{where}/bucket={b}" for b in buckets])

    # Lookup

    def candidates(self, ids: DataFrame, batch_id: int) -> DataFrame:
        """(id, run, bucket) for every run of an earlier batch whose filter has all bits of the id set."""
        parts = []
        for run in self.runs(batch_id):
            filters = self.spark.read.schema("bucket int, part bigint, bitmap binary").parquet(f"{self.folder}/filters/{run.name}")
            probes = ids.select(self.key, self._bucket(), F.explode(self._probes(run.bits)).alias("at")).withColumn("part", F.expr(f"at div {BITMAP}"))
            octet = F.conv(F.hex(F.substring(F.col("bitmap"), F.expr(f"cast(at % {BITMAP} div 8 as int) + 1"), F.lit(1))), 16, 10).cast("int")
            hit = probes.join(filters, ["bucket", "part"]).where(F.getbit(octet, F.col("at") % 8) == 1)
            full = hit.groupBy(self.key, "bucket").agg(F.count(F.lit(1)).alias("hits")).where(F.col("hits") == self.hashes)
            parts.append(full.select(self.key, F.lit(run.name).alias("run"), "bucket"))
        if not parts:
            return ids.select(self.key, F.lit("").alias("run"), F.lit(0).alias("bucket")).limit(0)
        return reduce(DataFrame.unionByName, parts)

    def seen(self, ids: DataFrame, batch_id: int, out: str) -> DataFrame | None:
        """Those of ``ids`` that an earlier batch had, stored in ``out``; None if no filter lets any pass, and then no run is read."""
        found = scratch(self.spark, "candidates")
        self.candidates(ids, batch_id).write.parquet(found)
        kept = self.spark.read.schema(f"{self.key} {self.kind}, run string, bucket int").parquet(found)
        wanted: dict[str, list[int]] = {}
        # At most runs x buckets pairs.
        for run, bucket in kept.select("run", "bucket").distinct().collect():
            wanted.setdefault(run, []).append(bucket)
        if wanted:
            held = [self._ids(r, sorted(wanted[r.name])) for r in self.runs(batch_id) if r.name in wanted]
            kept.select(self.key).distinct().join(reduce(DataFrame.unionByName, held), self.key, "left_semi").write.parquet(out)
        discard(self.spark, found)
        return self.spark.read.schema(f"{self.key} {self.kind}").parquet(out) if wanted else None


def ingest_once(
    stream: DataFrame,
    path: str,
    index: SeenIndex,
    checkpoint: str,
    trigger: Trigger = once(),
    name: str | None = None,
) -> StreamingQuery:
    """Landed trades to a raw table with one partition per batch, each trade once however late a copy comes.

    Of copies within a batch the first by trade and ingestion time stays. A row without an id is a trade of its own. The
    index takes a batch's ids from what was stored, after it was stored; a crash in between is mended by the replay.
    """
    key = index.key

    def handle(batch: DataFrame, batch_id: int) -> None:
        index.merge(batch_id)
        named = batch.where(F.col(key).isNotNull())
        fresh = latest_per_key(named, [key], F.col("trade_time"), F.col("ingestion_time"))
        aside = scratch(index.spark, "seen")
        seen = index.seen(named.select(key).distinct(), batch_id, aside)
        if seen is not None:
            fresh = fresh.join(seen, key, "left_anti").select(*batch.columns)
        append_batch(enrich(fresh.unionByName(batch.where(F.col(key).isNull()))), batch_id, path)
        discard(index.spark, aside)
        if exists(index.spark, path):
            stored = index.spark.read.schema(f"{key} {index.kind}, batch_id bigint").parquet(path)
            index.add(stored.where((F.col("batch_id") == batch_id) & F.col(key).isNotNull()), batch_id)

    return start_batches(stream, handle, checkpoint, trigger, name)
