"""Counts of batches and rows per stream that outlive the process.

What a stream reads is counted within its own plan (``observe``) and arrives with the progress of each batch; what a batch
function writes is counted by an ``Observation`` on the write. Either way the count is kept by stream and batch id, so that
a replayed batch counts once. After a restart the counts of the batches that the checkpoint holds as committed go on;
one that was committed but not yet noted is counted again from the files of the sink.
"""

from __future__ import annotations

import json
import re
from threading import Lock

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..session import names_in, read_small, write_small

COUNTED = "counted"


def counted(stream: DataFrame) -> DataFrame:
    """The stream with its rows counted on the way."""
    return stream.observe(COUNTED, F.count(F.lit(1)).alias("rows"))


class RunCounters(StreamingQueryListener):
    """Rows by stream and batch, noted in a shared folder. Add it with ``spark.streams.addListener``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._lock = Lock()
        self._rows: dict[str, dict[int, int]] = {}

    # Notes

    def note(self, stream: str, batch_id: int, rows: int) -> None:
        """Set the rows of a batch."""
        with self._lock:
            if self._rows.setdefault(stream, {}).get(batch_id) == rows:
                return
            self._rows[stream][batch_id] = rows
            write_small(self.spark, f"{self.folder}/{stream}/{batch_id}.json", json.dumps({"rows": rows}), replace=True)

    def restore(self, stream: str, checkpoint: str, sink: str | None = None) -> None:
        """Take up the counts of a stream's committed batches; call it before the stream starts again.

        Batches that are not committed will run again and are left out. ``sink`` is the folder of a file sink.
        """
        committed = {int(n) for n in names_in(self.spark, f"{checkpoint}/commits") if n.isdigit()}
        last = max(committed, default=-1)
        noted = {}
        files = [n for n in names_in(self.spark, f"{self.folder}/{stream}") if re.fullmatch(r"[0-9]+\.json", n)]
        if files:
            for row in self.spark.read.schema("rows bigint").json(f"{self.folder}/{stream}").select("rows", "_metadata.file_name").collect():
                noted[int(row["file_name"][:-5])] = row["rows"]
        with self._lock:
            self._rows[stream] = {b: n for b, n in noted.items() if b <= last}
        for batch in sorted(committed - noted.keys()):
            rows = self._from_sink(sink, batch) if sink else None
            if rows is not None:
                self.note(stream, batch, rows)

    def _from_sink(self, sink: str, batch: int) -> int | None:
        """Rows of the files that a file sink's log lists for a batch."""
        log = f"{sink}/_spark_metadata"
        if str(batch) not in names_in(self.spark, log):
            return None
        lines = [x for x in read_small(self.spark, f"{log}/{batch}").splitlines() if x.startswith("{")]
        files = [json.loads(line)["path"] for line in lines]
        return self.spark.read.parquet(*files).count() if files else 0

    def totals(self) -> dict[str, dict[str, int]]:
        """Batches with rows, and rows, of every stream."""
        with self._lock:
            return {
                stream: {"batches": sum(1 for n in by_batch.values() if n), "rows": sum(by_batch.values())}
                for stream, by_batch in self._rows.items()
            }

    # Sources of counts

    def write(self, stream: str, batch_id: int, rows: DataFrame, write) -> None:
        """``write`` the rows of a batch and note how many they were; no second pass."""
        seen = Observation()
        write(rows.observe(seen, F.count(F.lit(1)).alias("rows")))
        self.note(stream, batch_id, seen.get["rows"])

    def settle(self, query: StreamingQuery) -> None:
        """Note what a finished query still remembers; progress may reach a listener late."""
        for progress in query.recentProgress:
            self._take(progress["name"], progress["batchId"], progress.get("observedMetrics") or {})

    def _take(self, stream: str | None, batch_id: int, metrics) -> None:
        found = metrics.get(COUNTED)
        # Metrics of a batch without data may be missing or null.
        if stream and found is not None and found["rows"] is not None:
            self.note(stream, batch_id, found["rows"])

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        self._take(event.progress.name, event.progress.batchId, event.progress.observedMetrics)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass
