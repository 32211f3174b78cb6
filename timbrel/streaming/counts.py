"""Counts of a running job, taken on the way and without another pass over the results."""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from timbrel.functions.errors import is_error

COUNTS = ("total", "ok", "failed", "quarantined", "bytes")


def observe_counts(
    df: DataFrame, name: str, error: str = "error", size: Column | str | None = None, quarantined: Column | None = None
) -> DataFrame:
    """The same rows, which are counted as they pass: total, ok, failed, quarantined, bytes.

    A quarantined row counts as that alone, not as ok or failed. ``size`` is the
    column or expression of a row's bytes. Works on streams, whose counts a
    :class:`RunCounts` collects per micro-batch, and on batch frames with an
    observation of that name.
    """
    apart = F.coalesce(quarantined, F.lit(False)) if quarantined is not None else F.lit(False)
    failed = is_error(F.col(error))
    of = F.lit(0) if size is None else F.col(size) if isinstance(size, str) else size
    return df.observe(
        name,
        F.count("*").alias("total"),
        F.count_if(~apart & ~failed).alias("ok"),
        F.count_if(~apart & failed).alias("failed"),
        F.count_if(apart).alias("quarantined"),
        F.coalesce(F.sum(of.cast("bigint")), F.lit(0)).alias("bytes"),
    )


class RunCounts(StreamingQueryListener):
    """Totals over all micro-batches of the queries that count under ``name``.

    A batch that is run again counts once, with its last figures. Only running
    totals and the batch at hand of each query are held.
    """

    def __init__(self, name: str) -> None:
        self.name = name
        self.lock = threading.Lock()
        self.closed = dict.fromkeys(COUNTS, 0)
        self.batches = 0
        self.open: dict[str, tuple[int, dict[str, int]]] = {}
        self.ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(self.name)
        if row is None:
            return
        found = {k: int(row[k] or 0) for k in COUNTS}
        if not found["total"]:
            return
        query, batch = str(event.progress.id), event.progress.batchId
        with self.lock:
            if query in self.open and self.open[query][0] != batch:
                self._close(query)
            self.open[query] = (batch, found)

    def _close(self, query: str) -> None:
        _, found = self.open.pop(query)
        self.batches += 1
        for k, n in found.items():
            self.closed[k] += n

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self.lock:
            self.ended.add(str(event.id))

    @property
    def totals(self) -> dict[str, int]:
        """Counts so far, and the number of micro-batches."""
        with self.lock:
            out = dict(self.closed)
            for _, found in self.open.values():
                for k, n in found.items():
                    out[k] += n
            return {**out, "batches": self.batches + len(self.open)}

    def frame(self, spark: SparkSession) -> DataFrame:
        """The totals as one row."""
        found = self.totals
        columns = (*COUNTS, "batches")
        return spark.createDataFrame([tuple(found[k] for k in columns)], ", ".join(f"{k} bigint" for k in columns))
