"""Run a streaming job: drain, bound, watch and stop."""

from __future__ import annotations

import time
from collections import deque
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from timbrel.sinks.tables import split_sink


def drain(stream: DataFrame, path: str) -> DataFrame:
    """Process everything that has arrived, then stop; returns the written table."""
    start_table(stream, path, available_now=True).awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{path}/table")


def start_table(stream: DataFrame, path: str, available_now: bool = False, every: str = "1 second") -> StreamingQuery:
    """Append a stream to a parquet table; its checkpoint lies beside it."""
    trigger = {"availableNow": True} if available_now else {"processingTime": every}
    return (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(**trigger)
        .start(f"{path}/table")
    )


def start_split(
    stream: DataFrame,
    path: str,
    error: str = "error",
    on_success: Callable[[DataFrame, int], None] | None = None,
    available_now: bool = True,
    every: str = "1 second",
) -> StreamingQuery:
    """Successes and failures of a stream to two tables."""
    trigger = {"availableNow": True} if available_now else {"processingTime": every}
    return (
        stream.writeStream.foreachBatch(split_sink(f"{path}/table", error, on_success))
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(**trigger)
        .start()
    )


#: Batches without rows after which a query may count as standing still.
_EMPTY_BATCHES = 3


def wait_for(ready: Callable[[], bool], query: StreamingQuery | None = None, seconds: float = 120.0, pause: float = 0.3) -> None:
    """Wait until something holds; an ended query raises its error, and so does a standstill that takes too long.

    With a query, ``seconds`` count from the last batch that took in rows, and a
    batch that is still at work is no standstill, however long it takes.
    """
    limit = time.monotonic() + seconds
    last, empty = -1, 0
    while not ready():
        if query is not None and not query.isActive and query.exception() is not None:
            raise query.exception()
        at_work = False
        if query is not None and query.isActive:
            done = query.lastProgress
            if done is not None and done["batchId"] != last:
                last, empty = done["batchId"], empty + 1
                if done["numInputRows"]:
                    limit, empty = time.monotonic() + seconds, 0
            at_work = query.status["isTriggerActive"] and empty < _EMPTY_BATCHES
        if time.monotonic() > limit and not at_work:
            raise TimeoutError(f"not so after {seconds} s")
        time.sleep(pause)


class _Enough(Exception):
    """Ends a query before a micro-batch that is not wanted any more is committed."""


def read_until(
    stream: DataFrame, sink: Callable[[DataFrame, int], None], max_items: int, checkpoint: str, every: str = "1 second"
) -> int:
    """Stop after the micro-batch that reaches ``max_items``; returns the rows read.

    The count is looked at between micro-batches only, so at least
    ``max_items`` rows are delivered if that many arrive. A later micro-batch is
    refused, so it is not committed, and a run on the same checkpoint starts
    with it. The query is stopped only after the last delivered batch is
    committed.
    """
    seen, last = 0, -1

    def write(batch: DataFrame, batch_id: int) -> None:
        nonlocal seen, last
        if seen >= max_items:
            raise _Enough
        batch.persist()
        try:
            sink(batch, batch_id)
            seen, last = seen + batch.count(), batch_id
        finally:
            batch.unpersist()

    query: StreamingQuery = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=every)
        .start()
    )

    def committed() -> bool:
        return any(p["batchId"] >= last for p in query.recentProgress)

    try:
        while query.isActive and not (seen >= max_items and committed()):
            time.sleep(0.2)
    finally:
        query.stop()
    failure = query.exception()
    if failure is not None and not (seen >= max_items and _Enough.__name__ in str(failure)):
        raise failure
    return seen


class ProgressListener(StreamingQueryListener):
    """Input rows per trigger, the running total and the sources' own metrics, for health checks.

    Only the last ``keep`` triggers are held. Which metrics there are (such as
    how far a reader is behind) is up to the source; files report none.
    """

    def __init__(self, keep: int = 1000) -> None:
        self.triggers: deque[tuple[int, int, float]] = deque(maxlen=keep)
        self.total = 0
        self.source_metrics: list[dict[str, str]] = []
        self.healthy = True

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.total += p.numInputRows
        self.triggers.append((p.batchId, p.numInputRows, p.processedRowsPerSecond))
        self.source_metrics = [dict(s.metrics) for s in p.sources]
        self.healthy = True

    @property
    def status(self) -> dict:
        """Rows so far, triggers held, source metrics, and whether the last query ended in an error."""
        return {
            "rows": self.total,
            "held": len(self.triggers),
            "sources": self.source_metrics,
            "healthy": self.healthy,
        }

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.healthy = event.exception is None
