"""Results of a running stream as an iterator."""

from __future__ import annotations

import queue
import threading
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql.streaming import StreamingQuery


class _Closed(Exception):
    """The consumer has gone; the batch at hand is not committed."""


class _HandOver:
    """One micro-batch at a time goes from the query to the consumer, which says when it is done with it."""

    def __init__(self) -> None:
        self.batches: queue.Queue[tuple[int, DataFrame]] = queue.Queue(maxsize=1)
        self.done = threading.Event()
        self.closed = False

    def give(self, batch: DataFrame, batch_id: int) -> None:
        if self.closed:
            raise _Closed
        self.done.clear()
        self.batches.put((batch_id, batch))
        self.done.wait()
        if self.closed:
            raise _Closed

    def close(self) -> None:
        self.closed = True
        self.done.set()


def iterate_batches(
    stream: DataFrame, path: str, available_now: bool = False, every: str = "0 seconds"
) -> Iterator[tuple[int, DataFrame]]:
    """(number, written rows) of each micro-batch as soon as it is written, while input still arrives.

    A micro-batch is computed once, into ``path/table``, and what is given out
    reads that folder. The next one begins when the consumer asks for it, so a
    slow consumer slows the source and nothing piles up. A batch is committed
    when the next one is asked for: closing the iterator (or leaving a loop)
    stops the query, and a later run on the same ``path`` begins with the batch
    that was not finished. Errors of the query are raised here. The iterator
    ends with the query: with ``available_now`` when all that had arrived is
    through, else only when it is closed or the query is stopped.
    """
    hand = _HandOver()
    spark = stream.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        folder = f"{path}/table/batch={batch_id}"
        batch.write.mode("overwrite").parquet(folder)
        hand.give(spark.read.schema(batch.schema).parquet(folder), batch_id)

    trigger = {"availableNow": True} if available_now else {"processingTime": every}
    running: StreamingQuery = (
        stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{path}/checkpoint").trigger(**trigger).start()
    )
    try:
        while True:
            try:
                batch_id, rows = hand.batches.get(timeout=0.05)
            except queue.Empty:
                if running.isActive:
                    continue
                if running.exception() is not None:
                    raise running.exception() from None
                return
            yield batch_id, rows
            hand.done.set()
    finally:
        hand.close()
        running.stop()


def iterate_stream(
    stream: DataFrame, path: str, size: int = 1, available_now: bool = False, every: str = "0 seconds"
) -> Iterator[list[Row]]:
    """Lists of up to ``size`` rows from a running stream, for results that are meant for the driver.

    Rows come from one partition at a time and without prefetch, as
    :func:`timbrel.sinks.tables.iterate_results` gives them; a micro-batch ends
    with a shorter list instead of keeping rows back. Otherwise as
    :func:`iterate_batches`.
    """
    batches = iterate_batches(stream, path, available_now, every)
    try:
        for _, rows in batches:
            held: list[Row] = []
            for row in rows.toLocalIterator(prefetchPartitions=False):
                held.append(row)
                if len(held) == size:
                    yield held
                    held = []
            if held:
                yield held
    finally:
        batches.close()
