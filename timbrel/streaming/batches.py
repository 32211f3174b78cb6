"""Streams whose micro-batches are bounded by rows: numbered batches, and runs that end at a bound and go on later."""

from __future__ import annotations

import re
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from timbrel.sources.rows import FIRST, stream_rows

Shape = Callable[[DataFrame], DataFrame]


def numbered_sink(path: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that writes what a trigger takes in once, into a folder named by its number.

    A trigger that is repeated after a failure overwrites its folder.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def read_numbered(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What :func:`numbered_sink` wrote, with ``batch`` and ``batch_rows``.

    Batches are numbered from 0, also those that one trigger took together. The
    engine may begin a query with a batch of no rows; it is not counted. The
    numbering sees one row per batch, not the rows.
    """
    fields = [f for f in schema.fields if f.name != FIRST]
    with_folder = T.StructType([*fields, T.StructField(FIRST, T.LongType()), T.StructField("batch", T.LongType())])
    written = spark.read.schema(with_folder).parquet(path).withColumnRenamed("batch", "_folder")
    # a folder without this column is one batch
    written = written.withColumn(FIRST, F.coalesce(FIRST, F.lit(-1).cast("bigint")))
    sizes = written.groupBy("_folder", FIRST).agg(F.count("*").alias("batch_rows"))
    place = F.row_number().over(W.orderBy("_folder", FIRST)).cast("bigint") - 1
    return written.join(sizes.withColumn("batch", place), ["_folder", FIRST]).drop("_folder", FIRST)


def start_rows(
    spark: SparkSession, source: str, path: str, schema: T.StructType, shape: Shape | None = None, **bounds
) -> StreamingQuery:
    """Write arriving rows to ``path/table`` in numbered batches; ledger and checkpoint lie beside it.

    ``bounds`` are those of :func:`timbrel.sources.rows.stream_rows`; a ``shape``
    keeps its column ``FIRST`` if batches are taken ``together``.
    """
    stream = stream_rows(spark, source, f"{path}/ledger", schema, **bounds)
    stream = shape(stream) if shape else stream
    if bounds.get("together", 1) > 1 and FIRST not in stream.columns:
        raise ValueError(f"shape drops {FIRST}, without which batches taken together cannot be told apart")
    writer = stream.writeStream.foreachBatch(numbered_sink(f"{path}/table"))
    return writer.option("checkpointLocation", f"{path}/checkpoint").trigger(processingTime="0 seconds").start()


def rows_read(query: StreamingQuery) -> int:
    """Rows that the batches of a query have taken in so far, in this run."""
    return sum({p["batchId"]: p["numInputRows"] for p in query.recentProgress}.values())


def offset_of(query: StreamingQuery) -> int:
    """How far the committed batches of a query have come."""
    return max((_rows_at(p["sources"][0]["endOffset"]) for p in query.recentProgress if p["sources"]), default=0)


def _rows_at(offset: str | None) -> int:
    """The count in an offset, which progress reports show as text."""
    found = re.search(r"rows\D+(\d+)", str(offset))
    return int(found.group(1)) if found else 0


def read_bounded(
    spark: SparkSession,
    source: str,
    path: str,
    schema: T.StructType,
    max_items: int | None,
    shape: Shape | None = None,
    idle: float = 2.0,
    **bounds,
) -> int:
    """Take in exactly ``max_items`` new rows, or all there are, and stop; returns how far all runs have come.

    The bound is kept by the source, so no row is read beyond it, none is refused
    after reading, and the next run on the same ``path`` goes on with the row
    behind the last one. With fewer rows than that, or without a bound, the run
    ends when none has come for ``idle`` seconds.
    """
    bounds = {"batch_timeout": min(0.2, idle / 2), **bounds}
    query = start_rows(spark, source, path, schema, shape, max_items=max_items, **bounds)
    try:
        begin = last = None
        changed = time.monotonic()
        while query.isActive:
            now, at = time.monotonic(), offset_of(query)
            # the source has been asked and had nothing; starting up and batches at work are not idle
            asked = query.status["message"].startswith(("Waiting", "Getting offsets"))
            if at != last or not asked:
                last, changed = at, now
            if begin is None and query.recentProgress:
                begin = _rows_at(query.recentProgress[0]["sources"][0]["startOffset"])
            if max_items is not None and begin is not None and at - begin >= max_items:
                break
            if now - changed > idle:
                break
            time.sleep(0.02)
    finally:
        query.stop()
    if query.exception() is not None:
        raise query.exception()
    return offset_of(query)
