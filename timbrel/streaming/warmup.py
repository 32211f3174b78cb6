"""Warm up, then stream: rows wait until enough warm-up rows have come by, or until they have waited long enough."""

from __future__ import annotations

import io
import pickle
from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: The setting without which keyed state and timers are not available, and its value.
STATE_STORE = (
    "spark.sql.streaming.stateStore.providerClass",
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
)


#: Bytes of waiting rows that make one entry of the state.
ENTRY = 1 << 20


class WarmUp(StatefulProcessor):
    """Per key: counts warm-up rows and holds the others back until ``n`` have come or the timer ends.

    The timer starts with the first row of a key. What is held lies in the
    state store, many rows to an entry; a task has one entry of a key at a time.
    """

    def __init__(self, names: list[str], schema: T.StructType, marker: str, n: int, timeout_ms: int):
        self.names, self.schema, self.marker, self.n, self.timeout_ms = names, schema, marker, n, timeout_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.out = Row(*self.names, "warm_up")
        self.seen = handle.getValueState("seen", "n bigint, ended string, entries bigint")
        self.held = handle.getMapState("held", "entry bigint", "rows binary")

    def _release(self, ended: str, entries: int, waiting: bytes = b"") -> Iterator[Row]:
        for k in range(entries):
            yield from self._rows(self.held.getValue((k,))[0], ended)
        self.held.clear()
        yield from self._rows(waiting, ended)

    def _rows(self, packed: bytes, ended: str) -> Iterator[Row]:
        source = io.BytesIO(packed)
        while source.tell() < len(packed):
            yield self.out(*pickle.load(source), ended)

    def _end_timers(self) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        state = self.seen.get() if self.seen.exists() else None
        n, ended, entries = state if state is not None else (0, None, 0)
        if state is None:
            if self.n > 0:
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.timeout_ms)
            else:
                ended = "warm"
        waiting = io.BytesIO()
        mark, places = None, []
        for row in rows:
            if mark is None:
                mark, places = row.__fields__.index(self.marker), [row.__fields__.index(name) for name in self.names]
            if row[mark]:
                n += 1
                if ended is None and n >= self.n:
                    ended = "warm"
                    self._end_timers()
                    yield from self._release(ended, entries, waiting.getvalue())
                    waiting, entries = io.BytesIO(), 0
                continue
            values = tuple(row)
            values = tuple([values[k] for k in places])
            if ended is not None:
                yield self.out(*values, ended)
                continue
            pickle.dump(values, waiting)
            if waiting.tell() >= ENTRY:
                self.held.updateValue((entries,), (waiting.getvalue(),))
                waiting, entries = io.BytesIO(), entries + 1
        if waiting.tell():
            self.held.updateValue((entries,), (waiting.getvalue(),))
            entries += 1
        self.seen.update((n, ended, entries))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        n, ended, entries = self.seen.get()
        if ended is None:
            self.seen.update((n, "timeout", 0))
            yield from self._release("timeout", entries)

    def close(self) -> None:
        pass


def warm_up(stream: DataFrame, key: str, marker: str, n: int, timeout: float) -> DataFrame:
    """The rows that are not for warming up, held back per ``key`` until it is warm; ``warm_up`` says how that ended.

    A key is warm after ``n`` rows with ``marker`` (``warm``), or ``timeout``
    seconds after its first row (``timeout``: it goes on anyway). Rows with the
    marker are dropped, then and later. ``key`` is what warms up by itself, such
    as a replica of a model or a share of the rows; keys are independent, so a
    stream with many of them is spread over all tasks. ``n`` of 0 holds nothing
    back. A null marker is none.

    Needs the setting ``STATE_STORE`` and a trigger by processing time.
    """
    fields = [f for f in stream.schema.fields if f.name != marker]
    kept = T.StructType(fields)
    out = T.StructType([*fields, T.StructField("warm_up", T.StringType())])
    marked = stream.withColumn(marker, F.coalesce(F.col(marker), F.lit(False)))
    processor = WarmUp(kept.names, kept, marker, n, int(timeout * 1000))
    return marked.groupBy(key).transformWithState(processor, out, "append", "processingTime")
