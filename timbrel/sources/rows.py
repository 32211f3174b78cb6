"""A folder of arriving Parquet files as a stream bounded by rows and time."""

from __future__ import annotations

import json
import time
import uuid
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema


def _opened(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


#: Column with the place in the stream of the first row of a row's batch.
FIRST = "_first_row"


class _Rows(InputPartition):
    """Rows ``low`` to ``high`` of one or more files: (path, low, high); the stream's rows from ``at``, of a trigger from ``begin``."""

    def __init__(self, slices: list[tuple[str, int, int]], at: int, begin: int):
        self.slices, self.at, self.begin = slices, at, begin


class Ledger:
    """Which files there are, in the order in which they were found, and where their rows begin.

    Row offsets mean the same after a restart only if files keep their order,
    so each finding is written down before an offset beyond it is given out.
    """

    def __init__(self, folder: str, ledger: str):
        self.fs, self.folder = _opened(folder)
        self.ledger_fs, self.ledger = _opened(ledger)
        self.paths: list[str] = []
        self.ends: list[int] = []
        self.seen: set[str] = set()
        self.written = 0
        self.ledger_fs.create_dir(self.ledger, recursive=True)
        entries = self.ledger_fs.get_file_info(pafs.FileSelector(self.ledger))
        for entry in sorted((e for e in entries if e.base_name.endswith(".json")), key=lambda e: e.base_name):
            with self.ledger_fs.open_input_stream(entry.path) as file:
                self._append(json.loads(file.read()))
            self.written += 1

    def _append(self, found: list[list]) -> None:
        for path, rows in found:
            self.seen.add(path)
            self.paths.append(path)
            self.ends.append(self.rows + rows)

    @property
    def rows(self) -> int:
        return self.ends[-1] if self.ends else 0

    def look(self) -> None:
        """Take up new files: those of one look in order of time and name; hidden ones are not finished yet."""
        info = self.fs.get_file_info(self.folder)
        if info.type == pafs.FileType.NotFound:
            return
        is_file = info.type == pafs.FileType.File
        infos = [info] if is_file else self.fs.get_file_info(pafs.FileSelector(self.folder, recursive=True))
        fresh = []
        for i in infos:
            inside = i.path[len(self.folder) :].strip("/").split("/")
            hidden = not is_file and any(p[:1] in "._" and "=" not in p for p in inside)
            if i.type == pafs.FileType.File and i.path.endswith(".parquet") and not hidden and i.path not in self.seen:
                fresh.append(i)
        if not fresh:
            return
        fresh.sort(key=lambda i: (i.mtime_ns or 0, i.path))
        found = []
        for i in fresh:
            with self.fs.open_input_file(i.path) as file:
                found.append([i.path, pq.read_metadata(file).num_rows])
        target = f"{self.ledger}/{self.written:012d}.json"
        draft = f"{self.ledger}/.{uuid.uuid4().hex}"
        with self.ledger_fs.open_output_stream(draft) as file:
            file.write(json.dumps(found).encode())
        self.ledger_fs.move(draft, target)
        self.written += 1
        self._append(found)

    def slices(self, start: int, end: int) -> list[tuple[str, int, int]]:
        """The parts of files that hold rows ``start`` to ``end``."""
        out = []
        k = bisect_right(self.ends, start)
        while start < end and k < len(self.ends):
            begin = self.ends[k - 1] if k else 0
            stop = min(end, self.ends[k])
            if stop > start:
                out.append((self.paths[k], start - begin, stop - begin))
            start, k = max(start, stop), k + 1
        return out


class RowStreamReader(DataSourceStreamReader):
    """Offsets are counts of rows. A batch ends after ``batch_size`` rows, or sooner when rows have waited long enough.

    A trigger takes up to ``together`` full batches that wait, or one that time has ended.
    """

    def __init__(self, schema: T.StructType, options: dict[str, str]):
        self.schema = schema
        self.path = options["path"]
        self.batch_size = int(options.get("batch_size", "8"))
        self.batch_timeout = float(options.get("batch_timeout", "0.5"))
        self.poll_interval = float(options.get("poll_interval", "0.05"))
        self.max_items = int(options["max_items"]) if "max_items" in options else None
        self.parallelism = int(options.get("parallelism", "1"))
        self.together = int(options.get("together", "1"))
        if min(self.batch_size, self.parallelism, self.together) < 1 or (self.max_items is not None and self.max_items < 0):
            raise ValueError("batch_size, parallelism and together are 1 or more, max_items is 0 or more")
        self.ledger_path = options["ledger"]
        self.ledger: Ledger | None = None
        self.at: int | None = None  # rows given out
        self.limit: int | None = None
        self.looked, self.waiting_since = 0.0, None

    def _ledger(self) -> Ledger:
        if self.ledger is None:
            self.ledger = Ledger(self.path, self.ledger_path)
        return self.ledger

    def _begin(self, at: int) -> None:
        """The first offset of this run, from which ``max_items`` counts."""
        if self.at is None:
            self.at = at
            self.limit = None if self.max_items is None else at + self.max_items

    def initialOffset(self) -> dict:
        return {"rows": 0}

    def latestOffset(self) -> dict:
        self._begin(0)
        ledger, now = self._ledger(), time.monotonic()
        if now - self.looked >= self.poll_interval:
            ledger.look()
            self.looked = now
        end = ledger.rows if self.limit is None else min(ledger.rows, self.limit)
        if end > self.at:
            self.waiting_since = now if self.waiting_since is None else self.waiting_since
            full, last = (end - self.at) // self.batch_size, self.limit is not None and end == self.limit
            if full or last or now - self.waiting_since >= self.batch_timeout:
                self.at = min(end, self.at + self.batch_size * max(1, min(full, self.together)))
                self.waiting_since = None
        return {"rows": self.at}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        # after a restart the engine shows the last offset it knows before it asks for a new one
        self._begin(end["rows"])
        ledger, low, high = self._ledger(), start["rows"], end["rows"]
        step = max(1, -(-(high - low) // self.parallelism))
        return [_Rows(ledger.slices(k, min(high, k + step)), k, low) for k in range(low, high, step)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        wanted = to_arrow_schema(self.schema)
        numbered = FIRST in wanted.names
        for batch in self._read(partition, pa.schema([f for f in wanted if f.name != FIRST])):
            if numbered:
                places = np.arange(partition.at, partition.at + len(batch)) - partition.begin
                first = pa.array(places // self.batch_size * self.batch_size + partition.begin, pa.int64())
                columns = {**dict(zip(batch.schema.names, batch.columns, strict=True)), FIRST: first}
                partition.at += len(batch)
                batch = pa.RecordBatch.from_arrays([columns[n] for n in wanted.names], schema=wanted)
            yield batch

    def _read(self, partition: InputPartition, wanted: pa.Schema) -> Iterator[pa.RecordBatch]:
        fs, _ = _opened(self.path)
        for path, low, high in partition.slices:
            with fs.open_input_file(path) as raw:
                file, begin = pq.ParquetFile(raw), 0
                for group in range(file.num_row_groups):
                    rows = file.metadata.row_group(group).num_rows
                    a, b = max(low, begin) - begin, min(high, begin + rows) - begin
                    begin += rows
                    if a < b:
                        yield from self._part(file, group, a, b, wanted)

    @staticmethod
    def _part(file: pq.ParquetFile, group: int, low: int, high: int, wanted: pa.Schema) -> Iterator[pa.RecordBatch]:
        """Rows of a row group, without holding the group: batches before ``low`` are let go."""
        names, begin = [n for n in wanted.names if n in file.schema_arrow.names], 0
        for batch in file.iter_batches(row_groups=[group], columns=names):
            a, b = max(low - begin, 0), min(high - begin, len(batch))
            begin += len(batch)
            if a < b:
                part = batch.slice(a, b - a)
                columns = [
                    part.column(f.name).cast(f.type) if f.name in names else pa.nulls(len(part), f.type) for f in wanted
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=wanted)
            if begin >= high:
                return


class RowStream(DataSource):
    """Spark data source ``timbrel_rows``; options as in :func:`stream_rows`."""

    @classmethod
    def name(cls) -> str:
        return "timbrel_rows"

    def schema(self) -> T.StructType:
        ledger = Ledger(self.options["path"], self.options["ledger"])
        ledger.look()
        if not ledger.paths:
            raise ValueError("give a schema for a folder that is still empty")
        with ledger.fs.open_input_file(ledger.paths[0]) as file:
            found = from_arrow_schema(pq.read_schema(file))
        return _numbered(found) if int(self.options.get("together", "1")) > 1 else found

    def streamReader(self, schema: T.StructType) -> RowStreamReader:
        return RowStreamReader(schema, dict(self.options))


def _numbered(schema: T.StructType) -> T.StructType:
    if FIRST in schema.names:
        raise ValueError(f"a table whose batches are taken together has no column {FIRST}")
    return T.StructType([*schema.fields, T.StructField(FIRST, T.LongType())])


def stream_rows(
    spark: SparkSession,
    path: str,
    ledger: str,
    schema: T.StructType | None = None,
    batch_size: int = 8,
    batch_timeout: float = 0.5,
    poll_interval: float = 0.05,
    max_items: int | None = None,
    parallelism: int = 1,
    together: int = 1,
) -> DataFrame:
    """Rows of Parquet files as they arrive, in micro-batches bounded by rows and time.

    A micro-batch has ``batch_size`` rows, or fewer once rows have waited for
    ``batch_timeout`` seconds; there are no empty ones. ``max_items`` ends a run
    after exactly so many rows that it had not been given before; the next run
    on the same checkpoint goes on behind them. A batch is read by
    ``parallelism`` tasks, each of which opens only the files and row groups of
    its rows.

    With ``together`` over 1, one trigger takes so many full batches if they wait
    already, since a trigger costs the same for few rows and for many. Batches are
    the same ones then, and a column ``FIRST`` tells them apart: the place in the
    stream of the first row of a row's batch.

    ``ledger`` is a folder, kept with the checkpoint, in which the order of the
    files is written down. Files appear whole (as Spark writes them); names that
    begin with a dot or underscore are not looked at. Like Spark's file source, the
    reader keeps the names of all files it has seen. ``path`` is a folder or file
    that Arrow's file systems know (local, HDFS, S3, GCS). Use it with a trigger by
    processing time; the one-shot triggers of Spark see one batch of it.
    """
    spark.dataSource.register(RowStream)
    reader = spark.readStream.format(RowStream.name()).option("path", path).option("ledger", ledger)
    if schema is not None:
        reader = reader.schema(_numbered(schema) if together > 1 else schema)
    given: dict[str, Any] = {
        "batch_size": batch_size, "batch_timeout": batch_timeout, "poll_interval": poll_interval,
        "max_items": max_items, "parallelism": parallelism, "together": together,
    }
    return reader.options(**{k: v for k, v in given.items() if v is not None}).load()
