"""User-function stages: batch maps, predictors and chains of them."""

from __future__ import annotations

import logging
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Any

import pyarrow as pa
from pyspark.resource import ResourceProfile
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from timbrel.functions.errors import is_error
from timbrel.functions.parse import parse_layers
from timbrel.operators.results import layered_result
from timbrel.schemas import PREDICTION

log = logging.getLogger(__name__)

ROWS, COLUMNS, ITEMS, ARROW = "rows", "columns", "items", "arrow"

# Rows a predictor holds back, at most, while it fills a batch or an answer frame.
MAX_HELD_ROWS = 1024

# Set-up results by stage, kept for as long as the Python worker lives.
_RESOURCES: dict[str, Any] = {}


@dataclass(frozen=True)
class Stage:
    """A batch function and how to run it.

    ``process`` gets a batch in ``batch_format`` (list of dicts, dict of lists,
    the bare values of ``item_column``, or an Arrow table) and, if ``setup``
    returned something, that as second argument. It returns a list of dicts of
    any length, a dict of lists for ``columns``, a table for ``arrow``.
    """

    name: str
    process: Callable[..., Any]
    schema: T.StructType
    setup: Callable[[], Any] | None = None
    teardown: Callable[[Any], None] | None = None
    batch_size: int = 32
    batch_format: str = ROWS
    item_column: str | None = None
    partitions: int | None = None
    profile: ResourceProfile | None = None
    on_error: str = "raise"
    error_row: Callable[[Any, str], dict] | None = None
    token: str = field(default_factory=lambda: uuid.uuid4().hex)

    def resource(self) -> Any:
        """Result of ``setup``: once per worker, or once per task when there is a teardown."""
        if self.setup is None:
            return None
        if self.teardown is not None:
            return self.setup()
        if self.token not in _RESOURCES:
            _RESOURCES[self.token] = self.setup()
        return _RESOURCES[self.token]

    def call(self, batch: Any, resource: Any) -> Any:
        return self.process(batch) if resource is None else self.process(batch, resource)

    def process_one(self, item: Any) -> Any:
        """First output of a batch of one, None without output."""
        outputs = self.call([item], self.resource())
        return outputs[0] if outputs else None


def _rebatch(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """Tables of exactly ``size`` rows, the last one shorter, whatever Arrow sends."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            piece = batch.slice(at, min(size - rows, batch.num_rows - at))
            held.append(piece)
            rows += piece.num_rows
            at += piece.num_rows
            if rows == size:
                yield pa.Table.from_batches(held)
                held, rows = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _run_batch(stage: Stage, batch: Any, resource: Any) -> Any:
    if stage.on_error == "raise":
        return stage.call(batch, resource)
    try:
        return stage.call(batch, resource)
    except Exception as e:
        if stage.on_error == "skip":
            log.warning("stage %s: batch skipped: %s", stage.name, e)
            return []
    out: list[dict] = []
    for item in batch:
        try:
            out.extend(stage.call([item], resource))
        except Exception as e:
            out.append(stage.error_row(item, str(e)))
    return out


def expand_rows(df: DataFrame, expand: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch | pa.Table]], schema: T.StructType) -> DataFrame:
    """Any number of rows for each row, by a table function over Arrow batches of a batch frame.

    ``expand`` gets record batches with the columns of ``df`` and gives tables of
    ``schema``, shorter or longer. The frame is the function's table argument: it
    is read where it lies, without a shuffle, no row becomes a Python object,
    and ``schema`` is known to the planner before anything runs.
    """

    class Expand:
        def eval(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch | pa.Table]:
            yield from expand(batch)

    return F.arrow_udtf(Expand, returnType=schema)(df.asTable())


def map_stage(df: DataFrame, stage: Stage) -> DataFrame:
    """Run a stage over a batch or streaming frame.

    ``on_error`` is ``raise``, ``skip`` (drop the failing batch), or ``row``:
    the failing batch is repeated row by row and only the rows that fail again
    become ``error_row(item, message)``.
    """
    if stage.on_error == "row" and (stage.error_row is None or stage.batch_format in (COLUMNS, ARROW)):
        raise ValueError("on_error='row' needs error_row and a row or item format")
    arrow_schema = to_arrow_schema(stage.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        resource = stage.resource()
        try:
            for table in _rebatch(batches, stage.batch_size):
                if stage.batch_format == ARROW:
                    out = _run_batch(stage, table, resource)
                    result = out.select(arrow_schema.names).cast(arrow_schema) if out else None
                elif stage.batch_format == COLUMNS:
                    out = _run_batch(stage, table.to_pydict(), resource) or {}
                    result = pa.Table.from_pydict(out, schema=arrow_schema) if out else None
                else:
                    items = (
                        table.column(stage.item_column).to_pylist()
                        if stage.batch_format == ITEMS
                        else table.to_pylist()
                    )
                    out = _run_batch(stage, items, resource)
                    result = pa.Table.from_pylist(out, schema=arrow_schema) if out else None
                if result is not None:
                    yield from result.to_batches()
        finally:
            if stage.teardown is not None:
                stage.teardown(resource)

    source = df.repartition(stage.partitions) if stage.partitions else df
    if stage.item_column and stage.batch_format == ITEMS:
        source = source.select(stage.item_column)
    return source.mapInArrow(run, stage.schema, profile=stage.profile)


def chain(df: DataFrame, *stages: Stage | Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Stages one after the other; neighbours without ``partitions`` share a task."""
    for stage in stages:
        df = map_stage(df, stage) if isinstance(stage, Stage) else df.transform(stage)
    return df


def _prediction_array(rows: list[tuple]) -> pa.Array:
    fields = to_arrow_schema(PREDICTION)
    columns = [pa.array(values, field.type) for values, field in zip(zip(*rows), fields)]
    return pa.StructArray.from_arrays(columns, fields=list(fields))


@dataclass(frozen=True)
class Predictor:
    """A batch model: ``predict(list of inputs[, resource]) -> list of answers``.

    Sampling settings are bound into ``predict``. ``on_error`` is ``row`` (the
    failing batch is repeated one by one, rows that fail again become error
    rows), ``raise``, or ``skip`` (the failing batch is dropped).
    """

    predict: Callable[..., list[str]]
    setup: Callable[[], Any] | None = None
    batch_size: int = 32
    on_error: str = "row"
    token: str = field(default_factory=lambda: uuid.uuid4().hex)

    def _resource(self) -> Any:
        if self.setup is None:
            return None
        if self.token not in _RESOURCES:
            _RESOURCES[self.token] = self.setup()
        return _RESOURCES[self.token]

    def _answers(self, inputs: list, resource: Any) -> list[str]:
        answers = self.predict(inputs) if resource is None else self.predict(inputs, resource)
        if len(answers) != len(inputs):
            raise ValueError(f"predictor returned {len(answers)} answers for {len(inputs)} inputs")
        if any(a is None for a in answers):
            raise ValueError("predictor returned no answer")
        return answers

    def _batch(self, inputs: list, resource: Any) -> list[tuple]:
        try:
            return [(a, "") for a in self._answers(inputs, resource)]
        except Exception as e:
            if self.on_error == "raise":
                raise
            if self.on_error == "skip":
                log.warning("batch of %d inputs skipped: %s", len(inputs), e)
                return [(None, None)] * len(inputs)
            if len(inputs) == 1:
                return [(None, f"Prediction failed: {e}")]
            return [self._batch([x], resource)[0] for x in inputs]

    def _held(self, held: list, resource: Any) -> list[tuple]:
        """Predictions of held rows in order: one call for all that are not null."""
        todo = [x for x in held if x is not None]
        if not todo:
            return [(None, "", None, None)] * len(held)
        started = time.perf_counter()
        answers = iter(self._batch(todo, resource))
        spent = (time.perf_counter() - started) * 1000
        out = []
        timing = (spent, len(todo))
        for x in held:
            if x is None:
                out.append((None, "", None, None))
            else:
                out.append((*next(answers), *timing))
                timing = (None, None)
        return out

    def __call__(self, *inputs: Column) -> Column:
        """``struct<text, error, batch_ms, batch_rows>``; a null first input is not predicted.

        Only the given columns travel to Python and back, all others stay in
        the JVM. Batches are filled across Arrow batches, so a model gets
        ``batch_size`` inputs per call however large these are; inputs are plain
        Python values (texts, bytes, lists of dicts for chats). The expression is marked non-deterministic so that Catalyst
        neither repeats nor moves the call.
        """
        single = len(inputs) == 1

        def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
            resource = self._resource()
            held: list = []
            valid = 0
            out: list[tuple] = []
            for batch in batches:
                for item in zip(*[column.to_pylist() for column in batch]):
                    missing = item[0] is None
                    held.append(None if missing else item[0] if single else item)
                    valid += not missing
                    if valid == self.batch_size or len(held) >= max(MAX_HELD_ROWS, self.batch_size):
                        out += self._held(held, resource)
                        held, valid = [], 0
                    if len(out) >= MAX_HELD_ROWS:
                        yield _prediction_array(out)
                        out = []
            out += self._held(held, resource)
            if out:
                yield _prediction_array(out)

        def one(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            yield from run((batch,) for batch in batches)

        def many(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
            yield from run(batches)

        return F.arrow_udf(one if single else many, PREDICTION).asNondeterministic()(*inputs)


def _predict_mapped(
    df: DataFrame, name: str, predictor: Predictor, inputs: list[Column], profile: ResourceProfile
) -> DataFrame:
    """The predictor in a map stage, the form that can ask for resources of its own.

    All columns pass through Python here, batches are ``batch_size`` rows.
    """
    given = [f"_input{i}" for i in range(len(inputs))]
    keep = df.columns
    schema = T.StructType([*df.schema.fields, T.StructField(name, PREDICTION)])
    arrow_schema = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        resource = predictor._resource()
        for table in _rebatch(batches, predictor.batch_size):
            rows = zip(*[table.column(c).to_pylist() for c in given])
            held = [None if r[0] is None else r[0] if len(r) == 1 else r for r in rows]
            answers = _prediction_array(predictor._held(held, resource))
            columns = [*table.select(keep).columns, answers]
            yield from pa.Table.from_arrays(columns, names=schema.names).cast(arrow_schema).to_batches()

    return df.withColumns(dict(zip(given, inputs))).mapInArrow(run, schema, profile=profile)


def predict(
    df: DataFrame,
    name: str,
    predictor: Predictor,
    inputs: list[Column],
    error: str = "error",
    profile: ResourceProfile | None = None,
) -> DataFrame:
    """Add ``name`` (a prediction struct) for rows without an error; others pass untouched.

    ``error`` takes over a failed prediction's message. With ``skip``, rows of
    failed batches leave the frame here, as the policy says. ``profile`` names
    the resources of the tasks that run the model, such as GPUs.
    """
    ready = ~is_error(F.col(error))
    first, *rest = inputs
    if profile is None:
        out = df.withColumn(name, predictor(F.when(ready, first), *rest))
    else:
        out = _predict_mapped(df, name, predictor, [F.when(ready, first), *rest], profile)
    if predictor.on_error == "skip":
        out = out.filter(F.col(f"{name}.error").isNotNull())
    failure = F.when(first.isNull(), F.lit("Prediction failed: no input")).otherwise(F.col(f"{name}.error"))
    return out.withColumn(error, F.when(is_error(F.col(error)), F.col(error)).otherwise(failure))


def annotate(
    df: DataFrame,
    predictor: Predictor,
    prompt: Column,
    *keep: str,
    parse: Callable[[Column], Column] = parse_layers,
    envelope: Callable[..., DataFrame] = layered_result,
    error: str = "error",
    profile: ResourceProfile | None = None,
) -> DataFrame:
    """One-step annotation: predict on sound rows, parse in the JVM, one envelope for all rows.

    ``envelope(frame, parsed answer, plan, error, *keep)`` gives the fields of
    successes and errors.
    """
    answered = predict(df, "_answer", predictor, [prompt], error, profile)
    return envelope(answered, parse(F.col("_answer.text")), F.lit(""), F.col(error), *keep)


def annotate_steps(
    df: DataFrame,
    steps: list[tuple[str, Predictor, Callable[[dict[str, Column]], Column]]],
    *,
    error: str = "error",
    profile: ResourceProfile | None = None,
) -> DataFrame:
    """Chained predictions: each step builds its prompt from the answers before it.

    ``steps`` are ``(name, predictor, prompt builder)``; every answer stays as
    column ``<name>`` (text) beside ``<name>_stats`` (timing of its batches).
    """
    answers: dict[str, Column] = {}
    for name, predictor, prompt in steps:
        df = predict(df, f"_{name}", predictor, [prompt(answers)], error, profile)
        df = df.withColumns(
            {name: F.col(f"_{name}.text"), f"{name}_stats": F.struct(f"_{name}.batch_ms", f"_{name}.batch_rows")}
        ).drop(f"_{name}")
        answers[name] = F.col(name)
    return df


def predict_runs(df: DataFrame, name: str, predictor: Predictor, prompt: Column, runs: int, error: str = "error") -> DataFrame:
    """Array of ``runs`` answers per row; the predictor gets ``(input, run)`` pairs.

    A failed run has no answer; its message, with the number of the run, goes
    into ``error``, and the answers of the other runs stay.
    """
    ready = ~is_error(F.col(error))
    for run in range(runs):
        df = df.withColumn(f"_run{run}", predictor(F.when(ready, prompt), F.lit(run)))
    texts = F.array_compact(F.array(*[F.col(f"_run{run}.text") for run in range(runs)]))

    def message(run: int) -> Column:
        failed = is_error(F.col(f"_run{run}.error"))
        return F.when(ready & failed, F.concat(F.lit(f"run {run}: "), F.col(f"_run{run}.error")))

    said = F.concat_ws("; ", *[message(run) for run in range(runs)])
    return df.withColumns({name: texts, error: F.when(said != "", said).otherwise(F.col(error))}).drop(
        *[f"_run{run}" for run in range(runs)]
    )
