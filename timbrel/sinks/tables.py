"""Result tables, exports and the benchmark report."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from timbrel.functions.errors import is_error
from timbrel.schemas import LAYERS
from timbrel.session import run_dir


def csv_ready(df: DataFrame) -> DataFrame:
    """Lists and structs as JSON text, which is what a CSV cell can hold."""
    nested = (T.ArrayType, T.StructType, T.MapType)
    return df.select(
        *[F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name) for f in df.schema]
    )


def write_results_csv(df: DataFrame, path: str) -> None:
    csv_ready(df).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def export_catalog(df: DataFrame, folder: str) -> tuple[str, str]:
    """The catalogue as CSV and as JSON records; returns both paths.

    The CSV is made from the written records, so the catalogue is computed once
    and both files agree even if executors are lost in between.
    """
    spark = df.sparkSession
    json_path, csv_path = f"{folder}/json", f"{folder}/csv"
    df.write.mode("overwrite").option("ignoreNullFields", False).json(json_path)
    write_results_csv(spark.read.schema(df.schema).json(json_path), csv_path)
    return csv_path, json_path


def report_summary(
    results: DataFrame, load_seconds: float, run_seconds: float, error: str = "error", **more: Column
) -> DataFrame:
    """One ``summary`` struct over all results, and other aggregates of the same pass."""
    failed = is_error(F.col(error))
    ok = F.count_if(~failed)
    rate = F.coalesce(F.try_divide(ok, F.lit(float(run_seconds))), F.lit(0.0))
    return results.agg(
        F.struct(
            F.count("*").alias("total_files"),
            ok.alias("successful"),
            F.count_if(failed).alias("failed"),
            F.lit(float(load_seconds)).alias("model_load_time_sec"),
            F.lit(float(run_seconds)).alias("inference_time_sec"),
            rate.alias("throughput_files_per_sec"),
        ).alias("summary"),
        *[column.alias(name) for name, column in more.items()],
    )


def report_rows(results: DataFrame, error: str = "error") -> Column:
    """The ``results[]`` element of one row."""
    empty = F.array().cast("array<string>")
    return F.to_json(
        F.struct(
            F.col("filename"),
            *[F.coalesce(n, empty).alias(n) for n in LAYERS],
            F.coalesce(error, F.lit("")).alias("error"),
        )
    )


def report_lines(results: DataFrame, load_seconds: float, run_seconds: float, order: str) -> DataFrame:
    """``(part, position, line)``: the lines of one JSON document ``{summary, results[]}``.

    The document is a text file in order of ``part``, ``position`` and, for
    repeated positions, lines without a leading comma first; it is never held
    in one row. One element has no comma before it: the least one, once.
    ``order`` may repeat or be null.

    The elements are written first, so that ``results`` are computed once: one
    pass over what was written sums up and finds the least element by its place
    in the files, another one writes the lines.
    """
    spark, place = results.sparkSession, results.schema[order].dataType
    elements = results.select(F.col(order).alias("position"), report_rows(results).alias("json"), F.col("error"))
    path = run_dir(spark, "report")
    elements.write.parquet(path)
    at = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    kept = spark.read.schema(elements.schema).parquet(path).select("*", at.alias("at"))
    order_of_all = F.struct(F.col("position").isNotNull(), "position", "json", "at")
    known = report_summary(kept, load_seconds, run_seconds, least=F.min(order_of_all)["at"])
    found = known.first()
    head = spark.createDataFrame([(found.summary,)], known.select("summary").schema).select(
        F.lit(0).alias("part"),
        F.lit(None).cast(place).alias("position"),
        F.concat(F.lit('{"summary": '), F.to_json("summary"), F.lit(', "results": [')).alias("line"),
    )
    first = F.lit(False)
    if found.least is not None:
        first = (F.col("at.file") == found.least.file) & (F.col("at.row") == found.least.row)
    body = kept.select(
        F.lit(1).alias("part"), "position", F.concat(F.when(first, "").otherwise(","), "json").alias("line")
    )
    tail = results.sparkSession.range(1).select(
        F.lit(2).alias("part"), F.lit(None).cast(place).alias("position"), F.lit("]}").alias("line")
    )
    return head.unionAll(body).unionAll(tail)


def write_report(results: DataFrame, load_seconds: float, run_seconds: float, order: str, path: str) -> None:
    """Write the document as text parts which, read in name order, are one JSON document."""
    lines = report_lines(results, load_seconds, run_seconds, order)
    ordered = lines.orderBy("part", "position", F.col("line").startswith(","))
    ordered.select("line").write.mode("overwrite").text(path)


def iterate_results(df: DataFrame, size: int = 1) -> Iterator[list[Row]]:
    """Lists of ``size`` rows, one partition at a time and without prefetch."""
    held: list[Row] = []
    for row in df.toLocalIterator(prefetchPartitions=False):
        held.append(row)
        if len(held) == size:
            yield held
            held = []
    if held:
        yield held


def split_sink(
    path: str, error: str = "error", on_success: Callable[[DataFrame, int], None] | None = None
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function writing successes and failures apart.

    A micro-batch is computed and written once, into a folder of its own with
    one partition per branch. A batch repeated after a failure overwrites that
    folder, so nothing is written twice. ``on_success`` gets the written
    successes.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        folder = f"{path}/batch={batch_id}"
        marked = batch.withColumn("branch", F.when(is_error(F.col(error)), "failure").otherwise("success"))
        marked.write.mode("overwrite").partitionBy("branch").parquet(folder)
        if on_success:
            written = batch.sparkSession.read.schema(marked.schema).parquet(folder)
            on_success(written.filter("branch = 'success'").drop("branch"), batch_id)

    return write


def read_split(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(successes, failures) written by :func:`split_sink`; each reads its own folders only."""
    written = spark.read.parquet(path)
    return tuple(
        written.filter(F.col("branch") == branch).drop("branch", "batch") for branch in ("success", "failure")
    )
