"""Counts, throughput, stage timings and progress."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from timbrel.functions.errors import is_error


def _rate(count: Column, seconds: Column) -> Column:
    """Count per second, 0 without elapsed time."""
    return F.coalesce(F.try_divide(count, seconds), F.lit(0.0))


def error_counts(df: DataFrame, *by: str, error: str = "error") -> DataFrame:
    """Total, successful and failed rows, over all rows or per group."""
    failed = is_error(F.col(error))
    return df.groupBy(*by).agg(
        F.count("*").alias("total"),
        F.count_if(~failed).alias("successful"),
        F.count_if(failed).alias("failed"),
    )


def intake_status(track_found: Column, track_name: Column, hits: Column, error: Column) -> Column:
    """``struct<status, reason>`` of one download attempt; the first matching rule wins."""

    def outcome(status: str, reason: Column) -> Column:
        return F.struct(F.lit(status).alias("status"), reason.alias("reason"))

    return (
        F.when(~F.coalesce(track_found, F.lit(False)), outcome("skipped", F.lit("no_track")))
        .when(F.coalesce(track_name, F.lit("")) == "", outcome("unknown", F.lit("no_name")))
        .when(F.coalesce(hits, F.lit(0)) == 0, outcome("skipped", F.lit("no_results")))
        .when(is_error(error), outcome("error", error))
        .otherwise(outcome("downloaded", F.lit("")))
    )


def status_counts(df: DataFrame, status: str = "status", reason: str = "reason") -> DataFrame:
    """Rows, and rows with a reason, per status; a debug run counts as downloaded."""
    merged = F.when(F.col(status) == "debug", F.lit("downloaded")).otherwise(F.col(status))
    return df.groupBy(merged.alias("status")).agg(
        F.count("*").alias("n"), F.count_if(F.col(reason) != "").alias("with_reason")
    )


def throughput(
    results: DataFrame, batch: str, milliseconds: str, error: str = "error", skip_batches: int = 0
) -> DataFrame:
    """One row: successes, elapsed seconds, files/s and s/file.

    ``skip_batches`` leaves out the first batches (warm-up). Rows are reduced
    to one per batch first; the first of those are a top-k, whose sums are taken
    off the total. Both read the same shuffle, so the rows are read once.
    """
    per_batch = results.groupBy(batch).agg(
        F.count_if(~is_error(F.col(error))).alias("_ok"),
        F.sum(F.col(milliseconds).cast("decimal(18,3)")).alias("_ms"),
    )
    if skip_batches:
        warm_up = per_batch.orderBy(batch).limit(skip_batches)
        per_batch = per_batch.unionAll(warm_up.select(batch, -F.col("_ok"), -F.col("_ms")))
    totals = per_batch.agg(
        F.coalesce(F.sum("_ok"), F.lit(0)).alias("files"),
        (F.coalesce(F.sum("_ms"), F.lit(0)).cast("double") / 1000).alias("seconds"),
    )
    return totals.withColumns(
        {
            "files_per_second": _rate(F.col("files"), F.col("seconds")),
            "seconds_per_file": _rate(F.col("seconds"), F.col("files")),
        }
    )


def stage_stats(batches: DataFrame, stage: str, milliseconds: str, rows: str) -> DataFrame:
    """Per stage: processed rows, batches, total ms, ms per batch and per row.

    Reads one timing per batch; rows without a timing are ignored, so the
    output of a predictor stage can be used as it is.
    """
    total = F.coalesce(F.sum(F.col(milliseconds).cast("decimal(18,3)")), F.lit(0)).cast("double")
    return (
        batches.groupBy(stage)
        .agg(
            F.coalesce(F.sum(rows), F.lit(0)).alias("processed_count"),
            F.count(milliseconds).alias("batch_count"),
            total.alias("total_ms"),
        )
        .withColumns(
            {
                "ms_per_batch": _rate(F.col("total_ms"), F.col("batch_count")),
                "ms_per_row": _rate(F.col("total_ms"), F.col("processed_count")),
            }
        )
    )


def progress(log: DataFrame, time: str, event: str, every: str = "hour") -> DataFrame:
    """Running totals of submitted and consumed rows per interval.

    The log is reduced to one row per interval; only those rows are ordered
    and summed up.
    """
    per_interval = log.groupBy(F.date_trunc(every, time).alias("interval")).agg(
        F.count_if(F.col(event) == "SUBMIT").alias("submitted"),
        F.count_if(F.col(event) == "RESULT").alias("consumed"),
    )
    so_far = Window.orderBy("interval").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per_interval.withColumns(
        {
            "submitted_total": F.sum("submitted").over(so_far),
            "consumed_total": F.sum("consumed").over(so_far),
        }
    ).withColumn("backlog", F.col("submitted_total") - F.col("consumed_total"))


def streaming_proof(log: DataFrame, elapsed: str, event: str) -> DataFrame:
    """Did results arrive while jobs were still being submitted?

    One row: first and last result, end of the producer, results before that
    end, and the lead in seconds. The end is read by a scalar subquery.
    """
    done = log.filter(F.col(event) == "PRODUCER_DONE").agg(F.min(elapsed)).scalar()
    is_result = F.col(event) == "RESULT"
    return (
        log.withColumn("_done", done)
        .agg(
            F.min(F.when(is_result, F.col(elapsed))).alias("first_result"),
            F.max(F.when(is_result, F.col(elapsed))).alias("last_result"),
            F.max("_done").alias("producer_done"),
            F.count_if(is_result & (F.col(elapsed) < F.col("_done"))).alias("results_before_done"),
            F.count_if(is_result).alias("results"),
        )
        .withColumns(
            {
                "lead_seconds": F.col("producer_done") - F.col("first_result"),
                "streaming": F.coalesce(F.col("first_result") < F.col("producer_done"), F.lit(False)),
            }
        )
    )


def timeline(log: DataFrame, elapsed: str, *ties: str) -> DataFrame:
    """The event log by elapsed time."""
    return log.orderBy(elapsed, *ties)
