"""Which jobs have not come back, while jobs and results are still arriving."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def missing_on_stream(
    jobs: DataFrame, results: DataFrame, key: str, submitted: str, finished: str, wait: str, late: str = "0 seconds"
) -> DataFrame:
    """``key, submitted, finished, missing`` of every job: with each result, or missing once ``wait`` is over.

    Two streams: jobs with the time they were submitted at, results with the
    time they finished at. A result belongs to a job when it finishes from then
    until ``wait`` later. A job without one is named as soon as both streams have
    passed that time by ``late``, how far rows may be behind; what is kept in
    state is bounded by ``wait`` and ``late``. Rows without a key or time
    match nothing: such jobs count as missing at once or never come out, so filter them before.
    """
    job = jobs.select(F.col(key).alias("_key"), F.col(submitted).alias("_submitted")).withWatermark("_submitted", late)
    result = results.select(F.col(key).alias("_result"), F.col(finished).alias("_finished")).withWatermark("_finished", late)
    within = F.expr(f"_result = _key AND _finished >= _submitted AND _finished <= _submitted + INTERVAL {wait}")
    return job.join(result, within, "left_outer").select(
        F.col("_key").alias(key), F.col("_submitted").alias(submitted), F.col("_finished").alias(finished),
        F.col("_result").isNull().alias("missing"),
    )
