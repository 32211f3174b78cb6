"""Several answers per file: union, agreement and the rows behind them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timbrel.functions.parse import let, parse_set


def replicate_runs(df: DataFrame, runs: int, name: str = "run") -> DataFrame:
    """Every row once per ensemble run."""
    return df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(runs - 1))))


def ensemble_items(responses: Column, exact: bool = False) -> Column:
    """Sorted distinct items over a file's list of answers; stays in the row."""
    return F.array_sort(F.array_distinct(F.flatten(F.transform(responses, lambda r: parse_set(r, exact)))))


def ensemble(df: DataFrame, responses: str, *keep: str) -> DataFrame:
    """``ensembled_instruments, individual_responses, num_runs`` per row.

    The answers of one file are one array, as :func:`predict_runs` makes them,
    so nothing is shuffled.
    """
    return df.select(
        *keep,
        ensemble_items(F.col(responses)).alias("ensembled_instruments"),
        F.col(responses).alias("individual_responses"),
        F.size(responses).alias("num_runs"),
    )


def ensemble_rows(df: DataFrame, file: str, response: str) -> DataFrame:
    """``(file, item, runs_with_item)`` from one row per answer.

    For answers that were written run by run. Counts are combined map-side, so
    a file with very many answers is never gathered.
    """
    items = df.select(file, F.explode(parse_set(F.col(response))).alias("item"))
    return items.groupBy(file, "item").agg(F.count("*").alias("runs_with_item"))


def agreement(df: DataFrame, file: str, response: str) -> DataFrame:
    """Items found by all runs of a file over its largest run; null if all runs are empty.

    From one row per answer, in one pass. Each answer also emits a null item,
    whose count is the number of runs: the items of a file that are counted as
    often as it are the shared ones. The last two groupings see one row per
    distinct item and per distinct count, never a file's answers.
    """
    nothing = F.array(F.lit(None).cast("string"))
    items = df.select(file, parse_set(F.col(response)).alias("_items")).select(
        file, F.size("_items").alias("_size"), F.explode(F.concat(nothing, "_items")).alias("_item")
    )
    return (
        items.groupBy(file, "_item")
        .agg(F.count("*").alias("_runs"), F.max("_size").alias("_size"))
        .groupBy(file, "_runs")
        .agg(F.count("*").alias("_n"), F.max("_size").alias("_size"))
        .groupBy(file)
        .agg(
            F.max("_runs").alias("num_runs"),
            (F.max_by("_n", "_runs") - 1).alias("shared_items"),
            F.max("_size").cast("bigint").alias("max_size"),
        )
        .withColumn("agreement", F.try_divide("shared_items", "max_size"))
    )


def agreement_of(responses: Column) -> Column:
    """The same measure for answers held in one array."""


    def measure(sets: Column) -> Column:
        shared = F.aggregate(sets, F.get(sets, F.lit(0)), lambda a, b: F.array_intersect(a, b))
        return F.try_divide(F.size(shared), F.array_max(F.transform(sets, lambda s: F.size(s))))

    return let(F.transform(responses, lambda r: parse_set(r)), measure)
