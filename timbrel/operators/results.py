"""Job rows, result rows and the checks between them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timbrel.functions.errors import is_error
from timbrel.functions.names import ID_DIGITS, content_hash, given_or, random_id, stable_id, stem_to_last_dot
from timbrel.functions.parse import flatten_layers, parse_layers_lenient
from timbrel.operators.skew import join_spread
from timbrel.schemas import LAYERS

ID_COLUMNS = ("job_id", "song_id", "song_hash", "filename")


def make_jobs(
    df: DataFrame,
    content: Column,
    filename: Column,
    key: list[Column],
    song_id: Column | None = None,
    request: list[Column] | None = None,
    random_ids: bool = False,
    digits: int = ID_DIGITS,
) -> DataFrame:
    """Add ``job_id, song_id, song_hash, created_at, filename``.

    ``request`` gives one job id per request instead of one per file. Ids come
    from the key, so a retried task writes the same ids; ``random_ids`` draws
    them instead.
    """
    draw = random_ids and not request
    job = random_id("job", digits) if draw else stable_id("job", *(request or key), digits=digits)
    generated = random_id("trk", digits) if random_ids else stable_id("trk", *key, digits=digits)
    given = song_id if song_id is not None else F.lit(None).cast("string")
    return df.withColumns(
        {
            "filename": filename,
            "job_id": job,
            "song_id": given_or(given, generated),
            "song_hash": content_hash(content),
            "created_at": F.unix_timestamp(),
        }
    )


def with_default_ids(df: DataFrame) -> DataFrame:
    """Missing ids become ``unknown``, so that error rows can still be traced."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit("unknown")) for c in ID_COLUMNS if c in df.columns})


def layered_result(df: DataFrame, layers: Column, planning: Column, error: Column, *keep: str) -> DataFrame:
    """Envelope of a layered answer: error rows carry empty lists and no plan."""
    failed = is_error(error)
    empty = F.array().cast("array<string>")
    rows = df.select(
        *keep, failed.alias("_failed"), layers.alias("_layers"), planning.alias("_plan"), error.alias("_error")
    )
    return rows.select(
        *keep,
        *[F.when(F.col("_failed"), empty).otherwise(F.coalesce(f"_layers.{n}", empty)).alias(n) for n in LAYERS],
        F.when(F.col("_failed"), empty).otherwise(flatten_layers(F.col("_layers"))).alias("instruments"),
        F.when(F.col("_failed"), F.lit("")).otherwise(F.coalesce("_plan", F.lit(""))).alias("planning_response"),
        F.unix_timestamp().alias("detected_at"),
        F.when(F.col("_failed"), F.col("_error")).otherwise(F.lit("")).alias("error"),
    )


def script_result(df: DataFrame, filename: Column, plan: Column, answer: Column, *keep: str) -> DataFrame:
    """``filename, song_name``, leniently parsed layers, both texts: the row of a scoring script."""
    parsed = df.select(
        *keep,
        filename.alias("filename"),
        stem_to_last_dot(filename).alias("song_name"),
        parse_layers_lenient(answer).alias("_layers"),
        plan.alias("planning_response"),
        answer.alias("raw_response"),
    )
    return parsed.select(
        *keep, "filename", "song_name", "_layers.*", "planning_response", "raw_response"
    )


def flat_result(df: DataFrame, items: Column, error: Column, *keep: str) -> DataFrame:
    """Envelope of a plain instrument list."""
    return df.select(
        *keep,
        F.when(is_error(error), F.array().cast("array<string>")).otherwise(items).alias("instruments"),
        F.unix_timestamp().alias("detected_at"),
        F.when(is_error(error), error).otherwise(F.lit("")).alias("error"),
    )


def flat_envelope(df: DataFrame, items: Column, planning: Column, error: Column, *keep: str) -> DataFrame:
    """:func:`flat_result` in the form that jobs call: a plain list has no plan."""
    return flat_result(df, items, error, *keep)


def split_errors(df: DataFrame, error: str = "error") -> tuple[DataFrame, DataFrame]:
    """(successes, failures)."""
    failed = is_error(F.col(error))
    return df.filter(~failed), df.filter(failed)


def unpivot_layers(df: DataFrame, *keep: str) -> DataFrame:
    """One row per (row, layer) with the layer's list; filter it for a lookup by (song, layer)."""
    return df.unpivot(list(keep), list(LAYERS), "layer", "instruments")


def skip_existing(inputs: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Inputs without an output yet."""
    return join_spread(inputs, existing.select(key).distinct(), key, "left_anti")


def missing_results(jobs: DataFrame, results: DataFrame, key: str) -> DataFrame:
    """Jobs without any result row."""
    return join_spread(jobs, results.select(key).distinct(), key, "left_anti")


def completeness(jobs: DataFrame, results: DataFrame, key: str) -> DataFrame:
    """One row: submitted, received, and jobs that never came back.

    Both sides are reduced to one row per key before they meet, so a key with
    very many results costs one combined row per task.
    """
    per_key = (
        jobs.select(key, F.lit(1).alias("s"), F.lit(0).alias("r"))
        .unionAll(results.select(key, F.lit(0), F.lit(1)))
        .groupBy(key)
        .agg(F.sum("s").alias("s"), F.sum("r").alias("r"))
    )
    totals = per_key.agg(
        F.coalesce(F.sum("s"), F.lit(0)).alias("submitted"),
        F.coalesce(F.sum(F.when(F.col("s") > 0, F.col("r"))), F.lit(0)).alias("received"),
        F.coalesce(F.sum(F.when(F.col("r") == 0, F.col("s"))), F.lit(0)).alias("missing"),
    )
    return totals.withColumn("complete", F.col("missing") == 0)
