"""Validation of submitted files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timbrel.operators.settled import settled
from timbrel.operators.skew import join_spread

# Accepted extensions and the size limit.
ALLOWED_EXTENSIONS = ("mp3", "wav", "flac", "ogg", "m4a", "aac", "wma", "aiff")
MAX_FILE_BYTES = 100 * 1024 * 1024


def validate_upload(
    filename: Column,
    size: Column,
    allowed: tuple[str, ...] = ALLOWED_EXTENSIONS,
    max_bytes: int = MAX_FILE_BYTES,
) -> Column:
    """``struct<ok, code, detail>``; extension rules come first, then the inclusive size limit."""
    extension = F.lower(F.substring_index(filename, ".", -1))
    listed = ", ".join(sorted(allowed))

    def verdict(ok: bool, code: int, detail: Column) -> Column:
        return F.struct(F.lit(ok).alias("ok"), F.lit(code).alias("code"), detail.alias("detail"))

    bad_extension = F.concat(F.lit("File extension '"), extension, F.lit(f"' not allowed. Allowed: {listed}"))
    return (
        F.when(
            ~F.coalesce(F.contains(filename, F.lit(".")), F.lit(False)),
            verdict(False, 400, F.lit(f"File must have an extension. Allowed: {listed}")),
        )
        .when(~extension.isin(*allowed), verdict(False, 400, bad_extension))
        .when(
            ~F.coalesce(size <= max_bytes, F.lit(False)),
            verdict(False, 413, F.lit(f"File too large. Maximum size: {max_bytes / 1048576:.1f}MB")),
        )
        .otherwise(verdict(True, 200, F.lit("")))
    )


def split_uploads(
    df: DataFrame,
    filename: str,
    size: str,
    allowed: tuple[str, ...] = ALLOWED_EXTENSIONS,
    max_bytes: int = MAX_FILE_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """(accepted, quarantined with code and detail)."""
    checked = df.withColumn("_verdict", validate_upload(F.col(filename), F.col(size), allowed, max_bytes))
    return (
        # the size test once more by itself: in this form it reaches a file scan
        # and keeps the content of oversized files from being read
        checked.filter((F.col(size) <= max_bytes) & F.col("_verdict.ok")).drop("_verdict"),
        checked.filter("NOT _verdict.ok").select(*df.columns, "_verdict.code", "_verdict.detail"),
    )


def accept_prefix(df: DataFrame, batch: str, position: str, ok: Column) -> DataFrame:
    """Add ``accepted``: within a request only the files before its first invalid one.

    The first bad position per request is a plain ``min`` (combined map-side),
    so a request holding most of all files never sits in one window, and the
    join back with one row per request splits such a request.
    """
    df = settled(df, "accept")
    first_bad = df.filter(~ok).groupBy(batch).agg(F.min(position).alias("_first_bad"))
    return (
        join_spread(df, first_bad, batch, "left")
        .withColumn("accepted", F.col("_first_bad").isNull() | (F.col(position) < F.col("_first_bad")))
        .drop("_first_bad")
    )
