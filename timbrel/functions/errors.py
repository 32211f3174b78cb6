"""The real-error rule: errors are data, and ``""`` means success."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from timbrel.functions.text import strip


def is_error(error: Column) -> Column:
    """True unless the text is null, ``"nan"`` or blank."""
    return F.coalesce((error != F.lit("nan")) & (strip(error) != F.lit("")), F.lit(False))


def missing_waveform(waveform_bytes: Column) -> Column:
    return F.coalesce(F.octet_length(waveform_bytes), F.lit(0)) == 0


def waveform_error(waveform_bytes: Column, upstream: Column) -> Column:
    """Error text of a decoded row: the upstream error, a missing or cut waveform, or ``""``."""
    return (
        F.when(is_error(upstream), upstream)
        .when(
            missing_waveform(waveform_bytes),
            F.lit("Failed to deserialize waveform: waveform_bytes is None or empty"),
        )
        .when(
            F.octet_length(waveform_bytes) % 4 != 0,
            F.lit("Failed to deserialize waveform: buffer size must be a multiple of element size"),
        )
        .otherwise(F.lit(""))
    )
