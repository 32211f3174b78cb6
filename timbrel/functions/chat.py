"""Chat messages for the predictor as array<struct> columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from timbrel.functions.text import fill_template
from timbrel.schemas import MESSAGE


def _part(kind: str, text: Column | None = None, audio: Column | None = None) -> Column:
    return F.struct(
        F.lit(kind).alias("type"),
        (text if text is not None else F.lit(None).cast("string")).alias("text"),
        (audio if audio is not None else F.lit(None).cast("binary")).alias("audio"),
    )


def system_message(text: Column) -> Column:
    return F.struct(F.lit("system").alias("role"), F.array(_part("text", text=text)).alias("content")).cast(MESSAGE)


def user_message(audio: Column | None = None, text: Column | None = None) -> Column:
    """Audio before text; a part that is absent or null is left out."""
    parts = []
    if audio is not None:
        parts.append(F.when(audio.isNotNull(), _part("audio", audio=audio)))
    if text is not None:
        parts.append(F.when(text.isNotNull(), _part("text", text=text)))
    content = F.array_compact(F.array(*parts)) if parts else F.array()
    return F.struct(F.lit("user").alias("role"), content.alias("content")).cast(MESSAGE)


def first_step_chat(system: str, instructions: str | None, audio: Column, text: Column | None = None) -> Column:
    """[system, user(audio)]; step instructions join the system text."""
    full = system if instructions is None else f"{system}\n\n{instructions}"
    return F.array(system_message(F.lit(full)), user_message(audio, text))


def next_step_chat(
    system: str, template: str, audio: Column, instructions: str | None = None, **answers: Column
) -> Column:
    """[system, user(audio, instructions + template filled with earlier answers)]."""
    filled = fill_template(template, **answers)
    text = filled if instructions is None else F.concat(F.lit(f"{instructions}\n\n"), filled)
    return F.array(system_message(F.lit(system)), user_message(audio, text))
