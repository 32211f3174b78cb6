"""Parsing of free-text model answers and payloads, all inside the JVM."""

from __future__ import annotations

import ast
from collections.abc import Callable, Iterator
from functools import reduce
from operator import or_

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from timbrel.functions.text import strip
from timbrel.schemas import (
    LAYERS,
    TIMELINE,
    VIDEO_PAGE,
    VIDEO_PAGE_VARIABLE,
    VIDEO_URL_PREFIX,
)

_STRICT = {"allowSingleQuotes": "false"}


def outer_object(text: Column) -> Column:
    """First ``{`` to last ``}``; empty when there is no such slice."""
    return F.regexp_extract(text, r"(?s)\{.*\}", 0)


def outer_list(text: Column) -> Column:
    """First ``[`` to last ``]``; empty when there is no such slice."""
    return F.regexp_extract(text, r"(?s)\[.*\]", 0)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value evaluated once, also where branches use it again."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _read(slice_: Column, element: str, options: dict[str, str], body: Callable[[Column, Column], Column]) -> Column:
    """``body(value, slice)`` when the slice is exactly one JSON value, else null.

    The JSON reader stops after the first value. As a list of one, the slice
    cannot have trailing text unless it closes the list itself (``x][y``); as
    the only member of an object it cannot have that either (``x}} y`` fails as
    a list). No slice passes both but a single value. The second reading only
    skips over the text; an empty slice is not read at all.
    """

    def read(s: Column) -> Column:
        whole = F.size(F.json_object_keys(F.concat(F.lit('{"v":'), s, F.lit("}")))) == 1
        values = F.from_json(F.concat(F.lit("["), s, F.lit("]")), f"array<{element}>", options)
        return let(values, lambda v: F.when((F.size(v) == 1) & whole, body(F.get(v, F.lit(0)), s)))

    return let(slice_, lambda s: F.when(s != "", read(s)))


def _nested_items(body: Column) -> Column:
    """A layer has an item that is itself an object or a list; looked into only where a bracket allows for it."""
    element = "struct<" + ",".join(f"{name}:array<variant>" for name in LAYERS) + ">"

    def look(value: Column) -> Column:
        each = [F.exists(value[n], lambda x: F.schema_of_variant(x).rlike("^(OBJECT|ARRAY)")) for n in LAYERS]
        return F.coalesce(reduce(or_, [F.coalesce(e, F.lit(False)) for e in each]), F.lit(False))

    return F.when(body.rlike(r"(?s)\[.*[\[{].*\]"), let(F.from_json(body, element, _STRICT), look)).otherwise(F.lit(False))


def _layers(text: Column, lenient: bool) -> Column:
    element = "struct<" + ",".join(f"{name}:array<string>" for name in LAYERS) + ">"
    empty = F.array().cast("array<string>")

    def lists(value: Column, body: Column) -> Column:
        # the key is there, but its value is null or no list
        unusable = {
            n: value[n].isNull() & F.coalesce(F.array_contains(F.json_object_keys(body), n), F.lit(False)) for n in LAYERS
        }
        found = F.struct(
            *[F.when(~unusable[n] if lenient else F.lit(True), F.coalesce(value[n], empty)).alias(n) for n in LAYERS]
        )
        if lenient:
            return found
        return F.when(~reduce(or_, unusable.values()) & ~_nested_items(body), found)

    nothing = F.struct(*[empty.alias(n) for n in LAYERS])
    return F.coalesce(_read(outer_object(text), element, _STRICT, lists), nothing)


def parse_layers(text: Column) -> Column:
    """Three layer lists; anything but one sound object with list layers gives empty lists."""
    return _layers(text, lenient=False)


def parse_layers_lenient(text: Column) -> Column:
    """As :func:`parse_layers`, but a null layer stays null and the others survive."""
    return _layers(text, lenient=True)


def flatten_layers(layers: Column) -> Column:
    """Distinct items of the three layers in first-seen order."""
    empty = F.array().cast("array<string>")
    return F.array_distinct(F.concat(*[F.coalesce(layers[name], empty) for name in LAYERS]))


@F.pandas_udf(T.ArrayType(T.StringType()))
def _literal_list(slices: Iterator[pd.Series]) -> Iterator[pd.Series]:
    def read(text: str | None) -> list[str] | None:
        try:
            return [x if x is None else str(x) for x in ast.literal_eval(text)]
        except Exception:
            return None

    for batch in slices:
        yield batch.map(read)


def _list_items(text: Column, exact: bool) -> Column:
    body = outer_list(text)
    if exact:
        return F.when(body != "", _literal_list(body))
    return _read(body, "array<string>", {"allowSingleQuotes": "true"}, lambda value, _: value)


def parse_list(text: Column, exact: bool = False) -> Column:
    """Bracketed list in the answer, else the stripped answer as its only item.

    ``exact`` reads Python literals (trailing commas, escapes) in an Arrow
    UDF; the default stays in the JVM and covers JSON and single quotes.
    """
    return F.coalesce(_list_items(text, exact), F.array(strip(text)))


def parse_set(text: Column, exact: bool = False) -> Column:
    """Distinct items of the bracketed list, none when there is no readable list."""
    return F.coalesce(F.array_distinct(_list_items(text, exact)), F.array().cast("array<string>"))


def parse_timeline(text: Column) -> Column:
    """Instrument timeline of an answer; null when it is not one sound JSON object."""
    return _read(outer_object(text), TIMELINE, _STRICT, lambda value, _: value)


def clock_seconds(clock: Column) -> Column:
    """``m:ss`` (or ``h:mm:ss``) in seconds; null for anything else."""
    return F.aggregate(
        F.split(clock, ":"),
        F.lit(0).cast("bigint"),
        lambda total, part: total * 60 + part.try_cast("bigint"),
    )


def explode_timeline(df: DataFrame, timeline: str, *keep: str) -> DataFrame:
    """One row per instrument and time span; unparsable answers keep one empty row."""
    found = df.select(*keep, F.col(f"{timeline}.instruments").alias("_all")).select(
        *keep, F.coalesce(F.size("_all"), F.lit(0)).alias("n_instruments"), F.explode_outer("_all").alias("_one")
    )
    spans = found.select(*keep, "n_instruments", "_one", F.explode_outer("_one.timestamps").alias("_span"))
    there = F.col("_one").isNotNull()
    span = F.col("_span").isNotNull()
    return spans.select(
        *keep,
        "n_instruments",
        F.when(there, F.coalesce("_one.name", F.lit("?"))).alias("name"),
        F.when(there, F.coalesce("_one.layer", F.lit("?"))).alias("layer"),
        F.when(span, F.coalesce("_span.start", F.lit("?"))).alias("start"),
        F.when(span, F.coalesce("_span.end", F.lit("end"))).alias("end"),
        clock_seconds(F.col("_span.start")).alias("start_seconds"),
        clock_seconds(F.col("_span.end")).alias("end_seconds"),
    )


def embedded_object(html: Column, variable: str) -> Column:
    """Text of the object assigned to ``var <variable>`` in a page's script."""
    return F.regexp_extract(html, r"(?d)var " + variable + r" = (\{.*?\});", 1)


def embedded_videos(html: Column, k: int, variable: str = VIDEO_PAGE_VARIABLE) -> Column:
    """First ``k`` video hits of a search page as array<struct>; empty when a node is missing."""
    page = F.from_json(embedded_object(html, variable), VIDEO_PAGE, _STRICT)
    sections = page["contents"]["twoColumnSearchResultsRenderer"]["primaryContents"]["sectionListRenderer"]["contents"]
    items = F.get(sections, F.lit(0))["itemSectionRenderer"]["contents"]

    def first_run(node: Column) -> Column:
        return F.coalesce(F.get(node["runs"], F.lit(0))["text"], F.lit(""))

    def hit(item: Column) -> Column:
        video = item["videoRenderer"]
        return F.struct(
            first_run(video["title"]).alias("title"),
            video["videoId"].alias("video_id"),
            F.concat(F.lit(VIDEO_URL_PREFIX), video["videoId"]).alias("url"),
            first_run(video["ownerText"]).alias("channel"),
            F.coalesce(video["lengthText"]["simpleText"], F.lit("")).alias("duration"),
        )

    videos = F.filter(items, lambda i: F.coalesce(i["videoRenderer"]["videoId"], F.lit("")) != "")
    return F.transform(F.slice(videos, 1, k), hit)
