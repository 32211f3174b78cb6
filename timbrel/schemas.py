"""Declared schemas; every stage states its output instead of inferring it."""

from __future__ import annotations

from pyspark.sql import types as T

LAYERS = ("background", "middle_ground", "foreground")

_STRINGS = T.ArrayType(T.StringType())


def _ids() -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in ("job_id", "song_id", "song_hash", "filename")]


JOB = T.StructType(
    [
        T.StructField("job_id", T.StringType()),
        T.StructField("created_at", T.LongType()),
        T.StructField("song_id", T.StringType()),
        T.StructField("song_hash", T.StringType()),
        T.StructField("filename", T.StringType()),
        T.StructField("audio_bytes", T.BinaryType()),
    ]
)

DECODED = T.StructType(
    [
        T.StructField("waveform_bytes", T.BinaryType()),
        T.StructField("sample_rate", T.IntegerType()),
        T.StructField("duration_seconds", T.DoubleType()),
        T.StructField("error", T.StringType()),
    ]
)

FLAT_RESULT = T.StructType(
    [
        *_ids(),
        T.StructField("instruments", _STRINGS),
        T.StructField("detected_at", T.LongType()),
        T.StructField("error", T.StringType()),
    ]
)

LAYERED_RESULT = T.StructType(
    [
        *_ids(),
        *[T.StructField(name, _STRINGS) for name in LAYERS],
        T.StructField("instruments", _STRINGS),
        T.StructField("planning_response", T.StringType()),
        T.StructField("detected_at", T.LongType()),
        T.StructField("error", T.StringType()),
    ]
)

# What a predictor stage adds per row: the answer, an error, and the timing of
# the batch, carried by the first row of that batch only.
PREDICTION = T.StructType(
    [
        T.StructField("text", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("batch_ms", T.DoubleType()),
        T.StructField("batch_rows", T.IntegerType()),
    ]
)

MESSAGE = (
    "struct<role:string,content:array<struct<type:string,text:string,audio:binary>>>"
)

TIMELINE = (
    "struct<instruments:array<struct<name:string,layer:string,"
    "timestamps:array<struct<start:string,end:string>>>>>"
)

_TRACK_ITEM = (
    "struct<id:string,name:string,artists:array<struct<name:string>>,"
    "album:struct<name:string>,popularity:int,duration_ms:bigint,preview_url:string>"
)
SEARCH_PAYLOAD = f"struct<tracks:struct<items:array<{_TRACK_ITEM}>>>"
RECOMMENDATION_PAYLOAD = f"struct<tracks:array<{_TRACK_ITEM}>>"

_RUNS = "struct<runs:array<struct<text:string>>>"
# Node names of the video search page's embedded object.
VIDEO_PAGE = (
    "struct<contents:struct<twoColumnSearchResultsRenderer:struct<primaryContents:struct<"
    "sectionListRenderer:struct<contents:array<struct<itemSectionRenderer:struct<contents:array<"
    f"struct<videoRenderer:struct<videoId:string,title:{_RUNS},ownerText:{_RUNS},"
    "lengthText:struct<simpleText:string>>>>>>>>>>>>"
)
VIDEO_PAGE_VARIABLE = "ytInitialData"
VIDEO_URL_PREFIX = "https://www.youtube.com/watch?v="
