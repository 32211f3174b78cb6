"""Waveforms and decoding; the embeddings table plays the recorded samples."""

from __future__ import annotations

import io
import wave
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from timbrel.functions import waveform
from timbrel.functions.errors import waveform_error
from timbrel.operators import media, results
from timbrel.plans.registry import query, table
from timbrel.session import run_dir
from timbrel.sources.media import scan_media

# Some rows get no samples, some an upstream error, some lose their ids.
_SAMPLES = "CASE WHEN vec_id % 7 = 3 THEN NULL WHEN vec_id % 7 = 5 THEN CAST(array() AS array<float>) ELSE embedding END"
_UPSTREAM = "CASE vec_id % 5 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN 'nan' WHEN 3 THEN ' ' ELSE 'Preprocessing failed: bad header' END"
_ERROR_SQL = f"""CASE WHEN vec_id % 5 = 4 THEN 'Preprocessing failed: bad header'
    WHEN vec_id % 7 IN (3, 5) THEN 'Failed to deserialize waveform: waveform_bytes is None or empty' ELSE '' END"""


def _decoded(spark, folder):
    return table(spark, folder, "embeddings").select(
        "vec_id",
        "label",
        waveform.pack_waveform(F.expr(_SAMPLES)).alias("waveform_bytes"),
        F.expr(_UPSTREAM).alias("upstream"),
    )


@query("waveform_check", f"SELECT vec_id, {_ERROR_SQL} AS error, {_ERROR_SQL} <> '' AS failed FROM embeddings")
def waveform_check(spark, folder):
    rows = _decoded(spark, folder).withColumn("error", waveform_error(F.col("waveform_bytes"), F.col("upstream")))
    return rows.select("vec_id", "error", (F.col("error") != "").alias("failed"))


@query(
    "result_rows",
    f"""
    WITH e AS (SELECT vec_id, label, {_ERROR_SQL} AS error FROM embeddings)
    SELECT vec_id, CASE WHEN vec_id % 4 = 0 THEN 'unknown' ELSE 'job_' || vec_id END AS job_id,
           'song_' || label AS song_id, 'unknown' AS song_hash, 'v' || vec_id || '.wav' AS filename,
           CASE WHEN error <> '' THEN '' ELSE 'i' || label || '|pad' END AS instruments,
           CASE WHEN error <> '' OR label % 2 = 0 THEN '' ELSE 'pad' END AS foreground,
           error FROM e""",
)
def result_rows(spark, folder):
    rows = _decoded(spark, folder).withColumns(
        {
            "job_id": F.expr("CASE WHEN vec_id % 4 <> 0 THEN 'job_' || vec_id END"),
            "song_id": F.expr("'song_' || label"),
            "song_hash": F.lit(None).cast("string"),
            "filename": F.expr("'v' || vec_id || '.wav'"),
            "error": waveform_error(F.col("waveform_bytes"), F.col("upstream")),
        }
    )
    rows = results.with_default_ids(rows)
    # a missing list must come out as an empty one
    layers = F.expr(
        "named_struct('background', array('i' || label), 'middle_ground', array('pad'), "
        "'foreground', CASE WHEN label % 2 = 1 THEN array('pad') END)"
    )
    keep = ["vec_id", *results.ID_COLUMNS]
    layered = results.layered_result(rows, layers, F.lit(""), F.col("error"), *keep)
    return layered.select(
        *keep,
        F.array_join("instruments", "|").alias("instruments"),
        F.array_join("foreground", "|").alias("foreground"),
        "error",
    )


@query(
    "flat_result_rows",
    f"""
    SELECT vec_id, CASE WHEN {_ERROR_SQL} <> '' THEN '' ELSE 'i' || label || '|bass' END AS instruments,
           {_ERROR_SQL} AS error FROM embeddings""",
)
def flat_result_rows(spark, folder):
    rows = _decoded(spark, folder)
    error = waveform_error(F.col("waveform_bytes"), F.col("upstream"))
    flat = results.flat_result(rows, F.expr("array('i' || label, 'bass')"), error, "vec_id")
    return flat.select("vec_id", F.array_join("instruments", "|").alias("instruments"), "error")


@query(
    "duration",
    """
    SELECT vec_id, CASE WHEN vec_id % 7 = 3 THEN NULL WHEN vec_id % 7 = 5 THEN 0.0
                        ELSE CASE label % 3 WHEN 0 THEN len(embedding) / 16000.0 WHEN 1 THEN len(embedding) / 8000.0 END
                   END::DOUBLE AS duration_seconds
    FROM embeddings WHERE vec_id % 7 <> 5 OR label % 3 < 2
    UNION ALL SELECT vec_id, NULL FROM embeddings WHERE vec_id % 7 = 5 AND label % 3 = 2""",
)
def duration(spark, folder):
    rate = F.when(F.col("label") % 3 == 0, 16000).when(F.col("label") % 3 == 1, 8000).otherwise(0)
    return _decoded(spark, folder).select(
        "vec_id", waveform.duration_seconds(F.col("waveform_bytes"), rate).alias("duration_seconds")
    )


@query(
    "waveform_roundtrip",
    """
    SELECT vec_id, CAST(unnest(range(64)) AS INTEGER) AS pos, CAST(unnest(embedding) AS DOUBLE) AS sample
    FROM embeddings""",
)
def waveform_roundtrip(spark, folder):
    packed = table(spark, folder, "embeddings").select(
        "vec_id", waveform.pack_waveform("embedding").alias("waveform_bytes")
    )
    back = packed.select("vec_id", waveform.unpack_waveform("waveform_bytes").alias("samples"))
    return back.select("vec_id", F.posexplode("samples").alias("pos", "sample")).withColumn(
        "sample", F.col("sample").cast("double")
    )


@query(
    "downmix",
    """
    SELECT vec_id, i AS pos, CASE WHEN vec_id % 2 = 0
        THEN (CAST(embedding[i + 1] AS DOUBLE) + CAST(embedding[i + 33] AS DOUBLE)) / 2
        ELSE CAST(embedding[i + 1] AS DOUBLE) END AS sample
    FROM embeddings, (SELECT CAST(unnest(range(32)) AS INTEGER) AS i) WHERE vec_id % 2 = 0
    UNION ALL
    SELECT vec_id, CAST(unnest(range(64)) AS INTEGER), CAST(unnest(embedding) AS DOUBLE) FROM embeddings WHERE vec_id % 2 = 1""",
)
def downmix(spark, folder):
    # even rows are stereo (two halves), odd rows are mono
    channels = F.when(
        F.col("vec_id") % 2 == 0, F.array(F.slice("embedding", 1, 32), F.slice("embedding", 33, 32))
    ).otherwise(F.array("embedding"))
    mono = table(spark, folder, "embeddings").select("vec_id", waveform.downmix(channels).alias("samples"))
    return mono.select("vec_id", F.posexplode("samples").alias("pos", "sample"))


@F.pandas_udf(T.BinaryType())
def pcm_wav(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """16-bit PCM WAV files from frames of integer samples, a channel count and a rate."""

    def one(samples, channels: int, rate: int) -> bytes:
        out = io.BytesIO()
        with wave.open(out, "wb") as f:
            f.setnchannels(int(channels))
            f.setsampwidth(2)
            f.setframerate(int(rate))
            f.writeframes(np.asarray(samples, dtype="<i2").tobytes())
        return out.getvalue()

    for samples, channels, rate in batches:
        yield pd.Series([one(*x) for x in zip(samples, channels, rate)])


# Samples as 16-bit integers, cut towards zero by both engines.
_PCM = "transform(embedding, x -> CAST(CAST(x AS DOUBLE) * 32767 AS INT))"


def wav_jobs(spark, folder, channels, rate, *keep):
    return table(spark, folder, "embeddings").select(
        "vec_id",
        *keep,
        F.expr("'clip' || vec_id || '.wav'").alias("filename"),
        pcm_wav(F.expr(_PCM), channels, rate).alias("audio_bytes"),
    )


@query(
    "decode_wav",
    """
    WITH pcm AS (
        SELECT vec_id, list_transform(embedding, lambda x: CAST(trunc(CAST(x AS DOUBLE) * 32767) AS INTEGER)) AS s FROM embeddings),
    mono AS (
        SELECT vec_id, CAST(unnest(range(64)) AS INTEGER) AS pos, unnest(s) / 32768.0 AS sample FROM pcm WHERE vec_id % 6 IN (0, 2)
        UNION ALL
        SELECT vec_id, i, (s[2 * i + 1] + s[2 * i + 2]) / 65536.0
        FROM pcm, (SELECT CAST(unnest(range(32)) AS INTEGER) AS i) WHERE vec_id % 6 IN (1, 3))
    SELECT vec_id, '' AS error, CAST(16000 AS INTEGER) AS sample_rate,
           CASE WHEN vec_id % 2 = 0 THEN 64 ELSE 32 END / 16000.0::DOUBLE AS duration_seconds,
           pos, CAST(sample AS DOUBLE) AS sample FROM mono
    UNION ALL
    SELECT vec_id, CASE vec_id % 6 WHEN 4 THEN 'Preprocessing failed: no decoder for ' || chr(39) || 'xyz' || chr(39)
           ELSE 'Preprocessing failed: file does not start with RIFF id' END, NULL, NULL, NULL, NULL
    FROM embeddings WHERE vec_id % 6 IN (4, 5)""",
)
def decode_wav(spark, folder):
    # odd rows are stereo; two rows of six cannot be decoded and stay as error rows
    channels = (F.col("vec_id") % 2 + 1).cast("int")
    jobs = wav_jobs(spark, folder, channels, F.lit(16000)).withColumns(
        {
            "filename": F.expr("CASE vec_id % 6 WHEN 4 THEN 'clip' || vec_id || '.xyz' ELSE filename END"),
            "audio_bytes": F.when(F.col("vec_id") % 6 == 5, F.lit(b"not a wave file")).otherwise(F.col("audio_bytes")),
        }
    )
    decoded = media.decode_media(jobs)
    samples = decoded.withColumn("samples", waveform.unpack_waveform("waveform_bytes"))
    return samples.select(
        "vec_id", "error", "sample_rate", "duration_seconds", F.posexplode_outer("samples").alias("pos", "sample")
    ).withColumn("sample", F.col("sample").cast("double"))


@query(
    "resample_wav",
    """
    SELECT vec_id, CASE label % 3 WHEN 0 THEN 8000 WHEN 1 THEN 44100 ELSE 16000 END AS from_rate,
           CAST(ceil(64 * 16000.0 / CASE label % 3 WHEN 0 THEN 8000 WHEN 1 THEN 44100 ELSE 16000 END) AS INTEGER) AS n_samples,
           ceil(64 * 16000.0 / CASE label % 3 WHEN 0 THEN 8000 WHEN 1 THEN 44100 ELSE 16000 END) / 16000.0::DOUBLE AS duration_seconds
    FROM embeddings""",
)
def resample_wav(spark, folder):
    rate = F.when(F.col("label") % 3 == 0, 8000).when(F.col("label") % 3 == 1, 44100).otherwise(16000)
    jobs = wav_jobs(spark, folder, F.lit(1), rate, rate.alias("from_rate"))
    decoded = media.decode_media(jobs).filter(F.col("error") == "")
    return decoded.select(
        "vec_id",
        "from_rate",
        (F.octet_length("waveform_bytes") / 4).cast("int").alias("n_samples"),
        "duration_seconds",
    )


@query(
    "media_scan",
    "SELECT page_id, url, length(html) AS n_chars, md5(html) AS digest, page_id % 2 = 0 AS at_top FROM pages",
)
def media_scan(spark, folder):
    """The pages as files, half of them in deeper folders, found again by a recursive and a flat scan."""
    pages, root = table(spark, folder, "pages"), run_dir(spark, "pages")
    line = F.to_json(F.struct("page_id", "url", "html")).alias("value")
    pages.filter("page_id % 2 = 0").select(line).write.text(root)
    for rest in (1, 3):
        pages.filter(f"page_id % 4 = {rest}").select(line).write.text(f"{root}/more/deep{rest}")
    every = scan_media(spark, root, ("txt",)).select("path", "content")
    top = scan_media(spark, root, ("txt",), recursive=False).select("path", F.lit(True).alias("at_top"))
    text = F.decode("content", "UTF-8")
    lines = every.join(top, "path", "left").select("at_top", F.explode(F.split(text, "\n")).alias("line")).filter("line <> ''")
    found = lines.select("at_top", F.from_json("line", "page_id long, url string, html string").alias("page"))
    return found.select(
        F.col("page.page_id").cast(pages.schema["page_id"].dataType).alias("page_id"),
        "page.url",
        F.char_length("page.html").cast("bigint").alias("n_chars"),
        F.md5("page.html").alias("digest"),
        F.coalesce("at_top", F.lit(False)).alias("at_top"),
    )
