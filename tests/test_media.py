import io
import math
import wave

import numpy as np
import pytest
from pyspark.sql import functions as F

from timbrel.functions import waveform
from timbrel.functions.errors import waveform_error
from timbrel.operators import media


def sine(rate, seconds=0.5, hertz=440.0):
    return np.sin(2 * np.pi * hertz * np.arange(int(rate * seconds)) / rate)


def wav(channels, rate, width=2):
    """PCM file of float channels in [-1, 1)."""
    frames = np.stack(channels, axis=1).ravel()
    out = io.BytesIO()
    with wave.open(out, "wb") as f:
        f.setnchannels(len(channels))
        f.setsampwidth(width)
        f.setframerate(rate)
        if width == 1:
            data = np.round(frames * 128 + 128).astype("u1").tobytes()
        elif width == 3:
            data = np.round(frames * (2**23 - 1)).astype("<i4").view("u1").reshape(-1, 4)[:, :3].tobytes()
        else:
            data = np.round(frames * (2 ** (8 * width - 1) - 1)).astype(f"<i{width}").tobytes()
        f.writeframes(data)
    return out.getvalue()


@pytest.mark.parametrize("width,tolerance", [(1, 0.005), (2, 1e-4), (3, 1e-6), (4, 1e-6)])
def test_sample_widths(width, tolerance):
    x = 0.9 * sine(8000)
    channels, rate = media.decode_pcm_wav(wav([x, -x], 8000, width))
    assert (channels.shape, rate) == ((2, x.size), 8000)
    assert np.abs(channels[0] - x).max() < tolerance
    assert np.abs(media.to_mono(channels)).max() < tolerance


@pytest.mark.parametrize("rate", [8000, 11025, 22050, 44100, 48000])
def test_resampled_sine(rate):
    got = media.resample(sine(rate).astype("float32"), rate, 16000)
    assert got.size == math.ceil(int(rate * 0.5) * 16000 / rate)
    want = sine(16000)[: got.size]
    inner = slice(200, want.size - 200)
    assert np.abs(got[: want.size][inner] - want[inner]).max() < 0.01


def test_same_rate_is_untouched():
    x = sine(16000).astype("float32")
    assert np.array_equal(media.resample(x, 16000, 16000), x)


def test_tones_above_the_target_band_vanish():
    x = sine(44100, hertz=12000.0).astype("float32")
    assert np.abs(media.resample(x, 44100, 16000)[200:-200]).max() < 0.05


def test_decode_job(spark):
    x = 0.5 * sine(8000)
    files = [
        ("a", "mono.wav", wav([x], 8000)),
        ("b", "stereo.WAV", wav([x, x], 16000)),
        ("c", "empty.wav", b""),
        ("d", "noise.wav", bytes(range(256))),
        ("e", "none.wav", None),
        ("f", "noext", wav([x], 8000)),
        ("g", "song.raw", x.astype("<f4").tobytes()),
        ("h", None, b"x"),
    ]
    df = spark.createDataFrame(files, "job_id string, filename string, audio_bytes binary")
    decoders = {"raw": lambda data: (np.frombuffer(data, "<f4")[None, :], 16000)}
    rows = {r.job_id: r for r in media.decode_media(df, decoders=decoders).collect()}
    assert rows["a"].error == "" and rows["a"].sample_rate == 16000
    assert rows["a"].duration_seconds == pytest.approx(0.5)
    assert np.frombuffer(rows["a"].waveform_bytes, "<f4").size == 8000
    assert rows["b"].duration_seconds == pytest.approx(0.25)
    assert rows["g"].error == "" and rows["g"].duration_seconds == pytest.approx(0.25)
    for bad in "cdefh":
        r = rows[bad]
        assert r.error.startswith("Preprocessing failed: "), bad
        assert (r.waveform_bytes, r.sample_rate, r.duration_seconds) == (b"", None, None)
    assert "missing audio data" in rows["e"].error and "'mp3'" in rows["f"].error


def test_large_output_is_cut(spark):
    x = 0.5 * sine(16000, 0.1)
    files = [(i, f"f{i}.wav", wav([x * (i + 1) / 20], 16000)) for i in range(20)]
    df = spark.createDataFrame(files, "i int, filename string, audio_bytes binary").coalesce(1)
    whole = {r.i: r for r in media.decode_media(df).collect()}
    cut = {r.i: r for r in media.decode_media(df, max_output_bytes=10000).collect()}
    assert whole == cut and len(cut) == 20


def test_round_trip_with_gaps(spark):
    rng = np.random.default_rng(1)
    values = [rng.normal(size=n).astype("float32") for n in (16000, 0, 1, 7)]
    data = [(i, v.tolist()) for i, v in enumerate(values)] + [(9, None)]
    df = spark.createDataFrame(data, "i int, x array<float>").coalesce(1)
    packed = df.select("i", "x", waveform.pack_waveform("x").alias("b"))
    rows = packed.select("*", waveform.unpack_waveform("b").alias("y")).collect()
    for r in rows:
        assert r.y == r.x
        assert r.b == (None if r.x is None else values[r.i].tobytes())


def test_round_trip_in_many_batches(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = spark.range(100).select("id", F.expr("transform(sequence(0, cast(id % 5 as int)), k -> cast(k + id as float))").alias("x"))
        df = df.withColumn("x", F.when(F.col("id") % 11 != 0, F.col("x")))
        back = df.select("x", waveform.unpack_waveform(waveform.pack_waveform("x")).alias("y")).collect()
        assert len(back) == 100 and all(r.x == r.y for r in back)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_cut_waveforms(spark):
    df = spark.createDataFrame([(b"abc", ""), (b"", ""), (None, ""), (b"abcd", "nan"), (b"", "boom")], "b binary, e string")
    rows = df.select(waveform_error(F.col("b"), F.col("e")).alias("e"), waveform.unpack_waveform("b").alias("x")).collect()
    prefix = "Failed to deserialize waveform: "
    assert [r.e for r in rows] == [
        prefix + "buffer size must be a multiple of element size",
        prefix + "waveform_bytes is None or empty",
        prefix + "waveform_bytes is None or empty",
        "",
        "boom",
    ]
    assert rows[0].x is None and len(rows[3].x) == 1


def test_downmix_and_duration(spark):
    df = spark.createDataFrame([([[1.0, 2.0], [3.0, 6.0]],), ([[1.0, 2.0]],), ([[1.0], [2.0], [6.0]],)], "c array<array<float>>")
    assert [r[0] for r in df.select(waveform.downmix(F.col("c"))).collect()] == [[2.0, 4.0], [1.0, 2.0], [3.0]]
    d = spark.createDataFrame([(bytes(8), 4), (bytes(8), 0), (None, 4)], "b binary, r int")
    assert [r[0] for r in d.select(waveform.duration_seconds(F.col("b"), F.col("r"))).collect()] == [0.5, None, None]
