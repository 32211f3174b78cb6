"""Decode job: media bytes to mono float32 waveforms at a target rate."""

from __future__ import annotations

import io
import math
import wave
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timbrel.functions.names import decoder_suffix
from timbrel.schemas import DECODED

# bytes -> (channels x samples float32, sample rate)
Decoder = Callable[[bytes], tuple[np.ndarray, int]]

# The resampler's zero crossings per side and its roll-off.
FILTER_WIDTH = 6
ROLLOFF = 0.99


def decode_pcm_wav(content: bytes) -> tuple[np.ndarray, int]:
    """PCM WAV of 8, 16, 24 or 32 bits as channels x samples in [-1, 1)."""
    with wave.open(io.BytesIO(content)) as f:
        width, channels, rate = f.getsampwidth(), f.getnchannels(), f.getframerate()
        raw = f.readframes(f.getnframes())
    if width == 1:
        samples = (np.frombuffer(raw, "u1").astype("float32") - 128.0) / 128.0
    elif width == 3:
        # put the three bytes on top of a 32-bit word, so its sign bit is theirs
        words = np.zeros((len(raw) // 3, 4), "u1")
        words[:, 1:] = np.frombuffer(raw, "u1").reshape(-1, 3)
        samples = (words.view("<i4").ravel() / 2.0**31).astype("float32")
    elif width == 2:
        samples = np.frombuffer(raw, "<i2").astype("float32") / np.float32(2**15)
    else:
        samples = (np.frombuffer(raw, "<i4") / 2.0**31).astype("float32")
    return samples.reshape(-1, channels).T, rate


@lru_cache(maxsize=32)
def _kernel(down: int, up: int) -> tuple[np.ndarray, int]:
    """(one row of taps per output phase, reach of the taps) of a Hann-windowed sinc."""
    cutoff = min(up, down) * ROLLOFF
    reach = math.ceil(FILTER_WIDTH * down / cutoff)
    # time of each tap relative to each output phase, in zero crossings of the kernel
    taps = np.arange(-reach, reach + down) / down
    t = np.clip((taps[None, :] - np.arange(up)[:, None] / up) * cutoff, -FILTER_WIDTH, FILTER_WIDTH)
    kernel = np.sinc(t) * np.cos(t * np.pi / (2 * FILTER_WIDTH)) ** 2 * (cutoff / down)
    return kernel.T.astype("float32"), reach


def resample(samples: np.ndarray, rate: int, target: int) -> np.ndarray:
    """Band-limited resampling; the length is ``ceil(samples * target / rate)``."""
    if rate == target or samples.size == 0:
        return samples.astype("float32")
    g = math.gcd(rate, target)
    down, up = rate // g, target // g
    kernel, reach = _kernel(down, up)
    padded = np.pad(samples.astype("float32"), (reach, reach + down))
    frames = np.lib.stride_tricks.sliding_window_view(padded, kernel.shape[0])[::down]
    out = np.empty((frames.shape[0], up), "float32")
    # the product copies overlapping frames, so it is taken in blocks of some 16 MB
    block = max(1, 4_000_000 // kernel.shape[0])
    for at in range(0, frames.shape[0], block):
        out[at : at + block] = frames[at : at + block] @ kernel
    return out.ravel()[: -(-samples.size * up // down)]


def to_mono(channels: np.ndarray) -> np.ndarray:
    """Mean over channels, added up one by one, which is faster than a mean across strides."""
    mono = channels[0].copy()
    for channel in channels[1:]:
        mono += channel
    return mono / np.float32(channels.shape[0])


def decode_media(
    df: DataFrame,
    content: str = "audio_bytes",
    filename: str = "filename",
    target_rate: int = 16000,
    decoders: dict[str, Decoder] | None = None,
    max_output_bytes: int = 64 * 1024 * 1024,
) -> DataFrame:
    """Replace ``content`` by ``waveform_bytes, sample_rate, duration_seconds, error``.

    Only the bytes and the suffix go to Python; ids stay in the JVM. A file
    that cannot be decoded becomes an error row. Codecs other than PCM WAV are
    given by suffix in ``decoders``.
    """
    known: dict[str, Decoder] = {"wav": decode_pcm_wav, **(decoders or {})}

    def one(data: bytes | None, suffix: str) -> tuple:
        try:
            if data is None:
                raise ValueError("audio_bytes is None - missing audio data")
            decoder = known.get(suffix.lower())
            if decoder is None:
                raise ValueError(f"no decoder for '{suffix}'")
            channels, rate = decoder(bytes(data))
            mono = resample(to_mono(channels), rate, target_rate)
            return mono.astype("<f4").tobytes(), target_rate, mono.size / target_rate, ""
        except Exception as e:
            return b"", None, None, f"Preprocessing failed: {e}"

    def frame(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=DECODED.names).astype({"sample_rate": "Int32", "duration_seconds": "Float64"})

    @F.pandas_udf(DECODED)
    def decode(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for data, suffix in batches:
            # compressed input grows when decoded, so the output is cut by its own size
            rows, held = [], 0
            for d, s in zip(data, suffix):
                rows.append(one(d, s))
                held += len(rows[-1][0])
                if held >= max_output_bytes:
                    yield frame(rows)
                    rows, held = [], 0
            if rows:
                yield frame(rows)

    suffix = F.coalesce(decoder_suffix(F.col(filename)), F.lit("mp3"))
    decoded = df.withColumn("_decoded", decode(F.col(content), suffix)).drop(content)
    return decoded.select(*[c for c in decoded.columns if c != "_decoded"], "_decoded.*")
