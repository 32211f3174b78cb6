"""Waveform columns: little-endian float32 bytes and their list form."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SAMPLE_BYTES = 4


def duration_seconds(waveform_bytes: Column, sample_rate: Column) -> Column:
    """Samples over rate; null when the rate is missing or zero."""
    return F.try_divide(F.octet_length(waveform_bytes) / F.lit(SAMPLE_BYTES), sample_rate)


def downmix(channels: Column) -> Column:
    """Mean over channels of an ``array<array<float>>``; one channel passes through."""
    count = F.size(channels)
    first = F.get(channels, F.lit(0))
    mean = F.transform(
        first,
        lambda _, i: F.aggregate(
            channels, F.lit(0.0), lambda total, channel: total + F.get(channel, i).cast("double")
        )
        / count,
    )
    return F.when(count > 1, mean).otherwise(first.cast("array<double>"))


@F.arrow_udf(T.BinaryType())
def pack_waveform(samples: pa.Array) -> pa.Array:
    """``array<float>`` to bytes; the whole Arrow batch is re-labelled, not looped over."""
    flat = np.ascontiguousarray(samples.values.to_numpy(zero_copy_only=False), dtype="<f4")
    offsets = samples.offsets.to_numpy().astype("int32") * np.int32(SAMPLE_BYTES)
    packed = pa.Array.from_buffers(
        pa.binary(), len(samples), [None, pa.py_buffer(offsets), pa.py_buffer(flat)]
    )
    return pc.if_else(samples.is_valid(), packed, pa.scalar(None, pa.binary()))


@F.arrow_udf(T.ArrayType(T.FloatType()))
def unpack_waveform(packed: pa.Array) -> pa.Array:
    """Bytes to ``array<float>``; null for null or for a length that is not whole samples."""
    sound = pc.and_(
        packed.is_valid(),
        pc.equal(pc.bit_wise_and(pc.fill_null(pc.binary_length(packed), 0), SAMPLE_BYTES - 1), 0),
    )
    # if_else writes a fresh array, so its buffers start at offset 0 and hold whole samples only
    packed = pc.if_else(sound, packed, pa.scalar(b"", packed.type)).cast(pa.binary())
    _, offsets, data = packed.buffers()
    bounds = np.frombuffer(offsets, dtype="int32", count=packed.offset + len(packed) + 1)[packed.offset :]
    data = data if data is not None else pa.py_buffer(b"")
    flat = np.frombuffer(data, dtype="u1")[bounds[0] : bounds[-1]].view("<f4")
    lists = pa.ListArray.from_arrays(pa.array((bounds - bounds[0]) // SAMPLE_BYTES, pa.int32()), pa.array(flat))
    return pc.if_else(sound, lists, pa.scalar(None, lists.type))
