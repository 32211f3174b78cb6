"""Long byte strings that occur more than once: a sieve of anchors, then merged transforms of what is left."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timbrel.llm.interleave import repeated_places
from timbrel.llm.rows import field, keyed, sieve, sifted, text_of, with_groups, written

#: Bytes of a string that must not repeat, and of the part by which such strings meet.
LENGTH, ANCHOR = 200, 64
#: Bits of the map of anchors that occur twice or more: its size does not depend on the input.
BITS = 1 << 26
#: Different surroundings of one anchor that a task compares; those of other anchors are dealt out window by window.
TOGETHER = 4096
#: Bytes whose transforms a task merges at once, up to the end of the anchor's surroundings that reach them.
MERGED = 1 << 20

_VALUES = np.random.default_rng(2024).integers(1, 1 << 63, size=(2, 256), dtype=np.uint64) | np.uint64(1)
_FACTORS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


class Roller:
    """Hashes of all windows of a fixed length; powers are kept from text to text."""

    def __init__(self, which: int):
        self.values, self.factor = _VALUES[which], _FACTORS[which]
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def hashes(self, raw: np.ndarray, length: int) -> np.ndarray:
        n = len(raw)
        if len(self.up) < n + 1:
            size = max(n + 1, 2 * len(self.up))
            inverse = pow(self.factor, -1, 1 << 64)
            self.up = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, self.factor, dtype=np.uint64)], dtype=np.uint64)
            self.down = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, inverse, dtype=np.uint64)], dtype=np.uint64)
        sums = np.r_[np.uint64(0), np.cumsum(self.values[raw] * self.up[:n], dtype=np.uint64)]
        return _mixed((sums[length:] - sums[: n - length + 1]) * self.down[: n - length + 1])


def window_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """The least value of each run of ``width`` values, by block-wise minima from both sides."""
    n = len(x)
    pad = -n % width
    blocks = np.r_[x, np.full(pad, np.iinfo(x.dtype).max, dtype=x.dtype)].reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def anchors(raw: np.ndarray, roller: Roller) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Key and place of each anchor, and the first and last begin of the windows it stands for.

    The anchor of a window is the part of it with the least hash, the first one
    of equal ones; equal windows have equal anchors in the same place.
    """
    none = np.empty(0, dtype=np.int64)
    if len(raw) < LENGTH:
        return none.astype(np.uint64), none, none, none
    h = roller.hashes(raw, ANCHOR)
    ranked = (h & ~np.uint64((1 << 31) - 1)) | np.arange(len(h), dtype=np.uint64)
    least = (window_minimum(ranked, LENGTH - ANCHOR + 1) & np.uint64((1 << 31) - 1)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
    last = np.r_[first[1:] - 1, len(least) - 1]
    place = least[first]
    return h[place], place, first, last


def _texts(frame: pa.RecordBatch, column: int) -> Iterator[tuple[int, np.ndarray]]:
    values = frame.column(column)
    for k in range(frame.num_rows):
        yield k, np.frombuffer(values[k].as_buffer() or b"", dtype=np.uint8) if values[k].is_valid else np.empty(0, np.uint8)


def repeated_map(rows: DataFrame) -> np.ndarray:
    """Bits of the keys of anchors that occur twice or more, at most ``BITS`` of them."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller = Roller(0)
        for frame in frames:
            keys = [anchors(raw, roller)[0] for _, raw in _texts(frame, 0)]
            if keys:
                each, n = np.unique(np.concatenate(keys), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(each.view(np.int64)), pa.array(n, pa.int64())], names=["key", "n"])

    found = rows.select(text_of(rows).alias("text")).mapInArrow(run, "key bigint, n bigint")
    many = found.groupBy("key").agg(F.sum("n").alias("n")).filter("n > 1")
    bit = many.select(F.pmod("key", F.lit(BITS)).alias("bit"))
    words = bit.groupBy(F.floor(F.col("bit") / 64).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(bit % 64 as int)))").alias("mask"))
    out = np.zeros(BITS // 64, dtype=np.int64)
    table = words.toArrow()  # at most BITS / 64 rows
    out[table.column("word").to_numpy()] = table.column("mask").to_numpy()
    return out.view(np.uint64)


def occurrences(rows: DataFrame, bits: np.ndarray) -> DataFrame:
    """row, lo, hi, same, key, off, raw: windows lo to hi stand around an anchor that may repeat.

    ``same`` is a digest of the bytes from lo to hi + LENGTH and the anchor's
    place in them; ``raw``, those bytes, comes once per batch.
    """
    shared = rows.sparkSession.sparkContext.broadcast(bits)

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller, words = Roller(0), shared.value
        for frame in frames:
            at, lows, highs, keys, offs, digests, raws, seen = [], [], [], [], [], [], [], set()
            for k, raw in _texts(frame, 1):
                key, place, first, last = anchors(raw, roller)
                bit = key % np.uint64(BITS)
                hit = (words[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
                some = np.flatnonzero(hit)
                if not len(some):
                    continue
                whole = raw.tobytes()
                for key_, p, lo, hi in zip(key[some].view(np.int64).tolist(), place[some].tolist(), first[some].tolist(), last[some].tolist(), strict=True):
                    part = whole[lo : hi + LENGTH]
                    digest = hashlib.blake2b(part, digest_size=16, salt=(p - lo).to_bytes(8, "little")).digest()
                    at.append(k)
                    lows.append(lo)
                    highs.append(hi)
                    keys.append(key_)
                    offs.append(p - lo)
                    digests.append(digest)
                    raws.append(None if digest in seen else part)
                    seen.add(digest)
            yield pa.RecordBatch.from_arrays(
                [frame.column(0).take(pa.array(at, pa.int64())), pa.array(lows, pa.int64()), pa.array(highs, pa.int64()),
                 pa.array(keys, pa.int64()), pa.array(offs, pa.int32()), pa.array(digests, pa.binary()), pa.array(raws, pa.binary())],
                names=["row", "lo", "hi", "key", "off", "same", "raw"])

    form = "row binary, lo bigint, hi bigint, key bigint, off int, same binary, raw binary"
    return written(rows.select("row", text_of(rows).alias("text")).mapInArrow(run, form), "bytes-anchors")


def _windows(raw: bytes, rollers: list[Roller]) -> np.ndarray:
    """A pair of hashes of each window of the surroundings of an anchor."""
    x = np.frombuffer(raw, dtype=np.uint8)
    return np.stack([r.hashes(x, LENGTH) for r in rollers], axis=1)


def repeated_windows(group: list[tuple[int, bytes]], rollers: list[Roller]) -> list[np.ndarray]:
    """For each of the surroundings of one anchor, which of its windows others have, too."""
    each = [_windows(raw, rollers) for _, raw in group]
    place = [np.arange(len(w), dtype=np.uint64) - np.uint64(off) for (off, _), w in zip(group, each, strict=True)]
    flat = np.concatenate([np.c_[w, p] for w, p in zip(each, place, strict=True)])
    order = np.lexsort(flat.T)
    equal = (flat[order[1:]] == flat[order[:-1]]).all(axis=1)
    twice = np.zeros(len(flat), dtype=bool)
    twice[order[1:][equal]] = True
    twice[order[:-1][equal]] = True
    return np.split(twice, np.cumsum([len(w) for w in each])[:-1])


def merged_windows(group: list[tuple[int, bytes]]) -> list[np.ndarray]:
    """The same from the merged transforms of the group's texts."""
    raws = [np.frombuffer(raw, dtype=np.uint8) for _, raw in group]
    return [m[: len(m) - LENGTH + 1] for m in repeated_places(raws, LENGTH)]


def _runs(marks: np.ndarray) -> list[dict[str, int]]:
    edge = np.flatnonzero(np.diff(np.r_[False, marks, False].astype(np.int8)))
    return [{"a": a, "b": b} for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)]


_RUNS = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))


def compared(found: DataFrame, transforms: bool = True) -> DataFrame:
    """same, runs: begins of the windows, from the first one, that occur elsewhere, as half-open runs.

    Surroundings that occur twice repeat as a whole. The different ones of one
    anchor are compared in a task: by the hashes of their windows or, with
    ``transforms``, by merging the transforms of shards of them. Anchors share a
    merge of about ``MERGED`` bytes: equal windows have equal anchors, so what
    other anchors bring along adds no match.
    """
    surroundings = found.groupBy("key", "same").agg(
        F.count("*").alias("n"), F.first("off").alias("off"), F.max("raw").alias("raw"))
    surroundings = written(surroundings, "bytes-around")
    whole = surroundings.filter("n > 1").select("same", F.array(F.struct(
        F.lit(0).alias("a"), (F.octet_length("raw") - LENGTH + 1).cast("int").alias("b"))).alias("runs"))
    kinds = surroundings.groupBy("key").agg(F.count("*").alias("kinds"), F.sum(F.when(F.col("n") == 1, 1).otherwise(0)).alias("single"))
    many = kinds.filter("kinds > 1 and single > 0")
    crowded = written(many.filter(F.col("kinds") > TOGETHER).select("key"), "bytes-crowded")
    mixed = sifted(surroundings, "key", sieve(many, "key")).filter("maybe").drop("maybe")
    marked = sifted(mixed, "key", sieve(crowded, "key"))
    few = marked.filter("not maybe").select("key", "same", "n", "off", "raw")

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rollers = [Roller(0), Roller(1)]
        at, ids, group, held, begin = None, [], [], 0, 0

        def close() -> list[tuple]:
            own = [g[1:] for g in group]
            marks = merged_windows(own) if transforms else repeated_windows(own, rollers)
            return [(i, _runs(m)) for i, g, m in zip(ids, group, marks, strict=True) if g[0] == 1 and m.any()]

        for frame in frames:
            out = []
            for key, same, n, off, raw in zip(*[c.to_pylist() for c in frame.columns], strict=True):
                if key != at:
                    if len(group) - begin == 1:  # the sieve let an anchor through whose surroundings are all equal
                        ids.pop()
                        held -= len(group.pop()[2])
                    if group and (held >= MERGED or not transforms):
                        out += close()
                        ids, group, held = [], [], 0
                    at, begin = key, len(group)
                ids.append(same)
                group.append((n, off, raw))
                held += len(raw)
            if out:
                yield _frame(out)
        out = close() if group else []
        if out:
            yield _frame(out)

    def _frame(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out], _RUNS)], names=["same", "runs"]
        )

    dealt = few.repartition("key").sortWithinPartitions("key", "same")
    runs = "same binary, runs array<struct<a:int,b:int>>"
    inside = dealt.mapInArrow(run, runs)

    def spread(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rollers = [Roller(0), Roller(1)]
        for frame in frames:
            for k in range(frame.num_rows):
                pair = _windows(frame.column(3)[k].as_py(), rollers).view(np.int64)
                n = len(pair)
                at = pa.array(np.full(n, k), pa.int64())
                place = np.arange(n, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [frame.column(0).take(at), frame.column(1).take(at), pa.array(place), pa.array(place - frame.column(2)[k].as_py(), pa.int32()),
                     pa.array(pair[:, 0]), pa.array(pair[:, 1])], names=["key", "same", "at", "off", "h", "g"])

    rest = marked.filter("maybe").select("key", "same", "off", "raw")
    each = rest.mapInArrow(spread, "key bigint, same binary, at int, off int, h bigint, g bigint")
    twice = with_groups(each, ["h", "g", "key", "off"], F.col("same"), by="same").filter("size > 1")
    spread_runs = twice.groupBy("same").agg(F.collect_list(F.struct(F.col("at").alias("a"), (F.col("at") + 1).alias("b"))).alias("runs"))
    return whole.union(inside).union(spread_runs)


def repeated_bytes(docs: DataFrame, transforms: bool = True) -> DataFrame:
    """One row per row of ``docs``: row, doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Every byte covered by a string of 200 bytes that begins anywhere else too,
    in the same text or another, is removed; strings never cross texts. A null
    text counts as empty; texts under 200 bytes stay; an empty table gives an
    empty result; rows that repeat a doc_id are texts of their own, so both
    copies of a long text go. Without ``transforms`` what the sieve leaves is
    compared by pairs of hashes, with the same result.
    """
    return cleaned(docs, transforms).drop("kept")


def cleaned(docs: DataFrame, transforms: bool = True) -> DataFrame:
    """The same with ``kept``, the remaining bytes."""
    rows = docs if "doc" in docs.columns and "row" in docs.columns else keyed(docs)
    found = occurrences(rows, repeated_map(rows))
    runs = compared(found, transforms)
    spans = found.select("row", "lo", "same").join(runs, "same").select("row", "lo", F.explode("runs").alias("r"))
    per_row = written(spans.groupBy("row").agg(
        F.collect_list((F.col("lo") + F.col("r.a"))).alias("a"), F.collect_list(F.col("lo") + F.col("r.b") - 1 + LENGTH).alias("b")
    ), "bytes-spans")
    plain = rows.select("row", field("doc_id", rows, "bigint").alias("doc_id"), text_of(rows).alias("text"))
    marked = sifted(plain, "row", sieve(per_row, "row"))
    none = F.array().cast("array<bigint>")
    clear = marked.filter("not maybe").select("row", "doc_id", "text", none.alias("a"), none.alias("b"))
    doubt = marked.filter("maybe").join(per_row, "row", "left").select(
        "row", "doc_id", "text", F.coalesce("a", none).alias("a"), F.coalesce("b", none).alias("b"))

    def cut(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            sizes, removed, spans, digests, kept = [], [], [], [], []
            for (_, raw), a, b in zip(_texts(frame, 2), frame.column(3).to_pylist(), frame.column(4).to_pylist(), strict=True):
                gone = np.zeros(len(raw) + 1, dtype=np.int32)
                if a:
                    np.add.at(gone, np.array(a), 1)
                    np.add.at(gone, np.array(b), -1)
                cover = np.cumsum(gone[:-1]) > 0
                left = raw[~cover].tobytes()
                sizes.append(len(raw))
                removed.append(int(cover.sum()))
                spans.append(int((np.diff(np.r_[False, cover].astype(np.int8)) == 1).sum()))
                digests.append(hashlib.sha256(left).hexdigest())
                kept.append(left)
            yield pa.RecordBatch.from_arrays(
                [frame.column(0), frame.column(1), *[pa.array(x, pa.int64()) for x in (sizes, removed, spans)],
                 pa.array(digests, pa.string()), pa.array(kept, pa.binary())],
                names=["row", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    form = "row binary, doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"
    return clear.union(doubt).mapInArrow(cut, form)
