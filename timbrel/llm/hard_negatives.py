"""Hard negatives by rotated one-bit codes: popcount estimates, sure intervals, integer scores for what is left."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from timbrel.llm.rows import field, keyed, with_groups, written

#: One-bit codes of a vector, one after the other: each encodes what those before it have left.
LEVELS = 6
#: Levels that are looked at for all pairs of a chunk; the others only for pairs that are left.
DENSE = 3
#: Bits of a rotated component of an anchor.
PLANES = 8
#: Components become floor(SCALE * x).
SCALE = 256.0
#: Rows whose integer vector is longer than this take no part: their scores may not fit into 64 bits.
LONGEST = 2.0**31
#: Bytes of 64-bit components in a block of rows, anchors in a block, and pairs looked at together.
ROW_BYTES = 1 << 22
ANCHORS = 1 << 14
CELLS = 1 << 20


def width_of(dim: int) -> int:
    """Bits of a code: the next power of two, 64 at least."""
    return max(64, 1 << max(dim - 1, 0).bit_length())


@lru_cache(maxsize=64)
def _signs(width: int, level: int) -> np.ndarray:
    return np.random.default_rng([width, level]).choice([-1.0, 1.0], (2, width))


def rotate(x: np.ndarray, level: int) -> np.ndarray:
    """Each row turned by the rotation of a level: random signs and a Hadamard transform, twice."""
    n, width = x.shape
    for signs in _signs(width, level):
        x = x * signs
        half = 1
        while half < width:
            pairs = x.reshape(n, width // (2 * half), 2, half)
            x = np.stack((pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]), axis=2).reshape(n, width)
            half *= 2
        x = x / np.sqrt(width)
    return x


def _packed(bits: np.ndarray) -> np.ndarray:
    return np.packbits(bits, axis=1).view(np.uint64)


class Codes(NamedTuple):
    """For n vectors: bits (levels, n, words), alignments and what each level leaves (levels, n)."""

    bits: np.ndarray
    aligned: np.ndarray
    left: np.ndarray


def encode(vectors: np.ndarray) -> Codes:
    """Codes of integer vectors (n, dim).

    A level turns what is left, u, and keeps its signs c. ``aligned`` is the mean of
    abs(u), so that aligned * c is the point next to u on the line of its code,
    and ``left`` the length of u - aligned * c, which the next level encodes.
    """
    u = np.zeros((len(vectors), width_of(vectors.shape[1])))
    u[:, : vectors.shape[1]] = vectors
    bits, aligned, left = [], [], []
    for level in range(LEVELS):
        u = rotate(u, level)
        positive = u > 0
        mean = np.abs(u).mean(axis=1)
        u = u - mean[:, None] * np.where(positive, 1.0, -1.0)
        bits.append(_packed(positive))
        aligned.append(mean)
        left.append(np.sqrt((u * u).sum(axis=1)))
    return Codes(np.array(bits), np.array(aligned), np.array(left))


class Probes:
    """Anchors turned like the codes, their components in bit planes."""

    def __init__(self, vectors: np.ndarray):
        q = np.zeros((len(vectors), width_of(vectors.shape[1])))
        q[:, : vectors.shape[1]] = vectors
        self.width = q.shape[1]
        self.norm = np.sqrt((q * q).sum(axis=1))
        self.planes, self.low, self.step, self.total, self.error = [], [], [], [], []
        for level in range(LEVELS):
            q = rotate(q, level)
            low = q.min(axis=1)
            step = np.maximum((q.max(axis=1) - low) / (2**PLANES - 1), 1e-300)
            k = np.clip(np.rint((q - low[:, None]) / step[:, None]), 0, 2**PLANES - 1).astype(np.uint8)
            rounded = low[:, None] + step[:, None] * k
            self.planes.append(np.array([_packed(k >> b & 1) for b in range(PLANES)]))
            self.low.append(low)
            self.step.append(step)
            self.total.append(k.sum(axis=1, dtype=np.int64))
            self.error.append(np.sqrt(((q - rounded) ** 2).sum(axis=1) * self.width))

    def add_level(self, level: int, codes: Codes, a, r, estimate, slack):
        """Estimates and slacks with one more level for anchors ``a`` and rows ``r`` (arrays that broadcast).

        The inner product with a code is a sum of popcounts; rounding an anchor
        to bit planes moves it by ``error`` at most (Cauchy-Schwarz).
        """
        hits = np.int32(0)
        for b in range(PLANES):
            both = self.planes[level][b][a] & codes.bits[level][r]
            count = np.bitwise_count(both).sum(axis=-1, dtype=np.int32) if both.shape[-1] > 1 else np.bitwise_count(both[..., 0])
            hits = hits + (count.astype(np.int32) << b)
        ones = np.bitwise_count(codes.bits[level][r]).sum(axis=-1, dtype=np.int32)
        product = self.low[level][a] * (2 * ones - self.width) + self.step[level][a] * (2 * hits - self.total[level][a])
        aligned = codes.aligned[level][r]
        return estimate + aligned * product, slack + aligned * self.error[level][a]

    def margin(self, level: int, codes: Codes, a, r, slack):
        """Half the interval: rounding, plus anchor times what the levels leave (Cauchy-Schwarz), plus float error."""
        return slack + self.norm[a] * (codes.left[level][r] * (1 + 1e-9) + 1e-6) + 1e-6


def survivors(probes: Probes, codes: Codes, low: np.ndarray, high: np.ndarray, allowed, best: int | None = None) -> Iterator[tuple]:
    """(anchors, rows) of all pairs whose score may lie between ``low`` and ``high`` of its anchor.

    ``allowed(a, r)`` marks pairs that may be paired at all. With ``best``,
    pairs that surely are not among so many best of their anchor are left out, too.
    """
    n, n_rows = len(probes.norm), codes.bits.shape[1]
    chunk = max(1, CELLS // max(n_rows, 1))
    every = np.arange(n_rows)[None, :]
    for begin in range(0, n, chunk):
        a = np.arange(begin, min(n, begin + chunk))
        grid = a[:, None]
        estimate, slack = np.zeros((len(a), n_rows)), np.zeros((len(a), n_rows))
        for level in range(DENSE):
            estimate, slack = probes.add_level(level, codes, grid, every, estimate, slack)
        margin = probes.margin(DENSE - 1, codes, grid, every, slack)
        may = allowed(grid, every)
        least = low[a]
        if best is not None and n_rows >= best:
            sure = np.where(may, estimate - margin, -np.inf)
            least = np.maximum(least, np.partition(sure, n_rows - best, axis=1)[:, n_rows - best])
        at, r = np.nonzero(may & (estimate + margin >= least[:, None]) & (estimate - margin <= high[a][:, None]))
        estimate, slack = estimate[at, r], slack[at, r]
        least, most, at = least[at], high[a][at], a[at]
        for level in range(DENSE, LEVELS):
            estimate, slack = probes.add_level(level, codes, at, r, estimate, slack)
            margin = probes.margin(level, codes, at, r, slack)
            keep = (estimate + margin >= least) & (estimate - margin <= most)
            at, r, estimate, slack, least, most = at[keep], r[keep], estimate[keep], slack[keep], least[keep], most[keep]
        yield at, r


def scores(anchors: np.ndarray, rows: np.ndarray, a: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Integer inner products of pairs."""
    out = np.empty(len(a), dtype=np.int64)
    step = max(1, CELLS // max(anchors.shape[1], 1))
    for k in range(0, len(a), step):
        part = slice(k, k + step)
        out[part] = np.einsum("ij,ij->i", anchors[a[part]], rows[r[part]])
    return out


class _Block:
    """The rows of one block as arrays."""

    def __init__(self, table: pa.Table):
        self.rows = table.column("row").to_pylist()
        self.ids = table.column("vec_id").to_pylist()
        self.labels = np.array(table.column("label").to_pylist(), dtype=np.int64)
        n, dim = len(self.rows), table.column("dim")[0].as_py() if len(table) else 0
        self.vectors = np.zeros((n, dim), dtype=np.int64)
        for k, raw in enumerate(table.column("ints").to_pylist()):
            self.vectors[k] = np.frombuffer(raw, dtype=np.int16 if len(raw) == 2 * dim else np.int64)
        # order among equal scores: smaller vec_id, null last, then the row
        key = [(i is None, i or 0, row) for i, row in zip(self.ids, self.rows, strict=True)]
        self.order = np.empty(n, dtype=np.int64)
        self.order[sorted(range(n), key=key.__getitem__)] = np.arange(n)
        names = dict(zip(dict.fromkeys(self.rows), range(n)))
        self.names = names

    def codes(self, table: pa.Table) -> Codes:
        n, words = len(self.rows), width_of(self.vectors.shape[1]) // 64
        raw = np.frombuffer(b"".join(table.column("code").to_pylist()), dtype=np.uint64).reshape(n, LEVELS, words + 2)
        bits = np.ascontiguousarray(raw[:, :, :words].transpose(1, 0, 2))
        numbers = np.ascontiguousarray(raw[:, :, words:].transpose(1, 2, 0)).view(np.float64)
        return Codes(bits, numbers[:, 0], numbers[:, 1])


def _first(group: np.ndarray, score: np.ndarray, order: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` of each group: higher scores first, then ``order``."""
    by = np.lexsort((order, -score, group))
    sorted_group = group[by]
    starts = np.flatnonzero(np.r_[True, sorted_group[1:] != sorted_group[:-1]]) if len(by) else np.zeros(0, dtype=np.int64)
    rank = np.arange(len(by)) - np.repeat(starts, np.diff(np.r_[starts, len(by)]))
    return by[rank < k]


_INDEX = "row binary, vec_id bigint, label bigint, dim int, ints binary, code binary"


def index(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", label: Column | None = None) -> DataFrame:
    """row, vec_id, label, dim, ints, code of the rows that take part; no shuffle.

    ``ints`` are 16-bit components where all fit, else 64-bit ones.
    """
    rows = vectors if "doc" in vectors.columns and "row" in vectors.columns else keyed(vectors)
    own = field(vector, rows, "array<double>")
    shown = rows.select(
        "row", field(id_column, rows, "bigint").alias("vec_id"),
        (field("label", rows, "bigint") if label is None else label).alias("label"), own.alias("v"),
    )
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    shown = shown.filter(F.col("label").isNotNull() & F.col("v").isNotNull() & finite)

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            v, dims = frame.column(3), np.asarray(frame.column(3).value_lengths())
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                step = max(1, CELLS // width_of(dim))
                for part in np.split(at, range(step, len(at), step)):
                    x = np.asarray(v.take(pa.array(part)).flatten(), dtype=np.float64).reshape(len(part), dim)
                    x = np.floor(SCALE * x)
                    with np.errstate(over="ignore"):
                        short = np.sqrt((x * x).sum(axis=1)) <= LONGEST
                    x, part = x[short], part[short]
                    if not len(part):
                        continue
                    codes = encode(x)
                    numbers = np.stack((codes.aligned, codes.left), axis=2).view(np.uint64)
                    code = np.concatenate((codes.bits, numbers), axis=2).transpose(1, 0, 2)
                    small = (np.abs(x) < 2**15).all(axis=1)
                    ints = [row.astype(np.int16 if s else np.int64).tobytes() for row, s in zip(x, small)]
                    taken = frame.take(pa.array(part))
                    yield pa.RecordBatch.from_arrays(
                        [taken.column(0), taken.column(1), taken.column(2), pa.array([dim] * len(part), pa.int32()),
                         pa.array(ints, pa.binary()), pa.array([c.tobytes() for c in code], pa.binary())],
                        names=["row", "vec_id", "label", "dim", "ints", "code"])

    return shown.mapInArrow(run, _INDEX)


def _blocks(size: Column, bytes_each: Column) -> Column:
    return F.greatest(F.ceil(size * bytes_each / ROW_BYTES), F.lit(1)).cast("int")


def _dealt(df: DataFrame, own: str, blocks: Column, other: str, others: Column) -> DataFrame:
    """Each row in its block, and once for each block of the other side."""
    mine = F.pmod(F.xxhash64("row"), blocks).cast("int")
    return df.withColumn(own, mine).withColumn(other, F.explode(F.sequence(F.lit(0), others - 1)))


_TOP = "anchor_row binary, anchor_id bigint, other_row binary, other_id bigint, score bigint"


def positives(indexed: DataFrame, anchors: DataFrame, n: int) -> DataFrame:
    """anchor_row, anchor_id, other_row, other_id, score: the first ``n`` other rows of each anchor's label.

    ``indexed`` and ``anchors`` have ``size``, the rows of their dimension and label.
    Rows of a label meet its anchors block by block, so that a hot label is many tasks.
    """
    anchor_blocks = F.lit(_anchor_blocks(anchors))
    row_blocks = _blocks(F.col("size"), 8 * F.greatest("dim", F.lit(64)))
    rows = _dealt(indexed, "i", row_blocks, "j", anchor_blocks)
    probes = _dealt(anchors, "j", anchor_blocks, "i", row_blocks)

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if len(left) and len(right):
            block, asked = _Block(left), _Block(right)
            itself = np.array([block.names.get(row, -1) for row in asked.rows])
            none = np.full(len(asked.rows), np.inf)
            pairs = survivors(Probes(asked.vectors), block.codes(left), -none, none, lambda a, r: itself[a] != r, n)
            for a, r in pairs:
                score = scores(asked.vectors, block.vectors, a, r)
                for k in _first(a, score, block.order[r], n).tolist():
                    i, j = int(a[k]), int(r[k])
                    out.append((asked.rows[i], asked.ids[i], block.rows[j], block.ids[j], int(score[k])))
        return _table(out, _TOP_ARROW)

    keys = ["dim", "label", "i", "j"]
    found = rows.groupBy(*keys).cogroup(probes.groupBy(*keys)).applyInArrow(meet, _TOP)
    order = [F.col("score").desc(), F.col("other_id").asc_nulls_last(), F.col("other_row")]
    ranked = found.withColumn("place", F.row_number().over(W.partitionBy("anchor_row").orderBy(*order)))
    return ranked.filter(F.col("place") <= n)


_TOP_ARROW = pa.schema(
    [("anchor_row", pa.binary()), ("anchor_id", pa.int64()), ("other_row", pa.binary()), ("other_id", pa.int64()), ("score", pa.int64())]
)
_FOUND = "anchor_row binary, anchor_id bigint, place int, positive_id bigint, positive_score bigint, negative_row binary, negative_id bigint, negative_score bigint"
_FOUND_ARROW = pa.schema(
    [("anchor_row", pa.binary()), ("anchor_id", pa.int64()), ("place", pa.int32()), ("positive_id", pa.int64()),
     ("positive_score", pa.int64()), ("negative_row", pa.binary()), ("negative_id", pa.int64()), ("negative_score", pa.int64())]
)


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)


def _anchor_blocks(anchors: DataFrame) -> int:
    return max(1, -(-anchors.count() // ANCHORS))


def negatives(indexed: DataFrame, anchors: DataFrame, n: int, percent: int) -> DataFrame:
    """The first ``n`` rows of another label for each anchor and positive, with scores from ``percent`` of the positive's up to it.

    ``anchors`` have ``wanted``, a list of struct(place, id, score) of their positives.
    """
    total = indexed.agg(F.sum(8 * F.greatest("dim", F.lit(64)))).first()[0] or 0
    row_blocks, anchor_blocks = F.lit(max(1, -(-total // ROW_BYTES))), F.lit(_anchor_blocks(anchors))
    rows = _dealt(indexed, "i", row_blocks, "j", anchor_blocks)
    probes = _dealt(anchors, "j", anchor_blocks, "i", row_blocks)

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if len(left) and len(right):
            block, asked = _Block(left), _Block(right)
            wanted = right.column("wanted").to_pylist()
            most = max(map(len, wanted))
            top, least = np.full((len(wanted), most), -(2**62)), np.full((len(wanted), most), 2**62)
            for k, own in enumerate(wanted):
                top[k, : len(own)] = [p["score"] for p in own]
                least[k, : len(own)] = [-((-percent * p["score"]) // 100) for p in own]
            pairs = survivors(
                Probes(asked.vectors), block.codes(left), least.min(axis=1).astype(float), top.max(axis=1).astype(float),
                lambda a, r: asked.labels[a] != block.labels[r])
            for a, r in pairs:
                score = scores(asked.vectors, block.vectors, a, r)
                at, p = np.nonzero((least[a] <= score[:, None]) & (score[:, None] <= top[a]))
                for k in _first(a[at] * most + p, score[at], block.order[r[at]], n).tolist():
                    i, j, own = int(a[at[k]]), int(r[at[k]]), wanted[int(a[at[k]])][int(p[k])]
                    out.append((asked.rows[i], asked.ids[i], own["place"], own["id"], own["score"],
                                block.rows[j], block.ids[j], int(score[at[k]])))
        return _table(out, _FOUND_ARROW)

    keys = ["dim", "i", "j"]
    found = rows.groupBy(*keys).cogroup(probes.groupBy(*keys)).applyInArrow(meet, _FOUND)
    order = [F.col("negative_score").desc(), F.col("negative_id").asc_nulls_last(), F.col("negative_row")]
    ranked = found.withColumn("rank", F.row_number().over(W.partitionBy("anchor_row", "place").orderBy(*order)))
    return ranked.filter(F.col("rank") <= n)


def hard_negatives(
    vectors: DataFrame, n_positives: int = 5, n_negatives: int = 5, percent: int = 80, every: int = 100, label: Column | None = None
) -> DataFrame:
    """anchor_row, anchor_id, positive_id, rank, negative_row, negative_id, positive_score, negative_score.

    Anchors are the rows whose vec_id is divisible by ``every``, positives the
    first ``n_positives`` other rows of an anchor's label, negatives the first
    ``n_negatives`` of another label that score from ``percent`` of the positive
    up to it. Components become ``floor(256 * x)``, scores are integer inner
    products; higher scores come first, then smaller vec_id (null last), then any
    order that stays the same.

    Every vector has ``LEVELS`` one-bit codes after random rotations, each with
    its alignment and what it leaves. Anchors meet all rows in blocks; popcounts
    give an estimate, and Cauchy-Schwarz an interval that holds the score
    without exception; pairs whose interval can matter are scored in integers.

    Rows with a null label or vector, or a null or infinite component or NaN, take
    no part, nor do rows whose integer vector is longer than 2**31, whose scores
    might not fit. Vectors of different length do not meet; empty ones score 0
    with each other. A null vec_id is never an anchor and comes last among
    equals. Repeated rows count one by one, also as anchors and as each other's
    positives. A very long vector is encoded by itself and bounds its block. An
    empty table gives an empty result; other columns are ignored. ``label`` is
    an expression over the columns ``doc.label`` and ``doc.vec_id``, for other labels.
    """
    indexed = with_groups(index(vectors, label=label), ["dim", "label"], F.col("row")).drop("best")
    indexed = written(indexed, "negative-index")
    anchors = indexed.filter(F.col("vec_id") % every == 0)
    top = written(positives(indexed, anchors, n_positives), "negative-positives")
    lists = top.groupBy("anchor_row").agg(
        F.sort_array(F.collect_list(F.struct("place", F.col("other_id").alias("id"), "score"))).alias("wanted"))
    asked = anchors.join(lists.withColumnRenamed("anchor_row", "row"), "row")
    found = negatives(indexed, written(asked, "negative-anchors"), n_negatives, percent)
    return found.select(
        "anchor_row", "anchor_id", "positive_id", "rank", "negative_row", "negative_id", "positive_score", "negative_score")
