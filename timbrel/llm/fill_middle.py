"""Fill-in-the-middle forms of documents, assembled and taken apart again in streams of sorted pieces."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from timbrel.llm.rows import field, keyed, text_of

# What marks the parts of an output.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARKS = (PREFIX, SUFFIX, MIDDLE)
#: The order of the marks in an output, by form.
ORDER = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
#: The order of the parts in the text itself.
PLACE = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}

#: A piece is closed by the first end of a unit after so many bytes; a longer unit is cut.
PIECE = 1 << 15
#: Batches sent back to Spark are closed after so many bytes.
BATCH = 1 << 22

HEAD = (
    "row binary, place bigint, data binary, doc_id bigint, n bigint, form string, "
    "prefix_chars bigint, middle_chars bigint, output_sha256 string"
)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def unit_ends(raw: bytes) -> np.ndarray:
    """Byte offsets where the units of a text end: words with the white space before them, and white space at the end."""
    if not raw:
        return np.zeros(0, dtype=np.int64)
    space = _SPACE[np.frombuffer(raw, dtype=np.uint8)]
    ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
    return np.append(ends, len(raw))


def draws(doc_id: int | None, seed: int = 42) -> list[int]:
    """Four numbers from the digest of seed and id; a missing id is written as nothing."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]


def form_of(raw: bytes, drawn: list[int], rate: int, spm_rate: int) -> str:
    if not raw or drawn[2] % 100 >= rate or any(m in raw for m in MARKS):
        return "plain"
    return "spm" if drawn[3] % 100 < spm_rate else "psm"


def _chars(raw: bytes) -> int:
    return int(np.count_nonzero(np.frombuffer(raw, dtype=np.uint8) & 0xC0 != 0x80))


def pieces_of(raw: bytes, ends: np.ndarray, begin: int, end: int, piece: int) -> Iterator[bytes]:
    """The bytes from ``begin`` to ``end`` in pieces of whole units; only a unit longer than a piece is cut."""
    while begin < end:
        stop = end
        if end - begin > piece:
            k = int(np.searchsorted(ends, begin + piece, side="right"))
            stop = int(ends[k - 1]) if k and ends[k - 1] > begin else begin + piece
        yield raw[begin:stop]
        begin = stop


class _Batches:
    """Collects rows and gives record batches of a bounded number of bytes."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.size = schema, [], 0

    def add(self, row: tuple, size: int) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.size += size + 100
        if self.size >= BATCH:
            yield from self.close()

    def close(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            columns = [pa.array(c, t) for c, t in zip(zip(*self.rows, strict=True), self.schema.types, strict=True)]
            self.rows, self.size = [], 0
            yield pa.RecordBatch.from_arrays(columns, schema=self.schema)


_HEAD_ARROW = pa.schema(
    [("row", pa.binary()), ("place", pa.int64()), ("data", pa.binary()), ("doc_id", pa.int64()), ("n", pa.int64()),
     ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output_sha256", pa.string())]
)


def output_pieces(
    docs: DataFrame, seed: int = 42, rate: int = 50, spm_rate: int = 80, piece: int = PIECE, plain: bool = True
) -> DataFrame:
    """The outputs of all rows of ``docs`` as pieces, sorted by ``row`` and ``place`` in each partition.

    row, place, data, doc_id, n, form, prefix_chars, middle_chars, output_sha256.
    A row's first record has place -1, no data and what is known of it; the data
    of the records after it, one after the other, are its output: ``<P>``prefix
    ``<S>``suffix``<M>``middle (psm), the suffix first (spm), or the text as it
    is (plain). Cuts lie at ends of units: words with the white space before
    them, and white space at the end.

    With ``plain=False`` the texts that stay as they are have no pieces: their
    digest is in the first record, and only the others are shuffled.

    A null text counts as empty and is plain; a null doc_id draws as an empty
    id; rows that repeat a doc_id draw the same and are apart by ``row``; an
    empty table gives an empty result; other columns are ignored. A very long
    text is one value where it is read, and pieces of ``piece`` bytes (or of one
    unit cut so) from there on; no later step holds more of it than a batch.
    """
    rows = docs if "doc" in docs.columns and "row" in docs.columns else keyed(docs)

    def cut(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Batches(_HEAD_ARROW)
        none = (None,) * 6
        for frame in frames:
            for row, doc_id, raw in zip(frame.column(0), frame.column(1), frame.column(2), strict=True):
                row, doc_id, raw = row.as_py(), doc_id.as_py(), raw.as_py()
                ends, drawn = unit_ends(raw), draws(doc_id, seed)
                n, form = len(ends), form_of(raw, drawn, rate, spm_rate)
                if form == "plain":
                    digest = None if plain else hashlib.sha256(raw).hexdigest()
                    yield from out.add((row, -1, None, doc_id, n, form, None, None, digest), 64)
                    parts = [(b"", 0, len(raw))] if plain else []
                else:
                    low, high = sorted(d % (n + 1) for d in drawn[:2])
                    a, b = (int(ends[k - 1]) if k else 0 for k in (low, high))
                    yield from out.add((row, -1, None, doc_id, n, form, _chars(raw[:a]), _chars(raw[a:b]), None), 64)
                    bounds = {PREFIX: (0, a), MIDDLE: (a, b), SUFFIX: (b, len(raw))}
                    parts = [(mark, *bounds[mark]) for mark in ORDER[form]]
                place = 0
                for mark, begin, end in parts:
                    own = pieces_of(raw, ends, begin, end, piece)
                    for data in [mark + next(own, b"")] if mark else []:
                        yield from out.add((row, place, data, *none), len(data))
                        place += 1
                    for data in own:
                        yield from out.add((row, place, data, *none), len(data))
                        place += 1
        yield from out.close()

    shown = rows.select("row", field("doc_id", rows, "bigint").alias("doc_id"), text_of(rows).cast("binary").alias("text"))
    cuts = shown.mapInArrow(cut, HEAD)
    return cuts.repartition("row").sortWithinPartitions("row", "place")


class Reader:
    """Finds the parts of an output that comes in chunks cut anywhere."""

    def __init__(self, form: str):
        self.marks = list(ORDER.get(form, ()))
        self.part, self.held = PREFIX, b""

    def feed(self, data: bytes, last: bool = False) -> Iterator[tuple[int, bytes]]:
        """(place of the part in the text, bytes of it), in the order of the output."""
        data = self.held + data
        self.held = b""
        while self.marks:
            at = data.find(self.marks[0])
            if at < 0:
                break
            if at:
                yield PLACE[self.part], data[:at]
            self.part = self.marks.pop(0)
            data = data[at + len(self.part) :]
        if self.marks and not last:  # the start of a mark waits for the rest of it
            keep = next((k for k in (2, 1) if data[-k:] == self.marks[0][:k]), 0)
            data, self.held = data[: len(data) - keep], data[len(data) - keep :]
        if data:
            yield PLACE[self.part], data


def restored_text(output: str, form: str) -> str:
    """The text of one output."""
    parts: list[list[bytes]] = [[], [], []]
    for place, data in Reader(form).feed(output.encode(), last=True):
        parts[place].append(data)
    return b"".join(b"".join(p) for p in parts).decode()


def _records(frames: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for frame in frames:
        yield from zip(*[c.to_pylist() for c in frame.columns], strict=True)


def restored_pieces(pieces: DataFrame) -> DataFrame:
    """The texts of all rows as pieces, rebuilt from outputs and forms.

    Reads :func:`output_pieces` in order and adds the digest of the output to
    each row's first record; the parts found in the output are sorted again
    within the partition, without another shuffle.
    """

    def read(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, none = _Batches(_HEAD_ARROW), (None,) * 6
        head, digest, reader, counts = None, None, None, [0, 0, 0]

        def found(data: bytes, last: bool) -> Iterator[pa.RecordBatch]:
            for part, own in reader.feed(data, last):
                yield from out.add((head[0], part << 48 | counts[part], own, *none), len(own))
                counts[part] += 1

        def close() -> Iterator[pa.RecordBatch]:
            if head is not None:
                yield from found(b"", True)
                yield from out.add((*head[:8], head[8] or digest.hexdigest()), 64)

        for record in _records(frames):
            if record[1] == -1:
                yield from close()
                head, digest, reader, counts = record, hashlib.sha256(), Reader(record[5]), [0, 0, 0]
            else:
                digest.update(record[2])
                yield from found(record[2], False)
        yield from close()
        yield from out.close()

    return pieces.mapInArrow(read, HEAD).sortWithinPartitions("row", "place")


_DIGESTS = (
    "row binary, doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, "
    "output_sha256 string, restored_sha256 string"
)
_DIGESTS_ARROW = pa.schema([f for f in _HEAD_ARROW if f.name not in ("place", "data")] + [pa.field("restored_sha256", pa.string())])


def digests(pieces: DataFrame) -> DataFrame:
    """One row per row: doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256.

    Digests grow piece by piece, so no output or text is held as a whole. A
    plain text without pieces is its own output and its own restoration.
    """

    def digest(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Batches(_DIGESTS_ARROW)
        head, sha, seen = None, None, False

        def close() -> Iterator[pa.RecordBatch]:
            if head is not None:
                whole = head[8] if head[5] == "plain" and not seen else sha.hexdigest()
                yield from out.add((head[0], *head[3:], whole), 200)

        for record in _records(frames):
            if record[1] == -1:
                yield from close()
                head, sha, seen = record, hashlib.sha256(), False
            else:
                sha.update(record[2])
                seen = True
        yield from close()
        yield from out.close()

    return restored_pieces(pieces).mapInArrow(digest, _DIGESTS)


def fill_in_middle(docs: DataFrame, seed: int = 42, rate: int = 50, spm_rate: int = 80) -> DataFrame:
    """row, doc_id, n, form, prefix_chars, middle_chars, output: the outputs as texts, one row each.

    The pieces of :func:`output_pieces` put together; for rows of unlimited
    length work with the pieces. Nulls, ties and empty tables as there.
    """

    schema = pa.schema([f for f in _HEAD_ARROW if f.name not in ("place", "data", "output_sha256")] + [pa.field("output", pa.string())])

    def join(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, head, parts = _Batches(schema), None, []
        for record in _records(frames):
            if record[1] == -1:
                if head is not None:
                    yield from out.add((head[0], *head[3:8], b"".join(parts)), sum(map(len, parts)))
                head, parts = record, []
            else:
                parts.append(record[2])
        if head is not None:
            yield from out.add((head[0], *head[3:8], b"".join(parts)), 0)
        yield from out.close()

    form = "row binary, doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
    return output_pieces(docs, seed, rate, spm_rate).mapInArrow(join, form)
