"""Byte-level BPE by an index of pair occurrences, and decoding."""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from timbrel.llm.rows import field, keyed, text_of

#: The pattern that splits a text before the merges (fixed value): letters first and without going back, the same
#: matches as of ``'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+`` in three quarters of the time.
SPLIT = r""" ?+\p{L}++|'(?:[stmd]|re|ve|ll)| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s+(?!\S)|\s+"""
#: Words whose ids a worker remembers before it forgets the rarer ones.
REMEMBERED = 60_000
#: New words are merged together once so many of their characters, or so many words of texts, are waiting.
FRESH, WAITING = 400_000, 1_000_000
#: Places put into the index at a time, which bounds the memory of looking up their ranks.
STEP = 65_536
#: Characters of the texts in one batch that a task gives back; a longer text is a batch of its own.
GIVEN = 1_000_000


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte: printable ones for themselves, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    others = [b for b in range(256) if b not in set(plain)]
    return letters | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Tokens, merges and special tokens of a tokenizer file, as arrays."""

    def __init__(self, content: str):
        spec = json.loads(content)
        ids: dict[str, int] = spec["model"]["vocab"]
        letters = byte_letters()
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = max([*ids.values(), *self.special.values()]) + 1
        self.tokens = [b""] * size
        for token, i in ids.items():
            self.tokens[i] = bytes(letters[c] for c in token)
        for token, i in self.special.items():
            self.tokens[i] = token.encode()
        self.byte_ids = np.zeros(256, dtype=np.int32)
        for letter, b in letters.items():
            self.byte_ids[b] = ids[letter]
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.left = np.array([ids[a] for a, _ in merges], dtype=np.int64)
        self.right = np.array([ids[b] for _, b in merges], dtype=np.int64)
        self.merged = np.array([ids[a + b] for a, b in merges], dtype=np.int32)
        codes = self.left << 32 | self.right
        order = np.argsort(codes, kind="stable")
        self.codes, self.order = codes[order], order.astype(np.int32)
        self.split = regex.compile(SPLIT)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair of tokens, -1 for pairs that do not merge."""
        code = a.astype(np.int64) << 32 | b
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where(self.codes[at] == code, self.order[at], -1)


class PairIndex:
    """All places of every pair in a run of symbols; pairs are merged in ascending rank.

    A merged pair only makes pairs of higher rank, as it had to exist before
    them when the merges were learnt; so each rank is active once.
    """

    def __init__(self, vocabulary: Vocabulary, symbols: np.ndarray, ends: np.ndarray):
        n = len(symbols)
        self.v, self.symbols = vocabulary, symbols
        self.next = np.arange(1, n + 1, dtype=np.int32)
        self.next[ends - 1] = -1
        self.previous = np.arange(-1, n - 1, dtype=np.int32)
        self.previous[0] = -1
        self.previous[ends[:-1][ends[:-1] < n]] = -1
        self.places: dict[int, list[np.ndarray]] = {}
        self.active: list[int] = []
        for begin in range(0, n, STEP):
            self.add(np.flatnonzero(self.next[begin : begin + STEP] >= 0).astype(np.int32) + np.int32(begin))

    def add(self, at: np.ndarray) -> None:
        """Put the pairs that begin at these places into the index."""
        if not len(at):
            return
        rank = self.v.ranks(self.symbols[at], self.symbols[self.next[at]])
        at, rank = at[rank >= 0], rank[rank >= 0]
        if not len(at):
            return
        order = np.argsort(rank, kind="stable")
        at, rank = at[order], rank[order]
        ends = np.flatnonzero(rank[1:] != rank[:-1]) + 1
        begin = 0
        for end in [*ends.tolist(), len(at)]:
            r = int(rank[begin])
            if r in self.places:
                self.places[r].append(at[begin:end])
            else:
                self.places[r] = [at[begin:end]]
                heapq.heappush(self.active, r)
            begin = end

    def merge(self) -> np.ndarray:
        """Symbols after all merges; -1 where a symbol was merged into the one before."""
        symbols, following, previous = self.symbols, self.next, self.previous
        while self.active:
            rank = heapq.heappop(self.active)
            parts = self.places.pop(rank)
            at = parts[0] if len(parts) == 1 else ordered(parts)
            a, b = self.v.left[rank], self.v.right[rank]
            second = following[at]
            good = (symbols[at] == a) & (second >= 0) & (symbols[second] == b)
            at, second = at[good], second[good]
            if a == b and len(at) > 1:  # of a run of the same symbol, pairs are taken from its left end
                fresh = np.r_[True, at[1:] != second[:-1]]
                begin = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
                odd = (np.arange(len(at)) - begin) % 2 == 0
                at, second = at[odd], second[odd]
            if not len(at):
                continue
            after = following[second]
            symbols[at] = self.v.merged[rank]
            symbols[second] = -1
            following[at] = after
            inner = after >= 0
            previous[after[inner]] = at[inner]
            before = previous[at]
            self.add(ordered([at[inner], before[before >= 0]]))
        return symbols


def ordered(parts: list[np.ndarray]) -> np.ndarray:
    """All numbers of the parts, ascending and once each (``np.unique`` costs several times as much on short ones)."""
    at = np.concatenate(parts)
    at.sort()
    if len(at) < 2:
        return at
    first = np.empty(len(at), dtype=bool)
    first[0] = True
    np.not_equal(at[1:], at[:-1], out=first[1:])
    return at[first]


def encode_words(vocabulary: Vocabulary, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words in a row, and where each word's ids end."""
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths)
    symbols = vocabulary.byte_ids[np.frombuffer(b"".join(words), dtype=np.uint8)]
    merged = PairIndex(vocabulary, symbols, ends).merge()
    alive = merged >= 0
    return merged[alive], np.cumsum(alive)[ends - 1]


class Known(dict):
    """The place of each known word; a new one takes the next place and waits to be learnt."""

    def __init__(self, words: Iterable[str]):
        super().__init__((w, at) for at, w in enumerate(words))
        self.fresh: list[str] = []
        self.n_fresh = 0

    def __missing__(self, word: str) -> int:
        at = self[word] = len(self)
        self.fresh.append(word)
        self.n_fresh += len(word)
        return at


def joined(parts: pa.Array, ends: np.ndarray) -> pa.Array:
    """Neighbouring strings put together, up to each of the ends; the bytes stay where they are."""
    if not len(parts):
        return pa.array([b""] * len(ends), pa.binary())
    offsets = np.frombuffer(parts.buffers()[1], dtype=np.int32, count=len(parts) + 1)
    own = np.concatenate([offsets[:1], offsets[ends]])
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(own), parts.buffers()[2]])


def as_text(values: pa.Array) -> pa.Array:
    """Bytes as UTF-8, with replacements where they are none."""
    try:
        return values.cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([v.decode("utf-8", "replace") for v in values.to_pylist()], pa.string())


class Coder:
    """Encodes and decodes batches of texts, remembering the words it has seen.

    ``numbers`` has the ids of each word by its place, each id after a comma,
    ``decoded`` the bytes of their tokens, ``uses`` how often the word was met.
    """

    def __init__(self, content: str):
        self.v = Vocabulary(content)
        self.number_of = pa.array([b",%d" % i for i in range(len(self.v.tokens))], pa.binary())
        self.bytes_of = pa.array(self.v.tokens, pa.binary())
        special = pa.array(self.v.special.values(), pa.int32())
        self.known = Known("\0" + t for t in self.v.special)
        self.numbers, self.decoded = self.number_of.take(special), self.bytes_of.take(special)
        self.uses = np.zeros(len(special), dtype=np.int64)

    def forget(self) -> None:
        """Only special tokens and the words met most often stay, half as many as may be remembered at most.

        A word met once does not stay; uses of those that stay count half from now on.
        """
        n = len(self.v.special)
        often = np.flatnonzero(self.uses[n:] > 1) + n
        most = REMEMBERED // 2
        if len(often) > most:
            often = np.sort(often[np.argsort(-self.uses[often], kind="stable")[:most]])
        stay = np.concatenate([np.arange(n), often])
        words = list(self.known)
        self.known = Known([words[at] for at in stay.tolist()])
        self.numbers, self.decoded = self.numbers.take(pa.array(stay)), self.decoded.take(pa.array(stay))
        self.uses = self.uses[stay] // 2

    def learn(self) -> None:
        """Encode the words that are not known yet, all of them together."""
        words = self.known.fresh
        if not words:
            return
        ids, ends = encode_words(self.v, [w.encode() for w in words])
        ids = pa.array(ids)
        self.numbers = pa.concat_arrays([self.numbers, joined(self.number_of.take(ids), ends)])
        self.decoded = pa.concat_arrays([self.decoded, joined(self.bytes_of.take(ids), ends)])
        self.uses = np.concatenate([self.uses, np.zeros(len(words), dtype=np.int64)])
        self.known.fresh, self.known.n_fresh = [], 0

    def words(self, text: str) -> list[str]:
        """The parts of a text; special tokens are marked by a leading NUL."""
        if self.v.cut is None or not any(t in text for t in self.v.special):
            return self.v.split.findall(text)
        out: list[str] = []
        for k, part in enumerate(self.v.cut.split(text)):
            out += ["\0" + part] if k % 2 else self.v.split.findall(part)
        return out

    def coded(self, texts: Iterable[str]) -> Iterator[tuple[pa.Array, pa.Array, pa.Array]]:
        """Runs of texts in order: numbers of ids, ids as decimals joined by commas, texts decoded from them.

        Merging costs by active ranks more than by words, so texts wait as places
        of their words until enough new words have come to be merged together.
        """
        waiting, n_waiting, sizes = [], 0, []
        for text in texts:
            words = self.words(text)
            waiting.append(np.fromiter(map(self.known.__getitem__, words), dtype=np.int32, count=len(words)))
            n_waiting += len(words)
            sizes.append(len(text))
            if self.known.n_fresh > FRESH or n_waiting > WAITING:
                yield from self.given(waiting, sizes)
                waiting, n_waiting, sizes = [], 0, []
                if len(self.known) > REMEMBERED:
                    self.forget()
        yield from self.given(waiting, sizes)

    def given(self, waiting: list[np.ndarray], sizes: list[int]) -> Iterator[tuple[pa.Array, pa.Array, pa.Array]]:
        """Learn the new words and give back the texts, which are given as places of their words, run by run."""
        self.learn()
        begin, size = 0, 0
        for k, own in enumerate(sizes):
            size += own
            if size < GIVEN and k + 1 < len(sizes):
                continue
            run = waiting[begin : k + 1]
            begin, size = k + 1, 0
            places, ends = np.concatenate(run), np.cumsum([len(x) for x in run])
            self.uses += np.bincount(places, minlength=len(self.uses))
            at = pa.array(places)
            ids = joined(self.numbers.take(at), ends)
            counts = pc.count_substring(ids, ",").cast(pa.int64())
            yield counts, pc.ascii_ltrim(as_text(ids), ","), as_text(joined(self.decoded.take(at), ends))

    def encode(self, texts: Iterable[str]) -> Iterator[tuple[str, str]]:
        """For each text its ids as decimals joined by commas, and the text decoded from them."""
        for _, ids, decoded in self.coded(texts):
            yield from zip(ids.to_pylist(), decoded.to_pylist(), strict=True)


def bpe(docs: DataFrame, tokenizer: str, decode: bool = True) -> DataFrame:
    """One row per row of ``docs``: row, doc_id, n_tokens, ids (decimals joined by commas), decoded.

    ``tokenizer`` is the path of a byte-level BPE file as the tokenizers library
    reads it; its special tokens are recognised in a text, none is added. A null
    text counts as empty and has no ids; an empty table gives an empty result;
    rows that repeat a doc_id are encoded one by one. No shuffle.
    """
    rows = docs if "doc" in docs.columns and "row" in docs.columns else keyed(docs)
    shared = rows.sparkSession.sparkContext.broadcast(open(tokenizer, encoding="utf-8").read())

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(shared.value)
        for frame in frames:
            begin = 0
            for counts, ids, decoded in coder.coded(value.as_py() for value in frame.column(2)):
                part = frame.slice(begin, len(ids))
                begin += len(ids)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), counts, ids, decoded if decode else pa.nulls(len(ids), pa.string())],
                    names=["row", "doc_id", "n_tokens", "ids", "decoded"])

    plain = rows.select("row", field("doc_id", rows, "bigint").alias("doc_id"), text_of(rows).alias("text"))
    return plain.mapInArrow(run, "row binary, doc_id bigint, n_tokens bigint, ids string, decoded string")
