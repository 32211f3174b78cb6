"""Language-model score of a text: the marginal probability over all segmentations into known pieces."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timbrel.llm.language import held_out
from timbrel.llm.rows import field, keyed, text_of, written

#: The mark of a word's begin in the vocabulary (fixed value).
BEGIN = "▁"
#: Words kept in the tasks' memory: at most so many, all that occur often enough.
FREQUENT = 100_000
#: Words of more characters are not put side by side, but walked through in segments of so many.
LONG = 4096
#: Expected counts are added up in this fraction, as integers, so that reruns agree.
UNIT = 4096
_BASE = np.uint64(0x9E3779B97F4A7C15)


def vocabulary(path: str) -> tuple[list[str], np.ndarray]:
    """Pieces of a sentencepiece file and the logarithms of their first weights, from the file's scores.

    The file's scores only order the pieces; the first weights fall with the
    place in that order, as word frequencies do. Byte pieces come as ``<0xNN>``.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    lowest = min((model.get_score(i) for i in ids), default=0.0) - 1
    scores = np.array([lowest if model.is_byte(i) else model.get_score(i) for i in ids])
    place = np.empty(len(ids))
    place[np.argsort(-scores, kind="stable")] = np.arange(len(ids))
    weight = 1 / (place + 20)
    return [model.id_to_piece(i) for i in ids], np.log(weight / weight.sum())


class Lattice:
    """All segmentations of words into pieces, many words at a time."""

    def __init__(self, pieces: list[str], logs: np.ndarray):
        self.logs = np.append(logs, -np.inf)
        self.byte = np.full(256, len(pieces), dtype=np.int64)
        texts, ids = [], []
        for i, piece in enumerate(pieces):
            if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
                self.byte[int(piece[3:5], 16)] = i
            else:
                texts.append(piece)
                ids.append(i)
        self.longest = max(map(len, texts), default=1)
        keys = np.zeros(len(texts), dtype=np.uint64)
        for k, text in enumerate(texts):
            h = 0
            for c in text:
                h = (h * int(_BASE) + ord(c) + 1) % (1 << 64)
            keys[k] = h
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.array(ids, dtype=np.int64)[order]
        self.lengths = sorted({len(t) for t in texts})

    def edges(self, words: list[str]):
        """Begins of the words in one run of characters, their lengths, and per piece length the piece ids.

        Words come sorted from the longest to the shortest. ``extra`` are the
        logarithms of single characters spelled in bytes.
        """
        marked = [BEGIN + w for w in words]
        lengths = np.fromiter(map(len, marked), dtype=np.int64, count=len(marked))
        begins = np.r_[0, np.cumsum(lengths)[:-1]]
        chars = np.frombuffer("".join(marked).encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
        left = np.repeat(begins + lengths, lengths) - np.arange(len(chars))
        found: dict[int, np.ndarray] = {}
        h = np.zeros(len(chars), dtype=np.uint64)
        for size in range(1, min(self.longest, int(lengths.max())) + 1):
            n = len(chars) - size + 1
            h = h[:n] * _BASE + chars[size - 1 :] + np.uint64(1)
            at = np.flatnonzero(left[:n] >= size)
            key = h[at]
            place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[place] == key
            ids = np.full(len(chars), -1, dtype=np.int32)
            ids[at[hit]] = self.ids[place[hit]]
            found[size] = ids
        single = found[1] < 0
        spelled: dict[int, list[int]] = {}
        for c in np.unique(chars[single]).tolist():
            spelled[c] = self.spelling(c)
        extra = np.full(len(chars), -np.inf)
        for c, own in spelled.items():
            extra[single & (chars == c)] = self.logs[own].sum()
        return begins, lengths, chars, found, extra, spelled

    def _log(self, found: dict, extra: np.ndarray, size: int, at: np.ndarray) -> np.ndarray:
        ids = found[size][at]
        logs = self.logs[ids]  # id -1 reads the last entry, minus infinity
        return np.maximum(logs, extra[at]) if size == 1 else logs

    def forward(self, edges) -> np.ndarray:
        """Logarithm of the weight of all ways to each place; place 0 of a word is its begin."""
        begins, lengths, _, found, extra, _ = edges
        alpha = np.full(int(lengths.sum()) + len(lengths), -np.inf)
        base = begins + np.arange(len(begins))
        alpha[base] = 0.0
        for t in range(1, int(lengths[0]) + 1):
            n = int(np.searchsorted(-lengths, -t, side="right"))
            total = np.full(n, -np.inf)
            for size in found:
                if size > t:
                    break
                logs = self._log(found, extra, size, begins[:n] + t - size)
                some = np.flatnonzero(logs > -np.inf)
                if len(some):
                    total[some] = np.logaddexp(total[some], alpha[base[some] + t - size] + logs[some])
            alpha[base[:n] + t] = total
        return alpha

    def backward(self, edges) -> np.ndarray:
        """Logarithm of the weight of all ways from each place to the word's end."""
        begins, lengths, _, found, extra, _ = edges
        beta = np.full(int(lengths.sum()) + len(lengths), -np.inf)
        base = begins + np.arange(len(begins))
        beta[base + lengths] = 0.0
        for back in range(1, int(lengths[0]) + 1):
            n = int(np.searchsorted(-lengths, -back, side="right"))
            at, total = lengths[:n] - back, np.full(n, -np.inf)
            for size in found:
                if size > back:
                    break
                logs = self._log(found, extra, size, begins[:n] + at)
                some = np.flatnonzero(logs > -np.inf)
                if len(some):
                    total[some] = np.logaddexp(total[some], logs[some] + beta[base[some] + at[some] + size])
            beta[base[:n] + at] = total
        return beta

    def segment(self, codes: np.ndarray, begin: int, end: int):
        """The pieces that end in characters ``begin`` to ``end`` of a word: where they begin, their length, id and logarithm.

        They come ordered by their end. A character that is no piece has id -1
        and the logarithm of its spelling in bytes.
        """
        start = max(0, begin - self.longest + 1)
        chars = codes[start:end].astype(np.uint64)
        h = np.zeros(len(chars), dtype=np.uint64)
        places, sizes, ids = [], [], []
        for size in range(1, min(self.longest, len(chars)) + 1):
            n = len(chars) - size + 1
            h = h[:n] * _BASE + chars[size - 1 :] + np.uint64(1)
            at = np.arange(max(0, begin + 1 - size - start), n)
            place = np.minimum(np.searchsorted(self.keys, h[at]), len(self.keys) - 1)
            hit = self.keys[place] == h[at]
            own = np.where(hit, self.ids[place], -1)
            if size > 1:
                at, own = at[hit], own[hit]
            places.append(at + start)
            sizes.append(np.full(len(at), size, dtype=np.int64))
            ids.append(own)
        place, size, own = np.concatenate(places), np.concatenate(sizes), np.concatenate(ids)
        order = np.argsort(place + size, kind="stable")
        place, size, own = place[order], size[order], own[order]
        logs = self.logs[own]
        for c in np.unique(codes[place[own < 0]]).tolist():
            logs[(own < 0) & (codes[place] == c)] = self.logs[self.spelling(c)].sum()
        return place, size, own, logs

    def spelling(self, code: int) -> list[int]:
        """The byte pieces of a character."""
        return self.byte[list(chr(code).encode("utf-8", "surrogatepass"))].tolist()

    def ahead(self, edges, before: list[float], begin: int, end: int) -> list[float]:
        """Logarithms of all ways to the places ``begin`` to ``end``; ``before`` has those up to ``begin``, its last one."""
        place, size, _, logs = edges
        alpha, shift = list(before), begin - len(before) + 1
        cuts = np.searchsorted(place + size, np.arange(begin + 1, end + 2)).tolist()
        place, logs = (place - shift).tolist(), logs.tolist()
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            terms = [alpha[place[k]] + logs[k] for k in range(a, b)]
            most = max(terms)
            alpha.append(most if most == -math.inf or b - a == 1 else most + math.log(sum([math.exp(x - most) for x in terms])))
        return alpha[len(before) - 1 :]

    def long_score(self, word: str) -> float:
        """``score`` of one long word: segment by segment, a piece's length of places carried over."""
        codes = np.frombuffer((BEGIN + word).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        carried = [0.0]
        for begin in range(0, len(codes), LONG):
            end = min(begin + LONG, len(codes))
            found = self.ahead(self.segment(codes, begin, end), carried, begin, end)
            carried = (carried[:-1] + found)[-self.longest :]
        return carried[-1]

    def long_expected(self, word: str, count: int) -> np.ndarray:
        """``expected`` of one long word: forward once for what segments hand on, then from the last to the first.

        Only the places handed on are kept; inside a segment the ways forward are
        found again beside the ways back.
        """
        codes = np.frombuffer((BEGIN + word).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        begins, handed, carried = list(range(0, len(codes), LONG)), [], [0.0]
        for begin in begins:
            handed.append(carried)
            end = min(begin + LONG, len(codes))
            found = self.ahead(self.segment(codes, begin, end), carried, begin, end)
            carried = (carried[:-1] + found)[-self.longest :]
        whole, out = carried[-1], np.zeros(len(self.logs))
        after = {len(codes): 0.0}  # ways back of the places that a segment shares with the next one
        for begin, before in zip(reversed(begins), reversed(handed), strict=True):
            end = min(begin + LONG, len(codes))
            edges = self.segment(codes, begin, end)
            alpha = before[:-1] + self.ahead(edges, before, begin, end)
            place, size, ids, logs = edges
            shift = begin - len(before) + 1
            # the pieces that end in this segment give their share to the places where they begin
            beta = [after.get(k, -math.inf) for k in range(shift, end + 1)]
            starts, ends, weights = (place - shift).tolist(), (place + size - shift).tolist(), logs.tolist()
            for k in range(len(starts) - 1, -1, -1):
                x, y = beta[starts[k]], weights[k] + beta[ends[k]]
                high, low = (x, y) if x > y else (y, x)
                beta[starts[k]] = high if low == -math.inf else high + math.log1p(math.exp(low - high))
            share = np.exp(np.array(alpha)[place - shift] + logs + np.array(beta)[place + size - shift] - whole) * count
            known = ids >= 0
            out += np.bincount(ids[known], weights=share[known], minlength=len(out))
            odd = codes[place[~known]]
            for c in np.unique(odd).tolist():
                np.add.at(out, self.spelling(c), share[~known][odd == c].sum())
            after = {k: beta[k - shift] for k in range(shift, begin + 1)}
        return out[:-1]

    def score(self, words: list[str]) -> np.ndarray:
        """Natural logarithm of each word's marginal probability."""
        if any(len(w) > LONG for w in words):
            out, short = np.empty(len(words)), [i for i, w in enumerate(words) if len(w) <= LONG]
            if short:
                out[short] = self.score([words[i] for i in short])
            for i, w in enumerate(words):
                if len(w) > LONG:
                    out[i] = self.long_score(w)
            return out
        order = sorted(range(len(words)), key=lambda i: -len(words[i]))
        edges = self.edges([words[i] for i in order])
        alpha = self.forward(edges)
        ends = edges[0] + np.arange(len(words)) + edges[1]
        out = np.empty(len(words))
        out[order] = alpha[ends]
        return out

    def expected(self, words: list[str], counts: np.ndarray) -> np.ndarray:
        """How often each piece is expected to be used in so many occurrences of the words."""
        if any(len(w) > LONG for w in words):
            short = [i for i, w in enumerate(words) if len(w) <= LONG]
            out = self.expected([words[i] for i in short], np.asarray(counts)[short]) if short else np.zeros(len(self.logs) - 1)
            for w, c in zip(words, np.asarray(counts).tolist(), strict=True):
                if len(w) > LONG:
                    out += self.long_expected(w, c)
            return out
        order = sorted(range(len(words)), key=lambda i: -len(words[i]))
        edges = self.edges([words[i] for i in order])
        begins, lengths, chars, found, extra, spelled = edges
        alpha, beta = self.forward(edges), self.backward(edges)
        word = np.repeat(np.arange(len(words)), lengths)
        whole = alpha[begins + np.arange(len(words)) + lengths][word]
        weight = np.asarray(counts, dtype=np.float64)[order][word]
        place = np.arange(len(chars)) + word
        out = np.zeros(len(self.logs))
        for size, ids in found.items():
            at = np.flatnonzero((ids >= 0) | (extra > -np.inf)) if size == 1 else np.flatnonzero(ids >= 0)
            share = np.exp(alpha[place[at]] + self._log(found, extra, size, at) + beta[place[at] + size] - whole[at]) * weight[at]
            known = ids[at] >= 0
            out += np.bincount(ids[at][known], weights=share[known], minlength=len(out))
            if size == 1 and spelled:
                codes = chars[at][~known]
                for c, own in spelled.items():
                    np.add.at(out, own, share[~known][codes == c].sum())
        return out[:-1]


def tokens_of(text: str) -> list[bytes]:
    """Words of the lower-cased text (A to Z only), as UTF-8."""
    return text.encode().lower().split()


def _in_parts(frames: Iterator[pa.RecordBatch], most: int = 100_000, most_bytes: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """Parts of up to so many words and so many bytes of them; a longer word is a part by itself."""
    for frame in frames:
        ends = np.cumsum(np.fromiter(map(len, frame.column(0).to_pylist()), dtype=np.int64, count=frame.num_rows))
        begin = 0
        while begin < frame.num_rows:
            before = int(ends[begin - 1]) if begin else 0
            fit = int(np.searchsorted(ends, before + most_bytes, side="right"))
            end = min(max(fit, begin + 1), begin + most)
            yield frame.slice(begin, end - begin)
            begin = end


def word_counts(rows: DataFrame) -> DataFrame:
    """word (UTF-8), c: occurrences in training documents; words of held-out documents come with 0 at least."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            seen: Counter = Counter()
            for out, text in zip(frame.column(0).to_pylist(), frame.column(1).to_pylist(), strict=True):
                if out:
                    for w in tokens_of(text):
                        seen.setdefault(w, 0)
                else:
                    seen.update(tokens_of(text))
            yield pa.RecordBatch.from_arrays(
                [pa.array(seen.keys(), pa.binary()), pa.array(seen.values(), pa.int64())], names=["word", "c"]
            )

    out = held_out(field("doc_id", rows, "bigint"), 7, 2)
    counted = rows.select(out.alias("out"), text_of(rows).alias("text")).mapInArrow(run, "word binary, c bigint")
    return counted.groupBy("word").agg(F.sum("c").alias("c"))


def lattice_score(docs: DataFrame, model: str) -> DataFrame:
    """One row per row of ``docs``: row, doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``model`` is the path of a sentencepiece file whose pieces are taken as they
    are. Its scores only order them (those of a BPE file are merge ranks, not log
    probabilities): the first weights follow from the place in that order, and
    what the pieces weigh is learnt from the word counts of all training
    documents by one step of expectation and maximisation over the lattice. ``score`` is the base-10 logarithm of the text's probability: for
    each word the sum over all its segmentations, by the forward recursion in
    log space, and one end. Characters that are no piece are spelled in bytes.
    ``base_score`` is the add-one unigram score. A null text counts as empty and
    has the end alone; without training documents the first weights hold; an
    empty table gives an empty result; rows that repeat a doc_id are scored, and
    counted in training, one by one. A word of any length is scored whole: over
    ``LONG`` characters it is walked through in segments, with the same result
    and the memory of one segment.
    """
    rows = docs if "doc" in docs.columns and "row" in docs.columns else keyed(docs)
    spark = rows.sparkSession
    pieces, first = vocabulary(model)
    counts = written(word_counts(rows), "lm-words")
    total = counts.agg(F.sum("c").alias("n"), F.count(F.when(F.col("c") > 0, 1)).alias("v")).first()
    ends = rows.filter(~held_out(field("doc_id", rows, "bigint"), 7, 2)).count()
    n_train, v_train = (total.n or 0) + ends, (total.v or 0) + (1 if ends else 0)
    start = spark.sparkContext.broadcast((pieces, first))

    def expect(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(*start.value)
        out = np.zeros(len(start.value[0]))
        for frame in _in_parts(frames):
            words = [w.decode() for w in frame.column(0).to_pylist()]
            if words:
                out += np.rint(lattice.expected(words, frame.column(1).to_numpy()) * UNIT)
        used = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int64()), pa.array(out[used].astype(np.int64))], names=["piece", "n"]
        )

    used = counts.filter("c > 0").mapInArrow(expect, "piece bigint, n bigint").groupBy("piece").agg(F.sum("n").alias("n"))
    weight = np.exp(first)
    for r in used.collect():  # at most one row per piece of the vocabulary
        weight[r.piece] += r.n / UNIT
    whole = weight.sum() + ends + 1
    learnt, end_log = np.log(weight / whole), math.log10((ends + 1) / whole)
    final = spark.sparkContext.broadcast((pieces, learnt))
    log_base = math.log10(n_train + v_train + 1)

    def score(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(*final.value)
        for frame in _in_parts(frames):
            words = [w.decode() for w in frame.column(0).to_pylist()]
            if words:
                own = lattice.score(words) / math.log(10)
                yield pa.RecordBatch.from_arrays([frame.column(0), frame.column(1), pa.array(own)], names=["word", "c", "lm"])

    scored = written(counts.mapInArrow(score, "word binary, c bigint, lm double"), "lm-scored")
    power = F.floor(F.log2(F.col("c"))).cast("int")
    sizes = {r.k: r.n for r in scored.filter("c > 0").groupBy(power.alias("k")).agg(F.count("*").alias("n")).collect()}
    least, sum_of = 64, 0
    while least > 0 and sum_of + sizes.get(least - 1, 0) <= FREQUENT:
        least -= 1
        sum_of += sizes.get(least, 0)
    often = scored.filter(F.col("c") >= 2.0**least).collect()
    table = {bytes(r.word): i for i, r in enumerate(often)}
    logs = np.array([[math.log10(r.c + 1) - log_base, r.lm] for r in often] + [[0.0, 0.0]])
    shared = spark.sparkContext.broadcast((table, logs))

    def apart(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, values = shared.value
        for frame in frames:
            whole, rare_at, rare_words, rare_n = [], [], [], []
            for k, text in enumerate(frame.column(3).to_pylist()):
                words = tokens_of(text)
                at = np.array([known.get(w, -1) for w in words], dtype=np.int64)
                sums = values[at].sum(axis=0) if len(at) else np.zeros(2)
                hits = int((at >= 0).sum())
                whole.append((len(words) + 1, hits, float(sums[0]), float(sums[1])))
                if hits < len(words):
                    rest = Counter(w for w, i in zip(words, at.tolist(), strict=True) if i < 0)
                    rare_at += [k] * len(rest)
                    rare_words += rest.keys()
                    rare_n += rest.values()
            if not whole:
                continue
            n, m = len(whole), len(rare_at)
            ids = frame.column(0).take(pa.array(rare_at, pa.int64()))
            parts = [pa.array(x, t) for x, t in zip(zip(*whole, strict=True), (pa.int64(), pa.int64(), pa.float64(), pa.float64()), strict=True)]
            names = ["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "lm", "word", "n"]
            yield pa.RecordBatch.from_arrays(
                [frame.column(0), frame.column(1), frame.column(2), *parts, pa.nulls(n, pa.binary()), pa.nulls(n, pa.int64())],
                names=names)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.nulls(m, pa.int64()), pa.nulls(m, pa.bool_()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()),
                 pa.nulls(m, pa.float64()), pa.nulls(m, pa.float64()), pa.array(rare_words, pa.binary()), pa.array(rare_n, pa.int64())],
                names=names)

    doc_id = field("doc_id", rows, "bigint")
    plain = rows.select("row", doc_id.alias("doc_id"), held_out(doc_id, 7, 2).alias("held_out"), text_of(rows).alias("text"))
    form = "row binary, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base double, lm double, word binary, n bigint"
    split = written(plain.mapInArrow(apart, form), "lm-split")
    rare = split.filter("word is not null").select("row", "word", "n").join(scored, "word")
    seen = F.when(F.col("c") > 0, F.col("n")).otherwise(0)
    of_rare = rare.groupBy("row").agg(
        F.sum(seen).alias("known2"), F.sum(F.col("n") * (F.log10(F.col("c") + 1) - F.lit(log_base))).alias("base2"),
        F.sum(F.col("n") * F.col("lm")).alias("lm2"))
    joined = split.filter("word is null").join(of_rare, "row", "left").fillna(0, ["known2", "base2", "lm2"])
    end_base = math.log10(ends + 1) - log_base
    return joined.select(
        "row", "doc_id", "held_out", "n_tokens",
        (F.col("n_known") + F.col("known2") + F.lit(1 if ends else 0)).alias("n_known"),
        F.lit(n_train).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.col("base2") + F.lit(end_base)).alias("base_score"),
        (F.col("lm") + F.col("lm2") + F.lit(end_log)).alias("score"))
