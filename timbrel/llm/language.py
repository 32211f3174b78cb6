"""Language of a text by a small convolutional network over bytes, trained with numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from timbrel.llm.rows import field, keyed, text_of

#: Bytes of a window, filter widths, filters of each width, size of a byte's vector.
WINDOW, WIDTHS, FILTERS, VECTOR = 128, (2, 3, 4), 16, 8
#: The sample: at most this many documents of a language, two windows of each.
SAMPLE = 400
LETTER = regex.compile(r"\p{L}")
#: Windows that go through the network at once.
AT_ONCE = 2048


def windows_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts cut into windows (zero-padded at their ends), and the number of windows of each."""
    counts = np.array([-(-len(t) // WINDOW) for t in texts], dtype=np.int64)
    padded = b"".join(t + b"\0" * (-len(t) % WINDOW) for t in texts)
    return np.frombuffer(padded, dtype=np.uint8).reshape(-1, WINDOW), counts


@dataclass
class Network:
    """Byte vectors, one bank of filters per width, and a softmax over the languages."""

    labels: list[str]
    vectors: np.ndarray
    filters: list[np.ndarray]
    bias: list[np.ndarray]
    out: np.ndarray
    out_bias: np.ndarray

    @classmethod
    def start(cls, labels: list[str], seed: int) -> Network:
        draw = np.random.default_rng(seed)
        return cls(
            labels,
            draw.normal(0, 0.5, (256, VECTOR)).astype(np.float32),
            [draw.normal(0, 1 / np.sqrt(w * VECTOR), (w * VECTOR, FILTERS)).astype(np.float32) for w in WIDTHS],
            [np.zeros(FILTERS, dtype=np.float32) for _ in WIDTHS],
            draw.normal(0, 0.1, (FILTERS * len(WIDTHS), len(labels))).astype(np.float32),
            np.zeros(len(labels), dtype=np.float32),
        )

    def parameters(self) -> list[np.ndarray]:
        return [self.vectors, *self.filters, *self.bias, self.out, self.out_bias]

    def forward(self, windows: np.ndarray) -> tuple[np.ndarray, list]:
        """Logits, and what the backward pass needs."""
        embedded = self.vectors[windows]
        pooled, kept = [], []
        for width, bank, bias in zip(WIDTHS, self.filters, self.bias, strict=True):
            flat = np.lib.stride_tricks.sliding_window_view(embedded, width, axis=1).transpose(0, 1, 3, 2)
            patches = flat.reshape(len(windows), WINDOW - width + 1, width * VECTOR)
            response = patches @ bank
            best = response.argmax(axis=1)
            top = np.take_along_axis(response, best[:, None, :], axis=1)[:, 0, :] + bias
            pooled.append(np.maximum(top, 0))
            kept.append((best, top, patches))
        features = np.concatenate(pooled, axis=1)
        return features @ self.out + self.out_bias, [features, kept]

    def gradient(self, windows: np.ndarray, goal: np.ndarray) -> list[np.ndarray]:
        logits, (features, kept) = self.forward(windows)
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(len(goal)), goal] -= 1
        p /= len(goal)
        back = p @ self.out.T
        d_vectors = np.zeros_like(self.vectors)
        d_filters, d_bias = [], []
        for k, (width, bank) in enumerate(zip(WIDTHS, self.filters, strict=True)):
            best, top, patches = kept[k]
            d_top = back[:, k * FILTERS : (k + 1) * FILTERS] * (top > 0)
            rows = np.arange(len(windows))[:, None]
            chosen = patches[rows, best]
            d_filters.append(np.einsum("nfp,nf->pf", chosen, d_top))
            d_bias.append(d_top.sum(axis=0))
            d_patch = d_top[:, :, None] * bank.T[None]
            for offset in range(width):
                at = windows[rows, best + offset]
                np.add.at(d_vectors, at.ravel(), d_patch[:, :, offset * VECTOR : (offset + 1) * VECTOR].reshape(-1, VECTOR))
        return [d_vectors, *d_filters, *d_bias, features.T @ p, p.sum(axis=0)]

    def tables(self) -> list[np.ndarray]:
        """What each byte adds to each filter at each offset, all widths side by side."""
        out = []
        for width, bank in zip(WIDTHS, self.filters, strict=True):
            out.append([self.vectors @ bank[o * VECTOR : (o + 1) * VECTOR] for o in range(width)])
        return out

    def pair_tables(self) -> list[list[np.ndarray]]:
        """The same for two bytes at once: one table lookup in place of two products."""
        pairs = []
        for singles in self.tables():
            row = []
            for o in range(0, len(singles) - 1, 2):
                row.append((singles[o][:, None, :] + singles[o + 1][None, :, :]).reshape(65536, FILTERS))
            if len(singles) % 2:
                row.append(np.repeat(singles[-1][:, None, :], 256, axis=1).reshape(65536, FILTERS))
            pairs.append(row)
        return pairs

    def logits(self, windows: np.ndarray, pairs: list[list[np.ndarray]]) -> np.ndarray:
        """The forward pass by table lookups, in parts of bounded size."""
        out = np.empty((len(windows), len(self.labels)), dtype=np.float32)
        for begin in range(0, len(windows), AT_ONCE):
            part = windows[begin : begin + AT_ONCE].astype(np.int32)
            wide = np.concatenate([part, np.zeros((len(part), 1), dtype=np.int32)], axis=1)
            codes = wide[:, :-1] * 256 + wide[:, 1:]
            pooled = []
            for width, row, bias in zip(WIDTHS, pairs, self.bias, strict=True):
                n = WINDOW - width + 1
                response = np.take(row[0], codes[:, :n], axis=0)
                for k, table in enumerate(row[1:], 1):
                    response += np.take(table, codes[:, 2 * k : 2 * k + n], axis=0)
                pooled.append(np.maximum(response.max(axis=1) + bias, 0))
            out[begin : begin + AT_ONCE] = np.concatenate(pooled, axis=1) @ self.out + self.out_bias
        return out


def train(texts: list[str], labels: list[str], seed: int = 5, epochs: int = 8, batch: int = 64) -> Network | None:
    """Fit the network on windows of the texts, some of them cut short; Adam on the cross entropy."""
    names = sorted(set(labels))
    if not names:
        return None
    draw = np.random.default_rng(seed)
    goal_of = {name: i for i, name in enumerate(names)}
    windows, goals = [], []
    for text, label in zip(texts, labels, strict=True):
        raw = text.encode()
        for k in range(0, len(raw), WINDOW):
            part = raw[k : k + WINDOW]
            if len(part) >= 16 or k == 0:
                windows.append(part.ljust(WINDOW, b"\0"))
                goals.append(goal_of[label])
                if draw.random() < 0.25:
                    windows.append(part[: int(draw.integers(8, WINDOW))].ljust(WINDOW, b"\0"))
                    goals.append(goal_of[label])
    x = np.frombuffer(b"".join(windows), dtype=np.uint8).reshape(-1, WINDOW)
    y = np.array(goals)
    net = Network.start(names, seed)
    first = [np.zeros_like(p) for p in net.parameters()]
    second = [np.zeros_like(p) for p in net.parameters()]
    step = 0
    for _ in range(epochs):
        order = draw.permutation(len(x))
        for begin in range(0, len(order), batch):
            at = order[begin : begin + batch]
            step += 1
            for p, g, m, v in zip(net.parameters(), net.gradient(x[at], y[at]), first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= 0.004 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-7)
    return net


def held_out(doc_id: Column, parts: int, which: int) -> Column:
    """True if crc32 of the id as text leaves this remainder; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == which, F.lit(False))


def labelled_sample(rows: DataFrame, per_language: int, seed: int) -> list:
    """Two pieces of text of at most so many documents of each language, and never of held-out ones.

    Rows first pass a threshold on their hash that lets about three times the
    bound through, then the smallest hashes stay.
    """
    text, doc_id = text_of(rows), field("doc_id", rows, "bigint")
    draw = F.xxhash64(doc_id, text, F.lit(seed))
    usable = rows.select(field("lang", rows, "string").alias("lang"), draw.alias("draw"), text.alias("text"),
                         held_out(doc_id, 3, 1).alias("out")).filter("lang is not null and not out and text <> ''")
    counts = {r.lang: r.n for r in usable.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return []
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, 3.0 * per_language / n))])
    few = usable.filter((F.pmod("draw", F.lit(1 << 20)) / float(1 << 20)) < F.try_element_at(share, F.col("lang")))
    length = 2 * WINDOW
    room = F.greatest(F.char_length("text") - length, F.lit(1)).cast("bigint")
    pieces = few.select("lang", "draw", *[
        F.substring("text", (F.pmod(F.xxhash64("draw", F.lit(k)), room) + 1).cast("int"), F.lit(length)).alias(f"t{k}")
        for k in range(2)])
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "t0"))
    return pieces.withColumn("rank", rank).filter(F.col("rank") <= per_language).orderBy("lang", "rank").collect()


def language(docs: DataFrame, per_language: int = SAMPLE, seed: int = 5) -> DataFrame:
    """One row per row of ``docs``: row, doc_id, held_out, lang_pred, score, n_windows.

    The network is fitted on a sample of at most ``per_language`` documents of
    each non-null ``lang`` (two pieces of 256 characters of each) and applied to
    all windows of every text; a text's score is the softmax of the mean of its
    windows' logits. ``und`` with score 0 if the text is null or has no letter,
    or if no row is labelled. An empty table gives an empty result; rows that
    repeat a doc_id are judged one by one; other columns are ignored.
    """
    rows = docs if "doc" in docs.columns and "row" in docs.columns else keyed(docs)
    sample = labelled_sample(rows, per_language, seed)
    net = train([t for r in sample for t in (r.t0, r.t1)], [r.lang for r in sample for _ in range(2)], seed)
    shared = rows.sparkSession.sparkContext.broadcast(net)

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = shared.value
        pairs = network.pair_tables() if network else None
        for frame in frames:
            texts = [t if network and LETTER.search(t) else "" for t in frame.column("text").to_pylist()]
            windows, counts = windows_of([t.encode() for t in texts])
            names, scores = ["und"] * len(texts), np.zeros(len(texts))
            some = np.flatnonzero(counts)
            if len(some):
                logits = network.logits(windows, pairs)
                starts = np.r_[0, np.cumsum(counts[some])[:-1]]
                mean = np.add.reduceat(logits.astype(np.float64), starts, axis=0) / counts[some, None]
                p = np.exp(mean - mean.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
                scores[some] = p.max(axis=1)
                for i, best in zip(some.tolist(), p.argmax(axis=1).tolist(), strict=True):
                    names[i] = network.labels[best]
            yield pa.RecordBatch.from_arrays(
                [*[frame.column(c) for c in ("row", "doc_id", "held_out")], pa.array(names, pa.string()),
                 pa.array(scores, pa.float64()), pa.array(counts, pa.int64())],
                names=["row", "doc_id", "held_out", "lang_pred", "score", "n_windows"])

    doc_id = field("doc_id", rows, "bigint")
    plain = rows.select("row", doc_id.alias("doc_id"), held_out(doc_id, 3, 1).alias("held_out"), text_of(rows).alias("text"))
    return plain.mapInArrow(
        run, "row binary, doc_id bigint, held_out boolean, lang_pred string, score double, n_windows bigint"
    )
