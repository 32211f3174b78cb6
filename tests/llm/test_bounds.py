"""What bounds a task: long words, long texts in a bucket, a row repeated very often, runs of new words."""

import random

import numpy as np
import pytest

from timbrel.llm import bpe, chosen_path, lattice, mixing
from timbrel.llm.queries import tokenizer_path

PIECES = tokenizer_path("piece_bpe_32k.model")


def some_word(draw, n):
    return "".join(draw.choice("abcdefghijklmnopqrst日本é語Δ") for _ in range(n))


@pytest.mark.parametrize("long", [1, 7, 64])
def test_long_words_by_segments_as_in_batches(monkeypatch, long):
    draw = random.Random(3)
    words = [some_word(draw, n) for n in (1, 2, 15, 16, 17, 63, 64, 65, 129, 500)] + ["a" * 300, "日" * 100, ""]
    counts = np.arange(1, len(words) + 1)
    table = lattice.Lattice(*lattice.vocabulary(PIECES))
    score, expected = table.score(words), table.expected(words, counts)
    monkeypatch.setattr(lattice, "LONG", long)
    assert table.score(words) == pytest.approx(score, abs=1e-8)
    assert table.expected(words, counts) == pytest.approx(expected, abs=1e-8)


def test_score_of_very_long_words(spark):
    docs = spark.createDataFrame([(1, "x" * 1_000_000), (2, "日本" * 3000 + " one two"), (3, "one two two"), (4, None)], "doc_id bigint, text string")
    got = {r.doc_id: r for r in lattice.lattice_score(docs, PIECES).collect()}
    assert sorted(got) == [1, 2, 3, 4]
    assert all(np.isfinite(r.score) and r.score < 0 for r in got.values())
    assert got[1].n_tokens == 2 and got[1].score < -100_000
    each = (got[3].score - got[4].score, got[2].score - got[4].score)
    assert each[1] < each[0] < 0


@pytest.mark.parametrize("shingles", [200, 1 << 20])
def test_links_in_blocks_by_shingles(spark, monkeypatch, shingles):
    draw = random.Random(5)
    rows = []
    for group in range(6):
        words = [f"g{group}w{draw.randrange(10**6)}" for _ in range(120 if group else 900)]
        for _ in range(12):
            own = list(words)
            own[draw.randrange(len(own))] = f"x{draw.randrange(10**9)}"
            rows.append((len(rows), " ".join(own)))
    sets = [set(zip(*(t.split()[k:] for k in range(5)), strict=False)) for _, t in rows]
    links = [sum(i != j and 5 * len(a & b) >= 4 * len(a | b) for j, b in enumerate(sets)) for i, a in enumerate(sets)]
    monkeypatch.setattr(chosen_path, "BLOCK_SHINGLES", shingles)
    got = {r.doc_id: r for r in chosen_path.jaccard_join(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert [got[i].n_links for i in range(len(rows))] == links
    assert [got[i].group_id for i in range(len(rows))] == [i // 12 * 12 for i in range(len(rows))]


def test_a_row_repeated_very_often_is_not_one_leaf(spark, monkeypatch):
    monkeypatch.setattr(mixing, "LEAF", 40)
    rows = [(7, "same words here", "a")] * 600 + [(i, "w " * (1 + i % 9), "ab"[i % 2]) for i in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(4)
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    for source in "ab":
        own = [r for r in got if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 10
        assert all(0 <= r.taken <= 3 * r.size for r in own)
    same = [r.copies for r in got if r.doc_id == 7 and r.size == 3]
    assert max(same) - min(same) <= 1


def test_new_words_merged_together_at_any_bound(monkeypatch):
    from tokenizers import Tokenizer

    draw = random.Random(2)
    letters = "abcdeé日 \n\t'01<|>|endoftext"
    texts = ["".join(draw.choice(letters) for _ in range(draw.randrange(80))) for _ in range(300)] + ["", "x" * 5000, "<|endoftext|>"]
    library = Tokenizer.from_file(tokenizer_path())
    library.no_truncation()
    library.no_padding()
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    content = open(tokenizer_path(), encoding="utf-8").read()
    for remembered, fresh, waiting in [(0, 0, 0), (50, 300, 10**6), (10**6, 10**6, 100), (10**6, 10**6, 10**6)]:
        monkeypatch.setattr(bpe, "REMEMBERED", remembered)
        monkeypatch.setattr(bpe, "FRESH", fresh)
        monkeypatch.setattr(bpe, "WAITING", waiting)
        got = list(bpe.Coder(content).encode(iter(texts)))
        assert [ids for ids, _ in got] == [",".join(map(str, own)) for own in want]
        assert [text for _, text in got] == [library.decode(own, skip_special_tokens=False) for own in want]


def test_frequent_words_are_merged_once(monkeypatch):
    """Words met again and again stay known when rare ones are forgotten."""
    merged, encode_words = [], bpe.encode_words

    def count(vocabulary, words):
        merged.extend(words)
        return encode_words(vocabulary, words)

    monkeypatch.setattr(bpe, "encode_words", count)
    monkeypatch.setattr(bpe, "REMEMBERED", 100)
    monkeypatch.setattr(bpe, "FRESH", 100)
    common = " ".join(f"c{k:c}" for k in range(ord("a"), ord("a") + 20))
    texts = [f"{common} {common} rare{chr(200 + k) * 3}" for k in range(300)]
    coder = bpe.Coder(open(tokenizer_path(), encoding="utf-8").read())
    assert [text for _, text in coder.encode(iter(texts))] == texts
    assert len(merged) == len(set(merged)) and len(coder.known) < 200


def test_split_as_the_pattern_of_the_tokenizer():
    import regex

    plain = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
    own, draw = regex.compile(bpe.SPLIT), random.Random(4)
    letters = "stremvld''  \n\t\u00a0\u3000é日²Ⅳ٣1_.<\u0301\0"
    for _ in range(5000):
        text = "".join(draw.choice(letters) for _ in range(draw.randrange(40)))
        assert own.findall(text) == plain.findall(text)


def test_decoded_bytes_that_are_no_text():
    import pyarrow as pa

    assert bpe.as_text(pa.array([b"a", b"\xff", b""], pa.binary())).to_pylist() == ["a", "\ufffd", ""]
    assert bpe.as_text(bpe.joined(pa.array([], pa.binary()), np.array([0, 0]))).to_pylist() == ["", ""]


@pytest.mark.parametrize("letters", [1, 2, 256])
def test_transforms_of_copies_and_short_texts(letters):
    """Order of all suffixes beside a plain sort, and marks beside a count of strings."""
    from collections import Counter

    from timbrel.llm.interleave import repeated_places, shard_transform

    rng = np.random.default_rng(letters)
    for _ in range(40):
        texts = [rng.integers(256 - letters, 256, rng.integers(0, 30)).astype(np.uint8) for _ in range(rng.integers(1, 5))]
        texts += [t[k:] for t in texts for k in rng.integers(0, 3, 2)]
        symbols = [(*(int(x) + 1 for x in t), -len(texts) + k) for k, t in enumerate(texts)]
        joined = [(k, at) for k, s in enumerate(symbols) for at in range(len(s))]
        want = sorted(range(len(joined)), key=lambda i: symbols[joined[i][0]][joined[i][1] :])
        assert shard_transform(texts)[1].tolist() == want
        for length in (2, 9):
            seen = Counter(t[k : k + length].tobytes() for t in texts for k in range(len(t) - length + 1))
            got = repeated_places(texts, length, per_shard=3)
            for t, marks in zip(texts, got, strict=True):
                n = max(0, len(t) - length + 1)
                assert marks[:n].tolist() == [seen[t[k : k + length].tobytes()] > 1 for k in range(n)]
