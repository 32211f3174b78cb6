"""Each operator on awkward rows, an empty table, and beside a plain loop."""

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from timbrel.llm import bpe, chosen_path, exact_dedup, interleave, language, lattice, line_chunks, line_frequency, mixing, personal_data
from timbrel.llm import repeated_bytes as rb
from timbrel.llm.queries import tokenizer_path

PIECES = public_tokenizers.path("piece_bpe_32k.model")
FORM = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, `row` int, _share string, size string"
PASSAGE = " ".join(f"word{i} and{i % 7}" for i in range(80))
LONG = " ".join(f"x{i * 7919 % 10007}" for i in range(30000))
TEXTS = [
    (1, PASSAGE, "en", "a"),
    (2, PASSAGE.replace(" ", "\n"), "en", "a"),
    (3, PASSAGE.replace("word40 ", "other "), "en", "b"),
    (3, PASSAGE.replace("word40 ", "other "), "en", "b"),
    (4, None, "en", "a"),
    (5, "", None, None),
    (None, "mail me at a.b@c.example.com or +1 (555) 123-4567, 10.0.0.1, 4111 1111 1111 1111 <|endoftext|>", None, None),
    (6, LONG, "de", "b"),
    (7, "\n".join(["one line", "two lines", "one line", "", "three"] * 3), None, "c"),
    (8, "été über 日本 " + PASSAGE, "fr", "c"),
    (9, " \t\n", "fr", "c"),
    (10, "1.2.3.4.5 999.1.1.1 a@b.c_d@e.f " + "7 " * 25, "de", "a"),
]
OPERATORS = {
    "exact": exact_dedup.exact_dedup,
    "rules": line_frequency.line_rules,
    "mix": mixing.mix,
    "bpe": lambda d: bpe.bpe(d, tokenizer_path()),
    "language": language.language,
    "lattice": lambda d: lattice.lattice_score(d, PIECES),
    "join": chosen_path.jaccard_join,
    "pii": personal_data.personal_data,
    "chunks": line_chunks.line_chunks,
    "bytes": rb.repeated_bytes,
}


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(*r, 0, "x", 1, "y", "z") for r in TEXTS]
    return spark.createDataFrame(rows, FORM).repartition(3)


@pytest.fixture(scope="module")
def found(docs):
    return {name: fn(docs).collect() for name, fn in OPERATORS.items()}


@pytest.mark.parametrize("name", list(OPERATORS))
def test_every_row_once(found, name):
    assert Counter(r.doc_id for r in found[name]) == Counter(t[0] for t in TEXTS)


@pytest.mark.parametrize("name", list(OPERATORS))
def test_empty_table(spark, name):
    assert OPERATORS[name](spark.createDataFrame([], FORM)).collect() == []


def test_exact(found):
    got = {r.doc_id: r for r in found["exact"]}
    assert got[1].group_size == got[2].group_size == 2 and (got[1].keep_id, got[2].keep_id) == (1, 1)
    assert sorted(r.kept for r in found["exact"] if r.doc_id == 3) == [False, True]
    assert {got[i].keep_id for i in (4, 5)} == {9} and got[9].kept and got[9].group_size == 3


def test_bpe_beside_the_library(found):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    for r in found["bpe"]:
        text = dict((t[0], t[1]) for t in TEXTS)[r.doc_id] or ""
        ids = library.encode(text, add_special_tokens=False).ids
        assert r.ids == ",".join(map(str, ids)) and r.n_tokens == len(ids)
        assert r.decoded == library.decode(ids, skip_special_tokens=False) == text


def test_repeated_strings(docs, found):
    seen = Counter()
    raws = [(t[0], (t[1] or "").encode()) for t in TEXTS]
    for _, raw in raws:
        seen.update(raw[k : k + 200] for k in range(len(raw) - 199))
    want = Counter()
    for i, raw in raws:
        cover = bytearray(len(raw))
        for k in range(len(raw) - 199):
            if seen[raw[k : k + 200]] > 1:
                cover[k : k + 200] = b"\1" * 200
        left = bytes(b for b, c in zip(raw, cover) if not c)
        want[(i, len(raw), sum(cover), hashlib.sha256(left).hexdigest())] += 1
    for rows in (found["bytes"], rb.repeated_bytes(docs, transforms=False).collect()):
        assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.kept_sha256) for r in rows) == want


def test_merged_transforms_beside_a_loop():
    draw = np.random.default_rng(3)
    for _ in range(60):
        texts = [draw.integers(0, draw.integers(1, 4), draw.integers(0, 30)).astype(np.uint8) for _ in range(draw.integers(1, 9))]
        length = int(draw.integers(2, 9))
        seen = Counter(bytes(t[k : k + length]) for t in texts for k in range(len(t) - length + 1))
        got = interleave.repeated_places(texts, length, per_shard=int(draw.integers(1, 4)))
        for t, marks in zip(texts, got):
            assert marks.tolist() == [k + length <= len(t) and seen[bytes(t[k : k + length])] > 1 for k in range(len(t))]


def test_base_spans(found):
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans if s.base] for r in found["pii"]}
    text = TEXTS[6][1]
    kinds = [text[a:b] for _, a, b in got[None]]
    assert kinds == ["a.b@c.example.com", "10.0.0.1", "4111 1111 1111 1111", "+1 (555) 123-4567"]
    assert [TEXTS[11][1][a:b] for _, a, b in got[10]] == ["a@b.c", "_d@e.f", "1.2.3.4"]


def test_boosting_learns_a_pattern():
    cells = [(b, 100, 95 if b & 1 and b & 4 else 1) for b in range(16)]
    trees, threshold = personal_data.boost(cells)
    chosen = {b for b in range(16) if personal_data._value(trees, b) >= threshold}
    assert chosen == {b for b in range(16) if b & 1 and b & 4}


def test_links(found):
    got = {r.doc_id: r for r in found["join"]}
    assert got[1].class_id == got[2].class_id == 1 and got[3].n_copies == 2
    assert got[1].n_links == 2 and got[1].group_id == got[3].group_id == got[8].group_id == 1
    assert sum(r.kept for r in found["join"] if r.group_id == 1) == 1
    assert got[6].n_links == 0 and got[6].kept


def test_components(spark):
    edges = [(f"{a:03}", f"{a + 1:03}") for a in range(40)] + [("100", "101"), ("200", "101"), ("300", "300")]
    got = {r.u: r.root for r in chosen_path.components(spark.createDataFrame(edges, "u string, v string")).collect()}
    assert all(got[f"{k:03}"] == "000" for k in range(1, 41)) and got["101"] == got["200"] == "100"


def test_mix_targets(spark, docs):
    sized = spark.createDataFrame([("a", 100), ("b", 10), ("c", 300), (None, 50), ("d", 0)], "source string, size bigint")
    got = {r.source: r.target for r in mixing.targets(sized).collect()}
    weight, most = {"a": 5, "b": 2, "c": 1, "d": 5, None: 2}, {"a": 300, "b": 30, "c": 900, "d": 0, None: 150}
    free, left, want = set(weight), 460.0, {}
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > most[s]}
        if not over:
            break
        for s in over:
            want[s], left = most[s], left - most[s]
        free -= over
    assert got == pytest.approx(want | share)
    again = [sorted(mixing.mix(docs).select("doc_id", "taken").collect(), key=str) for _ in range(2)]
    assert again[0] == again[1]


def test_mix_comes_near_its_targets(spark):
    docs = spark.range(30000).select(
        F.col("id").alias("doc_id"), F.expr("repeat('w ', cast(1 + id % 97 as int))").alias("text"),
        F.expr("case when id % 3 = 0 then 'big' else 's' || id % 5 end").alias("source"))
    rows = mixing.mix(docs).groupBy("source").agg(
        F.sum("taken").alias("t"), F.first("target").alias("target"), F.max(F.col("taken") - 3 * F.col("size")).alias("over"))
    for r in rows.collect():
        assert abs(r.t - r.target) <= 97 and r.over <= 0


def test_base_score(found):
    held = [t[0] is not None and zlib.crc32(str(t[0]).encode()) % 7 == 2 for t in TEXTS]
    counts, ends = Counter(), 0
    for t, h in zip(TEXTS, held):
        if not h:
            counts.update((t[1] or "").encode().lower().split())
            ends += 1
    n, v = sum(counts.values()) + ends, len(counts) + 1
    got = {r.doc_id: r for r in found["lattice"]}
    for t in TEXTS:
        words = (t[1] or "").encode().lower().split()
        r = got[t[0]]
        want = sum(math.log10((c + 1) / (n + v + 1)) for c in [*(counts[w] for w in words), ends])
        assert (r.n_tokens, r.train_tokens, r.n_known) == (len(words) + 1, n, 1 + sum(counts[w] > 0 for w in words))
        assert r.base_score == pytest.approx(want) and -1e9 < r.score < 0


def test_lattice_beside_all_segmentations():
    pieces, logs = lattice.vocabulary(PIECES)
    weight = {p: x for p, x in zip(pieces, logs)}

    def ways(text):
        if not text:
            return [0.0]
        return [weight[text[:k]] + rest for k in range(1, len(text) + 1) if text[:k] in weight for rest in ways(text[k:])]

    words = ["the", "thander", "on"]
    want = [math.log(sum(math.exp(x) for x in ways(lattice.BEGIN + w))) for w in words]
    assert lattice.Lattice(pieces, logs).score(words).tolist() == pytest.approx(want)


def test_language_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language.language(docs).join(docs.select("doc_id", "lang", F.length("text").alias("n")), "doc_id")
    held = rows.filter("held_out and n > 0").collect()
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in held)


def test_undetermined(found):
    got = {r.doc_id: r.lang_pred for r in found["language"]}
    assert {got[4], got[5], got[9]} == {"und"}


def test_chunks(spark):
    shared = [f"shared line {k}" for k in range(60)]
    docs = spark.createDataFrame(
        [(i, "\n".join([f"own {i} {k}" for k in range(9)] + shared + [f"tail {i}"])) for i in range(5)], "doc_id bigint, text string")
    rows = line_chunks.line_chunks(docs).collect()
    rows = sorted(rows, key=lambda r: r.doc_id)
    assert rows[0].n_removed_lines == 0 and rows[0].kept_text.count("shared") == 60
    for r in rows[1:]:
        assert r.n_removed_lines >= 30 and r.kept_text.startswith(f"own {r.doc_id} 0") and r.n_lines == 70
        assert r.kept_text.count("\n") + 1 == r.n_lines - r.n_removed_lines


def test_frequent_lines_deplete(spark):
    own = " ".join(f"w{k}" for k in range(60))
    menu = " ".join(f"menu{k}" for k in range(60))
    rows = [(i, f"{menu}\nonly {i}", "h") for i in range(30)] + [(100 + i, f"{menu}\n{own} a{i} {own}", "h") for i in range(5)]
    got = {r.doc_id: r for r in line_frequency.line_rules(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()}
    assert not any(got[i].kept for i in range(30)) and not got[0].base_failed
    cut = line_frequency.without_frequent_lines(spark.createDataFrame(rows, "doc_id bigint, text string, source string"))
    assert {r.cleaned for r in cut.filter("doc.doc_id < 2").collect()} == {"only 0", "only 1"}


def test_redact(docs):
    got = personal_data.redact(docs).filter("doc.doc_id is null").first().redacted
    assert got == "mail me at [email] or [phone], [ip], [card] <|endoftext|>"


def test_stages(spark, docs):
    now, columns = docs, docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, "")
        assert now.columns == columns, name
    last = corpus_pipeline.STAGES[-1][1](spark, now, "").collect()
    assert {r.doc_id for r in last} <= {1, 2, 3, 6, 8, 10}


def _loop_lines(rows, chunks):
    """The text that stays of each row (doc_id, text), by a plain loop; chunks: doc_id to (first line, lines) of the first set."""
    gone, lines = {i: set() for i, _ in rows}, {i: t.split("\n") for i, t in rows}
    for least in (2, 0):
        first = {}
        for i, own in lines.items():
            full = [k for k, x in enumerate(own) if x.strip(" \t\n\v\f\r")]
            for at, n in chunks[i] if least else [(a, b - a + 1) for a, b in zip(full, full[1:])]:
                part = "\n".join(own[at : at + n])
                if n < least or not part.strip(" \t\n\v\f\r"):
                    continue
                j, k = first.setdefault(part, (i, at))
                if j != i or at >= k + n:
                    gone[i] |= set(range(at, at + n))
    return {i: "\n".join(x for k, x in enumerate(own) if k not in gone[i]) for i, own in lines.items()}


def test_short_passages(spark):
    draw = np.random.default_rng(5)
    rows = []
    for i in range(60):
        now = [f"own {i} {k}" for k in range(3)]
        for p in draw.integers(0, 8, 3):
            now += [f"passage {p} line {k}" for k in range(2 + p % 4)] + [f"after {i} {p}", *[""] * int(draw.integers(0, 2))]
        rows.append((i, "\n".join(now)))
    rows += [(60, "\n".join(["same"] * 5)), (61, "a one\n\n\nb two\nlast"), (62, "x\na one\n\n\nb two"), (63, ""), (64, "single 1\nown 3 0")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    cut = docs.select("doc_id", F.transform(line_chunks._chunks(F.col("text")), lambda c: F.struct(c["at"], c["n"])).alias("c"))
    chunks = {r.doc_id: [tuple(c) for c in r.c] for r in cut.collect()}
    got = {r.doc_id: r for r in line_chunks.line_chunks(docs).collect()}
    assert {i: r.kept_text for i, r in got.items()} == _loop_lines(rows, chunks)
    # no line of a passage is there twice, and none is lost
    every = Counter(x for r in got.values() for x in r.kept_text.split("\n") if x.startswith("passage"))
    assert set(every.values()) == {1} and set(every) == {x for _, t in rows for x in t.split("\n") if x.startswith("passage")}
    assert got[60].kept_text == "same\nsame" and got[62].kept_text == "x" and got[64].n_removed_lines == 0
    for i, t in rows:
        assert got[i].n_lines - got[i].n_removed_lines == (0 if not got[i].kept_text and got[i].n_removed_lines else got[i].kept_text.count("\n") + 1)


def _shingles(text):
    words = text.split()
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4)))


def _loop_links(texts):
    """doc_id to its number of links, and to its group, of texts that all differ in their sets, by a plain loop."""
    sets = {i: _shingles(t) for i, t in texts.items()}
    having, links, group = {}, Counter(), {i: i for i in texts}
    for i, s in sets.items():
        near = Counter(j for x in s for j in having.get(x, ()))
        for j, n in near.items():
            if n >= 0.8 * (len(s) + len(sets[j]) - n) - 1e-9:
                links.update([i, j])
                a, b = sorted((group[i], group[j]))
                group = {k: a if g == b else g for k, g in group.items()} if a != b else group
        for x in s:
            having.setdefault(x, []).append(i)
    return links, group


def test_links_beside_a_loop(spark, monkeypatch):
    monkeypatch.setattr(chosen_path, "LIMIT", 4)
    monkeypatch.setattr(chosen_path, "BLOCK", 8)
    draw, texts = np.random.default_rng(11), {}
    for family in range(130):
        base = [f"f{family}w{k}" for k in range(int(draw.integers(80, 140)))]
        for member in range(20 if family < 100 else 3):
            own = list(base)
            for place in draw.integers(0, len(own), int(draw.integers(1, 3))):
                own[place] = f"edit{family}x{member}x{place}"
            texts[len(texts)] = " ".join(own)
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(4)
    links, group = _loop_links(texts)
    got = {r.doc_id: r for r in chosen_path.jaccard_join(docs).collect()}
    assert len(got) == len(texts) and all(r.n_links <= links[i] for i, r in got.items())
    n_found = sum(r.n_links for r in got.values())
    assert n_found >= 0.999 * sum(links.values()) > 5_000, (n_found, sum(links.values()))
    assert {i: r.group_id for i, r in got.items()} == group
    assert {i for i, r in got.items() if r.kept} == set(group.values())
    # a leaf over LIMIT is one of the last level, and one over BLOCK is compared block by block
    sets = chosen_path.signed_sets(chosen_path.keyed(docs), chosen_path.runs_for(), 5, 0.8)
    sizes = [r.n for r in chosen_path.buckets(sets).select("key", "n").distinct().collect()]
    assert max(sizes) > chosen_path.BLOCK and min(sizes) <= chosen_path.LIMIT


def _loop_quality(rows):
    lines = {i: [x for x in t.split("\n") if x.strip()] for i, t, _ in rows}
    plain = {i: ["".join(x.lower().split()) for x in own] for i, own in lines.items()}
    hosts = {s for *_, s in rows}
    often = set()
    for host in hosts:
        by_text = {t: set(plain[i]) for i, t, s in rows if s == host}
        seen = Counter(x for own in by_text.values() for x in own)
        often |= {(host, x) for x, n in seen.items() if n > max(20, 0.005 * len(by_text))}
    for i, t, s in rows:
        words = t.split()
        grams = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
        many = Counter(grams)
        repeated = {k + d for k, g in enumerate(grams) if many[g] > 1 for d in range(3)}
        chars = len("".join(words))
        left = chars - sum(len(x) for x in plain[i] if (s, x) in often)
        if len(words) >= 50 and 100 * len(repeated) <= 50 * len(words) and left >= 0.25 * chars:
            yield i


def _loop_exact(rows):
    best = {}
    for i, t, _ in rows:
        best.setdefault("".join(t.split()), []).append((-len(t), i))
    return {min(x)[1] for x in best.values()}


def test_stages_beside_loops(spark):
    draw, rows = np.random.default_rng(23), []
    for k in range(40):
        words = [f"w{k}x{n}" for n in range(int(draw.integers(60, 200)))]
        near = [*words[:30], "edited", *words[31:]]
        kinds = [" ".join(words), "\n".join(words), " ".join(near), " ".join(words[:40]), "again and again " * 20]
        rows += [(len(rows) + n, kinds[n], "abc"[k % 3]) for n in range(2 + k % 4)]
    menu = " ".join(f"menu{n}" for n in range(60))
    rows += [(1000 + n, f"{menu}\nonly {n}", "h") for n in range(25)] + [(2000, menu + "\n" + PASSAGE, "a")]
    texts, sources = {i: t for i, t, _ in rows}, {i: s for i, _, s in rows}
    now = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(3)
    want = []
    want.append(set(_loop_quality(rows)))
    want.append(_loop_exact([r for r in rows if r[0] in want[0]]))
    want.append(set(_loop_links({i: texts[i] for i in sorted(want[1])})[1].values()))
    assert len(rows) > len(want[0]) > len(want[1]) > len(want[2]) > 20
    for (name, stage), ids in zip(corpus_pipeline.STAGES[:3], want):
        now = stage(spark, now, "")
        assert sorted(r.doc_id for r in now.collect()) == sorted(ids), name
    sizes = {i: len(texts[i].split()) for i in want[2]}
    targets = spark.createDataFrame([(sources[i], n) for i, n in sizes.items()], "source string, size bigint")
    goals = {r.source: (r.target, r.source_size) for r in mixing.targets(targets).collect()}
    mixed = corpus_pipeline.STAGES[3][1](spark, now, "")
    taken = Counter(r.doc_id for r in mixed.collect())
    assert set(taken) <= want[2]
    for i in want[2]:
        target, whole = goals[sources[i]]
        assert math.floor(target / whole + 1e-9) <= taken[i] <= math.ceil(target / whole - 1e-9), i
    for source, (target, _) in goals.items():
        assert abs(sum(n * sizes[i] for i, n in taken.items() if sources[i] == source) - target) <= max(sizes.values())
    last = corpus_pipeline.STAGES[4][1](spark, mixed, "").collect()
    assert Counter(r.doc_id for r in last) == taken
    assert all(r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() and r.n_tokens > 0 for r in last)
