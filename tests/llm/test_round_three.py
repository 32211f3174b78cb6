"""Hard negatives, fill-in-the-middle and the URL filter beside plain loops, on awkward rows and empty tables."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from timbrel.llm import fill_middle, hard_negatives, redirects
from timbrel.llm.redirects import Rule

# ---- fill-in-the-middle

DOCS = "doc_id bigint, text string, kept string, `row` int, n string, place string"
UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def loop_form(doc_id, text):
    text = text or ""
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    units = UNITS.findall(text)
    n = len(units)
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 50:
        return (n, "plain", None, None, text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 80:
        return (n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}")
    return (n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


TEXTS = [
    None, "", " ", "\n\t ", "one", " one", "one ", "a b", "été  über\u00a0日本 x\x0by", "<P>", "a <S> b", "<", "<P", "M>", "< P > <M",
    "a<b <S c<P d< e<M", "x" * 300_000, " ".join(f"w{i}" for i in range(60_000)), "é" * 100_000 + " z", "  " * 50_000 + "end",
]


def middle_rows():
    rows = [(i * 20 + k, t) for i, t in enumerate(TEXTS) for k in range(14 if len(t or "") < 1000 else 4)]
    return rows + [(None, "null id text here"), (7, "tie one"), (7, "tie one"), (7, "tie two")]


@pytest.fixture(scope="module")
def middle(spark):
    return spark.createDataFrame([(*r, "x", 1, "y", "z") for r in middle_rows()], DOCS).repartition(5)


@pytest.mark.parametrize("plain", [False, True])
@pytest.mark.parametrize("piece", [5, fill_middle.PIECE])
def test_forms_beside_a_loop(middle, plain, piece):
    docs = middle if piece > 100 else middle.filter("length(coalesce(text, '')) < 1000")
    rows = [r for r in middle_rows() if piece > 100 or len(r[1] or "") < 1000]
    got = fill_middle.digests(fill_middle.output_pieces(docs, piece=piece, plain=plain)).collect()
    want = Counter((i, *loop_form(i, t)[:4], sha(loop_form(i, t)[4]), sha(t or "")) for i, t in rows)
    assert Counter(tuple(r[1:]) for r in got) == want
    assert {r.form for r in got} == {"plain", "spm", "psm"}


def test_outputs_as_texts(middle):
    rows = fill_middle.fill_in_middle(middle).collect()
    assert Counter((r.doc_id, r.form, r.output) for r in rows) == Counter((i, loop_form(i, t)[1], loop_form(i, t)[4]) for i, t in middle_rows())
    texts = Counter((i, t or "") for i, t in middle_rows())
    assert Counter((r.doc_id, fill_middle.restored_text(r.output, r.form)) for r in rows) == texts


def test_pieces_are_units_and_small(middle):
    pieces = fill_middle.output_pieces(middle, piece=1000, plain=False)
    long = pieces.filter(F.length("data") > 1003).count()
    assert long == 0 and pieces.filter("place > 20").count() > 100
    plan = fill_middle.digests(pieces)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1  # parts are sorted again where they are


def test_reader_with_chunks_cut_anywhere():
    output = "<S>s<P< <P><P<<M<M>m<"
    for cuts in range(1, 6):
        reader, parts = fill_middle.Reader("spm"), defaultdict(bytes)
        raw = output.encode()
        for k in range(0, len(raw), cuts):
            for place, data in reader.feed(raw[k : k + cuts], k + cuts >= len(raw)):
                parts[place] += data
        assert dict(parts) == {2: b"s<P< ", 0: b"<P<<M", 1: b"m<"}


def test_no_documents(spark):
    assert fill_middle.digests(fill_middle.output_pieces(spark.createDataFrame([], DOCS))).collect() == []
    assert fill_middle.fill_in_middle(spark.createDataFrame([], DOCS)).collect() == []


# ---- hard negatives

VECTORS = "vec_id bigint, embedding array<double>, label int, `row` int, size string, best string, dim string"


def loop_negatives(rows, percent=80):
    """All results by plain integers; rows are (place, vec_id, vector, label)."""
    alive = [(k, i, [int(np.floor(256 * x)) for x in v], lab) for k, (i, v, lab) in enumerate(rows)
             if lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    alive = [r for r in alive if sum(x * x for x in r[2]) <= 2**62]
    out = Counter()
    for a in alive:
        if a[1] is None or a[1] % 100:
            continue
        others = [(sum(x * y for x, y in zip(a[2], b[2])), b) for b in alive if b[0] != a[0] and len(b[2]) == len(a[2])]
        others.sort(key=lambda sb: (-sb[0], sb[1][1] is None, sb[1][1] or 0))
        for ps, p in [o for o in others if o[1][3] == a[3]][:5]:
            fit = [(s, b) for s, b in others if b[3] != a[3] and percent * ps <= 100 * s <= 100 * ps]
            for rank, (s, b) in enumerate(fit[:5], 1):
                out[(a[1], p[1], rank, b[1], ps, s)] += 1
    return out


def found_negatives(df, **settings):
    rows = hard_negatives.hard_negatives(df, **settings).collect()
    return Counter((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in rows)


def vectors(draw, n, dim, labels, spread=0.3):
    centres = draw.normal(size=(labels + 2, dim))
    out = []
    for i in range(n):
        v = centres[draw.integers(labels + 2)] + spread * draw.normal(size=dim)
        out.append((i, (v / np.linalg.norm(v)).tolist(), int(draw.integers(labels))))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, v, lab, 0, "s", "b", "d") for i, v, lab in rows], VECTORS).repartition(3)


@pytest.mark.parametrize(("dim", "spread"), [(64, 0.3), (64, 3.0), (7, 0.3), (130, 0.5)])
def test_negatives_beside_a_loop(spark, monkeypatch, dim, spread):
    monkeypatch.setattr(hard_negatives, "ROW_BYTES", 1 << 16)  # many blocks of rows, on the driver where blocks are counted
    monkeypatch.setattr(hard_negatives, "ANCHORS", 3)
    rows = vectors(np.random.default_rng(dim), 700, dim, 4, spread)
    want = loop_negatives(rows)
    assert len(want) > 20 and found_negatives(frame(spark, rows)) == want


def test_awkward_vectors(spark):
    draw = np.random.default_rng(5)
    rows = vectors(draw, 120, 16, 2)
    one, inf, nan = rows[0][1], float("inf"), float("nan")
    # one vector under a third of all rows, which all tie; ids repeat, also those of anchors
    rows += [(1000 + i, one, i % 2) for i in range(50)] + [(100, one, 0)] * 3 + [(None, one, 0), (None, one, 1)]
    rows += [(200, None, 1), (300, one, None), (400, [*one[:15], None], 1), (500, [*one[:15], inf], 1), (600, [*one[:15], nan], 1)]
    rows += [(700, [0.5] * 5, 1), (701, [0.5] * 5, 1), (702, [0.45] * 5, 0), (800, [], 1), (801, [], 1), (802, [], 0), (900, [-1.0] * 5, 0)]
    rows += [(1100, [1e300] * 16, 1), (1200, [1e4] * 16, 1), (1201, [1e4] * 16, 1), (1202, [0.9e4] * 16, 0)]
    want = loop_negatives(rows)
    got = found_negatives(frame(spark, rows))
    # rows that share an id may stand for each other
    assert got == want
    assert {k[0] for k in want} >= {0, 100, 700, 800, 1200} and not {k[0] for k in want} & {200, 300, 400, 500, 600, 1100}


def test_intervals_hold_every_score():
    draw = np.random.default_rng(11)
    for dim in (1, 3, 64, 100, 256):
        x = np.floor(256 * draw.normal(size=(300, dim)) * draw.uniform(0.01, 100, (300, 1)))
        q = np.floor(256 * draw.normal(size=(20, dim)))
        x[0] = 0
        codes, probes = hard_negatives.encode(x), hard_negatives.Probes(q)
        exact = q @ x.T
        grid, every = np.arange(20)[:, None], np.arange(300)[None, :]
        estimate, slack, widths = np.zeros((20, 300)), np.zeros((20, 300)), []
        for level in range(hard_negatives.LEVELS):
            estimate, slack = probes.add_level(level, codes, grid, every, estimate, slack)
            margin = probes.margin(level, codes, grid, every, slack)
            assert (np.abs(estimate - exact) <= margin).all()
            widths.append(margin.mean())
        assert widths[-1] < 0.3 * widths[0]


def test_few_pairs_are_scored():
    """On unit vectors most pairs are settled by their codes."""
    draw = np.random.default_rng(2)
    x = draw.normal(size=(4000, 64))
    x = np.floor(256 * x / np.linalg.norm(x, axis=1, keepdims=True))
    q = x[:40]
    exact = q @ x.T
    low = np.full(40, 0.36 * 65536)
    pairs = [(i, j) for a, r in hard_negatives.survivors(hard_negatives.Probes(q), hard_negatives.encode(x), low, np.full(40, np.inf), lambda a, r: a != r)
             for i, j in zip(a.tolist(), r.tolist())]
    need = {(i, j) for i, j in zip(*np.nonzero(exact >= low[:, None])) if i != j}
    assert need <= set(pairs) and len(pairs) < 0.03 * exact.size


def test_no_vectors(spark):
    assert hard_negatives.hard_negatives(spark.createDataFrame([], VECTORS)).collect() == []
    assert hard_negatives.hard_negatives(spark.createDataFrame([(1, [1.0], 1, 0, "", "", "")], VECTORS)).collect() == []


# ---- URL filter

PAGES = "page_id bigint, url string, html string, `row` int, rule string, verdict string, node string"
RULES = [
    Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"), Rule("block", "net", "/fr/"),
]


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, 0, "r", "v", "n") for i, u, h in rows], PAGES).repartition(3)


def verdicts(df):
    return Counter((r.page_id, r.rule, r.verdict) for r in df.collect())


def canonical(url):
    return f'<html><head><title>t</title><link rel="canonical" href="{url}"></head><body><a href="http://q.net/fr/1">x</a></body></html>'


def test_rules_and_parts(spark):
    rows = [
        (1, "HTTP://A.Example.COM/en/x?y#z", None), (2, "http://www.example.com/en/", ""), (3, "http://x.www.example.com/en/5", ""),
        (4, "http://example.com/en", ""), (5, "http://net/es/", ""), (6, "http://net.org/es/", ""), (7, None, ""), (8, "no scheme", ""),
        (9, "http://h.org?x://y/z", ""), (10, "a://b://c", ""), (11, "http://", ""), (12, "http://Ä.net/fr/é", ""), (12, "http://Ä.net/fr/é", ""),
    ]
    got = redirects.url_filter(pages(spark, rows), RULES).collect()
    assert sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got if r.rule) == [
        (1, "a.example.com", "/en/x", "example.com/en/", "block"), (2, "www.example.com", "/en/", "www.example.com/en/", "allow"),
        (3, "x.www.example.com", "/en/5", "www.example.com/en/", "allow"), (4, "example.com", "/en", "com/", "allow"),
        (5, "net", "/es/", "net/es/", "block"), (12, "Ä.net", "/fr/é", "net/fr/", "block"), (12, "Ä.net", "/fr/é", "net/fr/", "block"),
    ]
    assert {(r.page_id, r.host, r.path, r.verdict) for r in got if not r.rule} == {
        (6, "net.org", "/es/", "allow"), (7, "", "", "allow"), (8, "", "", "allow"), (9, "h.org", "", "allow"),
        (10, "b:", "//c", "allow"), (11, "", "", "allow"),
    }


def test_links_in_a_page(spark):
    cases = [
        ("http://c.org/d/e", "<HEAD><META content='0; URL=../p' HTTP-EQUIV=refresh><body><link rel=canonical href=/no>", ["http://c.org/p"]),
        ("http://c.org/p", "<link href='?a=1&amp;b=2' rel='x Canonical'>", ["http://c.org/p?a=1&b=2"]),
        ("http://c.org", "<!-- <link rel=canonical href=/no> --><link rel=canonical href=//q.net/fr/9>", ["http://q.net/fr/9"]),
        ("http://c.org/a/b", '<link rel=canonical href="mailto:x@y"><link rel=canonical href="#a"><link rel=canonical href="">', []),
        ("http://c.org/a/b", '<link rel="canonical" href=" c/./d/../e.html#f ">', ["http://c.org/a/c/e.html#f"]),
        ("http://c.org/a/b", '<link rel="stylesheet" href="x"><meta name="refresh" content="0;url=/x">', []),
        ("http://c.org", '<meta http-equiv="refresh" content="5"><meta http-equiv="Refresh" content="5; url=\'/x\'">', ["http://c.org/x"]),
        (None, canonical("http://x.org/"), None), ("nothing", canonical("http://x.org/"), None),
    ]
    df = spark.createDataFrame([(u, h) for u, h, _ in cases], "url string, html string")
    links = F.when(F.instr("url", "://") > 0, redirects.declared_links(F.col("url"), F.col("html")))
    got = {(r.url, r.html): r.links for r in df.select("url", "html", links.alias("links")).collect()}
    for url, html, want in cases:
        assert got[(url, html)] == want, (url, html)


def test_blocks_reach_aliases_beside_a_loop(spark):
    draw = np.random.default_rng(4)
    sites = ["a.org", "b.org", "c.net", "d.com", "e.example.com"]

    def url(k, scheme="http"):
        return f"{scheme}://{sites[k % 5]}/{['en', 'es', 'de'][k % 3]}/{k}"

    rows, edges = [], []
    for k in range(600):
        to = int(draw.integers(900)) if draw.random() < 0.45 else None  # targets from 600 on are not in the table
        rows.append((k, url(k, "https" if k % 2 else "http") + ("#top" if k % 4 == 0 else ""), canonical(url(to)) if to is not None else None))
        if to is not None:
            edges.append((k, to))
    log = [(int(a), int(b)) for a, b in draw.integers(0, 900, (40, 2))]
    # a hot page: a third of all rows, an alias of a blocked one
    rows += [(2000 + i, "https://hot.org/x", canonical(url(1001)) if i == 0 else None) for i in range(300)]
    edges.append(("hot", 1001))
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges + log:
        parent[root(a)] = root(b)

    def ruled(k):
        if k == "hot":
            return None
        host, path = sites[k % 5], ["en", "es", "de"][k % 3]
        if host == "e.example.com" and path == "en":
            return "block"
        return "allow" if host.endswith(".com") else "block" if host == "c.net" and path == "es" else None

    nodes = list(range(1002)) + ["hot"]
    bad = {root(k) for k in nodes if ruled(k) == "block"}
    want = Counter()
    for k, _, _ in rows:
        key = "hot" if k >= 2000 else k
        want[(k, ruled(key) or ("block" if root(key) in bad else "allow"))] += 1
    frame_ = spark.createDataFrame([(url(a), url(b)) for a, b in log], "from_url string, to_url string")
    got = redirects.url_filter(pages(spark, rows), RULES, frame_).collect()
    assert Counter((r.page_id, r.verdict) for r in got) == want
    assert any(r.verdict == "block" and not r.rule for r in got)
    assert not any(r.verdict == "block" for r in got if r.rule == "com/")


def test_long_page_and_chain(spark):
    body = "<p>" + "word <link rel=canonical href=http://net/es/> " * 40_000
    rows = [(i, f"http://s.org/{i}", canonical(f"http://s.org/{i + 1}")) for i in range(70)]
    rows += [(70, "http://s.org/70", canonical("http://net/es/")), (71, "http://t.org/", "<head></head><body>" + body)]
    got = verdicts(redirects.url_filter(pages(spark, rows), RULES))
    assert got == Counter({**{(i, None, "block"): 1 for i in range(71)}, (71, None, "allow"): 1})


def test_no_pages_and_no_rules(spark):
    assert redirects.url_filter(pages(spark, []), RULES).collect() == []
    some = redirects.url_filter(pages(spark, [(1, "http://net/es/", None)]), [])
    assert [(r.rule, r.verdict) for r in some.collect()] == [(None, "allow")]
    with pytest.raises(ValueError):
        redirects.url_filter(pages(spark, []), [Rule("block", f"h{i}.org") for i in range(redirects.MOST_RULES + 1)])


# ---- personal data: what the trees add

import random  # noqa: E402

from timbrel.llm import personal_data  # noqa: E402


def _card(rng):
    digits = [rng.randrange(10) for _ in range(15)]
    total = sum(d if i % 2 else (2 * d - 9 if 2 * d > 9 else 2 * d) for i, d in enumerate(digits))
    return "".join(map(str, digits)) + str(-total % 10)


def planted_texts(rng, n):
    """Texts with base spans, disguised ones and look-alikes: (text, list of what must be found, list of what must not)."""
    out = []
    words = "the report of last week says that we may meet at noon or later and then go home".split()

    def prose():
        return " ".join(rng.choice(words) for _ in range(rng.randrange(4, 12)))

    for i in range(n):
        user, host = f"u{rng.randrange(10**6)}", f"site{rng.randrange(10**4)}"
        card, a, b, c = _card(rng), rng.randrange(200, 999), rng.randrange(200, 999), rng.randrange(1000, 9999)
        ip = ".".join(str(rng.randrange(256)) for _ in range(4))
        base = [f"{user}@{host}.example.com", f"+1 ({a}) {b}-{c}", card, ip][i % 4]
        hidden = [f"{user}[at]{host}[dot]com", f"({a}) {b}-{c}", f"{card[:4]}.{card[4:8]}.{card[8:12]}.{card[12:]}", ip.replace(".", "[.]"),
                  f"{user} at {host} dot org", f"{a} {b} {c}", f"{user}{{at}}{host}.net"][i % 7]
        like = [f"20{rng.randrange(10, 30)}-0{rng.randrange(1, 9)}-1{rng.randrange(9)}", f"{rng.randrange(9)}.{rng.randrange(20)}.{rng.randrange(99)}",
                f"4{card[1:8]}{card[8:15]}{(int(card[15]) + 5) % 10}", f"{rng.randrange(10**7)}", "meet at noon. later"][i % 5]
        out.append((f"{prose()} {base} {prose()} {hidden}, {prose()} {like} {prose()}", hidden, like))
    return out


def test_disguised_spans_are_found_and_look_alikes_are_not(spark):
    rng = random.Random(8)
    texts = planted_texts(rng, 1400)
    docs = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(texts)], "doc_id bigint, text string").repartition(4)
    found = {r.doc_id: [(s.start, s.end, s.base) for s in r.spans] for r in personal_data.personal_data(docs).collect()}
    hits = added = right = 0
    missed = Counter()
    for i, (text, hidden, like) in enumerate(texts):
        at = text.rindex(hidden)  # a base span may hold it, too
        more = [(s, e) for s, e, base in found[i] if not base]
        added += len(more)
        hit = any(s < at + len(hidden) and at < e for s, e in more)
        right += sum(s < at + len(hidden) and at < e for s, e in more)
        hits += hit
        missed[i % 7] += not hit
    print("recall", hits / len(texts), "precision", right / max(added, 1), dict(missed))
    assert hits > 0.9 * len(texts) and right > 0.9 * added


def loop_base(text):
    """Base spans by plain matching: (kind, start, end)."""
    from timbrel.llm.personal_data import KINDS

    def luhn(d):
        return sum(int(x) if k % 2 == 0 else (2 * int(x) - 9 if int(x) > 4 else 2 * int(x)) for k, x in enumerate(reversed(d))) % 10 == 0

    patterns = [
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m, d: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m, d: all(int(p) <= 255 for p in m.split("."))),
        (r"[0-9]([\x20-]?[0-9])+", lambda m, d: 13 <= len(d) <= 19 and luhn(d)),
        (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m, d: 9 <= len(d) <= 15),
    ]
    return [(KINDS[k], m.start(), m.end()) for k, (p, good) in enumerate(patterns) for m in re.finditer(p, text)
            if good(m.group(), re.sub("[^0-9]", "", m.group()))]


def test_base_spans_beside_a_loop(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rng = random.Random(4)
    odd = ["".join(rng.choice("a1 .@+-()5é9_") for _ in range(rng.randrange(60))) for _ in range(500)]
    docs = docs.select("doc_id", "text").union(spark.createDataFrame([(10**6 + i, t) for i, t in enumerate(odd)], "doc_id bigint, text string"))
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    got = {r.doc_id: [(personal_data.KINDS[s.kind] if isinstance(s.kind, int) else s.kind, s.start, s.end) for s in r.spans if s.base]
           for r in personal_data.personal_data(docs).collect()}
    for i, text in texts.items():
        assert got[i] == loop_base(text), (i, text[:200])


def test_parts_of_words_are_bounded_by_bytes():
    import pyarrow as pa

    from timbrel.llm import lattice

    words = [b"a" * 10] * 50 + [b"b" * 5000] + [b""] * 20 + [b"c" * 60] * 10
    frame = pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(range(len(words)))], names=["word", "c"])
    parts = list(lattice._in_parts([frame], most=30, most_bytes=100))
    assert [v for p in parts for v in p.column(1).to_pylist()] == list(range(len(words)))
    for p in parts:
        own = p.column(0).to_pylist()
        assert len(own) <= 30 and (sum(map(len, own)) <= 100 or len([w for w in own if w]) == 1)
    assert list(lattice._in_parts([frame.slice(0, 0)])) == []


def test_the_query_takes_every_text_through_pieces(spark, tmp_path, monkeypatch):
    from timbrel.llm import middle_queries

    taken = []
    monkeypatch.setattr(middle_queries, "digests", lambda pieces: taken.append(pieces) or fill_middle.digests(pieces))
    texts = {i: f"word {i} in a text\n" if i % 5 else "" for i in range(40)}
    spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = middle_queries.op12_fill_middle(spark, str(tmp_path)).collect()
    assert {r.doc_id: r.restored_sha256 for r in got} == {i: sha(t) for i, t in texts.items()}
    pieces = taken[0].groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.sum(F.octet_length("data")).alias("size")).collect()
    marks = {r.doc_id: 0 if r.form == "plain" else 9 for r in got}
    assert {r.doc_id: r.size or 0 for r in pieces} == {i: len(t) + marks[i] for i, t in texts.items()}
    assert {r.form for r in got} == {"plain", "spm", "psm"}
