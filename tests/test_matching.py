import difflib
import random

from pyspark.sql import functions as F

from timbrel.operators import matching


def _frames(spark, targets, available):
    return (
        spark.createDataFrame([(t,) for t in targets], "t string"),
        spark.createDataFrame([(a, i) for i, a in enumerate(available)], "name string, pos int"),
    )


def _closest(word, available, threshold):
    return next(iter(difflib.get_close_matches(word, available, 1, threshold)), None)


def _built(rng, available):
    """Targets made for a tier each, with the match and the tier they were made for."""
    plain = [a for a in available if a == a.lower() and " " not in a and "&" not in a]
    made = {a: (a, 1) for a in available}
    for a in plain:
        made.setdefault(a.upper(), (a, 2))
        made.setdefault(a.replace("-", " ").title(), (a, 2))
    for alias, key in matching.KEY_ALIASES.items():
        if key in available and alias not in available and alias.replace(" ", "-").replace("&", "n") not in plain:
            made.setdefault(alias.upper(), (key, 3))
    for a in plain:
        cut = rng.randrange(len(a) + 1)
        near = a[:cut] + rng.choice(["", "x", "e"]) + a[cut + 1 :]
        if near and near not in plain and near not in matching.KEY_ALIASES:
            close = _closest(near, available, 0.6)
            made.setdefault(near, (close, 4 if close else None))
    return made


def _check(spark, want, available, **options):
    t, a = _frames(spark, list(want), available)
    rows = matching.match_keys(t, "t", a, "name", "pos", **options).collect()
    assert len(rows) == len(want)
    wrong = [(r, want[r.target]) for r in rows if (r.match, r.tier) != want[r.target]]
    assert not wrong, wrong[:5]


def test_literal_cases(spark):
    available = ["rock", "hip-hop", "r-n-b", "electronic", "reggae"]
    want = {
        "rock": "rock", "Hip Hop": "hip-hop", "r&b": "r-n-b", "edm": "electronic", "reggea": "reggae",
        "zzzz": None, "rnb": "r-n-b", "DnB": None,
    }
    for share in (matching.WORDS_PER_SHARE, 1):
        t, a = _frames(spark, list(want) * 3, available)
        rows = matching.match_keys(t, "t", a, "name", "pos", words_per_share=share).collect()
        assert {r.target: r.match for r in rows} == want


def test_targets_made_for_each_tier(spark):
    rng = random.Random(3)
    available = sorted({"".join(rng.choice("aabcdeeinorst-") for _ in range(rng.randrange(3, 12))) for _ in range(150)})
    available += [k for k in ("r-n-b", "electronic", "hip-hop") if k not in available]
    want = _built(rng, available)
    assert {tier for _, tier in want.values()} >= {1, 2, 3, 4}
    _check(spark, want, available)
    _check(spark, want, available, words_per_share=10)


def test_equal_scores_take_the_larger_word(spark):
    _check(spark, {"abcx": ("abcb", 4)}, ["abca", "abcb"])
    _check(spark, {"abcx": ("abcb", 4)}, ["abca", "abcb"], words_per_share=10)


def test_other_thresholds(spark):
    available = ["piano", "piano forte", "pianos", "organ"]
    for threshold in (0.3, 0.75, 0.9):
        want = {t: _closest(t, available, threshold) for t in ("pian", "fortepiano", "orgn")}
        t, a = _frames(spark, list(want), available)
        rows = matching.match_keys(t, "t", a, "name", "pos", threshold=threshold).collect()
        assert {r.target: r.match for r in rows} == want


def test_hot_target(spark):
    available = ["rock", "jazz"]
    targets = spark.range(50000).select(F.when(F.col("id") % 3 > 0, "Rock").otherwise(F.concat(F.lit("jaz"), F.col("id") % 7)).alias("t"))
    a = spark.createDataFrame([(x, i) for i, x in enumerate(available)], "name string, pos int")
    rows = matching.match_keys(targets, "t", a, "name", "pos").collect()
    assert {r.target: r.match for r in rows} == {"Rock": "rock", **{f"jaz{i}": "jazz" for i in range(7)}}


def test_few_pairs_are_scored_and_none_is_lost(spark):
    rng = random.Random(5)
    words = sorted({"".join(rng.choice("eeeaaiotnsrhldcump") for _ in range(rng.randrange(4, 15))) for _ in range(400)})
    targets, available = words[::2], words[1::2] + ["", "é", "ab" * 40]
    frame = spark.createDataFrame([(w, w in set(targets)) for w in words + available[-2:]], "word string, wanted boolean")
    pairs = [tuple(r) for r in matching.similar_pairs(frame, 0.6, words_per_share=50).collect()]
    assert len(pairs) == len(set(pairs)) < 0.25 * len(targets) * len(available)
    ratio = {(t, a): difflib.SequenceMatcher(None, a, t).ratio() for t in targets for a in available}
    assert {p for p, r in ratio.items() if r >= 0.6} <= set(pairs)
    t, a = _frames(spark, targets, available)
    found = {r.target: r.match for r in matching.closest(t, "t", a, "name").collect()}
    assert found == {t: c for t in targets if (c := _closest(t, available, 0.6))}


def test_any_key_size_gives_the_same_pairs_and_few_pairs_meet(spark):
    rng = random.Random(1)
    words = sorted({"".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(4, 13))) for _ in range(1000)})
    rng.shuffle(words)
    frame = spark.createDataFrame([(w, i % 2 == 0) for i, w in enumerate(words)], "word string, wanted boolean")
    met = matching.met_pairs(frame, 0.6).count()
    assert met < 0.1 * (len(words) / 2) ** 2
    sizes = [{tuple(r) for r in matching.similar_pairs(frame, 0.6, together=k).collect()} for k in (None, 1, 3)]
    assert sizes[0] == sizes[1] == sizes[2] and sizes[0]


def test_no_words(spark):
    t, a = _frames(spark, ["rock", "", None], [])
    assert {tuple(r) for r in matching.match_keys(t, "t", a, "name", "pos").collect()} == {
        ("rock", None, None), ("", None, None), (None, None, None)}
    t, a = _frames(spark, [], ["rock"])
    assert matching.match_keys(t, "t", a, "name", "pos").count() == 0
