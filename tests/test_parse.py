"""Literal cases, and generated answers whose content is known."""

import json
import random

import pytest
from pyspark.sql import functions as F

from timbrel.functions import parse
from timbrel.functions.errors import is_error
from timbrel.functions.text import fill_template, strip
from timbrel.schemas import LAYERS

NOTHING = ([], [], [])


def layered(low=None, mid=None, top=None):
    """An answer with these layers, and what has to come out of it."""
    given = [(n, x) for n, x in zip(LAYERS, (low, mid, top)) if x is not None]
    return json.dumps(dict(given)), (low or [], mid or [], top or [])


ONE = layered(["drone", "rain"], ["oboe"], ["alto"])
TWO = layered(["tabla"], [], ["sitar"])
CASES = [
    ONE,
    ("I can hear these.\n\n" + TWO[0] + "\n\nThat is all of it.", TWO[1]),
    layered([], [], []),
    layered(low=["theremin"]),
    ("nothing but words", NOTHING),
    (ONE[0][:-9], NOTHING),
    (ONE[0] + " or else " + TWO[0], NOTHING),
    ('{"background": null, "foreground": ["x"]}', NOTHING),
    ("} {", NOTHING),
    ('{"background": "guitar", "foreground": ["x"]}', NOTHING),
    ('{"background": ["a"]}][{"foreground": ["b"]}', NOTHING),
    ('{"background": ["a"]}} x {"foreground": {}}', NOTHING),
    ('{"background": ["a"]}, "foreground": {"b": 1}', NOTHING),
    ("{'background': ['a']}", NOTHING),
    ("", NOTHING),
    ('{"background": [{"a": 1}], "foreground": ["x"]}', NOTHING),
    ('{"middle_ground": [["n"]], "foreground": ["x"]}', NOTHING),
    ('{"background": ["a [b] {c}"], "foreground": ["x]"]}', (["a [b] {c}"], [], ["x]"])),
]


@pytest.mark.parametrize("exact", [False, True])
def test_lists(spark, exact):
    cases = {
        "x ['drums', 'piano'] y": (["drums", "piano"], ["drums", "piano"]),
        "just text\n": (["just text"], []),
        "['a'": (["['a'"], []),
        "[]": ([], []),
        '["a", "a"]': (["a", "a"], ["a"]),
        "['a'] and ['b']": (["['a'] and ['b']"], []),
        "] none [": (["] none ["], []),
    }
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    rows = df.select("t", parse.parse_list(F.col("t"), exact).alias("l"), parse.parse_set(F.col("t"), exact).alias("s"))
    for r in rows.collect():
        assert (r.l, r.s) == cases[r.t], r.t


def test_literal_lists_need_exact(spark):
    df = spark.createDataFrame([("['a',]",), ("['it\\'s', 'b']",), ("['a' 'b']",)], "t string")
    native = df.select(parse.parse_list(F.col("t"))).collect()
    exact = df.select(parse.parse_list(F.col("t"), exact=True)).collect()
    assert [r[0] for r in native] == [["['a',]"], ["it's", "b"], ["['a' 'b']"]]
    assert [r[0] for r in exact] == [["a"], ["it's", "b"], ["ab"]]


def test_layer_cases(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, t string")
    rows = df.select("i", parse.parse_layers(F.col("t")).alias("l")).orderBy("i").collect()
    for r, (text, want) in zip(rows, CASES):
        assert tuple(r.l[n] for n in LAYERS) == want, text


def test_repeats_and_null_answer(spark):
    text = '{"background": ["a", "a"], "middle_ground": ["b"], "foreground": ["a"]}'
    df = spark.createDataFrame([(text,), (None,)], "t string")
    rows = df.select(parse.parse_layers(F.col("t")).alias("l")).select(
        "l.background", parse.flatten_layers(F.col("l")).alias("f")
    )
    assert [tuple(r) for r in rows.collect()] == [(["a", "a"], ["a", "b"]), ([], [])]


def test_lenient(spark):
    df = spark.createDataFrame(
        [('{"background": null, "foreground": ["x"]}',), ('{"background": ["x"',)], "t string"
    )
    rows = [r.l for r in df.select(parse.parse_layers_lenient(F.col("t")).alias("l")).collect()]
    assert rows[0].asDict() == {"background": None, "middle_ground": [], "foreground": ["x"]}
    assert rows[1].asDict() == {"background": [], "middle_ground": [], "foreground": []}


WORDS = ["piano", "kick drum", 'qu"ote', "back\\slash", "é", "a,b", "", "{x}", "[y]", "]", "}"]


def _answer(rng):
    """A text and its layers: the generator knows what it breaks."""
    given, want = {}, {n: [] for n in LAYERS}
    sound = True
    for name in LAYERS:
        kind = rng.random()
        if kind < 0.7:
            given[name] = want[name] = [rng.choice(WORDS) for _ in range(rng.randrange(3))]
        elif kind < 0.8:
            given[name] = rng.choice([None, "text", 3, {"k": "v"}, [["n"]], ["m", {"k": 1}]])
            sound = False
    if rng.random() < 0.2:
        given["other"] = rng.choice([1, None, [1, 2], {"a": {"b": []}}])
    text = json.dumps(given, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 2]))
    harm = rng.choice(["none"] * 6 + ["cut", "twice", "open", "single"])
    if harm == "cut":  # the closing brace is lost, and no other one is left to stand in for it
        text = text[:-1].replace("}", "")
    elif harm == "twice":
        text += rng.choice([" and ", ",", "][", "}} ", '}, "foreground": ']) + text
    elif harm == "open":
        text = "{" + text
    elif harm == "single":
        text = text.replace("{", "{'", 1) if text != "{}" else "{'}"
    sound = sound and harm == "none"
    text = rng.choice(["", "Sure: ", "```json\n", "[", "} "]) + text + rng.choice(["", "\n```", " done.", "]"])
    return text, tuple(want[n] for n in LAYERS) if sound else NOTHING


def test_generated_answers(spark):
    rng = random.Random(5)
    cases = [_answer(rng) for _ in range(4000)]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, t string")
    rows = df.select("i", parse.parse_layers(F.col("t")).alias("l")).collect()
    wrong = [(cases[r.i], got) for r in rows if (got := tuple(r.l[n] for n in LAYERS)) != cases[r.i][1]]
    assert not wrong, wrong[:3]


def _listed(rng):
    """A text with a list of quoted words, and the items: those of the list, or the whole text if it is broken."""
    items = [rng.choice(["a", "b c", "d", "é", "", "[x]"]) for _ in range(rng.randrange(4))]
    quoted = [f'"{x}"' if x == "d" else f"'{x}'" for x in items]
    body = "[" + ", ".join(quoted) + "]"
    harm = rng.choice(["none"] * 4 + ["cut", "twice"])
    if harm == "cut":
        body = body[:-1].replace("]", ")")
    elif harm == "twice":
        body += rng.choice([" ", " or ", "]["]) + "['z']"
    text = rng.choice(["", "I hear ", "\n "]) + body + rng.choice(["", " ok\n"])
    if harm == "twice" and "]['z']" in body and not items:
        return _listed(rng)
    return text, items if harm == "none" else [text.strip()]


def test_generated_lists(spark):
    rng = random.Random(6)
    cases = [_listed(rng) for _ in range(1500)]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, t string")
    rows = df.select("i", parse.parse_list(F.col("t")).alias("n"), parse.parse_list(F.col("t"), True).alias("e")).collect()
    for r in rows:
        assert r.e == cases[r.i][1], cases[r.i]
        assert r.n == cases[r.i][1], cases[r.i]


def test_real_errors(spark):
    cases = {
        "": False, "nan": False, "  ": False, "\n\t": False, " ": False,
        "Preprocessing failed: invalid format": True, "Error: file not found": True,
    }
    df = spark.createDataFrame([(e,) for e in [*cases, None]], "e string")
    for r in df.select("e", is_error(F.col("e")).alias("x")).collect():
        assert r.x == cases.get(r.e, False), r.e


def test_strip_like_python(spark):
    texts = ["\x1c a　", "  x\x85", " \tb c\r\n", "", "\x0b\x0c"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    for r in df.select("i", strip(F.col("t")).alias("s")).collect():
        assert r.s == texts[r.i].strip()


def test_clock(spark):
    cases = {"0:00": 0, "1:30": 90, "1:02:03": 3723, "end": None, "x:1": None, None: None}
    df = spark.createDataFrame([(c,) for c in cases], "c string")
    for r in df.select("c", parse.clock_seconds(F.col("c")).alias("s")).collect():
        assert r.s == cases[r.c]


def test_template_is_not_scanned_again(spark):
    template = "A {x} {{y}} {y}."
    df = spark.createDataFrame([("{y}", "{{x}}")], "x string, y string")
    got = df.select(fill_template(template, x=F.col("x"), y=F.col("y"))).first()[0]
    assert got == template.format(x="{y}", y="{{x}}")


def test_embedded_page_without_nodes(spark):
    pages = ["no script", "<script>var ytInitialData = {\"contents\": {}};</script>", "var ytInitialData = {broken};"]
    df = spark.createDataFrame([(p,) for p in pages], "p string")
    rows = df.select(F.inline_outer(parse.embedded_videos(F.col("p"), 3))).collect()
    assert all(r.video_id is None for r in rows)
