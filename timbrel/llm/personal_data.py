"""Personal data: high-recall candidate spans, boosted trees over their format and context, calibrated thresholds."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from timbrel.llm.line_frequency import _bound
from timbrel.llm.rows import field, keyed, sieve, sifted, text_of, written

#: Kinds in their fixed order.
KINDS = ("email", "ip", "card", "phone")
#: The base patterns (fixed values, written so that the matcher neither recurses nor scans a run twice).
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"[0-9]+(?:\.[0-9]+){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Wider patterns: spelled-out or bracketed separators, other groupings, no country code.
WIDE = {
    "email": (
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?:@| ?[\[({] ?(?:at|AT|@) ?[\])}] ?| at | AT )[A-Za-z0-9-]++"
        r"(?:(?:\.| ?[\[({] ?(?:dot|DOT|\.) ?[\])}] ?| dot | DOT )[A-Za-z0-9-]++)+"
    ),
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:(?:\.| ?[\[({](?:\.|dot)[\])}] ?)[0-9]{1,3}){3}",
    "card": r"[0-9](?:[\x20./-]{0,2}[0-9]){12,18}",
    "phone": r"(?<![0-9A-Za-z+])(?:\+|00[\x20-]?)?\(?[0-9]{1,4}\)?(?:[\x20./-]{1,2}\(?[0-9]{2,4}\)?){2,4}",
}
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
_CONTEXT = {
    "email": "mail|contact|write|reply",
    "ip": "ip|host|server|from|login",
    "card": "card|visa|credit|pay|account",
    "phone": "call|phone|tel|fax|mobile",
}
#: Rounds of boosting, step, and the share of positives among what is selected of the documents left out.
ROUNDS, STEP, PRECISION = 24, 0.4, 0.9
#: One document in so many is left out of the fit and sets the threshold.
FOLDS = 4
#: Features of a candidate; the trees see counts per pattern of them.
N_BITS = 14


def _matches(text: Column, pattern: str) -> Column:
    """Matches with the length of the text before each, since the last one, and what surrounds it."""
    both = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"), F.split(text, pattern, -1).alias("p"))
    return _bound(both, lambda b: F.transform(b["m"], lambda m, i: F.struct(
        m.alias("m"), F.char_length(F.get(b["p"], i)).alias("gap"), F.right(F.get(b["p"], i), F.lit(24)).alias("before"),
        F.left(F.get(b["p"], i + 1), F.lit(4)).alias("after"))))


def _luhn(digits: Column) -> Column:
    doubled = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        F.when(c.cast("int") > 4, 2 * c.cast("int") - 9).otherwise(2 * c.cast("int"))))
    total = F.aggregate(doubled, F.lit(0), lambda a, x: a + x)
    return F.when(F.char_length(digits).between(12, 19), total % 10 == 0).otherwise(F.lit(False))


def _features(kind: Column, m: Column, digits: Column, before: Column, after: Column) -> list[Column]:
    """What is known of a candidate by its format and what surrounds it."""
    n = F.char_length(digits)
    own = F.lit(False)
    for k, words in _CONTEXT.items():
        own = F.when(kind == k, F.lower(before).rlike(words)).otherwise(own)
    plain = F.regexp_replace(m, r" ?[\[({](?:\.|dot)[\])}] ?", ".")
    return [
        _luhn(digits), n.between(13, 19), n.between(9, 15), n.between(7, 12), plain.rlike(rf"^(?:{_PART}\.){{3}}{_PART}$"),
        before.rlike(r"[A-Za-z0-9.]$"), after.rlike(r"^[A-Za-z0-9@]"),
        m.rlike(r"(?:\.|(?i:dot)[\])}]? ?|[\])}] ?)[A-Za-z]{2,12}$"),
        m.rlike(r"(?i)[\[({] ?(?:at|@|dot|\.) ?[\])}]"), m.rlike(r"(?i) at .* dot |\Wat\W.*\Wdot\W"),
        m.rlike(r"^(?:00[\x20-]?[0-9]{1,3}[\x20.-])?\(?[0-9]{2,4}\)?[\x20/.-][0-9]{3,4}[\x20.-][0-9]{3,4}$"),
        m.rlike(r"^(?:[0-9]{1,4}[./-][0-9]{1,2}[./-][0-9]{1,4}|[0-9]{1,3}(?:\.[0-9]{1,3}){2,4})$"),
        own, m.rlike(r"^(?:[0-9]{4}[\x20./-]{0,2}){3}[0-9]{1,7}$"),
    ]


def _bits(kind: Column, m: Column, before: Column, after: Column) -> Column:
    flags = _features(kind, m, F.regexp_replace(m, "[^0-9]", ""), before, after)
    return sum((F.when(f, F.lit(1 << k)).otherwise(F.lit(0)) for k, f in enumerate(flags)), F.lit(0))


def _whole_matches(values: Column, pattern: str) -> Column:
    return F.filter(values, lambda v: v.rlike(f"^(?:{pattern})$"))


def _disguised(kind: Column, m: Column) -> Column:
    """Other ways to write a base span, none of which is a base span of its kind."""
    def written_as(at: str, dot: str) -> Column:
        return F.replace(F.replace(m, F.lit("."), F.lit(dot)), F.lit("@"), F.lit(at))

    digits = F.regexp_replace(m, "[^0-9]", "")
    fours = [F.regexp_replace(digits, r"([0-9]{4})(?=[0-9])", f"$1{sep}") for sep in (".", "  ", "/", "--")]
    national = F.regexp_replace(m, r"^\+[0-9]{1,3}[\x20.-]?", "")
    bare = F.regexp_replace(national, r"[()]", "")
    forms = {
        "email": [written_as("[at]", "[dot]"), written_as(" (at) ", " (dot) "), written_as(" at ", " dot "), written_as("{at}", "."), written_as("[at]", ".")],
        "ip": [F.replace(m, F.lit("."), F.lit(x)) for x in ("[.]", "(.)", "[dot]", " [.] ")],
        "card": fours,
        "phone": [national, bare, F.regexp_replace(bare, r"[\x20-]", "."), F.regexp_replace(m, r"^\+", "00"), F.regexp_replace(m, r"^\+", "00 ")],
    }
    out = F.array().cast("array<string>")
    for k, ways in forms.items():
        # what its own generator would not propose is nothing to learn from
        out = F.when(kind == k, _whole_matches(F.array(*ways), WIDE[k])).otherwise(out)
    return out


def candidates(rows: DataFrame) -> DataFrame:
    """row, kind (its place in KINDS), base, valid, start, end, bits, disguised: all matches of all generators, as a written table.

    ``valid`` tells base spans from matches of a base pattern that fail their
    check. ``disguised`` has the bits of other ways to write either where it
    stands. ``never`` marks wider candidates that can be no such thing: dates,
    versions, numbers that fail their check.
    """
    text = text_of(rows)
    some = text.rlike(r"(?i)[0-9@]|[\[({] ?at ?[\])}]| at .* dot ")
    names = [(k, base) for base in (True, False) for k in KINDS]
    found = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(base).alias("base"),
                               _matches(F.col("text"), (BASE if base else WIDE)[k]).alias("found")) for k, base in names])
    per = rows.filter(some).select("row", text.alias("text")).select("row", F.explode(found).alias("g"))
    each = per.select("row", "g.kind", "g.base", F.posexplode("g.found").alias("i", "x"))
    each = each.select("row", "kind", "base", "i", "x.*", F.regexp_replace("x.m", "[^0-9]", "").alias("digits"))
    upto = Window.partitionBy("row", "kind", "base").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.char_length("m")).over(upto)
    kind, n = F.col("kind"), F.char_length("digits")
    valid = (
        F.when(kind == "ip", F.col("m").rlike(rf"^(?:{_PART}\.){{3}}{_PART}$"))
        .when(kind == "card", n.between(13, 19) & _luhn(F.col("digits")))
        .when(kind == "phone", n.between(9, 15))
        .otherwise(F.lit(True))
    )
    before, after = F.col("before"), F.col("after")
    ways = F.when(F.col("base"), F.transform(_disguised(kind, F.col("m")), lambda v: _bits(kind, v, before, after)))
    number = F.array_position(F.array(*map(F.lit, KINDS)), kind) - 1
    shape = F.col("m").rlike(r"^(?:[0-9]{4}[./-][0-9]{1,2}[./-][0-9]{1,2}|[0-9]{1,2}[./-][0-9]{1,2}[./-][0-9]{4}|[0-9]{1,3}(?:\.[0-9]{1,3}){2,4})$")
    never = (
        F.when(kind == "card", ~(n.between(13, 19) & _luhn(F.col("digits"))))
        .when(kind == "phone", shape | ~n.between(7, 15))
        .when(kind == "ip", ~F.regexp_replace("m", r"[^0-9]+", ".").rlike(rf"^(?:{_PART}\.){{3}}{_PART}$"))
        .when(kind == "email", ~F.col("m").rlike(r"[^A-Za-z][A-Za-z]{2,}$"))
        .otherwise(F.lit(False))
    )
    placed = each.withColumns({"end": end, "valid": F.coalesce(valid, F.lit(False)), "never": F.coalesce(never, F.lit(False))})
    placed = placed.withColumns({"bits": _bits(kind, F.col("m"), before, after), "disguised": ways, "number": number.cast("int")})
    return written(placed.select(
        "row", F.col("number").alias("kind"), "base", "valid", "never", (F.col("end") - F.char_length("m")).alias("start"), "end", "bits", "disguised",
    ), "pii-candidates")


def beside_base(spans: DataFrame) -> DataFrame:
    """Adds ``near``: the candidate overlaps a base span, of any kind, in its text."""
    base_end, base_start = F.when(F.col("base"), F.col("end")), F.when(F.col("base"), F.col("start"))
    order = Window.partitionBy("row").orderBy("start", "end", "kind", "base")
    up = F.max(base_end).over(order.rowsBetween(Window.unboundedPreceding, 0))
    down = F.min(base_start).over(order.rowsBetween(0, Window.unboundedFollowing))
    near = (F.coalesce(up, F.lit(-1)) > F.col("start")) | (F.coalesce(down, F.lit(1 << 60)) < F.col("end"))
    return spans.withColumn("near", near)


def _grow(cells: list[list[float]], n_bits: int) -> tuple:
    """The tree of depth two with the largest gain; cells have bits, gradient and curvature."""

    def split(part: list[list[float]]) -> tuple[float, int]:
        best = (-1.0, 0)
        for f in range(n_bits):
            sides = [[0.0, 1.0], [0.0, 1.0]]
            for bits, g, h in part:
                side = sides[int(bits) >> f & 1]
                side[0] += g
                side[1] += h
            best = max(best, (sum(g * g / h for g, h in sides), -f))
        return best[0], -best[1]

    def leaf(part: list[list[float]]) -> float:
        return STEP * sum(c[1] for c in part) / (1.0 + sum(c[2] for c in part))

    root = split(cells)[1]
    out = []
    for side in (0, 1):
        part = [c for c in cells if int(c[0]) >> root & 1 == side]
        f = split(part)[1] if part else 0
        out.append((f, *[leaf([c for c in part if int(c[0]) >> f & 1 == s]) for s in (0, 1)]))
    return root, out[0], out[1]


def _value(trees: list[tuple], bits: int) -> float:
    total = 0.0
    for root, *sides in trees:
        f, low, high = sides[bits >> root & 1]
        total += high if bits >> f & 1 else low
    return total


def boost(
    cells: list[tuple[int, int, int]], left_out: list[tuple[int, int, int]] | None = None, n_bits: int = N_BITS, rounds: int = ROUNDS
) -> tuple[list[tuple], float | None]:
    """Trees fitted on (bits, rows, positives), and the threshold above which positives have the wanted share.

    The threshold is set on ``left_out``, the counts of other documents; None if
    no threshold gives that share there.
    """
    trees: list[tuple] = []
    for _ in range(rounds):
        step = []
        for bits, n, positive in cells:
            p = 1 / (1 + math.exp(-_value(trees, bits)))
            step.append([bits, positive - n * p, n * p * (1 - p)])
        trees.append(_grow(step, n_bits))
    threshold, n_all, p_all = None, 0, 0
    judged = cells if left_out is None else left_out
    scored = sorted(((round(_value(trees, bits), 9), n, positive) for bits, n, positive in judged), reverse=True)
    for k, (score, n, positive) in enumerate(scored):
        n_all, p_all = n_all + n, p_all + positive
        last = k + 1 == len(scored) or scored[k + 1][0] < score
        if last and score > 0 and p_all >= PRECISION * n_all:
            threshold = score - 1e-6
    return trees, threshold


def _score(trees: list[tuple]) -> Column:
    """The trees as one expression over ``bits``."""

    def on(f: int) -> Column:
        return F.getbit(F.col("bits").cast("bigint"), F.lit(f)) == 1

    total = F.lit(0.0)
    for root, (f, a, b), (g, c, d) in trees:
        total = total + F.when(on(root), F.when(on(g), d).otherwise(c)).otherwise(F.when(on(f), b).otherwise(a))
    return total


def selected(rows: DataFrame) -> DataFrame:
    """row, kind, base, start, end of all spans to redact: the base ones, and those the trees select.

    Positives are base spans in disguise, where they stand: with spelled-out or
    bracketed separators, another grouping, no country code; as such they have
    no base form, so the trees cannot learn that. Negatives are matches of the
    base patterns that fail their check, disguised in the same ways, and wider
    candidates that can be no such thing (dates, versions, failing numbers). All
    others are open, and are what the trees decide. Both are counted over all
    documents by pattern of features; a quarter of the documents is left out of
    the fit and sets the threshold of each kind.
    """
    found = candidates(rows)
    spans = written(beside_base(found.filter("not base or valid")), "pii-spans")
    fold = (F.pmod(F.xxhash64("row"), F.lit(FOLDS)) == 0).alias("out")
    disguised = found.filter("base").select("kind", F.explode("disguised").alias("bits"), fold, F.col("valid").cast("int").alias("p"))
    look_alikes = spans.filter("not base and not near and never").select("kind", "bits", fold, F.lit(0).alias("p"))
    table = disguised.unionByName(look_alikes).groupBy("kind", "bits", "out").agg(F.count("*").alias("n"), F.sum("p").alias("p")).collect()
    wide = spans.filter("not base")
    keep = F.lit(False)
    for kind in range(len(KINDS)):  # at most two rows per pattern of the features
        fit, out = (sorted((r.bits, r.n, r.p) for r in table if r.kind == kind and r.out == o) for o in (False, True))
        if any(p for _, _, p in fit):
            trees, threshold = boost(fit, out)
            if threshold is not None:
                keep = F.when(F.col("kind") == kind, _score(trees) >= threshold).otherwise(keep)
    more = wide.filter("not near and not never").filter(keep)
    return spans.filter("base").union(more).select("row", "kind", "base", "start", "end").distinct()


def personal_data(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: row, doc_id, spans (array of kind, start, end, base; code points, end exclusive).

    Base spans are the leftmost non-overlapping matches of the base patterns
    that pass their check; the boosted trees add others. A null text counts as
    empty and has no spans; without base spans of a kind nothing is learnt or
    added for it; an empty table gives an empty result; rows that repeat a
    doc_id are read one by one; other columns are ignored. A very long text is
    matched as a whole by patterns that do not go back over it.
    """
    rows = docs if "doc" in docs.columns and "row" in docs.columns else keyed(docs)
    spans = selected(rows).groupBy("row").agg(F.sort_array(F.collect_list(F.struct("kind", "start", "end", "base"))).alias("spans"))
    ids = rows.select("row", field("doc_id", rows, "bigint").alias("doc_id"))
    none = F.array().cast("array<struct<kind:int,start:bigint,end:bigint,base:boolean>>")
    return ids.join(spans, "row", "left").select("row", "doc_id", F.coalesce("spans", none).alias("spans"))


def span_list(spans: Column) -> Column:
    """kind:start:end of each, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame) -> DataFrame:
    """row, doc and ``redacted``: the text with every selected span replaced by its kind in brackets."""
    rows = keyed(docs)
    spans = personal_data(rows).filter(F.size("spans") > 0).select("row", "spans")
    marked = sifted(rows, "row", sieve(spans, "row"))
    names = F.array(*[F.lit(f"[{k}]") for k in KINDS])
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))
    text = text_of(rows)

    def cut(state: Column, s: Column) -> Column:
        inside = s["end"] <= state["at"]
        begin = F.greatest(s["start"], state["at"])
        piece = F.substring(text, (state["at"] + 1).cast("int"), (begin - state["at"]).cast("int"))
        return F.struct(
            F.when(inside, state["at"]).otherwise(s["end"]).alias("at"),
            F.when(inside, state["out"]).otherwise(F.concat(state["out"], piece, F.get(names, s["kind"]))).alias("out"))

    by_start = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"], s["end"], s["kind"])))
    done = F.aggregate(by_start, start, cut, lambda x: F.concat(x["out"], F.substring(text, (x["at"] + 1).cast("int"), F.lit(2**31 - 1))))
    doubt = marked.filter("maybe").join(spans, "row", "left")
    changed = doubt.select("row", "doc", F.when(F.col("spans").isNull(), text).otherwise(done).alias("redacted"))
    return marked.filter("not maybe").select("row", "doc", text.alias("redacted")).union(changed)
