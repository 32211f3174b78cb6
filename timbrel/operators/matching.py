"""Tiered key matching: exact, normalised, alias, then most similar."""

from __future__ import annotations

import difflib
import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from timbrel.operators.settled import settled
from timbrel.operators.skew import join_spread

# Spellings that stand for an available key.
KEY_ALIASES = {
    "rnb": "r-n-b",
    "r&b": "r-n-b",
    "hiphop": "hip-hop",
    "hip hop": "hip-hop",
    "edm": "electronic",
    "dnb": "drum-and-bass",
    "drum n bass": "drum-and-bass",
}
SIMILARITY_THRESHOLD = 0.6

# Words are told apart by length classes, each this much longer than the one before.
LENGTH_STEP = 1.25
# Words with the same key in one share of its pairs.
WORDS_PER_SHARE = 4096
# Shared characters that make a key together, and the keys of a word in a length class, at most.
MOST_TOGETHER = 4
MOST_KEYS = 300
# Frequent letters, the most frequent first.
USUAL_LETTERS = "etaoinshrdlcumwfgypbvkjxqz"


def normalise_key(key: Column) -> Column:
    """Lower case, blanks to ``-``, ``&`` to ``n``."""
    return F.replace(F.replace(F.lower(key), F.lit(" "), F.lit("-")), F.lit("&"), F.lit("n"))


def match_tiers(
    targets: DataFrame, target: str, available: DataFrame, candidate: str, position: str, aliases: dict[str, str] = KEY_ALIASES
) -> DataFrame:
    """``(target, match, tier)`` of every distinct target by the first three tiers.

    Each target probes the candidates under up to three keys in one equi-join;
    the lowest tier wins. ``match`` is null where all three miss.
    """
    distinct = targets.select(F.col(target).alias("target")).distinct()
    alias_of = F.create_map(*[F.lit(x) for pair in aliases.items() for x in pair])
    probes = distinct.select(
        "target",
        F.inline(
            F.array(
                F.struct(F.lit(1).alias("tier"), F.col("target").alias("probe")),
                F.struct(F.lit(2).alias("tier"), normalise_key(F.col("target")).alias("probe")),
                F.struct(F.lit(3).alias("tier"), F.try_element_at(alias_of, F.lower("target")).alias("probe")),
            )
        ),
    )
    name = F.col(candidate)
    entries = [F.struct(F.lit(tier).alias("tier"), key.alias("probe")) for tier, key in ((1, name), (2, F.lower(name)), (3, name))]
    index = (
        available.select(name.alias("match"), F.col(position).alias("_pos"), F.inline(F.array(*entries)))
        .groupBy("tier", "probe")
        .agg(F.min_by("match", "_pos").alias("match"))
    )
    return (
        probes.join(index, ["tier", "probe"], "left")
        .groupBy("target")
        .agg(
            F.min_by("match", F.when(F.col("match").isNotNull(), F.col("tier"))).alias("match"),
            F.min(F.when(F.col("match").isNotNull(), F.col("tier"))).alias("tier"),
        )
    )


@F.pandas_udf(T.DoubleType())
def similarity(candidate: pd.Series, target: pd.Series) -> pd.Series:
    """``difflib`` ratio with the target as second sequence."""
    return pd.Series([difflib.SequenceMatcher(None, c, t).ratio() for c, t in zip(candidate, target)])


def _tokens(word: Column) -> Column:
    """Characters with a running number, so that repeats stay distinct; those that are rare by rule come first.

    A higher number is rarer, and so is a letter further down the usual order.
    Any one order for all words serves; this one only makes pairs meet less often.
    """
    chars = F.split(word, "")

    def token(c: Column, i: Column) -> Column:
        number = F.size(F.filter(F.slice(chars, F.lit(1), i + 1), lambda x: x == c))
        return F.struct((-number).alias("again"), (-F.instr(F.lit(USUAL_LETTERS), c)).alias("usual"), c.alias("c"))

    # a letter that is not in the list has place 0 there and must come before the others
    rare = F.array_sort(F.transform(chars, lambda c, i: token(c, i)), _rarer)
    return F.transform(rare, lambda t: F.concat(t["c"], (-t["again"]).cast("string")))


def _rarer(x: Column, y: Column) -> Column:
    """Order of two tokens: higher numbers, then unlisted letters, then those further down the list."""

    def key(t: Column) -> Column:
        return F.struct(t["again"], F.when(t["usual"] == 0, -len(USUAL_LETTERS) - 1).otherwise(t["usual"]).alias("usual"), t["c"])

    return F.when(key(x) < key(y), -1).when(key(x) > key(y), 1).otherwise(0)


def _length_class(length: Column) -> Column:
    return F.floor(F.log(length) / F.lit(math.log(LENGTH_STEP)) + F.lit(1e-9)).cast("int")


def _needed(a: Column, b: Column, threshold: float) -> Column:
    """The characters that words of lengths a and b share if their ratio reaches the threshold."""
    return F.ceil(F.lit(threshold / 2) * (a + b) - F.lit(1e-6))


def _classes(words: DataFrame, threshold: float, wanted: bool) -> DataFrame:
    """``word, tokens, _a, _b, missed, shared``: each word in its length class, for each class of similar words.

    ``_a`` is the class of the wanted word, ``_b`` that of the other one.
    ``missed`` is how many of its tokens a similar word of that class may lack,
    ``shared`` how many all similar words of the two classes share at least.
    """
    own, other = ("_a", "_b") if wanted else ("_b", "_a")
    share = threshold / (2 - threshold)
    length = F.char_length("word")
    classes = F.sequence(F.greatest(F.lit(0), _length_class(length * share)), _length_class(length / share))
    near = words.filter(F.col("wanted") == wanted).select(
        "word", _tokens(F.col("word")).alias("tokens"), _length_class(length).alias(own), F.explode(classes).alias(other))
    least = F.greatest(F.pow(F.lit(LENGTH_STEP), F.col(other)), length * share)
    a, b = (F.ceil(F.pow(F.lit(LENGTH_STEP), F.col(c)) - F.lit(1e-6)) for c in ("_a", "_b"))
    return near.select(
        "word", "tokens", "_a", "_b", F.greatest(length - _needed(length, least, threshold), F.lit(0)).cast("int").alias("missed"),
        F.greatest(_needed(a, b, threshold), F.lit(1)).cast("int").alias("shared"))


def _subsets(tokens: Column, size: Column) -> Column:
    """All subsets of so many tokens, in their order; hashed."""
    grown = F.aggregate(
        tokens, F.array(F.array().cast("array<string>")),
        lambda done, t: F.concat(done, F.transform(F.filter(done, lambda d: F.size(d) < size), lambda d: F.concat(d, F.array(t)))),
    )
    return F.transform(F.filter(grown, lambda d: F.size(d) == size), lambda d: F.xxhash64(d))


def _with_keys(classed: DataFrame) -> DataFrame:
    """One row per key of a word: subsets of ``size`` tokens of its prefix.

    Similar words share all but ``missed`` tokens of either, at least. The first
    ``size`` shared ones are then among the first ``missed + size`` of either
    word, so both have them as a key: no pair is lost.
    """
    prefix = F.slice("tokens", F.lit(1), F.col("missed") + F.col("size"))
    return classed.withColumn("key", F.explode(_subsets(prefix, F.col("size"))))


def _together(threshold: float) -> Column:
    """How many tokens make a key, for length classes ``_a`` and ``_b``: as many as give a word up to ``MOST_KEYS`` keys.

    More tokens make pairs meet less often, and more subsets to send. How many
    subsets there are follows from the lengths alone, so that both sides know
    the number without a look at the data. Any number gives the same result.
    """
    share = threshold / (2 - threshold)

    def missed(own: str, other: str) -> Column:
        longest = F.pow(F.lit(LENGTH_STEP), F.col(own) + 1)
        least = F.greatest(F.pow(F.lit(LENGTH_STEP), F.col(other)), longest * share)
        return F.greatest(F.floor(longest - F.lit(threshold / 2) * (longest + least)), F.lit(0))

    most = F.greatest(missed("_a", "_b"), missed("_b", "_a"))
    subsets, out = F.lit(1.0), F.lit(1)
    for k in range(1, MOST_TOGETHER + 1):
        subsets = subsets * (most + k) / k
        out = F.when(subsets <= MOST_KEYS, k).otherwise(out)
    return out


def met_pairs(words: DataFrame, threshold: float, words_per_share: int = WORDS_PER_SHARE, together: int | None = None) -> DataFrame:
    """``target, match, _left, _right, key, size``: the pairs that meet, some more than once, before any of them leaves."""
    chosen = _together(threshold) if together is None else F.lit(together)
    left, right = (
        _with_keys(_classes(words, threshold, wanted).withColumn("size", F.least(chosen, F.col("shared"))))
        for wanted in (True, False)
    )
    left = left.select(F.col("word").alias("target"), F.col("tokens").alias("_left"), "_a", "_b", "size", "key")
    right = right.select(F.col("word").alias("match"), F.col("tokens").alias("_right"), "_a", "_b", "key")
    hot = right.groupBy("_a", "_b", "key").agg(F.count("*").alias("n")).filter(F.col("n") > words_per_share)
    hot = hot.select("_a", "_b", "key", (F.floor(F.col("n") / words_per_share) + 1).cast("int").alias("_shares"))
    keys, shares = ["_a", "_b", "key"], F.coalesce("_shares", F.lit(1))
    left = left.join(hot, keys, "left").withColumn("_share", F.explode(F.sequence(F.lit(0), shares - 1))).drop("_shares")
    right = right.join(hot, keys, "left").withColumn("_share", F.pmod(F.xxhash64("match"), shares).cast("int")).drop("_shares")
    return left.join(right, [*keys, "_share"])


def similar_pairs(
    words: DataFrame,
    threshold: float = SIMILARITY_THRESHOLD,
    words_per_share: int = WORDS_PER_SHARE,
    together: int | None = None,
) -> DataFrame:
    """``(target, match)``: the pairs of ``(word, wanted)`` rows that are worth scoring, each once.

    Words meet within their length classes through the rarest characters that
    they share, several of them together: how many follows from the number of
    keys this costs (``together`` sets it). A pair stays where it met by the first of its shared
    characters, and where enough are shared for the threshold. The words of a
    frequent key are split in shares.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold lies above 0 and is at most 1")
    common = F.array_intersect("_left", "_right")
    enough = F.size(common) >= _needed(F.char_length("target"), F.char_length("match"), threshold)
    first = F.xxhash64(F.slice(common, F.lit(1), F.col("size")))
    return met_pairs(words, threshold, words_per_share, together).filter(enough & (first == F.col("key"))).select("target", "match")


def closest(
    targets: DataFrame, target: str, available: DataFrame, candidate: str, threshold: float = SIMILARITY_THRESHOLD, **split
) -> DataFrame:
    """``(target, match)``: the most similar candidate of every distinct target that has one.

    Only :func:`similar_pairs` are scored; of equal scores the larger word wins.
    """
    # both sides are read more than once; plain tables stay where they are
    wanted = settled(targets.select(F.col(target).alias("word")), "wanted").withColumn("wanted", F.lit(True))
    offered = settled(available.select(F.col(candidate).alias("word")), "offered").withColumn("wanted", F.lit(False))
    words = wanted.unionAll(offered).filter("word <> ''").distinct()
    return (
        similar_pairs(words, threshold, **split)
        .withColumn("score", similarity("match", "target"))
        .filter(F.col("score") >= threshold)
        .groupBy("target")
        .agg(F.max(F.struct("score", "match")).alias("_best"))
        .select("target", F.col("_best.match").alias("match"))
    )


def match_keys(
    targets: DataFrame,
    target: str,
    available: DataFrame,
    candidate: str,
    position: str,
    aliases: dict[str, str] = KEY_ALIASES,
    threshold: float = SIMILARITY_THRESHOLD,
    words_per_share: int = WORDS_PER_SHARE,
) -> DataFrame:
    """``(target, match, tier)`` with all four tiers; ``match`` is null without any.

    Only distinct targets left over by the first three tiers are compared by
    similarity, in one way for any number of candidates.
    """
    tiers = settled(match_tiers(targets, target, available, candidate, position, aliases), "tiers")
    probed = tiers.withColumn("_probe", F.when(F.col("match").isNull(), normalise_key(F.col("target"))))
    pairs = closest(probed, "_probe", available, candidate, threshold, words_per_share=words_per_share)
    return probed.join(pairs.toDF("_probe", "_found"), "_probe", "left").select(
        "target",
        F.coalesce("match", "_found").alias("match"),
        F.coalesce("tier", F.when(F.col("_found").isNotNull(), F.lit(4))).alias("tier"),
    )


def tag_matches(df: DataFrame, column: str, matches: DataFrame) -> DataFrame:
    """Every row with the match and tier of its key; a key in very many rows is split."""
    return join_spread(df, matches.withColumnRenamed("target", column), column, "left")


def unmatched(matches: DataFrame) -> DataFrame:
    return matches.filter(F.col("match").isNull()).select("target")
