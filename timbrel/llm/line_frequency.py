"""Quality rules by cross-document line frequency, with the plain counts of a text beside them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timbrel.llm.rows import SPACE, WORD, field, keyed, text_of, without, written

#: A line is too frequent in more than this share of a host's distinct documents, and in more than this many.
LINE_SHARE, LINE_DOCUMENTS = 0.005, 20
#: A document is depleted when less than this share of its characters is left.
LEFT = 0.25
#: The least number of words, and the most words in repeated windows, in hundredths.
MIN_WORDS, MAX_REPEATED = 50, 50
#: Shares into which the rows with a frequent line are split.
LINE_SHARES = 16


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, also where ``use`` reads it for each item."""
    return F.transform(F.array(value), use)[0]


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _plain(line: Column) -> Column:
    """A line as it is compared between documents: without white space and case."""
    return F.lower(F.regexp_replace(line, SPACE, ""))


def _with_word(lines: Column) -> Column:
    return F.filter(lines, lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def _repeated(words: Column) -> Column:
    """Words in windows of three words that occur twice or more.

    Windows are compared by hash; only texts in which two of them are equal
    have theirs sorted, so that equal ones stand side by side.
    """

    def covered(found: Column) -> Column:
        places = F.filter(
            found,
            lambda x, i: (F.get(found, i - 1)["h"] == x["h"]) | (F.get(found, i + 1)["h"] == x["h"]),
        )
        return F.size(F.array_distinct(F.flatten(F.transform(places, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))

    def windows(w: Column) -> Column:
        return F.slice(F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2))), 1, F.size(w) - 2)

    def sort(h: Column) -> Column:
        return F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

    def count(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(_bound(sort(h), covered))

    return F.when(F.size(words) < 4, F.lit(0)).otherwise(_bound(windows(words), count))


def text_counts(text: Column) -> list[Column]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    both = _bound(words, lambda w: F.struct(F.size(w).alias("n"), _repeated(w).alias("r")))
    dup = _bound(_with_word(_lines(text)), lambda x: F.size(x) - F.size(F.array_distinct(x)))
    return [
        both.alias("words"),
        F.char_length(F.regexp_replace(text, SPACE, "")).cast("bigint").alias("word_chars"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        dup.cast("bigint").alias("n_dup_lines"),
    ]


def hashed_lines(rows: DataFrame) -> DataFrame:
    """row, host, text (hash), line (hash), chars: the normalised lines with a word, as a written table."""
    text = text_of(rows)
    plain = F.transform(_with_word(_lines(text)), _plain)
    lines = rows.select(
        "row", field("source", rows, "string").alias("host"), F.unhex(F.md5(text)).alias("text"),
        F.explode(plain).alias("plain"))
    hashed = lines.select("row", "host", "text", F.unhex(F.md5("plain")).alias("line"), F.char_length("plain").alias("chars"))
    return written(hashed, "hashed-lines")


def frequent_lines(lines: DataFrame, share: float = LINE_SHARE, least: int = LINE_DOCUMENTS) -> DataFrame:
    """host, line (hash) of the lines above the limits of their host.

    A document counts once for each line, and equal texts count as one document.
    """
    counts = lines.select("host", "text", "line").distinct().groupBy("host", "line").agg(F.count("*").alias("n"))
    hosts = lines.select("host", "text").distinct().groupBy("host").agg(
        F.greatest(F.lit(float(least)), share * F.count("*")).alias("limit"))
    named = hosts.withColumnRenamed("host", "of")
    many = counts.filter(F.col("n") > least).join(named, F.col("host").eqNullSafe(F.col("of")))
    return many.filter("n > limit").select("host", "line")


def removed_lines(rows: DataFrame, **limits) -> DataFrame:
    """row, removed: the hashes of its lines above the limits, and chars: how many characters they hold."""
    lines = hashed_lines(rows)
    shares = F.explode(F.sequence(F.lit(0), F.lit(LINE_SHARES - 1)))
    right = frequent_lines(lines, **limits).select(F.col("host").alias("of"), "line", shares.alias("share"))
    left = lines.select(
        "row", "host", "line", "chars", F.pmod(F.xxhash64("row"), F.lit(LINE_SHARES)).cast("int").alias("share"))
    found = left.join(right, ["line", "share"]).filter(F.col("host").eqNullSafe(F.col("of")))
    return found.groupBy("row").agg(F.collect_set("line").alias("removed"), F.sum("chars").alias("chars"))


def line_rules(docs: DataFrame, left: float = LEFT, **limits) -> DataFrame:
    """One row per row of ``docs``: row, doc_id, the counts, removed_chars, base_failed, kept.

    Normalised lines are hashed and counted over the distinct documents of
    their host (``source``; null is a host of its own). A line above the limits
    counts as removed, and a document with less than ``left`` of its characters
    left is rejected, as is one that fails the plain rules: fewer than 50 words,
    or over half its words in repeated windows of three. A null text has no
    words and fails; an empty table gives an empty result; rows that repeat a
    doc_id are judged one by one.
    """
    rows = docs if "doc" in docs.columns and "row" in docs.columns else keyed(docs)
    counts = rows.select("row", field("doc_id", rows, "bigint").alias("doc_id"), *text_counts(text_of(rows))).select(
        "row", "doc_id", F.col("words.n").cast("bigint").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines",
        F.col("words.r").cast("bigint").alias("n_repeat_words"))
    removed = removed_lines(rows, **limits).select("row", F.col("chars").alias("removed_chars"))
    judged = counts.join(removed, "row", "left").fillna(0, ["removed_chars"])
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    depleted = F.col("word_chars") - F.col("removed_chars") < left * F.col("word_chars")
    return judged.withColumn("base_failed", failed).withColumn("kept", ~failed & ~depleted)


def without_frequent_lines(docs: DataFrame, **limits) -> DataFrame:
    """row, doc and ``cleaned``: the text without the lines above the limits."""
    rows = keyed(docs)
    cut = rows.join(removed_lines(rows, **limits).select("row", "removed"), "row", "left")
    keep = F.filter(_lines(text_of(rows)), lambda x: ~F.array_contains("removed", F.unhex(F.md5(_plain(x)))))
    cleaned = F.when(F.col("removed").isNull(), text_of(rows)).otherwise(F.array_join(keep, "\n"))
    return cut.select("row", "doc", cleaned.alias("cleaned"))


def drop_low_quality(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their columns."""
    rows = keyed(docs)
    return without(rows, line_rules(rows).filter("not kept").select("row")).select("doc.*")
