"""Line dedup by content-defined chunks of lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timbrel.llm.line_frequency import _bound
from timbrel.llm.rows import field, keyed, sieve, sifted, text_of, with_groups, written

#: A chunk ends where the rolling hash of so many lines leaves no remainder; one line in SPACING does.
ROLL, SPACING = 2, 3
#: The least number of lines of a chunk that may go.
LEAST = 2
#: What a chunk that may go has.
WORDS = r"[^\x20\x09-\x0D]"


def chunk_bounds(lines: Column) -> Column:
    """Where each chunk begins, and the number of lines at the end: places after lines whose rolling hash fits.

    A place depends on the ROLL lines before it alone, so lines added or lost
    elsewhere do not move it.
    """

    def cuts(h: Column) -> Column:
        def ends(i: Column) -> Column:
            rolled = F.lit(0).cast("bigint")
            for k in range(ROLL):
                rolled = F.xxhash64(rolled, F.get(h, i - k))
            return F.pmod(rolled, F.lit(SPACING)) == 0

        inner = F.filter(F.sequence(F.lit(1), F.size(h)), lambda p: (p < F.size(h)) & ends(p - 1))
        return F.concat(F.array(F.lit(0)), inner, F.array(F.size(h)))

    return _bound(F.transform(lines, lambda x: F.xxhash64(x)), cuts)


def _chunks(text: Column) -> Column:
    """at (its first line), n (lines) and chunk (text) of each chunk of a text."""

    def cut(b: Column) -> Column:
        return F.transform(F.slice(b["at"], 1, F.size(b["at"]) - 1), lambda p, i: F.struct(
            p.alias("at"), (F.get(b["at"], i + 1) - p).alias("n"),
            F.array_join(F.slice(b["lines"], p + 1, F.get(b["at"], i + 1) - p), "\n").alias("chunk")))

    return _bound(F.split(text, "\n"), lambda lines: _bound(F.struct(lines.alias("lines"), chunk_bounds(lines).alias("at")), cut))


def _covered(gone: Column, less: int) -> Column:
    """The lines of the ``gone`` chunks, without the last ``less`` of each."""
    return F.flatten(F.transform(gone, lambda g: F.sequence(g["at"], g["at"] + g["n"] - 1 - less)))


def _pairs(text: Column, gone: Column) -> Column:
    """at, n and chunk, as above, of each line with a word up to the next one with a word.

    Those inside one of the ``gone`` chunks are left out.
    """

    def full(lines: Column) -> Column:
        return F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: F.get(lines, i).rlike(WORDS))

    def some(b: Column) -> Column:
        # the pair that each line from the first word on begins or lies in, of the lines not followed by one of their gone chunk
        nth = F.flatten(F.transform(b["full"], lambda p, k: F.array_repeat(k, F.coalesce(F.get(b["full"], k + 1), F.size(b["lines"])) - p)))
        open_ = F.array_except(F.sequence(F.get(b["full"], F.lit(0)), F.get(b["full"], F.size(b["full"]) - 1) - 1), _covered(gone, 1))
        return _bound(nth, lambda of: F.array_distinct(F.transform(open_, lambda i: F.get(of, i - F.get(b["full"], F.lit(0))))))

    def cut(b: Column) -> Column:
        which = F.when(F.size(b["full"]) < 2, F.array().cast("array<int>")).when(
            F.size(gone) == 0, F.sequence(F.lit(0), F.size(b["full"]) - 2)).otherwise(some(b))

        def pair(k: Column) -> Column:
            p = F.get(b["full"], k)
            n = F.get(b["full"], k + 1) - p + 1
            return F.struct(p.alias("at"), n.alias("n"), F.array_join(F.slice(b["lines"], p + 1, n), "\n").alias("chunk"))

        return F.transform(which, pair)

    return _bound(F.split(text, "\n"), lambda lines: _bound(F.struct(lines.alias("lines"), full(lines).alias("full")), cut))


def _repeats(each: DataFrame, label: str) -> DataFrame:
    """row, at, n of the chunks (row, doc_id, at, n, chunk) that occur before, and not only within their own lines."""
    each = each.withColumn("hash", F.unhex(F.md5("chunk")))
    many = each.groupBy("hash").agg(F.count("*").alias("k")).filter("k > 1")
    some = written(sifted(each, "hash", sieve(written(many, label + "-hashes"), "hash")).filter("maybe").drop("maybe"), label)
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row"), F.col("at"))
    found = with_groups(some.withColumn("place", F.struct("row", "at")), ["hash", "chunk"], order, by="place")
    apart = (F.col("best.row") != F.col("row")) | (F.col("at") >= F.col("best.at") + F.col("n"))
    return written(found.filter(apart).select("row", "at", "n"), label + "-gone")


def _with_gone(rows: DataFrame, gone: DataFrame) -> list[DataFrame]:
    """The rows with ``gone``, the places (at, n) that go from each: those that surely have none, and the others."""
    of = gone.groupBy("row").agg(F.collect_list(F.struct("at", "n")).alias("gone"))
    none = F.array().cast("array<struct<at:int,n:int>>")
    marked = sifted(rows, "row", sieve(gone, "row"))
    doubt = marked.filter("maybe").drop("maybe").join(of, "row", "left")
    return [marked.filter("not maybe").drop("maybe").withColumn("gone", none), doubt.withColumn("gone", F.coalesce("gone", none))]


def line_chunks(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: row, doc_id, n_lines, n_chunks, n_removed_chunks, n_removed_lines, kept_text.

    Chunks of two lines or more that occur before, in the order of doc_id (null
    last), row and place, are removed. What repeats without filling a chunk goes
    after them: a second set of chunks begins at every line with a word and ends
    with the next one, so that any two lines of text that occur before, one after
    the other, are removed with the blank lines between them, and longer passages
    by all their pairs. Candidates are found by hash and compared byte by byte
    with the first. A line with a word stays where it occurs first, blank lines
    alone stay, and repeats that overlap their first occurrence stay. n_chunks
    counts the chunks of the first set, n_removed_chunks those of which no line
    is left. A null text counts as empty: one line, one chunk; an empty table
    gives an empty result; rows that repeat a doc_id are documents of their own,
    so a repeated text is removed chunk by chunk.
    """
    rows = docs if "doc" in docs.columns and "row" in docs.columns else keyed(docs)
    doc_id, text = field("doc_id", rows, "bigint"), text_of(rows)

    def exploded(df: DataFrame, chunks: Column) -> DataFrame:
        each = df.select("row", doc_id.alias("doc_id"), F.explode(chunks).alias("c"))
        return each.select("row", "doc_id", "c.at", "c.n", "c.chunk")

    chunks = exploded(rows, _chunks(text)).filter((F.col("n") >= LEAST) & F.col("chunk").rlike(WORDS))
    gone = _repeats(chunks, "chunks")
    clear, doubt = _with_gone(rows, gone)
    gone = gone.union(_repeats(exploded(clear, _pairs(text, F.col("gone"))).union(exploded(doubt, _pairs(text, F.col("gone")))), "pairs"))

    def shape(df: DataFrame) -> DataFrame:
        def left(lines: Column) -> Column:
            return F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), _covered(F.col("gone"), 0))

        def counts(b: Column) -> Column:
            cuts = F.slice(b["at"], 1, F.size(b["at"]) - 1)
            of = F.flatten(F.transform(cuts, lambda p, i: F.array_repeat(i, F.get(b["at"], i + 1) - p)))
            full = F.when(F.size("gone") == 0, F.size(cuts)).otherwise(
                _bound(of, lambda of: F.size(F.array_distinct(F.transform(b["left"], lambda i: F.get(of, i))))))
            return F.struct(
                F.size(b["lines"]).alias("n_lines"), F.size(cuts).alias("n_chunks"), full.alias("full"), F.size(b["left"]).alias("left"),
                F.when(F.size("gone") > 0, F.array_join(F.transform(b["left"], lambda i: F.get(b["lines"], i)), "\n")).alias("kept"))

        parts = _bound(F.split(text, "\n"), lambda lines: _bound(
            F.struct(lines.alias("lines"), left(lines).alias("left"), chunk_bounds(lines).alias("at")), counts))
        own = df.select("row", doc_id.alias("doc_id"), text.alias("text"), parts.alias("x"))
        return own.select(
            "row", "doc_id", F.col("x.n_lines").cast("bigint").alias("n_lines"), F.col("x.n_chunks").cast("bigint").alias("n_chunks"),
            (F.col("x.n_chunks") - F.col("x.full")).cast("bigint").alias("n_removed_chunks"),
            (F.col("x.n_lines") - F.col("x.left")).cast("bigint").alias("n_removed_lines"),
            F.coalesce("x.kept", "text").alias("kept_text"))

    clear, doubt = _with_gone(rows, gone)
    return shape(clear).union(shape(doubt))
