"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timbrel.llm.rows import SPACE, field, keyed, sieve, sifted, text_of, with_groups, without, written

#: Characters of the normalised text that the second step hashes.
PREFIX = 1024


def normalised(text: Column) -> Column:
    """The text without its white space."""
    return F.regexp_replace(text, SPACE, "")


def exact_dedup(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: row, doc_id, keep_id, keep_row, group_size, kept.

    Texts are equal when identical after white space is deleted. Of equal texts
    the row with the most code points stays, then the smallest doc_id (null
    last), then any one of them, always the same. The first step groups rows by
    the length of the normalised text, the second the rows left by a hash of
    its first characters; only rows that still share a group are read again in
    full and hashed. A null text counts as empty, and empty texts are equal to
    each other; an empty table gives an empty result; rows that repeat a doc_id
    count one by one; other columns are ignored.
    """
    rows = docs if "doc" in docs.columns and "row" in docs.columns else keyed(docs)
    text = text_of(rows)
    plain = rows.select("row", field("doc_id", rows, "bigint").alias("doc_id"), text.alias("text"))
    short = plain.withColumn("norm", normalised(F.col("text"))).select(
        "row", "doc_id", F.octet_length("norm").alias("length"),
        F.xxhash64(F.substring("norm", 1, PREFIX)).alias("prefix"),
    )
    short = written(short, "exact-short")
    by_length = with_groups(short, ["length"], F.col("row")).filter("size > 1").drop("size", "best")
    survivors = with_groups(by_length, ["length", "prefix"], F.col("row")).filter("size > 1")
    bits = sieve(survivors, "row")
    full = sifted(plain, "row", bits).filter("maybe").select(
        "row", "doc_id", F.char_length("text").alias("n_chars"), F.sha2(normalised(F.col("text")), 256).alias("hash"),
    )
    full = written(full, "exact-full")
    order = F.struct(-F.col("n_chars"), F.col("doc_id").isNull(), F.col("doc_id").alias("id"), F.col("row"))
    groups = with_groups(full, ["hash"], order).select(
        "row", "size", F.col("best.id").alias("best_id"), F.col("best.row").alias("best_row")
    )
    joined = short.select("row", "doc_id").join(groups, "row", "left")
    alone = F.col("size").isNull()
    return joined.select(
        "row", "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("best_id")).alias("keep_id"),
        F.coalesce("best_row", "row").alias("keep_row"),
        F.coalesce("size", F.lit(1)).alias("group_size"),
        (alone | (F.col("best_row") == F.col("row"))).alias("kept"),
    )


def drop_exact(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns."""
    rows = keyed(docs)
    verdict = exact_dedup(rows)
    return without(rows, verdict.filter("not kept").select("row")).select("doc.*")
