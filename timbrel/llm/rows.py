"""What the operators share: row keys, sieves of bounded size, groups with hot keys.

Rows are told apart by a key of their own, not by ``doc_id``, which may be
missing or repeated. All columns of a table travel in one struct ``doc``, so
that no name of theirs can clash with a name of an operator.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from timbrel.session import run_dir

#: Characters that separate words, and a word.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

#: A sieve has at most this many words of 64 bits (8 MB as rows), whatever goes into it.
SIEVE_WORDS = 1 << 17
#: Shares of a key that may hold a third of all rows.
SHARES = 64


def written(df: DataFrame, label: str) -> DataFrame:
    """The frame as a table in the shared folder: computed once, not again after a loss."""
    spark = df.sparkSession
    path = run_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def keyed(docs: DataFrame) -> DataFrame:
    """``row`` (16 bytes, one per row) and ``doc`` (all columns as a struct).

    A row of a Parquet scan is known by its file and its place in it, which any
    later scan finds again. Other frames are first written to the shared folder.
    """
    if docs._jdf.queryExecution().analyzed().nodeName() != "LogicalRelation" or "_metadata" in docs.columns:
        docs = written(docs, "rows")
    place = F.concat_ws("#", F.col("_metadata.file_path"), F.col("_metadata.row_index").cast("string"))
    every = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.select(F.unhex(F.md5(place)).alias("row"), every.alias("doc"))


def field(name: str, docs: DataFrame, kind: str) -> Column:
    """A column of ``doc``; null of that type where the table has none."""
    names = docs.schema["doc"].dataType.names
    return F.col(f"doc.`{name}`").cast(kind) if name in names else F.lit(None).cast(kind)


def text_of(docs: DataFrame) -> Column:
    return F.coalesce(field("text", docs, "string"), F.lit(""))


def _bit(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(64 * SIEVE_WORDS))


def sieve(keys: DataFrame, key: str) -> DataFrame:
    """A bit map of hashed keys, at most ``SIEVE_WORDS`` rows for any number of keys."""
    bit = keys.select(_bit(F.col(key)).alias("bit"))
    mask = F.expr("shiftleft(1L, cast(bit % 64 as int))")
    return bit.groupBy(F.floor(F.col("bit") / 64).alias("_word")).agg(F.bit_or(mask).alias("_mask"))


def sifted(df: DataFrame, key: str, bits: DataFrame) -> DataFrame:
    """Adds ``maybe``: false only for rows whose key surely is not in the sieve. No shuffle of the rows."""
    bit = _bit(F.col(key))
    marked = df.withColumn("_word", F.floor(bit / 64)).join(F.broadcast(bits), "_word", "left")
    hit = F.getbit(F.coalesce("_mask", F.lit(0).cast("bigint")), F.pmod(bit, F.lit(64)).cast("int")) == 1
    return marked.withColumn("maybe", hit).drop("_word", "_mask")


def without(rows: DataFrame, dropped: DataFrame) -> DataFrame:
    """Rows whose ``row`` is not in ``dropped``; only rows that the sieve cannot clear are shuffled.

    The keys in ``dropped`` are read twice, so they are written first: what finds them runs once.
    """
    dropped = written(dropped.select("row"), "dropped")
    marked = sifted(rows, "row", sieve(dropped, "row"))
    doubt = marked.filter("maybe").join(dropped, "row", "left_anti")
    return marked.filter("not maybe").select("row", "doc").union(doubt.select("row", "doc"))


def with_groups(df: DataFrame, keys: list[str], first: Column, by: str = "row", total: str | None = None) -> DataFrame:
    """Adds ``size`` and ``best`` (the least ``first``) of each row's group, and ``total`` of a column if one is named.

    A group is aggregated by shares of its rows, and its totals go back by the
    same shares, so that no task gets a hot group as a whole. Column ``by``
    tells the rows of a group apart.
    """
    shared = df.withColumn("_share", F.pmod(F.xxhash64(by), F.lit(SHARES)))
    sums = [F.sum(total).alias("total")] if total else []
    again = [F.sum("total").alias("total")] if total else []
    parts = shared.groupBy(*keys, "_share").agg(F.count("*").alias("n"), F.min(first).alias("best"), *sums)
    whole = parts.groupBy(*keys).agg(
        F.sum("n").alias("size"), F.min("best").alias("best"), F.collect_list("_share").alias("_shares"), *again
    )
    added = ["size", "best", "total"] if total else ["size", "best"]
    back = whole.select(*keys, *added, F.explode("_shares").alias("_share"))
    return shared.join(back, [*keys, "_share"]).drop("_share")
