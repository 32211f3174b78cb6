"""Joins in which one key may hold a large share of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timbrel.operators.settled import settled

# A key counts as hot from this share of the rows on.
HOT_SHARE = 0.01
# Keys the frequent-items sketch keeps track of; its error is far below HOT_SHARE.
TRACKED_KEYS = 10_000


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE) -> list:
    """Keys that hold at least ``share`` of the rows, of which there are at most ``1 / share``.

    One pass over the key column with a frequent-items sketch: tasks send
    their sketches, no key is shuffled.
    """
    top = F.expr(f"approx_top_k(`{key}`, {int(1 / share)}, {TRACKED_KEYS})")
    row = df.agg(F.count("*").alias("n"), top.alias("top")).first()
    least = max(2, row.n * share)
    return [item for item, count in row.top or [] if item is not None and count >= least]


def join_spread(
    large: DataFrame, lookup: DataFrame, key: str, how: str, spread: int = 64, hot: list | None = None
) -> DataFrame:
    """Join with a table of one row per key; hot keys are split over ``spread`` shares.

    A row of a hot key, or without a key, gets the share of the task that reads
    it, and only the lookup rows of hot keys are repeated per share. All other
    rows join as usual. Splitting skewed partitions is left undone by AQE when
    the lookup comes straight from an aggregate on the key, hence this. The hot
    keys are looked for in a settled frame, so that what comes before is run
    once. A stream cannot be sampled and joins as it is.
    """
    if large.isStreaming:
        return large.join(lookup, key, how)
    if hot is None:
        large = settled(large, "join")
        hot = hot_keys(large, key)
    if not hot and not large.schema[key].nullable:
        return large.join(lookup, key, how)

    def is_hot(column: Column) -> Column:
        return column.isin(hot) if hot else F.lit(False)

    apart = F.col(key).isNull() | is_hot(F.col(key))
    shares = F.when(is_hot(F.col(key)), F.sequence(F.lit(0), F.lit(spread - 1))).otherwise(F.array(F.lit(0)))
    left = large.withColumn("_share", F.when(apart, F.pmod(F.spark_partition_id(), F.lit(spread))).otherwise(0))
    return left.join(lookup.withColumn("_share", F.explode(shares)), [key, "_share"], how).drop("_share")
