"""Exact positions in a global order, without a one-task window."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from timbrel.operators.settled import settled

# Leaves of the compiled search tree over range bounds.
TREE_LEAVES = 64


def _range_bounds(df: DataFrame, order: tuple[str, ...], ranges: int, per_range: int = 16) -> list[tuple]:
    """Cut points of about ``ranges`` even ranges, from a sample of 16 keys per range.

    As few leading columns are used as tell the sampled rows apart. The cut
    points become literals of the plan, so every evaluation of it puts a row
    into the same range; a poor sample makes ranges uneven, never wrong.
    """
    wanted = ranges * per_range
    fraction = min(1.0, wanted / max(df.count(), 1))
    sample = df.select(*order).sample(fraction, seed=7).limit(2 * wanted).collect()
    keys = [tuple(row) for row in sample if all(v is not None for v in row)]
    width = 1
    while width < len(order) and keys and Counter(k[:width] for k in keys).most_common(1)[0][1] > per_range // 2:
        width += 1
    keys = sorted(k[:width] for k in keys)
    return sorted({keys[len(keys) * i // ranges] for i in range(1, ranges)}) if keys else []


def _range_of(df: DataFrame, order: tuple[str, ...], bounds: list[tuple]) -> Column:
    """How many bounds are <= the key, as a search tree of comparisons.

    The tree is compiled code; beyond its size, each leaf searches its own part
    of the bounds by halving steps.
    """
    if not bounds:
        return F.lit(0)
    columns = [(F.col(c), df.schema[c].dataType) for c in order[: len(bounds[0])]]

    def before(bound: tuple) -> Column:
        """The key sorts before the bound; nulls come first, bounds have none."""
        smaller = F.lit(False)
        for (column, kind), value in reversed(list(zip(columns, bound))):
            cut = F.lit(value).cast(kind)
            smaller = F.coalesce(column < cut, F.lit(True)) | (F.coalesce(column == cut, F.lit(False)) & smaller)
        return smaller

    def halve(first: int, part: list[tuple]) -> Column:
        cuts = F.array(*[F.struct(*[F.lit(v).cast(t) for v, (_, t) in zip(b, columns)]) for b in part])
        key = F.struct(*[c for c, _ in columns])
        steps = [1 << s for s in reversed(range(len(part).bit_length()))]
        within = F.aggregate(
            F.lit(steps),
            F.lit(0),
            lambda at, step: F.when(F.get(cuts, at + step - 1) <= key, at + step).otherwise(at),
        )
        return within + first

    leaf = -(-len(bounds) // TREE_LEAVES)

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        if high - low < leaf:
            return halve(low, bounds[low:high])
        middle = (low + high) // 2
        return F.when(before(bounds[middle]), search(low, middle)).otherwise(search(middle + 1, high))

    return search(0, len(bounds))


def with_position(df: DataFrame, *order: str, name: str = "position", ranges: int | None = None) -> DataFrame:
    """Add the 0-based ``bigint`` position of every row in the order of ``order``.

    Rows are numbered inside ranges of the key, and each range is shifted by
    the sizes of the ranges before it. ``order`` must identify a row, which
    also keeps the ranges even. Only the counts per range, at most ``ranges``
    rows, are brought together. Sample, sizes and rows are taken from one
    settled frame, the first two with the order columns only.
    """
    df = settled(df, "positions")
    ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = _range_bounds(df, order, ranges)
    ranged = df.withColumn("_range", _range_of(df, order, bounds))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_range")
        .count()
        .select("_range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy("_range").orderBy(*order)
    return (
        # one range per task: hashing the range numbers would put several into one
        ranged.repartitionById(len(bounds) + 1, "_range")
        .withColumn("_row", F.row_number().over(inside) - 1)
        .join(F.broadcast(offsets), "_range", "left")
        .withColumn(name, F.col("_offset") + F.col("_row"))
        .drop("_range", "_row", "_offset")
    )


def every_nth(df: DataFrame, n: int, *order: str) -> DataFrame:
    """Rows at positions 0, n, 2n, … of the order."""
    return with_position(df, *order, name="_at").filter(F.col("_at") % n == 0).drop("_at")


def with_batch_id(df: DataFrame, size: int, *order: str) -> DataFrame:
    """Add ``batch_id`` and ``batch_pos``: consecutive batches of ``size`` in the order."""
    placed = with_position(df, *order, name="_at")
    return placed.withColumns(
        {"batch_id": F.floor(F.col("_at") / size), "batch_pos": (F.col("_at") % size).cast("int")}
    ).drop("_at")


def skip_first(df: DataFrame, n: int, key: str, *order: str) -> DataFrame:
    """Drop the first ``n`` rows of the order, and no other row that shares a key with them.

    The ``n`` keys are a top-k, never a full sort; only rows with one of these
    keys are numbered. What is read more than once is settled first, so that no
    row is lost or doubled if the input would differ between the reads.
    """
    df = settled(df, "skip")
    first = df.orderBy(*order).limit(n).groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_n"))
    same = F.col(key).eqNullSafe(F.col("_key"))
    place = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    left = df.join(first, same).withColumn("_place", place).filter("_place > _n").select(*df.columns)
    return df.join(first, same, "left_anti").unionByName(left)


def drop_warmup(df: DataFrame, flag: str = "is_warmup") -> DataFrame:
    """Rows that are not marked as warm-up; an unmarked row counts as not."""
    return df.filter(~F.coalesce(flag, F.lit(False)))


def first_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    return df.orderBy(*order).limit(n)


def find_first(df: DataFrame, column: str, value, *order: str) -> DataFrame:
    """First row whose ``column`` equals ``value``; the filter reaches the scan."""
    return df.filter(F.col(column) == F.lit(value)).orderBy(*order).limit(1)


def top_per_group(df: DataFrame, n: int, groups: list[str], *order: str, spread: int = 64) -> DataFrame:
    """First ``n`` rows of every group.

    A group is first cut to ``n`` rows in each of ``spread`` shares, so one
    holding most rows is not sorted by one task, whatever ``n`` is; for small
    ``n`` Spark cuts the rows of a task before it sends them.
    """
    share = Window.partitionBy(*groups, "_share").orderBy(*order)
    df = (
        df.withColumn("_share", F.pmod(F.xxhash64(*order), F.lit(spread)))
        .withColumn("_rn", F.row_number().over(share))
        .filter(F.col("_rn") <= n)
        .drop("_share", "_rn")
    )
    w = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def first_per_key(df: DataFrame, key: str, *order: str) -> DataFrame:
    """One row per key, the first in the order."""
    return top_per_group(df, 1, [key], *order)
