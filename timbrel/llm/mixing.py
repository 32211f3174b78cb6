"""Mixing sources to target weights: pivotal rounding of fractional copies in a distributed tree."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from timbrel.llm.rows import WORD, field, keyed, sieve, sifted, text_of, written

#: Weights of the sources in the order of their names, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
#: A source gives at most this many times its size.
MOST = 3
#: Documents of a leaf of the reduction tree, and children of a node.
LEAF, FAN = 4096, 16
TINY = 1e-9

_PARTS = "source string, node bigint, row binary, size bigint, up int, p double, settled boolean"


def targets(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """source, n, source_size, target: shares by weight, held at ``MOST`` sizes, the excess shared again.

    One row per source is all that the single-partition windows see. The level
    at which the shares stop rising is where the sources that are held and the
    shares of the others make up the whole.
    """
    by = sized.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    listed = F.array(*[F.lit(w) for w in weights])
    by = by.withColumn("place", place).withColumn("weight", F.get(listed, F.pmod("place", F.lit(len(weights)))))
    by = by.withColumn("most", (MOST * F.col("source_size")).cast("double"))
    by = by.withColumn("stop", F.col("most") / F.col("weight"))
    order = Window.orderBy("stop", "place")
    before = F.coalesce(F.sum("most").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    whole = F.sum(F.col("most") / MOST).over(Window.partitionBy())
    by = by.withColumn("level", (whole - before) / rest)
    fits = F.when(F.col("level") <= F.col("stop"), F.struct("stop", "place", "level"))
    level = F.min(fits).over(Window.partitionBy())["level"]
    return by.select(
        "source", "n", "source_size", F.least("most", F.coalesce(level, F.lit(0.0)) * F.col("weight")).alias("target")
    )


def pivot(sizes: list[int], parts: list[float], draw: np.random.Generator) -> tuple[list[float], int]:
    """Settle all but one of the fractional copies; gives the parts and the place of the one left, or -1.

    Two open documents exchange words: one's part grows by as many words as the
    other's shrinks, at random in either direction and fair to both, until one
    of them is whole.
    """
    parts = list(parts)
    open_at = -1
    chance = draw.random(len(parts) + 1)
    for k in range(len(parts)):
        if parts[k] <= TINY or parts[k] >= 1 - TINY:
            parts[k] = float(round(parts[k]))
            continue
        if open_at < 0:
            open_at = k
            continue
        a, b = open_at, k
        up = min((1 - parts[a]) * sizes[a], parts[b] * sizes[b])
        down = min(parts[a] * sizes[a], (1 - parts[b]) * sizes[b])
        shift = up if chance[k] * (up + down) < down else -down
        parts[a] += shift / sizes[a]
        parts[b] -= shift / sizes[b]
        left = -1
        for x in (a, b):
            if parts[x] <= TINY or parts[x] >= 1 - TINY:
                parts[x] = float(round(parts[x]))
            else:
                left = x
        open_at = left
    return parts, open_at


def _node(seed: int, level: int, root: bool):
    def settle(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        source, node = key
        name = "" if source is None or source != source else f"s{source}"
        pdf = pdf.sort_values(["rank", "id", "size"], kind="stable")
        draw = np.random.default_rng([seed, level, int(node), *name.encode()])
        sizes = pdf["size"].tolist()
        parts, left = pivot(sizes, pdf["p"].tolist(), draw)
        settled = np.ones(len(parts), dtype=bool)
        if left >= 0 and root:
            parts[left] = float(draw.random() < parts[left])
        elif left >= 0:
            settled[left] = False
        return pdf.assign(p=parts, settled=settled)[["source", "node", "row", "size", "up", "p", "settled", "rank", "id"]]

    return settle


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, seed: int = 7) -> DataFrame:
    """One row per row of ``docs``: row, doc_id, source, size, source_size, target, copies, taken.

    ``copies`` is the number of times the document is taken, ``taken`` its words
    in the mix. Every document of a source has the same expected copies; the
    whole part is certain and the fractions are rounded by the pivotal method,
    which keeps each source's words within one document of its target. Leaves
    of about 4,096 documents each leave one document open, and nodes of 16
    children settle those, level by level. Documents without words are not
    taken; null is a source of its own, the last one; an empty table gives an
    empty result; rows that repeat a doc_id are rounded one by one. The draws
    depend on doc_id, text, size and source alone, so reruns agree; only a row
    that is repeated a thousand times and more (in doc_id and text) is dealt over
    the leaves by its place in the table, so that no leaf gets all of it.
    """
    rows = docs if "doc" in docs.columns and "row" in docs.columns else keyed(docs)
    text = text_of(rows)
    sized = rows.select(
        "row", field("doc_id", rows, "bigint").alias("doc_id"), field("source", rows, "string").alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("size"), F.xxhash64(text).alias("content"))
    sized = written(sized, "mix-sized")
    goal = written(targets(sized, weights), "mix-targets")
    named = goal.withColumnRenamed("source", "of")
    with_goal = sized.join(named, F.col("source").eqNullSafe(F.col("of")))
    # rows equal in doc_id and text draw alike: where they would fill a leaf by themselves, they are dealt over all leaves
    rank = F.xxhash64("doc_id", "content", F.lit(seed))
    often = sized.groupBy("doc_id", "content").count().filter(F.col("count") >= LEAF // 4).select(rank.alias("rank"))
    with_goal = sifted(with_goal.withColumn("rank", rank), "rank", sieve(often, "rank"))
    rate = F.col("target") / F.col("source_size")
    whole = F.floor(rate + TINY)
    leaves = F.greatest(F.lit(1), F.ceil(F.col("n") / LEAF))
    dealt = F.when(F.col("maybe"), F.xxhash64("rank", "row")).otherwise(F.col("rank"))
    open_rows = with_goal.filter("size > 0").select(
        "source", F.pmod(dealt, leaves).alias("node"), "row", "size", whole.cast("int").alias("up"),
        F.greatest(rate - whole, F.lit(0.0)).alias("p"), "rank", F.coalesce("doc_id", F.lit(0)).alias("id"))
    most = goal.agg(F.max(F.ceil(F.col("n") / LEAF))).first()[0] or 1
    done, level = [], 0
    while True:
        root = most <= 1
        out = _PARTS + ", rank bigint, id bigint"
        result = written(open_rows.groupBy("source", "node").applyInPandas(_node(seed, level, root), out), "mix-level")
        done.append(result.filter("settled"))
        if root:
            break
        open_rows = result.filter("not settled").withColumn("node", F.floor(F.col("node") / FAN)).drop("settled")
        most, level = -(-most // FAN), level + 1
    settled = done[0]
    for more in done[1:]:
        settled = settled.union(more)
    copies = settled.select("row", (F.col("up") + F.col("p").cast("int")).alias("copies"))
    mixed = with_goal.join(copies, "row", "left").fillna(0, ["copies"])
    return mixed.select(
        "row", "doc_id", "source", "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"))


def take_mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, seed: int = 7) -> DataFrame:
    """The rows of the mix, each as often as it is taken, with the columns of ``docs``."""
    rows = keyed(docs)
    other = mix(rows, weights, seed).filter("copies <> 1").select("row", "copies")
    marked = sifted(rows, "row", sieve(other, "row"))
    doubt = marked.filter("maybe").join(other, "row", "left").fillna(1, ["copies"])
    repeated = doubt.select("doc", F.explode(F.array_repeat(F.lit(0), F.col("copies"))).alias("copy"))
    return marked.filter("not maybe").select("doc").union(repeated.select("doc")).select("doc.*")
