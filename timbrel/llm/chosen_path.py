"""Jaccard join on word n-grams by chosen paths, and the groups that its links make."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timbrel.llm.rows import field, keyed, sieve, sifted, text_of, with_groups, without, written

#: Words of a shingle and the least similarity.
WORDS, SIMILARITY = 5, 0.8
#: The least share of links at exactly that similarity that the runs find.
RECALL = 0.999
#: Levels of a path; a bucket over LIMIT sets is split further, down to the last level.
DEPTH, LIMIT = 3, 64
#: Sets, and shingles of them, that one task compares with each other; larger buckets are compared block by block.
BLOCK, BLOCK_SHINGLES = 1024, 1 << 20

_ODD = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F,
                 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits (the finish of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * _ODD[1]
    x = (x ^ (x >> np.uint64(27))) * _ODD[2]
    return x ^ (x >> np.uint64(31))


def runs_for(recall: float = RECALL) -> int:
    """Runs after which a pair at the least similarity is found with this probability.

    On each level two such sets expect one shared chosen token, so a shared
    path survives a level with 1 - exp(-q) if it survives the levels below with q.
    """
    q = 1.0
    for _ in range(DEPTH):
        q = 1 - math.exp(-q)
    return math.ceil(math.log(1 - recall) / math.log(1 - q))


def shingle_sets(texts: list[bytes], words: int = WORDS) -> list[np.ndarray]:
    """The sorted set of hashed shingles of each text; a shorter text with a word is one shingle."""
    joined = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    blank = (joined == 32) | ((joined >= 9) & (joined <= 13))
    edge = np.diff(np.r_[True, blank, True].astype(np.int8))
    begin, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    text_ends = np.cumsum([len(t) + 1 for t in texts])
    if not len(begin):
        return [np.empty(0, dtype=np.uint64) for _ in texts]
    lengths = end - begin
    powers = np.cumprod(np.r_[np.uint64(1), np.full(int(lengths.max()), _ODD[0])], dtype=np.uint64)
    place = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    values = mix((joined[~blank].astype(np.uint64) + np.uint64(1)) * _ODD[3]) * powers[place]
    hashed = mix(np.add.reduceat(values, np.cumsum(lengths) - lengths) ^ lengths.astype(np.uint64) * _ODD[4])
    first = np.searchsorted(begin, np.r_[0, text_ends])
    factors = mix(np.arange(1, words + 1, dtype=np.uint64) * _ODD[5]) | np.uint64(1)
    sums = np.zeros(len(hashed), dtype=np.uint64)
    for k in range(words):
        sums[: len(hashed) - k] += mix(hashed[k:] ^ factors[k]) * factors[k]
    sums = mix(sums)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= words:
            out.append(np.unique(sums[a : b - words + 1]))
        elif b > a:
            own = np.zeros(1, dtype=np.uint64)
            for k in range(b - a):
                own += mix(hashed[a + k : a + k + 1] ^ factors[k]) * factors[k]
            out.append(mix(own))
        else:
            out.append(np.empty(0, dtype=np.uint64))
    return out


def paths(tokens: np.ndarray, runs: int, similarity: float = SIMILARITY) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per level the place of each node's parent in the level above, and the nodes' keys.

    A node chooses each token of the set with probability 1 / (similarity x
    size), by a hash that all sets share, so that two similar sets expect at
    least one common choice.
    """
    limit = np.uint64(min(2**64 - 1, int(2**64 / (similarity * max(1, len(tokens))))))
    nodes = mix(np.arange(1, runs + 1, dtype=np.uint64) * _ODD[6])
    out = []
    for _ in range(DEPTH):
        chosen = mix(tokens[None, :] ^ nodes[:, None]) <= limit
        parent, token = np.nonzero(chosen)
        nodes = mix(nodes[parent] * _ODD[7] + tokens[token])
        out.append((parent, nodes))
    return out


def _text_parts(frame: pa.RecordBatch, column: int, most: int = 1_000_000) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    texts, begin, size, values = [], 0, 0, frame.column(column)
    for k in range(frame.num_rows):
        raw = values[k].as_buffer().to_pybytes()
        if texts and size + len(raw) > most:
            yield frame.slice(begin, len(texts)), texts
            texts, begin, size = [], k, 0
        texts.append(raw)
        size += len(raw)
    if texts:
        yield frame.slice(begin, len(texts)), texts


def signed_sets(rows: DataFrame, runs: int, words: int, similarity: float) -> DataFrame:
    """row, doc_id, same (fingerprint of the set), size, and the nodes of its paths by level."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for part, texts in _text_parts(frame, 2):
                same, size = [], []
                levels: list[list[np.ndarray]] = [[] for _ in range(2 * DEPTH)]
                for tokens in shingle_sets(texts, words):
                    same.append(hashlib.blake2b(tokens.tobytes(), digest_size=16).digest())
                    size.append(len(tokens))
                    for k, (parent, nodes) in enumerate(paths(tokens, runs, similarity)):
                        levels[2 * k].append(parent.astype(np.int64))
                        levels[2 * k + 1].append(nodes.view(np.int64))
                lists = []
                for own in levels[1:]:
                    offsets = np.r_[0, np.cumsum([len(x) for x in own])].astype(np.int32)
                    lists.append(pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(own))))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(same, pa.binary()), pa.array(size, pa.int64()), *lists],
                    names=["row", "doc_id", "same", "size", "k1", "p2", "k2", "p3", "k3"])

    lists = ", ".join(f"{c} array<bigint>" for c in ("k1", "p2", "k2", "p3", "k3"))
    plain = rows.select("row", field("doc_id", rows, "bigint").alias("doc_id"), text_of(rows).alias("text"))
    return written(plain.mapInArrow(run, f"row binary, doc_id bigint, same binary, size bigint, {lists}"), "path-sets")


def buckets(sets: DataFrame) -> DataFrame:
    """key, row, n, blocks: the leaves of the paths that hold two sets or more, one of those with equal members.

    ``blocks`` is the number of parts a leaf is compared in, by its sets and by
    their shingles, so that neither many sets nor long ones fill a task.

    A node with at most ``LIMIT`` sets is a leaf; of larger ones the children on
    the next level are looked at, and nodes of the last level are leaves of any
    size. A sieve of open nodes may let children of closed nodes pass; they only
    add buckets.
    """
    leaves, open_nodes = None, None
    for level in range(1, DEPTH + 1):
        if level == 1:
            nodes = sets.select("row", "size", F.explode("k1").alias("key"))
        else:
            both = F.arrays_zip(F.col(f"p{level}").alias("p"), F.col(f"k{level}").alias("k"))
            each = sets.select("row", "size", F.col(f"k{level - 1}").alias("above"), F.explode(both).alias("x"))
            each = each.select("row", "size", F.get("above", F.col("x.p").cast("int")).alias("parent"), F.col("x.k").alias("key"))
            nodes = sifted(each, "parent", sieve(open_nodes, "key")).filter("maybe").select("row", "size", "key")
        nodes = nodes.distinct().withColumnRenamed("size", "shingles")
        sized = with_groups(nodes, ["key"], F.col("row"), total="shingles").filter("size > 1")
        blocks = F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("total") / BLOCK_SHINGLES)).cast("int")
        sized = written(sized.select("key", "row", F.col("size").alias("n"), blocks.alias("blocks")), "path-nodes")
        own = sized if level == DEPTH else sized.filter(F.col("n") <= LIMIT)
        leaves = own if leaves is None else leaves.union(own)
        open_nodes = sized.filter(F.col("n") > LIMIT).select("key")
    leaves = leaves.select("key", "row", "n", "blocks")
    members = leaves.groupBy("key", "n").agg(
        F.bit_xor(F.xxhash64("row")).alias("a"), F.bit_xor(F.xxhash64("row", F.lit(1))).alias("b"))
    first = members.groupBy("n", "a", "b").agg(F.min("key").alias("key"))
    return sifted(leaves, "key", sieve(first, "key")).filter("maybe").drop("maybe")


def _links(group: list[tuple], similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Number of links of each set that this bucket answers for, and the first set it is connected with here.

    ``group`` has (key, block, whether two blocks meet, keys of the set's buckets, tokens). Only
    tokens that two sets share are compared, a part of them at a time. Of the
    buckets that two sets share, the one with the least key answers.
    """
    n = len(group)
    sizes = np.array([len(g[4]) for g in group])
    owner = np.repeat(np.arange(n), sizes)
    tokens, of = np.unique(np.concatenate([g[4] for g in group]), return_inverse=True)
    shared = np.bincount(of, minlength=len(tokens)) > 1
    owner, of = owner[shared[of]], (np.cumsum(shared) - 1)[of[shared[of]]]
    common = np.zeros((n, n), dtype=np.float32)
    order = np.argsort(of, kind="stable")
    owner, of = owner[order], of[order]
    width = 4096
    for begin in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(of, [begin, begin + width])
        table = np.zeros((n, width), dtype=np.float32)
        table[owner[a:b], of[a:b] - begin] = 1
        common += table @ table.T
    linked = common >= similarity * (sizes[:, None] + sizes[None, :] - common) - 1e-6
    np.fill_diagonal(linked, False)
    block = np.array([g[1] for g in group])
    if group[0][2]:  # also where one of the two is empty: pairs of one block are counted there
        linked &= block[:, None] != block[None, :]
    label = np.arange(n)
    while True:
        best = np.minimum(label, np.where(linked, label[None, :], n).min(axis=1, initial=n))
        if (best == label).all():
            break
        label = best
    key = group[0][0]
    before: dict[int, list[int]] = {}
    for i, g in enumerate(group):
        for other in g[3]:
            if other < key:
                before.setdefault(other, []).append(i)
    answered = np.zeros((n, n), dtype=bool)
    for own in before.values():
        if len(own) > 1:
            answered[np.ix_(own, own)] = True
    return (linked & ~answered).sum(axis=1), label


def found_links(rows: DataFrame, leaves: DataFrame, words: int, similarity: float) -> DataFrame:
    """row, n_links, first: what each bucket, or pair of blocks of a large bucket, finds for a set."""
    lists = written(leaves.groupBy("row").agg(F.collect_set(F.struct("key", "blocks")).alias("of")), "path-lists")

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for part, texts in _text_parts(frame, 1):
                own = pa.array([x.tobytes() for x in shingle_sets(texts, words)], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), own], names=["row", "tokens"])

    some = sifted(rows.select("row", text_of(rows).alias("text")), "row", sieve(lists, "row")).filter("maybe")
    tokens = some.select("row", "text").mapInArrow(run, "row binary, tokens binary")
    each = tokens.join(lists, "row").select("row", "tokens", F.col("of.key").alias("keys"), F.explode("of").alias("b"))
    own_block = F.pmod(F.xxhash64("row"), F.col("b.blocks")).cast("int")
    each = each.select("row", "tokens", "keys", F.col("b.key").alias("key"), F.col("b.blocks").alias("blocks"), own_block.alias("block"))
    each = each.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    each = each.select(
        "key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "row", "keys", "tokens")
    dealt = each.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "row")

    def compare(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[bytes, int, bytes]] = []

        def close(rows_: list[bytes], group: list[tuple]) -> None:
            if len(group) > 1:
                counts, label = _links(group, similarity)
                for k in np.flatnonzero((counts > 0) | (label != np.arange(len(group)))).tolist():
                    out.append((rows_[k], int(counts[k]), rows_[int(label[k])]))

        def flush() -> pa.RecordBatch:
            a, b, c = zip(*out, strict=True)
            out.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(a, pa.binary()), pa.array(b, pa.int64()), pa.array(c, pa.binary())], names=["row", "n_links", "first"]
            )

        at, rows_, group = None, [], []
        for frame in frames:
            columns = [c.to_pylist() for c in frame.columns[:6]]
            sets = frame.column(6)
            for k, (key, i, j, block, row, keys) in enumerate(zip(*columns, strict=True)):
                if at != (key, i, j):
                    close(rows_, group)
                    at, rows_, group = (key, i, j), [], []
                rows_.append(row)
                group.append((key, block, i != j, keys, np.frombuffer(sets[k].as_py(), dtype=np.uint64)))
            if len(out) > 10_000:
                yield flush()
        close(rows_, group)
        if out:
            yield flush()

    return written(dealt.mapInArrow(compare, "row binary, n_links bigint, first binary"), "path-links")


def components(edges: DataFrame) -> DataFrame:
    """u, root: the least member of each component, by large and small stars in turn until nothing moves."""
    now = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(), "star")
    stamp = None
    while True:
        both = now.union(now.select("v", "u"))
        large = with_groups(both, ["u"], F.col("v"), by="v").select("u", "v", F.least("best", "u").alias("m"))
        large = large.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = with_groups(large, ["u"], F.col("v"), by="v").select("u", "v", F.col("best").alias("m"))
        small = small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v")))
        now = written(small.filter("u <> v").distinct(), "star")
        fresh = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if fresh == stamp:
            return now.select("u", F.col("v").alias("root"))
        stamp = fresh


def jaccard_join(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """One row per row of ``docs``: row, doc_id, class_id, n_copies, n_links, group_id, kept.

    Documents with equal sets of word shingles are one class, named by its
    smallest doc_id (null last). ``n_links`` is the number of other classes with
    a Jaccard similarity of at least ``similarity``; pairs meet in buckets of
    chosen paths, and are compared exactly there. Classes connected by links are
    a group, named in the same way; ``kept`` holds for one row of each group.
    A text of fewer words than a shingle is one shingle; texts without words
    (null too) are one class without links; an empty table gives an empty
    result; rows that repeat a doc_id are copies like others. Very long texts are
    compared whole: a block ends at ``BLOCK_SHINGLES`` shingles on average, so a
    task holds about two blocks, or two sets that are larger by themselves.
    """
    rows = docs if "doc" in docs.columns and "row" in docs.columns else keyed(docs)
    signed = signed_sets(rows, runs_for(recall), words, similarity)
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id").alias("id"), F.col("row"))
    member = written(with_groups(signed.select("row", "doc_id", "same"), ["same"], order).select(
        "row", "doc_id", F.col("best.id").alias("class_id"), F.col("best.row").alias("of"), F.col("size").alias("n_copies")
    ), "path-classes")
    copies = member.filter(F.col("row") != F.col("of")).select("row")
    marked = sifted(signed, "row", sieve(copies, "row"))
    single = marked.filter("not maybe").drop("maybe").union(
        marked.filter("maybe").drop("maybe").join(copies, "row", "left_anti"))
    single = written(single, "path-single")
    links = found_links(rows, buckets(single), words, similarity)
    per_class = links.groupBy("row").agg(F.sum("n_links").alias("n_links"))
    roots = components(links.select(F.col("row").alias("u"), F.col("first").alias("v")))
    classes = member.filter(F.col("row") == F.col("of")).select("row")
    classes = classes.join(per_class, "row", "left").join(roots.withColumnRenamed("u", "row"), "row", "left")
    classes = classes.select(
        F.col("row").alias("of"), F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("root", "row").alias("root"))
    shares = F.pmod(F.xxhash64("row"), F.least("n_copies", F.lit(64)))
    spread = classes.join(member.filter(F.col("row") == F.col("of")).select("of", "n_copies"), "of").withColumn(
        "share", F.explode(F.sequence(F.lit(0).cast("bigint"), F.least("n_copies", F.lit(64)) - 1))).drop("n_copies")
    every = member.withColumn("share", shares).join(spread, ["of", "share"])
    grouped = with_groups(every, ["root"], order)
    return grouped.select(
        "row", "doc_id", "class_id", "n_copies", "n_links", F.col("best.id").alias("group_id"),
        (F.col("best.row") == F.col("row")).alias("kept"))


def drop_near(docs: DataFrame, **settings) -> DataFrame:
    """One row of each group of near-duplicates, with its columns."""
    rows = keyed(docs)
    return without(rows, jaccard_join(rows, **settings).filter("not kept").select("row")).select("doc.*")
