"""Burrows-Wheeler transforms of shards, merged by refining their interleave."""

from __future__ import annotations

import numpy as np


def shard_transform(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The transform of a shard, and the position in the joined texts of each suffix in order.

    Bytes are shifted by one; every text ends with a 0, and equal ends are
    ordered by place. Suffixes are sorted by their first symbols, then by prefix
    doubling.
    """
    joined = np.concatenate([np.r_[t.astype(np.int64) + 1, 0] for t in texts])
    n = len(joined)
    ends = joined == 0
    text = np.cumsum(ends) - ends
    # the first symbols in one number, up to an end and then the place of the text
    step = max(1, (62 - len(texts).bit_length()) // 9)
    rank, over = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=bool)
    for k in range(step):
        symbol = np.zeros(n, dtype=np.int64)
        symbol[: max(0, n - k)] = joined[k:]
        symbol[over] = 0
        over |= symbol == 0
        rank = rank << 9 | symbol
    rank = rank * (len(texts) + 1) + np.where(over, text + 1, 0)
    rank = np.unique(rank, return_inverse=True)[1].astype(np.int64)
    while rank.max() + 1 < n:
        ahead = np.full(n, -1, dtype=np.int64)
        ahead[: max(0, n - step)] = rank[step:]
        rank = np.unique(rank * (n + 1) + ahead + 1, return_inverse=True)[1].astype(np.int64)
        step *= 2
    order = np.empty(n, dtype=np.int64)
    order[rank] = np.arange(n)
    return joined[order - 1], order


def merge(transforms: list[np.ndarray], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Where each suffix stands in the merged order, and its common prefix with the one before.

    Suffixes are numbered shard by shard, in the order of each shard; the first
    array gives their numbers in the merged order.

    Round h turns an interleave that is right for the first h - 1 characters
    into one that is right for h: the suffixes are passed in the order in which
    they stand, and the one that is longer by the symbol in front goes to the
    next free place of its block. A border between suffixes that differ for the
    first time in round h has a common prefix of h - 1; borders not found after
    ``depth`` rounds have at least ``depth``. A block can be split only by one
    that was split in the round before, so only those are passed. No suffix is
    sorted anew.
    """
    sizes = [len(t) for t in transforms]
    n = sum(sizes)
    ahead = np.empty(n, dtype=np.int32)  # the suffix that is longer by the symbol in front, -1 before a text
    head = np.empty(n, dtype=np.int16)
    begin = 0
    for t in transforms:
        dealt = np.argsort(t.astype(np.int16), kind="stable")
        head[begin : begin + len(t)] = t[dealt]
        ahead[begin + dealt] = np.arange(begin, begin + len(t), dtype=np.int32)
        ahead[begin : begin + len(t)][t == 0] = -1
        begin += len(t)
    order = np.argsort(head, kind="stable").astype(np.int32)
    ordered = head[order]
    fresh = np.r_[True, (ordered[1:] != ordered[:-1]) | (ordered[1:] == 0)]
    common = np.where(fresh, 0, depth).astype(np.int32)
    block = np.empty(n, dtype=np.int32)  # where the block of a suffix begins
    block[order] = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
    passed = np.arange(n, dtype=np.int32)
    for h in range(2, depth + 1):
        here = order[passed]
        longer = ahead[here]
        some = longer >= 0
        longer, source = longer[some], block[here[some]]
        into = block[longer]
        # those with the same symbol in front stand in order, so sorting by this short key sorts by block
        dealt = np.argsort(head[longer], kind="stable")
        longer, source, into = longer[dealt], source[dealt], into[dealt]
        fresh = into[1:] != into[:-1]
        border = np.r_[False, ~fresh & (source[1:] != source[:-1])]
        if not border.any():
            break
        begins = np.r_[0, np.flatnonzero(fresh) + 1]
        sizes = np.diff(begins, append=len(into))
        hit = np.logical_or.reduceat(border, begins)
        split = np.repeat(hit, sizes)
        longer, into, border = longer[split], into[split], border[split]
        sizes = sizes[hit]
        begins = (np.cumsum(sizes) - sizes).astype(np.int32)
        place = into + np.arange(len(into), dtype=np.int32) - np.repeat(begins, sizes)
        order[place] = longer
        common[place[border]] = h - 1
        border[begins] = True
        starts = np.flatnonzero(border)
        block[longer] = np.repeat(place[starts], np.diff(starts, append=len(into)))
        passed = place
    return order, common


#: Texts of a shard.
PER_SHARD = 64


def repeated_places(texts: list[np.ndarray], length: int, per_shard: int = PER_SHARD) -> list[np.ndarray]:
    """For each text, which places begin a string of ``length`` that occurs twice or more in the texts.

    The texts are cut into shards; neighbours in the merged order with a common
    prefix of ``length`` begin the same string.
    """
    shards = [texts[k : k + per_shard] for k in range(0, len(texts), per_shard)]
    built = [shard_transform(s) for s in shards]
    merged, common = merge([t for t, _ in built], length)
    twice = common >= length
    twice[:-1] |= common[1:] >= length
    of = np.empty(len(merged), dtype=bool)
    of[merged] = twice
    out: list[np.ndarray] = []
    begin = 0
    for own, (_, order) in zip(shards, built, strict=True):
        marks = np.empty(len(order), dtype=bool)
        marks[order] = of[begin : begin + len(order)]
        begin += len(order)
        ends = np.cumsum([len(t) + 1 for t in own])
        out += [part[:-1] for part in np.split(marks, ends[:-1])]
    return out
