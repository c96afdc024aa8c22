"""Each group's own random order of the same items, without a shuffle of their pairs."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# MD5: rotations, word of each step, constants and state (RFC 1321).
TURNS = [s for r in ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)) for s in r * 4]
WORDS = [(m * i + p) % 16 for m, p in ((1, 0), (5, 1), (3, 5), (7, 0)) for i in range(16)]
SINES = [np.uint32(int(abs(math.sin(i + 1)) * 2**32)) for i in range(64)]
STATE = [np.uint32(x) for x in (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)]

#: Digests made at once (their words stay in the cache), pairs of one task, items in one row of a result.
CELLS, TASK_PAIRS, PIECE = 1 << 15, 2_000_000, 1 << 16


def digests(heads: np.ndarray, tails: np.ndarray) -> list[np.ndarray]:
    """The four words of the MD5 of each head with each tail behind it.

    Both are bytes, a text per row, all heads and all tails of one length, together at most
    55: one block, whose words are those of the head, of the tail, or of both.
    """
    cut, end = heads.shape[1], heads.shape[1] + tails.shape[1]
    p, s = np.zeros((len(heads), 64), "u1"), np.zeros((len(tails), 64), "u1")
    p[:, :cut], s[:, cut:end], s[:, end] = heads, tails, 0x80
    p, s = p.view("<u4").T[:, :, None], np.ascontiguousarray(s.view("<u4").T)[:, None, :]
    words = [p[w] if 4 * w + 4 <= cut else s[w] if 4 * w >= cut else p[w] | s[w] for w in range(end // 4 + 1)]
    words += [np.zeros((1, 1), "u4")] * (16 - len(words))
    words[14] = np.full((1, 1), 8 * end, "u4")
    a, b, c, d = (np.full((len(heads), len(tails)), x) for x in STATE)
    f, t = np.empty_like(a), np.empty_like(a)
    for i in range(64):
        if i < 16:
            np.bitwise_xor(c, d, out=f)
            f &= b
            f ^= d
        elif i < 32:
            np.bitwise_xor(b, c, out=f)
            f &= d
            f ^= c
        elif i < 48:
            np.bitwise_xor(b, c, out=f)
            f ^= d
        else:
            np.invert(d, out=f)
            f |= b
            f ^= c
        f += a
        f += words[WORDS[i]] + SINES[i]
        np.left_shift(f, np.uint32(TURNS[i]), out=t)
        f >>= np.uint32(32 - TURNS[i])
        f |= t
        f += b
        a, d, c, b, f = d, c, b, f, a
    return [x + y for x, y in zip((a, b, c, d), STATE)]


def by_length(numbers: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Places and decimal texts (bytes) of whole numbers, by the length of the text."""
    texts = numbers.astype("S20")
    lengths, each = np.char.str_len(texts), texts.view("u1").reshape(len(numbers), 20)
    return {int(n): (at, each[at, :n]) for n in np.unique(lengths) for at in [np.flatnonzero(lengths == n)]}


def half(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Two words of a digest as a number that sorts as its hexadecimal digits do."""
    return high.byteswap().astype("u8") << np.uint64(32) | low.byteswap()


def hashed_orders(heads: np.ndarray, items: np.ndarray, texts: dict, bits: int = 0) -> np.ndarray:
    """For each head the places of all items, ordered by the MD5 of head and item, then item.

    Sorted are the first bits of the hash with the place in the last ``bits`` (as few as hold
    it); a head with two items that agree in those is sorted again by the whole hash and the
    item.
    """
    bits = np.uint64(bits or len(items).bit_length())
    keys = np.empty((len(heads), len(items)), "u8")

    def each(heads):
        for at, tails in texts.values():
            for i in range(0, len(at), CELLS):
                yield at[i : i + CELLS], digests(heads, tails[i : i + CELLS])

    for at, (a, b, _, _) in each(heads):
        keys[:, at] = half(a, b) >> bits << bits | at.astype("u8")
    keys.sort(axis=1)
    mask = (np.uint64(1) << bits) - np.uint64(1)
    places = (keys & mask).astype("i8")
    for k in np.flatnonzero((keys[:, 1:] ^ keys[:, :-1] <= mask).any(axis=1)):
        first, last = np.empty(len(items), "u8"), np.empty(len(items), "u8")
        for at, (a, b, c, d) in each(heads[k : k + 1]):
            first[at], last[at] = half(a, b)[0], half(c, d)[0]
        places[k] = np.lexsort((items, last, first))
    return places


def orders(ids: list[int | None], items: np.ndarray, seed: int) -> Iterator[tuple[list[int | None], np.ndarray]]:
    """Lots of ids, with the items in the order of each.  A null id has no hash: items as they sort."""
    texts, lot = by_length(items), max(1, CELLS // len(items))
    if None in ids:
        yield [None], np.sort(items)[None, :]
    known = np.array([x for x in ids if x is not None], "i8")
    for n, (at, each) in by_length(known).items():
        start, colon = np.frombuffer(b"%d:" % seed, "u1"), np.frombuffer(b":", "u1")
        heads = np.hstack([np.tile(start, (len(at), 1)), each, np.tile(colon, (len(at), 1))])
        for i in range(0, len(at), lot):
            yield known[at[i : i + lot]].tolist(), items[hashed_orders(heads[i : i + lot], items, texts)]


def shuffled_orders(groups: DataFrame, items: DataFrame, name: str, seed: int = 42) -> DataFrame:
    """``group, item, name``: the place of each item in each group's own fixed random order.

    Both tables have one column of whole numbers; each distinct group (null is one) meets
    each distinct item that is not null.  The order is that of ``shuffled_rank`` over all
    pairs.  Each task has the list of items, hashes and sorts it for a group at a time, so
    only the groups are shuffled; a task takes some 80 bytes of memory an item.
    """
    (group,), (item,) = groups.columns, items.columns
    found = items.where(F.col(item).isNotNull()).distinct().toArrow()
    listed, kind = found.column(0).to_numpy(), found.schema.field(0).type
    if not len(listed):
        return groups.crossJoin(items.where("false")).withColumn(name, F.lit(0))
    groups = groups.distinct()
    tasks = -(-groups.count() * len(listed) // TASK_PAIRS)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, rows in orders(batch.column(0).to_pylist(), listed.astype("i8"), seed):
                for at in range(0, len(listed), PIECE):
                    part = rows[:, at : at + PIECE]
                    ends = np.arange(len(ids) + 1, dtype="i4") * part.shape[1]
                    parts = pa.ListArray.from_arrays(pa.array(ends), pa.array(part.ravel()).cast(kind))
                    yield pa.RecordBatch.from_arrays([pa.array(ids, batch.column(0).type), pa.array([at] * len(ids), pa.int32()), parts], [group, "_from", "_items"])

    of, to = (d.schema[0].dataType.simpleString() for d in (groups, items))
    lists = groups.repartition(max(1, tasks)).mapInArrow(work, f"`{group}` {of}, _from int, _items array<{to}>")
    each = lists.select(group, "_from", F.posexplode("_items").alias("_at", item))
    return each.select(group, item, (F.col("_from") + F.col("_at") + 1).alias(name))
