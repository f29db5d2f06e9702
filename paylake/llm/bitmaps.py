"""Compressed bitmaps of 64-bit ids per group, and rank queries on them.

The ids of a group are cut into containers of 2^16 ids.  A container is a sorted array
while it holds few ids and a bitmap with a directory of popcounts otherwise; it answers
``rank``, how many of its ids are smaller, without sorting anything.  What lies before a
container is added up over three levels of prefixes of 16 bits each, so no window here
ever has more than 2^16 rows, whether ids are dense or spread over all 64 bits.

An id may carry a weight, the number of rows that share it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paylake.llm.common import stored

LOW_BITS = 16
# A container of fewer ids is an array: from here on a bitmap is smaller.
BITMAP_FROM = 5120
ARRAY, BITMAP = b"a", b"b"
WORDS = (1 << LOW_BITS) // 64

# Sorts before every prefix: what comes ahead of all ids of a group.
AHEAD = -(1 << 31)

PACKED = "_group string, _prefix long, total long, container binary, weights binary"


def packed(lows: np.ndarray) -> bytes:
    """A container of the given ids (16 bits, in any order, no repeats)."""
    if len(lows) < BITMAP_FROM:
        return ARRAY + np.sort(lows).astype("<u2").tobytes()
    bits = np.zeros(1 << LOW_BITS, np.uint8)
    bits[lows] = 1
    words = np.packbits(bits, bitorder="little").view("<u8")
    counts = np.bitwise_count(words).astype(np.int64)
    directory = (np.cumsum(counts) - counts).astype("<u2")
    return BITMAP + directory.tobytes() + words.tobytes()


def ranks_in(container: bytes, lows: np.ndarray) -> np.ndarray:
    """For each of ``lows`` the number of smaller ids in the container."""
    if container[:1] == ARRAY:
        return np.searchsorted(np.frombuffer(container, "<u2", offset=1), lows).astype(np.int64)
    directory = np.frombuffer(container, "<u2", WORDS, 1)
    words = np.frombuffer(container, "<u8", WORDS, 1 + 2 * WORDS)
    at, below = lows >> 6, (np.uint64(1) << (lows & 63).astype(np.uint64)) - np.uint64(1)
    return directory[at].astype(np.int64) + np.bitwise_count(words[at] & below)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        totals, containers, weights = [], [], []
        for lows, counts in zip(batch.column("lows"), batch.column("counts"), strict=True):
            ids = lows.values.to_numpy(zero_copy_only=False).astype(np.int64)
            n = counts.values.to_numpy(zero_copy_only=False).astype(np.int64)
            totals.append(int(n.sum()))
            containers.append(packed(ids))
            plain = bool((n == 1).all())
            weights.append(None if plain else np.concatenate([[0], np.cumsum(n[np.argsort(ids)])]).astype("<i8").tobytes())
        yield pa.record_batch(
            [batch.column("_group"), batch.column("_prefix"), pa.array(totals, pa.int64()),
             pa.array(containers, pa.binary()), pa.array(weights, pa.binary())],
            ["_group", "_prefix", "total", "container", "weights"],
        )


def _prefix(key: str) -> Column:
    return F.shiftright(F.col(key), LOW_BITS)


def _low(key: str) -> Column:
    return F.col(key).bitwiseAND((1 << LOW_BITS) - 1)


def bitmap_index(ids: DataFrame, group: str, key: str, weight: str, ahead: DataFrame | None = None) -> DataFrame:
    """The containers of the distinct (group, key) of ``ids``: with what lies before each, ``base``.

    ``ahead`` has rows (group, weight) that come before all ids of their group, at most one each.
    """
    small = ids.select(
        F.col(group).alias("_group"), _prefix(key).alias("_prefix"), _low(key).alias("_low"), F.col(weight).alias("_n")
    )
    containers = stored(
        small.groupBy("_group", "_prefix")
        .agg(F.collect_list(F.struct("_low", "_n")).alias("_ids"))
        .select("_group", "_prefix", F.col("_ids._low").alias("lows"), F.col("_ids._n").alias("counts"))
        .mapInArrow(_pack, PACKED),
        "containers",
    )
    levels = containers.select(
        "*", F.shiftright("_prefix", 16).alias("_upper"), F.shiftright("_prefix", 32).alias("_top")
    )
    sums = levels.groupBy("_group", "_top", "_upper").agg(F.sum("total").alias("total"))
    tops = sums.groupBy("_group", "_top").agg(F.sum("total").alias("total"))
    if ahead is not None:
        tops = tops.unionByName(
            ahead.select(F.col(group).alias("_group"), F.lit(AHEAD).cast("long").alias("_top"), F.col(weight).alias("total"))
        )

    def before(partition: list[str], order: str) -> Column:
        rows = Window.partitionBy(*partition).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("total").over(rows), F.lit(0)).cast("long")

    tops = tops.select("_group", "_top", before(["_group"], "_top").alias("_b0"))
    sums = sums.select("_group", "_top", "_upper", before(["_group", "_top"], "_upper").alias("_b1"))
    inner = levels.withColumn("_b2", before(["_group", "_upper"], "_prefix"))
    return (
        inner.join(sums, ["_group", "_top", "_upper"]).join(tops, ["_group", "_top"])
        .select("_group", "_prefix", "container", "weights", (F.col("_b0") + F.col("_b1") + F.col("_b2")).alias("base"))
    )


def _rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        starts = []
        rows = zip(
            batch.column("container").to_pylist(), batch.column("weights").to_pylist(),
            batch.column("base").to_pylist(), batch.column("lows"), strict=True,
        )
        for container, weights, base, lows in rows:
            rank = ranks_in(container, lows.values.to_numpy(zero_copy_only=False).astype(np.int64))
            if weights is not None:
                rank = np.frombuffer(weights, "<i8")[rank]
            starts.append(rank + base)
        yield pa.record_batch(
            [batch.column("_group"), batch.column("_prefix"), batch.column("lows"),
             pa.array(starts, pa.list_(pa.int64()))],
            ["_group", "_prefix", "lows", "starts"],
        )


def ranks(index: DataFrame, queries: DataFrame, group: str, key: str) -> DataFrame:
    """(group, key, start) for the distinct (group, key) of ``queries`` that are in containers of the index.

    ``start`` is the weight of all smaller ids of the group.
    """
    asked = (
        queries.groupBy(F.col(group).alias("_group"), _prefix(key).alias("_prefix"))
        .agg(F.collect_set(_low(key)).alias("lows"))
    )
    found = asked.join(index, ["_group", "_prefix"]).select("_group", "_prefix", "lows", "container", "weights", "base")
    answered = found.mapInArrow(_rank, "_group string, _prefix long, lows array<long>, starts array<long>")
    each = answered.select("_group", "_prefix", F.explode(F.arrays_zip("lows", "starts")).alias("_one"))
    return each.select(
        F.col("_group").alias(group),
        (F.shiftleft(F.col("_prefix"), LOW_BITS) + F.col("_one.lows")).alias(key),
        F.col("_one.starts").alias("start"),
    )
