"""Contiguous shards of minimal capacity: minimax partition over ordered atomic groups.

Texts that are equal form one group, and a group stays in one shard. Groups are ordered
by a 60-bit hash of their text, the shards are ranges of that order, and the largest shard
is as small as any such ranges allow. The capacity is found by binary search: a capacity
is feasible if filling shards greedily needs no more than the given number.

The search runs over sums of hash ranges (a bounded table). Merging groups can only
raise the capacity, so each round brackets the place of every cut between two ranges,
opens the ranges in the brackets that hold several groups, and repeats until each is a
single group; the result is the optimum over groups, not over ranges.

Sizes are UTF-8 bytes plus 1; a null text has the size 1 and counts as the empty text. Rows
repeated in full get slots of their own. Empty input gives empty output; fewer groups than
shards leave shards empty. Other columns of the input are not read.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm._shared import stored

HASH_BITS = 60
#: Ranges of the first round, and into how many each opened range is split, as powers of two.
FIRST_BITS, MORE_BITS = 14, 8


def greedy_cuts(sums: list[int], capacity: int, shards: int) -> list[int] | None:
    """Ends of greedily filled shards as indexes into the running sums, or None if they don't suffice."""
    cuts, begin = [], 0
    for _ in range(shards):
        end = bisect_right(sums, sums[begin] + capacity) - 1
        cuts.append(end)
        if end == len(sums) - 1:
            return cuts
        if end == begin:
            return None
        begin = end
    return None


def smallest_capacity(sizes: list[int], shards: int) -> int:
    """The least capacity for which contiguous runs of the sizes fit into so many shards."""
    sums = [0, *accumulate(sizes)]
    low, high = max(max(sizes), -(-sums[-1] // shards)), sums[-1]
    while low < high:
        middle = (low + high) // 2
        if greedy_cuts(sums, middle, shards) is None:
            low = middle + 1
        else:
            high = middle
    return low


def brackets(sizes: list[int], low: int, high: int, shards: int) -> set[int]:
    """Indexes of the ranges in which a cut can lie when the capacity lies between low and high."""
    sums = [0, *accumulate(sizes)]
    found: set[int] = set()
    least = most = 0
    for _ in range(shards - 1):
        begin = bisect_right(sums, least + low) - 1  # a range's end is a place where greedy filling can cut
        least, most = sums[begin], min(most + high, sums[-1])
        found.update(range(begin, min(bisect_right(sums, most), len(sizes))))
    return found


def cut_points(groups: DataFrame, shards: int) -> list[int]:
    """Hashes at which the second and later shards begin. groups: hash, bytes (one row each)."""
    largest = groups.agg(F.max("bytes"), F.sum("bytes")).first()
    if largest[0] is None:
        return []
    floor = max(largest[0], -(-largest[1] // shards))

    def summed(rows: DataFrame, shift: int) -> list[tuple[int, int, int, int]]:
        key = F.shiftright("hash", shift)
        return [
            (r["first"], shift, r["groups"], r["bytes"])
            for r in rows.groupBy(key.alias("key"))
            .agg(F.min("hash").alias("first"), F.count("hash").alias("groups"), F.sum("bytes").alias("bytes"))
            .collect()
        ]

    shift = HASH_BITS - FIRST_BITS
    ranges = sorted(summed(groups, shift))
    while True:
        sizes = [r[3] for r in ranges]
        capacity = smallest_capacity(sizes, shards)
        opened = [k for k in brackets(sizes, floor, capacity, shards) if ranges[k][2] > 1]
        if not opened:
            break
        finer = []
        for level in {ranges[k][1] for k in opened}:
            keys = [ranges[k][0] >> level for k in opened if ranges[k][1] == level]
            finer += summed(groups.filter(F.shiftright("hash", level).isin(keys)), max(0, level - MORE_BITS))
        ranges = sorted([*(r for k, r in enumerate(ranges) if k not in set(opened)), *finer])
    sums = [0, *accumulate(sizes)]
    return [ranges[k][0] for k in greedy_cuts(sums, capacity, shards)[:-1]]


def shard(docs: DataFrame, shards: int = 16, slices: int = 256) -> DataFrame:
    """doc_id, size, text_crc32, law ('bytes'), shard, slot and grown_shard (null) of every document.

    Slots number the rows of a shard from 0. They are counted in ``slices`` parts by the hash
    of doc_id, so a group or shard of any size is numbered by many tasks.
    """
    text = F.coalesce("text", F.lit(""))
    rows = stored(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.conv(F.substring(F.md5(text.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long").alias("hash"),
            F.pmod(F.xxhash64("doc_id"), F.lit(slices)).cast("int").alias("slice"),
        )
    )
    cuts = cut_points(stored(rows.groupBy("hash").agg(F.sum("size").alias("bytes"))), shards)
    place = sum((F.when(F.col("hash") >= cut, 1).otherwise(0) for cut in cuts), F.lit(0))
    placed = rows.withColumn("shard", place.cast("int"))
    before = Window.partitionBy("shard").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("shard", "slice")
        .agg(F.count(F.lit(1)).alias("rows"))
        .select("shard", "slice", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    )
    order = Window.partitionBy("shard", "slice").orderBy("doc_id", "hash", "size")
    return (
        placed.withColumn("nth", F.row_number().over(order) - 1)
        .join(F.broadcast(starts), ["shard", "slice"])  # at most shards x slices rows
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("start") + F.col("nth")).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
