"""Sharding by longest processing time: kept-together groups to the least-loaded shard.

Groups are equal texts; a group never splits.  Sizes are summed per group before
anything moves.  Groups of at least ``total / (shards * fine)`` bytes go through
the heap by key; there are at most ``shards * fine`` of them.  Smaller groups go
through it by size, longest first, from the number of groups of each size: groups
of one size are alike, so the heap's answer is how many of them each shard takes,
and a group takes its place by its rank within its size.  The driver holds one
row per different size, fewer than the square root of twice the total bytes.

Null text is empty (size 1); equal rows form one group; ties go by group key
among large groups and by rank within the size among others, then by shard
number.  An empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegrid.llm.tables import slots, written


def longest_first(sizes: Iterable[tuple[str, int]], loads: list[int]) -> dict[str, int]:
    """Shard of every (key, size): largest first, each to the least-loaded shard; ``loads`` grow."""
    heap = [(load, shard) for shard, load in enumerate(loads)]
    heapq.heapify(heap)
    placed = {}
    for key, size in sorted(sizes, key=lambda x: (-x[1], x[0])):
        load, shard = heap[0]
        placed[key] = shard
        heapq.heapreplace(heap, (load + size, shard))
        loads[shard] = load + size
    return placed


def alike(size: int, many: int, loads: list[int]) -> list[int]:
    """How many of ``many`` groups of one size each shard takes; ``loads`` grow.

    One by one, the heap would give the shard of load ``l`` its j-th group when
    its load is ``l + j * size``.  Whole rounds of that are found by halving on
    the load that is reached, and fewer groups than shards are left for the heap.
    """
    def taken(level: int) -> list[int]:
        return [max(0, -((load - level) // size)) for load in loads]

    low, high = min(loads), max(loads) + size * many
    while low < high:  # the highest level that takes no more than there are
        level = (low + high + 1) // 2
        if sum(taken(level)) <= many:
            low = level
        else:
            high = level - 1
    counts = taken(low)
    heap = [(load + n * size, shard) for shard, (load, n) in enumerate(zip(loads, counts, strict=True))]
    heapq.heapify(heap)
    for _ in range(many - sum(counts)):
        load, shard = heap[0]
        counts[shard] += 1
        heapq.heapreplace(heap, (load + size, shard))
    for shard, n in enumerate(counts):
        loads[shard] += n * size
    return counts


def sharded(rows: DataFrame, shards: int = 16, fine: int = 256,
            size: str = "size", group: str = "group_key") -> DataFrame:
    """Add ``shard``: rows of one ``group`` stay together, bytes per shard are near equal.

    ``group`` is a hash text column without nulls, ``size`` a positive long.
    """
    spark = rows.sparkSession
    groups = written(rows.groupBy(group).agg(F.sum(size).alias("_size")), "shard-groups")
    total = groups.agg(F.sum("_size")).first()[0] or 0
    large = F.col("_size") * shards * fine >= total
    loads = [0] * shards
    placed = longest_first([(r[0], r[1]) for r in groups.where(large).collect()], loads)  # bounded, see above
    counts = groups.where(~large).groupBy("_size").agg(F.count(F.lit(1)).alias("n"))
    places = []
    for row in sorted(counts.collect(), reverse=True):  # one row per different size
        ends, end = [], 0
        for n in alike(row["_size"], row["n"], loads):
            end += n
            ends.append(end)
        places.append((row["_size"], ends))
    own = F.broadcast(spark.createDataFrame(list(placed.items()), f"{group} string, shard int"))
    ranked = slots(groups.where(~large), "_size", F.xxhash64(group), [F.col(group)], "_place")
    ends = spark.createDataFrame(places, "_size long, _ends array<long>")
    rest = ranked.join(ends, "_size").select(
        group, F.size(F.filter("_ends", lambda end: end <= F.col("_place"))).alias("shard"))
    # a group that is not large has few rows, so no key of the second join is hot
    return rows.join(own, group).unionByName(rows.join(own, group, "left_anti").join(rest, group))


def document_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, size (UTF-8 bytes plus 1), text_crc32 and the key of the text's group."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"),
                       F.sha2(text, 256).alias("group_key"))


def shard_documents(docs: DataFrame, shards: int = 16) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document."""
    rows = written(document_sizes(docs), "shard-rows")
    out = slots(sharded(rows, shards), "shard", F.xxhash64("doc_id", "group_key"),
                [F.col("doc_id"), F.col("group_key")], "slot")
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
