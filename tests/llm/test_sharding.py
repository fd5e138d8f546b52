"""Sharding against a plain longest-first loop."""

import random
import zlib
from collections import Counter, defaultdict

import pytest

pytest.importorskip("tastegrid.llm.queries")

from tastegrid.llm import sharding  # noqa: E402
from tastegrid.session import local_session  # noqa: E402

SCHEMA = "doc_id long, text string, shard int, size string"


@pytest.fixture(scope="module")
def spark():
    return local_session(cores=4, shuffle_partitions=4, memory="3g")


def plainly(sizes: list[int], shards: int) -> list[int]:
    """Loads after the longest-first rule, one group at a time."""
    loads = [0] * shards
    for size in sorted(sizes, reverse=True):
        loads[loads.index(min(loads))] += size
    return loads


def test_alike_is_the_heap_one_by_one():
    draw = random.Random(5)
    for _ in range(300):
        loads = [draw.randrange(60) for _ in range(draw.randint(1, 6))]
        size, many = draw.randint(1, 20), draw.randint(0, 50)
        expected, counts = list(loads), [0] * len(loads)
        for _ in range(many):
            at = expected.index(min(expected))
            expected[at] += size
            counts[at] += 1
        got = sharding.alike(size, many, loads)
        assert got == counts and loads == expected


@pytest.mark.parametrize("fine", [2, 256])
def test_loads_are_those_of_the_plain_rule(spark, fine):
    draw = random.Random(fine)
    texts = [str(i) + "x" * draw.choice([5, 5, 5, 9, 30, 200]) for i in range(400)]
    texts += ["copy" * 20] * 150 + ["", None, None, "é" * 40]
    rows = spark.createDataFrame([(i, t, 3, "clash") for i, t in enumerate(texts)], SCHEMA)
    got = sharding.sharded(sharding.document_sizes(rows), 5, fine).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(len(texts)))
    groups, loads, shards = Counter(), Counter(), defaultdict(set)
    for r in got:
        assert r["size"] == len((texts[r["doc_id"]] or "").encode()) + 1
        groups[r["group_key"]] += r["size"]
        loads[r["shard"]] += r["size"]
        shards[r["group_key"]].add(r["shard"])
    assert all(len(s) == 1 for s in shards.values())
    assert sorted(loads.values()) == sorted(plainly(list(groups.values()), 5))


def test_equal_sizes_and_slots(spark):
    rows = spark.createDataFrame([(i, f"{i:04d}", 0, None) for i in range(1000)], SCHEMA)
    got = sharding.shard_documents(rows, 8).collect()
    slots = defaultdict(list)
    for r in got:
        assert (r["size"], r["text_crc32"]) == (5, zlib.crc32(f"{r['doc_id']:04d}".encode()))
        slots[r["shard"]].append(r["slot"])
    assert {s: sorted(n) for s, n in slots.items()} == {s: list(range(125)) for s in range(8)}
