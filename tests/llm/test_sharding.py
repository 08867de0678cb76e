from __future__ import annotations

import random
import zlib
from itertools import accumulate

import pytest

from ledgerloom.llm import sharding
from tests.llm.fixtures import docs, empty, odd_table, rows  # noqa: F401


@pytest.mark.parametrize("seed", range(8))
def test_least_capacity_and_cuts(seed):
    draw = random.Random(seed)
    sizes = [draw.choice([draw.randint(1, 99), draw.randint(1, 3000)]) for _ in range(draw.randint(1, 60))]
    shards = draw.randint(1, 7)
    cells = sharding._Cells([(i, 0, s, 1) for i, s in enumerate(sizes)])
    capacity = cells.least_capacity(shards)
    sums = [0, *accumulate(sizes)]
    best = [0] + [10**9] * len(sizes)
    for _ in range(shards):  # by dynamic programming
        best = [min(max(best[j], sums[i] - sums[j]) for j in range(i + 1)) for i in range(len(sums))]
    assert capacity == best[-1]
    cuts = [0, *cells.cuts(shards, capacity), len(sizes)]
    assert cuts == sorted(cuts) and max(sums[b] - sums[a] for a, b in zip(cuts, cuts[1:], strict=False)) == capacity


@pytest.mark.parametrize("shards", [1, 5, 40])
def test_whole_table(docs, shards, monkeypatch):  # noqa: F811
    monkeypatch.setattr(sharding, "FIRST_BITS", 2)  # cells of several groups, so that some are refined
    monkeypatch.setattr(sharding, "CELL_BITS", 3)
    got = sharding.shard_by_bytes(docs, shards).collect()
    texts = {i: (t or "").encode() for i, t, *_ in rows()}
    assert {r.doc_id: (r["size"], r.text_crc32) for r in got} == {i: (len(t) + 16, zlib.crc32(t)) for i, t in texts.items()}
    where: dict[bytes, set[int]] = {}
    slots: dict[int, list[int]] = {}
    for r in got:
        where.setdefault(texts[r.doc_id], set()).add(r.shard)
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(len(s) == 1 for s in where.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) <= set(range(shards))


def test_capacity_is_the_least_over_the_places(docs, monkeypatch):  # noqa: F811
    monkeypatch.setattr(sharding, "FIRST_BITS", 2)
    monkeypatch.setattr(sharding, "CELL_BITS", 3)
    from pyspark.sql import functions as F

    place = F.shiftrightunsigned(F.xxhash64(F.coalesce("text", F.lit(""))), 1)
    groups = docs.groupBy(place.alias("place")).agg(F.sum(F.octet_length(F.coalesce("text", F.lit(""))) + 16).alias("size"))
    sizes = [r["size"] for r in groups.orderBy("place").collect()]
    whole = sharding._Cells([(i, 0, s, 1) for i, s in enumerate(sizes)])
    got = sharding.shard_by_bytes(docs, 6).groupBy("shard").agg(F.sum("size").alias("s")).collect()
    assert max(r.s for r in got) == whole.least_capacity(6)


def test_odd_rows(spark):
    got = sharding.shard_by_bytes(odd_table(spark), 3).collect()
    assert len(got) == 6 and sum(r.doc_id is None for r in got) == 1
    assert sharding.shard_by_bytes(empty(spark), 3).collect() == []
