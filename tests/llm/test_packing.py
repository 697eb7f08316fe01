"""The packing plan against the same two steps made item by item."""

import random
from bisect import bisect_right

from pyspark.sql import functions as F

from lumenweave.llm import packing


def by_items(sizes, capacity):
    """Loads of the containers, without runs; which of equal gaps is filled makes no difference to them."""
    large = sorted(s for s in sizes if 3 * s > capacity)
    bins = []
    while large:
        s = large.pop()
        at = bisect_right(large, capacity - s) - 1
        bins.append([s, large.pop(at)] if at >= 0 else [s])
    room = [capacity - sum(b) for b in bins]
    for s in sorted((s for s in sizes if 3 * s <= capacity), reverse=True):
        best = min((i for i in range(len(bins)) if room[i] >= s), key=lambda i: room[i], default=None)
        if best is None:
            bins.append([])
            room.append(capacity)
            best = len(bins) - 1
        bins[best].append(s)
        room[best] -= s
    return sorted(sum(b) for b in bins)


def by_plan(sizes, capacity):
    histogram = {}
    for s in sizes:
        histogram[s] = histogram.get(s, 0) + 1
    runs, n = packing.plan(histogram, capacity)
    bins = [[] for _ in range(n)]
    seen = {s: set() for s in histogram}
    for size, lo, hi, first, each in runs:
        for rank in range(lo, hi):
            assert rank not in seen[size]
            seen[size].add(rank)
            bins[first + (rank - lo) // each].append(size)
    assert all(seen[s] == set(range(k)) for s, k in histogram.items())
    return sorted(sum(b) for b in bins)


def test_plan_equals_item_by_item():
    rng = random.Random(3)
    for _ in range(300):
        capacity = rng.choice([1, 2, 7, 12, 30, 100])
        n = rng.choice([0, 1, 5, 40, 120])
        sizes = [rng.randint(1, rng.choice([capacity, max(1, capacity // 3)])) for _ in range(n)]
        assert by_plan(sizes, capacity) == by_items(sizes, capacity), (capacity, sizes)


def test_plan_of_one_hot_size():
    runs, n = packing.plan({10: 10**9, 4: 3}, 30)
    assert n == -(-10**9 // 3) + (0 if 10**9 % 3 else 1)
    assert len(runs) < 10


def test_pack_keeps_every_text_and_capacity(spark):
    texts = ["", None, "a", "one two three four five six seven eight nine ten " * 9, "cat " * 7, "cat " * 7, "x y"]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)] + [(None, "lost", "c"), (4, "cat " * 7, "again")], "doc_id bigint, text string, size string")
    limits = spark.createDataFrame([(1, "a", 8), (2, "b", 50), (None, "c", 5), (3, "d", 0)], "limit_id int, used_for string, capacity_tokens int")
    packed = packing.pack(docs, limits)
    rows = packed.collect()
    assert {r["limit_id"] for r in rows} == {1, 2}
    for limit, capacity in ((1, 8), (2, 50)):
        own = [r for r in rows if r["limit_id"] == limit]
        assert {r["doc_id"] for r in own} == set(range(len(texts)))
        load = {}
        for r in own:
            assert (r["container_id"] is None) == (r["n_tokens"] == 0)
            if r["container_id"] is not None:
                load[r["container_id"]] = load.get(r["container_id"], 0) + r["n_tokens"]
        assert max(load.values()) <= capacity and set(load) == set(range(len(load)))
        whole = {}
        for r in own:
            whole.setdefault(r["doc_id"], []).append(r)
        for pieces in whole.values():
            assert len(pieces) == pieces[0]["n_pieces"] and (len(pieces) == 1 or sum(p["n_tokens"] for p in pieces) > capacity)
    again = packing.pack(docs.repartition(5), limits).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))
    report = packing.fill_report(packed, limits).where(F.col("limit_id") == 2).collect()[0]
    assert report["n_texts"] == len(texts) and 0 < report["fill"] <= 1


def test_pack_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    limits = spark.createDataFrame([(1, "a", 8)], "limit_id int, used_for string, capacity_tokens int")
    assert packing.pack(docs, limits).count() == 0
