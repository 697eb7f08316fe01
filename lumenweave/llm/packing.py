"""Packing texts into containers of fixed capacity by large-item matching and best fit.

Sizes are whole numbers up to the capacity, so a packing is decided by the histogram of sizes alone: items of one size are
interchangeable. The histogram has at most ``capacity`` rows whatever the number of texts, and the plan made from it has a
few rows for each size. Two steps:

1. Items above a third of the capacity: at most two fit in a container. Each largest one left is matched with the largest
   other one that fits beside it, which needs the fewest containers for such items.
2. Smaller items, in descending size, go to the tightest gap that holds them; a new container is opened if none does.

Both steps work on runs of equal sizes and equal gaps, and give exactly what they give item by item. The plan says for a
range of ranks among the items of a size in which containers they lie. Ranks are prefix counts over hash buckets, whose number
grows with the items of a size, so no size, however frequent, is ordered in one task.

A text above the capacity is cut into full pieces and a rest; all others stay whole. Texts without tokens (null, empty) need
no room: they come out with a null container. Rows without a key are no records; a repeated key counts once.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections import defaultdict

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import broadcast_if_small, materialise
from .tokens import VOCABULARY, n_tokens

#: Items of one size for which there is one more hash bucket in which they are ranked.
BUCKET_ROWS = 20_000

Run = tuple[int, int, int, int, int]


def plan(histogram: dict[int, int], capacity: int) -> tuple[list[Run], int]:
    """Runs ``(size, first_rank, end_rank, first_container, items_per_container)`` and the number of containers.

    Ranks of a size are from 0 up. In a run the items fill one container after the other, ``items_per_container`` each.
    """
    left = {s: n for s, n in histogram.items() if n > 0 and 0 < s <= capacity}
    used: dict[int, int] = defaultdict(int)
    runs: list[Run] = []
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)
    open_gaps: list[int] = []
    containers = 0

    def put(size: int, n: int, first: int, each: int) -> None:
        runs.append((size, used[size], used[size] + n, first, each))
        used[size] += n

    def leave(gap: int, first: int, n: int) -> None:
        if gap > 0:
            if not gaps[gap]:
                insort(open_gaps, gap)
            gaps[gap].append((first, n))

    large = sorted(s for s in left if 3 * s > capacity)
    while large:
        size = large[-1]
        n = left[size]
        at = bisect_right(large, capacity - size) - 1
        mate = large[at] if at >= 0 else None
        if mate is None:
            put(size, n, containers, 1)
            leave(capacity - size, containers, n)
            containers, done = containers + n, n
        elif mate == size:
            pairs = n // 2
            if pairs:
                put(size, 2 * pairs, containers, 2)
                leave(capacity - 2 * size, containers, pairs)
                containers += pairs
            left[size] = n - 2 * pairs
            if left[size] and at > 0:  # one is left over: the next smaller size is its mate
                mate = large[at - 1]
                put(size, 1, containers, 1)
                put(mate, 1, containers, 1)
                leave(capacity - size - mate, containers, 1)
                left[mate] -= 1
                if not left[mate]:
                    large.pop(at - 1)
                containers += 1
            elif left[size]:
                put(size, 1, containers, 1)
                leave(capacity - size, containers, 1)
                containers += 1
            done = left[size]
        else:
            done = min(n, left[mate])
            put(size, done, containers, 1)
            put(mate, done, containers, 1)
            leave(capacity - size - mate, containers, done)
            containers += done
            left[mate] -= done
            if not left[mate]:
                large.pop(at)
        left[size] -= done
        if not left[size]:
            large.remove(size)

    for size in sorted((s for s in left if 3 * s <= capacity), reverse=True):
        n = left[size]
        while n:
            at = bisect_left(open_gaps, size)
            if at < len(open_gaps):
                gap = open_gaps[at]
                first, there = gaps[gap].pop()
                if not gaps[gap]:
                    open_gaps.pop(at)
            else:
                gap, first, there = capacity, containers, -(-n // (capacity // size))
                containers += there
            each = gap // size
            full = min(there, n // each)
            if full:
                put(size, full * each, first, each)
                leave(gap - each * size, first, full)
            n -= full * each
            rest = there - full
            if rest and n:  # fewer than ``each`` items are left: they go to one container
                put(size, n, first + full, n)
                leave(gap - n * size, first + full, 1)
                n, rest, full = 0, rest - 1, full + 1
            leave(gap, first + full, rest) if rest else None
    return runs, containers


def items(sizes: DataFrame, limits: dict[int, int]) -> DataFrame:
    """Pieces ``(limit_id, doc_id, piece_no, n_pieces, token_from, size)`` of ``sizes(doc_id, n_tokens)`` for each limit."""
    each = F.explode(F.array(*[F.struct(F.lit(k).cast("int").alias("limit_id"), F.lit(c).cast("bigint").alias("capacity")) for k, c in sorted(limits.items())]))
    rows = sizes.select("doc_id", "n_tokens", each.alias("l")).select("l.*", "doc_id", "n_tokens")
    n_pieces = F.greatest(F.ceil(F.col("n_tokens") / F.col("capacity")), F.lit(1)).cast("int")
    rows = rows.withColumn("n_pieces", n_pieces).withColumn("piece_no", F.explode(F.sequence(F.lit(0), F.col("n_pieces") - 1)))
    start = F.col("piece_no") * F.col("capacity")
    return rows.select("limit_id", "doc_id", "piece_no", "n_pieces", start.alias("token_from"), F.least(F.col("n_tokens") - start, F.col("capacity")).alias("size"))


def ranked(pieces: DataFrame, histogram: DataFrame) -> DataFrame:
    """``pieces`` with ``rank``, the 0-based place among the pieces of one limit and size, ordered by bucket, document and piece.

    ``histogram(limit_id, size, buckets)`` has the number of buckets of each size, which grows with its pieces.
    """
    keyed = pieces.join(histogram, ["limit_id", "size"]).withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece_no"), F.col("buckets")).cast("int")).drop("buckets")
    of = ["limit_id", "size", "bucket"]
    before = Window.partitionBy("limit_id", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = keyed.groupBy(*of).count().select(*of, F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    local = keyed.withColumn("local", F.row_number().over(Window.partitionBy(*of).orderBy("doc_id", "piece_no")) - 1)
    return local.join(offsets, of).withColumn("rank", F.col("local") + F.col("offset")).drop("local", "offset", "bucket")


def pack(documents: DataFrame, limits: DataFrame, vocabulary: str = VOCABULARY, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Containers of the texts of ``documents(doc_id, text)`` for each row of ``limits(limit_id, capacity_tokens)``.

    Returns ``(limit_id, container_id, doc_id, piece_no, n_pieces, token_from, n_tokens)``; containers of a limit are
    numbered from 0. Limits without an id or a positive capacity are left out. The limits are a table of settings: more
    than 1000 are refused.
    """
    spark = documents.sparkSession
    rows = limits.where("limit_id is not null and capacity_tokens > 0").groupBy("limit_id").agg(F.max("capacity_tokens").alias("c")).limit(1001).collect()
    if len(rows) > 1000:
        raise ValueError("more than 1000 limits")
    capacities = {r["limit_id"]: r["c"] for r in rows}
    schema = "limit_id int, container_id bigint, doc_id bigint, piece_no int, n_pieces int, token_from bigint, n_tokens bigint"
    if not capacities:
        return spark.createDataFrame([], schema)
    counted = documents.where("doc_id is not null").select("doc_id", n_tokens(F.col("text"), vocabulary).alias("n_tokens"))
    pieces = items(materialise(counted).groupBy("doc_id").agg(F.max("n_tokens").alias("n_tokens")), capacities)
    histogram: dict[int, dict[int, int]] = {k: {} for k in capacities}
    for r in pieces.where("size > 0").groupBy("limit_id", "size").count().collect():  # at most the sum of the capacities
        histogram[r["limit_id"]][r["size"]] = r["count"]
    runs = [(k, *run) for k, c in capacities.items() for run in plan(histogram[k], c)[0]]
    steps = spark.createDataFrame(runs, "limit_id int, size bigint, first_rank bigint, end_rank bigint, first_container bigint, each bigint")
    buckets = [(k, size, max(1, n // bucket_rows)) for k, sizes in histogram.items() for size, n in sizes.items()]
    placed = ranked(pieces.where("size > 0"), broadcast_if_small(spark.createDataFrame(buckets, "limit_id int, size bigint, buckets bigint"))).join(broadcast_if_small(steps), ["limit_id", "size"]).where("rank >= first_rank and rank < end_rank")
    placed = placed.withColumn("container_id", F.expr("first_container + (rank - first_rank) div each"))
    out = placed.unionByName(pieces.where("size = 0").withColumn("container_id", F.lit(None).cast("bigint")), allowMissingColumns=True)
    return out.select("limit_id", "container_id", "doc_id", "piece_no", "n_pieces", "token_from", F.col("size").alias("n_tokens"))


def fill_report(packed: DataFrame, limits: DataFrame) -> DataFrame:
    """Per limit: texts, containers, tokens, least possible number of containers, and the share of the room that is used."""
    per = packed.groupBy("limit_id").agg(F.count_if(F.col("piece_no") == 0).alias("n_texts"), (F.max("container_id") + 1).alias("n_containers"), F.sum("n_tokens").alias("tokens"))
    return per.join(limits.select("limit_id", "used_for", "capacity_tokens"), "limit_id").select(
        "limit_id", "used_for", "n_texts", "n_containers", "tokens", F.ceil(F.col("tokens") / F.col("capacity_tokens")).alias("least_containers"),
        F.try_divide(F.col("tokens"), F.col("n_containers") * F.col("capacity_tokens")).alias("fill"))
