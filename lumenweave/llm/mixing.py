"""Mixing sources to target weights, with distributed prefix sums.

Each record gets a hash-random key in [0, 1). The key's range is cut into equal buckets per source, which is a range
partition of a uniform key; bucket totals are summed in a window over the buckets of a source (at most ``buckets`` rows),
and a window inside each bucket finishes the prefix sum. So no source, however large, is ordered in one task.

The budget of a source is ``total * weight / sum(weights)``. With T the source's size it is served by floor(budget / T)
whole epochs and one cut epoch: a record belongs to the cut if at least half of it lies before the remaining budget, so
the error is at most half a record. ``max_repeats`` bounds the uses of a record; a source that can't fill its budget stays
short, and its actual share says so. A source without data gives no rows but stands in the report with zero.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import broadcast_if_small, materialise

#: Least number of ranges of keys (buckets) in a source.
BUCKETS = 1024
#: Records for which there is one more range.
BUCKET_ROWS = 20_000
SEED = 20


def normal_source(source: Column) -> Column:
    """One spelling of a source: trimmed, lower case, without trailing slashes; null if nothing is left."""
    return F.nullif(F.regexp_replace(F.lower(F.trim(source)), "/+$", ""), F.lit(""))


def caption_size(captions: Column) -> Column:
    """Characters of all captions that aren't null; 0 for a null or empty array."""
    return F.coalesce(F.aggregate(captions, F.lit(0).cast("bigint"), lambda n, x: n + F.coalesce(F.length(x), F.lit(0))), F.lit(0).cast("bigint"))


def hash_key(record: Column, seed: int = SEED) -> Column:
    """A number in [0, 2^32) that depends on the record's key and the seed alone; the same in any engine that has md5."""
    return F.conv(F.substring(F.md5(F.concat(record.cast("string"), F.lit(f":{seed}"))), 1, 8), 16, 10).cast("bigint")


def prefix_sums(records: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``records(id, source, size, key)`` with ``start``, the total size of the source's records before each one, and ``source_size``.

    Ties of the key are ordered by id. Records of size 0 are kept; they have the start of their successor.
    """
    keyed = records.withColumn("bucket", F.floor(F.col("key") * F.lit(buckets) / F.lit(2**32)).cast("int"))
    totals = keyed.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    by_source = Window.partitionBy("source")
    before = by_source.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("source", "bucket", F.coalesce(F.sum("bucket_size").over(before), F.lit(0)).alias("offset"), F.sum("bucket_size").over(by_source).alias("source_size"))
    inside = Window.partitionBy("source", "bucket").orderBy("key", "id").rowsBetween(Window.unboundedPreceding, -1)
    local = keyed.withColumn("local", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return local.join(offsets, ["source", "bucket"]).select("id", "source", "size", "key", (F.col("local") + F.col("offset")).alias("start"), "source_size")


def budgets(targets: DataFrame, total_size: DataFrame) -> DataFrame:
    """Targets with ``target_share`` and ``budget``; ``total_size`` has one row ``(all_size)``.

    Null and non-positive weights count as 0. Sources are compared in their normal spelling; a mix that names one twice
    has its weights added and the larger cap (null: none).
    """
    one = targets.where("mix_name is not null").groupBy("mix_name", normal_source(F.col("image_source")).alias("source")).agg(
        F.sum(F.greatest(F.coalesce("weight", F.lit(0.0)), F.lit(0.0))).alias("weight"), F.when(F.count_if(F.col("max_repeats").isNull()) == 0, F.max("max_repeats")).alias("max_repeats"), F.max("size_ratio").alias("size_ratio"))
    share = F.try_divide(F.col("weight"), F.sum("weight").over(Window.partitionBy("mix_name")))
    return one.withColumn("target_share", F.coalesce(share, F.lit(0.0))).withColumn("budget", total_size.scalar() * F.col("size_ratio") * F.col("target_share"))


def mix(annotations: DataFrame, targets: DataFrame, buckets: int = BUCKETS, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """The mixes and their report.

    ``annotations(ann_id, image_source, captions, ...)``: one row per ``ann_id`` counts. Returns
    ``(mix_name, image_source, ann_id, repeats, size)`` and ``(mix_name, image_source, target_share, actual_share,
    budget, actual_size, n_records, most_repeats)``. Records without a source belong to no mix, but to the total size; rows
    without a key are no records.
    """
    rows = annotations.where("ann_id is not null").select(F.col("ann_id").alias("id"), normal_source(F.col("image_source")).alias("source"), caption_size(F.col("captions")).alias("size")).dropDuplicates(["id"])
    rows = materialise(rows)  # texts are read once; what follows needs three numbers a record
    buckets = max(buckets, rows.count() // BUCKET_ROWS)
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("all_size"))
    goals = broadcast_if_small(budgets(targets, total))
    summed = prefix_sums(rows.where("source is not null").withColumn("key", hash_key(F.col("id"), seed)), buckets)
    # uses of a record: whole epochs, and one more if most of it lies before what then remains of the budget
    epochs = F.floor(F.col("budget") / F.col("source_size"))
    rest = F.col("budget") - epochs * F.col("source_size")
    uses = epochs + F.when(F.col("start") + F.col("size") / 2 <= rest, 1).otherwise(0)
    capped = F.least(uses, F.coalesce(F.col("max_repeats").cast("bigint"), uses))
    mixed = summed.where("source_size > 0").join(goals, "source").withColumn("repeats", capped.cast("bigint")).where("repeats > 0")
    mixed = mixed.select("mix_name", F.col("source").alias("image_source"), F.col("id").alias("ann_id"), "repeats", "size")
    actual = mixed.groupBy("mix_name", "image_source").agg(F.sum(F.col("size") * F.col("repeats")).alias("actual_size"), F.count("*").alias("n_records"), F.max("repeats").alias("most_repeats"))
    report = goals.withColumnRenamed("source", "image_source").join(actual, ["mix_name", "image_source"], "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    report = report.select("mix_name", "image_source", "target_share", "budget", zero("actual_size"), zero("n_records"), zero("most_repeats"))
    whole = F.sum("actual_size").over(Window.partitionBy("mix_name"))
    return mixed, report.withColumn("actual_share", F.coalesce(F.try_divide(F.col("actual_size").cast("double"), whole), F.lit(0.0)))
