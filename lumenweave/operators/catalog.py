"""The catalogue of annotations: a long table with one row per picture and data set.

All operators take and return DataFrames of canonical rows (:mod:`..sources.records`); none collects rows. Pictures are taken
in an order that depends on a hash of their path and a seed, never on partitions or time, so a claim made again is the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import adapters  # noqa: F401  (registers the sources)
from ..sources.records import COLUMNS, SCHEMA, load


def merge(*parts: DataFrame) -> DataFrame:
    """Union of canonical rows; the same row coming twice stays once when its data set is loaded again.

    Of rows with the same picture and data set that differ, all stay: a data set may describe a picture in several rows.
    """
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def records(df: DataFrame, key: str, newest: str | None = None) -> DataFrame:
    """One row per key: the newest by a column, else any of the equal ones. Rows without a key are no records."""
    df = df.where(F.col(key).isNotNull())
    if newest is None:
        return df.dropDuplicates([key])
    return df.groupBy(key).agg(F.max_by(F.struct(*[c for c in df.columns if c != key]), F.struct(F.col(newest))).alias("_r")).select(key, "_r.*").select(*df.columns)


def nested(rows: DataFrame) -> DataFrame:
    """One row per picture with ``sources``, a map from data set to its first row's fields."""
    fields = F.struct("image_id", "image_source", "bboxes", "captions", "qa")
    first = rows.where("image_path is not null and dataset is not null").groupBy("image_path", "dataset").agg(F.min(F.struct(F.xxhash64("image_id", "captions").alias("h"), fields.alias("r")))["r"].alias("r"))
    return first.groupBy("image_path").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("dataset", "r")))).alias("sources"))


def drop_imageset(rows: DataFrame, folder: str) -> DataFrame:
    """Pictures whose path doesn't hold the text."""
    return rows.where(~F.contains(F.col("image_path"), F.lit(folder)))


def drop_dataset(rows: DataFrame, dataset: str, only_when_alone: bool = False) -> DataFrame:
    """Rows of all other data sets. ``only_when_alone``: only pictures go that have no other data set; others stay whole.

    The test of loneliness is a pre-aggregated join on the picture, so a picture with very many rows meets no window.
    """
    if not only_when_alone:
        return rows.where(~F.col("dataset").eqNullSafe(F.lit(dataset)))
    alone = rows.groupBy("image_path").agg(F.min(F.col("dataset").eqNullSafe(F.lit(dataset))).alias("_alone")).where("_alone").select("image_path")
    return rows.join(alone, "image_path", "left_anti")


def order_key(path: Column, seed: str | int = 0) -> Column:
    """Place of a picture in the order of claims: the first 32 bits of a hash of path and seed."""
    return F.conv(F.substring(F.md5(F.concat(path, F.lit(f"|{seed}"))), 1, 8), 16, 10).cast("bigint")


def pending(rows: DataFrame, *done: DataFrame) -> DataFrame:
    """Distinct pictures that occur in none of the tables ``done(image_path)``."""
    out = rows.select("image_path").where("image_path is not null").distinct()
    for d in done:
        out = out.join(d.select("image_path"), "image_path", "left_anti")
    return out


def first_pictures(pictures: DataFrame, n: int, seed: str | int = 0) -> DataFrame:
    """The first ``n`` pictures in the order of claims, or all if there are fewer; a top-k, not a sort of all."""
    return pictures.select("image_path").distinct().orderBy(order_key(F.col("image_path"), seed), "image_path").limit(n)


def sample(rows: DataFrame, n: int, seed: str | int = 0) -> DataFrame:
    """All rows of ``n`` pictures drawn without repetition; an error if there are fewer."""
    taken = first_pictures(rows.where("image_path is not null"), n, seed)
    there = taken.count()
    if there < n:
        raise ValueError(f"{n} pictures asked, {there} are there")
    return rows.join(F.broadcast(taken) if n <= 100_000 else taken, "image_path", "left_semi")


def by_source(rows: DataFrame) -> DataFrame:
    """Pictures per data set, with the total under ``*``."""
    per = rows.groupBy("dataset").agg(F.countDistinct("image_path").alias("n_images"))
    return per.unionByName(rows.agg(F.lit("*").alias("dataset"), F.countDistinct("image_path").alias("n_images")))


def having_image(df: DataFrame, listing: DataFrame, column: str = "image_path") -> DataFrame:
    """Rows whose picture is in the listing ``(image_path)``."""
    return df.join(listing.select(F.col("image_path").alias(column)).distinct(), column, "left_semi")


def information_lines(rows: DataFrame, statements: DataFrame | None = None, box_text: DataFrame | None = None, keys: tuple[str, ...] = ("image_path",)) -> DataFrame:
    """``(*keys, part, dataset, image_id, pos, line)``: information one line a row, without any grouping.

    Parts in order: 0 captions, 1 statements of questions, 2 the text of boxes. ``statements(*keys, lines)`` and
    ``box_text(*keys, lines)`` are outputs of converters. Texts that are null or without a visible character are left out.
    """
    own = rows.select(*keys, F.lit(0).alias("part"), "dataset", "image_id", F.posexplode("captions").alias("pos", "line"))
    for part, more in ((1, statements), (2, box_text)):
        if more is not None:
            none = F.lit(None).cast("string")
            own = own.unionByName(more.select(*keys, F.lit(part).alias("part"), none.alias("dataset"), none.alias("image_id"), F.posexplode("lines").alias("pos", "line")))
    return own.where("line is not null and trim(line) != ''").dropna(subset=list(keys))


def information(rows: DataFrame, statements: DataFrame | None = None, box_text: DataFrame | None = None, keys: tuple[str, ...] = ("image_path",)) -> DataFrame:
    """``(*keys, information)``: the lines of :func:`information_lines` as one list for the generation loop.

    A list is what one picture holds. Where many pictures were filed under one placeholder path, name the record's key in
    ``keys`` too, so that each record has its own list. Keys without information have an empty one.
    """
    lines = information_lines(rows, statements, box_text, keys)
    listed = lines.groupBy(*keys).agg(F.transform(F.sort_array(F.collect_list(F.struct("part", "dataset", "image_id", "pos", "line"))), lambda s: s["line"]).alias("information"))
    all_keys = rows.select(*keys).dropna().distinct()
    return all_keys.join(listed, list(keys), "left").withColumn("information", F.coalesce("information", F.array().cast("array<string>")))


class Catalog:
    """Catalogue, claims and results as tables in one folder.

    ``annotations`` holds canonical rows; ``reservations`` and ``results`` are appended to, split by run. A claim is the
    first pending pictures in a seeded order, so one job at a time claims; what it claimed is appended after it is written.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.folder}/{table}"

    def exists(self, table: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(table))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def read(self, table: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self.path(table)) if self.exists(table) else self.spark.createDataFrame([], schema)

    def load(self, root: str, names: list[str]) -> DataFrame:
        return load(self.spark, root, names)

    def cache(self, rows: DataFrame, name: str = "annotations") -> DataFrame:
        """Writes rows as a table of that name and reads it back."""
        rows.write.mode("overwrite").parquet(self.path(name))
        return self.annotations(name)

    def annotations(self, name: str = "annotations") -> DataFrame:
        return self.read(name, SCHEMA)

    def set_data(self, rows: list[dict]) -> DataFrame:
        """Canonical rows from Python records; fields that are missing are empty."""
        return self.spark.createDataFrame([tuple(r.get(c) for c in COLUMNS) for r in rows], SCHEMA)

    def reservations(self) -> DataFrame:
        return self.read("reservations", "image_path string, run_id string")

    def reserve(self, n: int, run_id: str, seed: str | int = 0) -> DataFrame:
        """Claims the first ``n`` pictures, or what is left, that are neither claimed nor done in the run, and returns their rows."""
        from . import results

        rows = self.annotations()
        done = [t.where(F.col("run_id") == run_id) for t in (self.reservations(), self.read("results", results.SCHEMA))]
        taken = first_pictures(pending(rows, *done), n, seed)
        before = self.reservations().where(F.col("run_id") == run_id).count()
        stamp = f"{self.path('claims')}/{run_id}-{before}"
        taken.write.mode("overwrite").parquet(stamp)
        taken = self.spark.read.schema("image_path string").parquet(stamp)
        taken.withColumn("run_id", F.lit(run_id)).write.mode("append").partitionBy("run_id").parquet(self.path("reservations"))
        return rows.join(taken, "image_path", "left_semi")

    def claims(self, n: int, run_id: str, seed: str | int = 0):
        """Claims of ``n`` pictures one after the other until none is left."""
        while not (rows := self.reserve(n, run_id, seed)).isEmpty():
            yield rows
