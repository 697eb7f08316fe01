"""Results of generation runs: collect, count, clean, statistics, export.

A result is one step of one attempt on one picture. Runs are a column (and a partition of the stored table), so no two runs can
be taken for each other, and reading one run reads only its files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "image_path string, attempt bigint, step int, prompt_type string, input array<string>, output array<string>, filtered_out array<string>, error struct<type string, message string>, run_id string"
CONVERSATIONS = "array<struct<from string, value string>>"


def append(results: DataFrame, folder: str) -> None:
    results.write.mode("append").partitionBy("run_id").parquet(f"{folder}/results")


def of_run(results: DataFrame, run_id: str | None) -> DataFrame:
    """Results of one run, or of all runs."""
    return results if run_id is None else results.where(F.col("run_id") == run_id)


def collect(results: DataFrame, run_id: str | None = None, keys: tuple[str, ...] = ("image_path",)) -> DataFrame:
    """``(*keys, results)``: steps of each picture in the order of run, attempt and step; of several runs one after the other.

    A list is what one picture holds. Where many pictures were filed under one placeholder path, name the attempt in ``keys``
    too, or take the same steps as ordered rows from :func:`steps`, which makes no lists.
    """
    entry = F.struct("run_id", "attempt", "step", "prompt_type", "input", "output", "filtered_out")
    return of_run(results, run_id).dropna(subset=list(keys)).groupBy(*keys).agg(F.sort_array(F.collect_list(entry)).alias("results"))


def steps(results: DataFrame, run_id: str | None = None) -> DataFrame:
    """Rows of pictures in the order of picture, run, attempt and step, over sorted ranges: no picture is held whole."""
    order = ["image_path", "run_id", "attempt", "step"]
    return of_run(results, run_id).where("image_path is not null").repartitionByRange(*order).sortWithinPartitions(*order)


def count(results: DataFrame, reservations: DataFrame, run_id: str | None = None) -> DataFrame:
    """``(run_id, n_images, n_empty)``: pictures claimed or done in each run, and those without a result."""
    done = of_run(results, run_id).select("run_id", "image_path", F.lit(1).alias("done"))
    claimed = of_run(reservations, run_id).select("run_id", "image_path", F.lit(0).alias("done"))
    each = done.unionByName(claimed).groupBy("run_id", "image_path").agg(F.max("done").alias("done"))
    return each.groupBy("run_id").agg(F.count("*").alias("n_images"), F.count_if(F.col("done") == 0).alias("n_empty"))


def is_empty(output: Column) -> Column:
    return output.isNull() | (F.size(output) == 0)


def clean(results: DataFrame, run_id: str | None = None, empty_only: bool = True) -> DataFrame:
    """What is left: without the results of the run that have no output, or without all of the run's."""
    own = F.lit(True) if run_id is None else F.col("run_id").eqNullSafe(F.lit(run_id))
    return results.where(~(own & is_empty(F.col("output")))) if empty_only else results.where(~own)


def clean_table(spark_results: DataFrame, folder: str, run_id: str | None = None, empty_only: bool = True) -> None:
    """The same on the stored table: what is left is written aside, the table renamed, and what is left takes its place.

    A table that a job left between the two renames is put back by the next call of :func:`restore`.
    """
    spark = spark_results.sparkSession
    restore(spark, folder)
    clean(spark_results, run_id, empty_only).write.mode("overwrite").partitionBy("run_id").parquet(f"{folder}/results-cleaned")
    files, path = _files(spark, folder)
    files.rename(path("results"), path("results-before"))
    files.rename(path("results-cleaned"), path("results"))
    files.delete(path("results-before"), True)


def restore(spark: SparkSession, folder: str) -> None:
    """Ends or undoes a cleaning that was broken off, so that ``results`` is a whole table."""
    files, path = _files(spark, folder)
    if files.exists(path("results-before")):
        if files.exists(path("results")):
            files.delete(path("results-before"), True)
        else:
            files.rename(path("results-before"), path("results"))


def _files(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path
    return path(folder).getFileSystem(spark._jsc.hadoopConfiguration()), lambda name: path(f"{folder}/{name}")


def first_attempt(results: DataFrame) -> DataFrame:
    """Results of each picture's first attempt in each run: a join with its pre-aggregated number."""
    first = results.groupBy("run_id", "image_path").agg(F.min("attempt").alias("attempt"))
    return results.join(first, ["run_id", "image_path", "attempt"], "left_semi")


def conversation(messages: Column, token: str = "<fill-in-the-blank>", replacement: str = "[blank]") -> Column:
    """Messages in turn as an exported conversation: ``human`` and ``gpt``, the picture before the first, tokens replaced."""
    def message(text: Column, i: Column) -> Column:
        said = F.replace(text, F.lit(token), F.lit(replacement))
        return F.struct(F.when(i % 2 == 0, "human").otherwise("gpt").alias("from"), F.when(i == 0, F.concat(F.lit("<image>\n"), said)).otherwise(said).alias("value"))

    return F.transform(messages, message)


def conversation_id(*parts: Column) -> Column:
    """An id that depends on what the conversation belongs to."""
    return F.concat(F.lit("conversation_"), F.substring(F.sha2(F.concat_ws("|", *[p.cast("string") for p in parts]), 256), 1, 16))


def export(results: DataFrame, listing: DataFrame | None = None, without: tuple[str, ...] = ()) -> DataFrame:
    """``(id, image, conversations)`` of the first attempts: results with an output, of other prompt types than ``without``.

    With a listing ``(image_path)`` pictures that aren't in it are left out. A null prompt type is none of ``without``.
    """
    rows = first_attempt(results).where(~is_empty(F.col("output")) & ~F.coalesce(F.col("prompt_type").isin(*without), F.lit(False)) if without else ~is_empty(F.col("output")))
    if listing is not None:
        rows = rows.join(listing.select("image_path").distinct(), "image_path", "left_semi")
    return rows.select(conversation_id(F.col("run_id"), F.col("image_path"), F.col("attempt"), F.col("step")).alias("id"), F.col("image_path").alias("image"), conversation(F.col("output")).alias("conversations"))


def write_json(exported: DataFrame, path: str) -> None:
    """One JSON object a line, in a folder."""
    exported.select(F.to_json(F.struct("id", "image", "conversations")).alias("value")).write.mode("overwrite").text(path)


def write_json_array(exported: DataFrame, path: str) -> None:
    """One file that is one JSON array, written through the driver a partition at a time; for exports that one file can hold."""
    lines = exported.select(F.to_json(F.struct("id", "image", "conversations")).alias("value")).toLocalIterator()
    with open(path, "w", encoding="utf-8") as file:
        file.write("[")
        for i, row in enumerate(lines):
            file.write((",\n" if i else "\n") + row["value"])
        file.write("\n]\n")


def split_errors(results: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(results, dead letters): rows without and with an error."""
    return results.where("error is null"), results.where("error is not null")


def statistics(results: DataFrame) -> DataFrame:
    """Pictures with a conversation, conversations, and messages of them all, over first attempts."""
    rows = first_attempt(results).where(~is_empty(F.col("output")))
    return rows.agg(F.countDistinct("image_path").alias("n_images"), F.count("*").alias("n_conversations"), F.coalesce(F.sum(F.size("output")), F.lit(0)).alias("n_messages"))
