"""Results as a stream: new files of results are exported once each, from a checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import results


def read(spark: SparkSession, folder: str) -> DataFrame:
    """The results table as a stream of its new files."""
    return spark.readStream.schema(results.SCHEMA).parquet(f"{folder}/results")


def conversations(stream: DataFrame) -> DataFrame:
    """Exported conversations of every result with an output; no state, so nothing grows with the stream."""
    rows = stream.where(~results.is_empty(F.col("output")))
    return rows.select(results.conversation_id(F.col("run_id"), F.col("image_path"), F.col("attempt"), F.col("step")).alias("id"), F.col("image_path").alias("image"), results.conversation(F.col("output")).alias("conversations"))


def export(spark: SparkSession, folder: str, target: str) -> StreamingQuery:
    """Writes the conversations of all files that are new since the last time to ``target`` and ends; exactly once each."""
    return conversations(read(spark, folder)).writeStream.format("parquet").option("path", target).option("checkpointLocation", f"{target}-checkpoint").trigger(availableNow=True).start()
