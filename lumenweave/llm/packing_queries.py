"""Queries that pack texts into containers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import broadcast_if_small, materialise, table
from . import packing


def p6_packed(spark: SparkSession, d: str) -> DataFrame:
    """Every text of ``documents`` in a container, for each row of ``pack_limits``."""
    return packing.pack(table(spark, d, "documents"), table(spark, d, "pack_limits"))


def p6_fill(spark: SparkSession, d: str) -> DataFrame:
    """How full the containers are."""
    return packing.fill_report(materialise(p6_packed(spark, d)), table(spark, d, "pack_limits"))


def p6_kept(spark: SparkSession, d: str) -> DataFrame:
    """What any packing must hold to, per limit: texts that were placed, containers above the capacity, and texts cut or placed twice without need."""
    limits = table(spark, d, "pack_limits").select("limit_id", "capacity_tokens").where("capacity_tokens > 0").distinct()
    packed = materialise(p6_packed(spark, d)).join(broadcast_if_small(limits), "limit_id")
    texts = packed.groupBy("limit_id", "capacity_tokens", "doc_id").agg(F.sum("n_tokens").alias("n"), F.count("*").alias("pieces"), F.max("n_pieces").alias("n_pieces"))
    wrong = (F.col("pieces") != F.col("n_pieces")) | (F.col("pieces") != F.greatest(F.ceil(F.col("n") / F.col("capacity_tokens")), F.lit(1)))
    per_text = texts.groupBy("limit_id").agg(F.count("*").alias("n_texts"), F.count_if(wrong).alias("n_cut"))
    rooms = packed.where("container_id is not null").groupBy("limit_id", "capacity_tokens", "container_id").agg(F.sum("n_tokens").alias("n"))
    return per_text.join(rooms.groupBy("limit_id").agg(F.count_if(F.col("n") > F.col("capacity_tokens")).alias("n_over")), "limit_id")


QUERIES = {"p6_packed": p6_packed, "p6_fill": p6_fill, "p6_kept": p6_kept}
SQL = {"p6_kept": "SELECT limit_id, (SELECT count(DISTINCT doc_id) FROM documents) AS n_texts, 0::BIGINT AS n_cut, 0::BIGINT AS n_over FROM (SELECT DISTINCT limit_id FROM pack_limits WHERE capacity_tokens > 0)"}
