"""Queries over defective pairs and texts that were cut off."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialise, table
from . import pairs, truncation
from .mixing import normal_source


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Every defective answer with its defect."""
    return pairs.defects(table(spark, d, "chat_exports")).select("export_id", "turn_no", "defect")


def p1_triggered(spark: SparkSession, d: str) -> DataFrame:
    """Every defective answer with all rules that hold."""
    return pairs.defects(table(spark, d, "chat_exports"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Turns whose value was cut off."""
    return pairs.cut_turns(table(spark, d, "chat_exports")).select("export_id", "turn_no")


def p5_by_source(spark: SparkSession, d: str) -> DataFrame:
    """Per source: turns, cut turns, and their share."""
    chats = table(spark, d, "chat_exports")
    source = normal_source(F.col("image_source")).alias("image_source")
    turns = chats.where("export_id is not null").select("export_id", source, F.greatest(F.size("conversations"), F.lit(0)).alias("n")).dropDuplicates(["export_id"])
    n = turns.groupBy("image_source").agg(F.sum("n").alias("n_turns"))
    cut = materialise(pairs.cut_turns(chats)).groupBy(source).agg(F.count("*").alias("n_cut")).withColumnRenamed("image_source", "s")
    joined = n.join(cut, n["image_source"].eqNullSafe(cut["s"]), "left").withColumn("n_cut", F.coalesce("n_cut", F.lit(0)))
    return joined.select("image_source", "n_turns", "n_cut", F.coalesce(F.try_divide(F.col("n_cut"), F.col("n_turns")), F.lit(0.0)).alias("cut_share"))


def p1_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Pairs that the rules of p1 look at, per export: an answer turn directly after a human turn; and answers that are null or blank."""

    @F.pandas_udf("array<int>")
    def looked_at(roles: pd.Series, texts: pd.Series) -> pd.Series:
        out = []
        for names, values in zip(roles, texts):
            kinds = [pairs.role_of(n) for n in names]
            at = [i for i in range(1, len(kinds)) if kinds[i] == 2 and kinds[i - 1] == 1]
            out.append([len(at), sum(pairs.rules_of(values[i - 1], values[i]) == ["empty"] and not (values[i] or "").strip() for i in at)])
        return pd.Series(out)

    rows = table(spark, d, "chat_exports").where("export_id is not null and conversations is not null").dropDuplicates(["export_id"])
    counted = rows.select("export_id", looked_at(F.col("conversations.from"), F.col("conversations.value")).alias("n"))
    return counted.select("export_id", F.get("n", F.lit(0)).alias("n_pairs"), F.get("n", F.lit(1)).alias("n_blank"))


QUERIES = {"p1_found": p1_found, "p1_triggered": p1_triggered, "p1_pairs": p1_pairs, "p5_found": p5_found, "p5_by_source": p5_by_source}
SQL = {
    "p1_pairs": """WITH t AS (SELECT export_id, unnest(range(len(conversations))) AS i, unnest(conversations) AS c FROM (SELECT * FROM chat_exports WHERE export_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY export_id ORDER BY exported_at) = 1)),
 r AS (SELECT export_id, i, c.value AS v, CASE WHEN lower(trim(c."from")) IN ('human', 'user', 'question', 'prompter') THEN 1 WHEN lower(trim(c."from")) IN ('gpt', 'assistant', 'answer', 'model', 'bot') THEN 2 ELSE 0 END AS kind FROM t),
 p AS (SELECT b.export_id, b.v FROM r a JOIN r b ON a.export_id = b.export_id AND b.i = a.i + 1 WHERE a.kind = 1 AND b.kind = 2)
 SELECT e.export_id, count(p.export_id)::INT AS n_pairs, (count(*) FILTER (p.export_id IS NOT NULL AND regexp_full_match(coalesce(v, ''), '[\\s\\v\\p{Z}]*')))::INT AS n_blank FROM (SELECT DISTINCT export_id FROM chat_exports WHERE export_id IS NOT NULL AND conversations IS NOT NULL) e LEFT JOIN p ON e.export_id = p.export_id GROUP BY e.export_id""",
}
