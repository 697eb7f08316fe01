"""Queries that find held-out items in the corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table
from . import leakage


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents with the items that leaked into them."""
    return leakage.leaks(table(spark, d, "documents"), table(spark, d, "heldout_items"))


def p7_by_set(spark: SparkSession, d: str) -> DataFrame:
    """Per item set: items, leaked items and documents they leaked into."""
    items = table(spark, d, "heldout_items")
    per = p7_found(spark, d).join(F.broadcast(items.select("item_id", "item_set")) if items.count() <= 100_000 else items.select("item_id", "item_set"), "item_id").groupBy("item_set")
    leaked = per.agg(F.countDistinct("item_id").alias("n_leaked"), F.countDistinct("doc_id").alias("n_documents"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return items.groupBy("item_set").agg(F.countDistinct("item_id").alias("n_items")).join(leaked, "item_set", "left").select("item_set", "n_items", zero("n_leaked"), zero("n_documents"))


QUERIES = {"p7_found": p7_found, "p7_by_set": p7_by_set}
_PAIRS = f"""WITH words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS w FROM documents)),
 iwords AS (SELECT item_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM (SELECT item_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS w FROM heldout_items)),
 grams AS (SELECT doc_id, hash(list(word) OVER w) AS g, count(*) OVER w AS n FROM words WINDOW w AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND {leakage.WINDOW - 1} FOLLOWING)),
 igrams AS (SELECT item_id, hash(list(word) OVER w) AS g, count(*) OVER w AS n FROM iwords WINDOW w AS (PARTITION BY item_id ORDER BY i ROWS BETWEEN CURRENT ROW AND {leakage.WINDOW - 1} FOLLOWING)),
 pairs AS (SELECT DISTINCT doc_id, item_id FROM grams JOIN igrams USING (g) WHERE grams.n = {leakage.WINDOW} AND igrams.n = {leakage.WINDOW})"""
SQL = {
    "p7_found": f"{_PAIRS} SELECT * FROM pairs",
    "p7_by_set": f"""{_PAIRS} SELECT item_set, count(DISTINCT i.item_id) AS n_items, count(DISTINCT p.item_id) AS n_leaked, count(DISTINCT p.doc_id) AS n_documents
FROM heldout_items i LEFT JOIN pairs p ON i.item_id = p.item_id GROUP BY item_set""",
}
