"""Queries over the quality of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table
from . import quality


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents that are lists, tables or junk."""
    return quality.kinds(table(spark, d, "documents")).where("kind != 'prose'").select("doc_id", "kind")


def p8_statistics(spark: SparkSession, d: str) -> DataFrame:
    """Statistics of every document, with its kind."""
    return quality.kinds(table(spark, d, "documents"))


COUNTED = ("mean_word_length", "symbol_ratio", "digit_ratio", "common_word_share", "bullet_line_share", "new_pair_share", "mojibake_ratio")


def p8_counts(spark: SparkSession, d: str) -> DataFrame:
    """The statistics of every document that are plain counts and their ratios, to nine decimals."""
    rows = quality.document_statistics(table(spark, d, "documents")).dropDuplicates(["doc_id"])
    return rows.select("doc_id", "n_chars", "n_words", "n_lines", *[(F.floor(F.col(c) * 1e9 + 0.5) / 1e9).alias(c) for c in COUNTED])


def p8_by_source(spark: SparkSession, d: str) -> DataFrame:
    """Per source: documents, share of each kind, mean share of common words."""
    rows = quality.kinds(table(spark, d, "documents")).select("doc_id", "kind", "common_word_share").join(table(spark, d, "documents").select("doc_id", "source"), "doc_id")
    share = lambda k: F.avg((F.col("kind") == k).cast("double")).alias(f"{k}_share")
    return rows.groupBy("source").agg(F.count("*").alias("n"), *map(share, ("prose", "list", "table", "junk")), F.avg("common_word_share").alias("common_word_share"))


QUERIES = {"p8_found": p8_found, "p8_counts": p8_counts, "p8_statistics": p8_statistics, "p8_by_source": p8_by_source}
_COMMON = ", ".join(f"'{w}'" for w in sorted(quality.COMMON_WORDS))
_RATIOS = {
    "mean_word_length": "least(v / greatest(pieces, 1), 20)",
    "symbol_ratio": r"len(regexp_extract_all(t, '[^_\p{L}\p{N}\s\v\p{Z}]')) / v",
    "digit_ratio": r"len(regexp_extract_all(t, '\p{Nd}')) / v",
    "common_word_share": f"len(list_filter(ws, lambda w: w IN ({_COMMON}))) / greatest(n, 1)",
    "bullet_line_share": r"len(regexp_extract_all(t, '(?m)^[ \t]*(?:[-*•·+–—▪◦>]|#?\(?\p{Nd}{1,3}[.):]|#\p{Nd}{1,3}|\(?[a-zA-Z][.)]|\[[ xX]?\])[ \t]+')) / k",
    "new_pair_share": "CASE WHEN n > 20 THEN len(list_distinct(list_zip(ws[1:n - 1], ws[2:n]))) / (n - 1) ELSE 1 END",
    "mojibake_ratio": r"least(1, 20 * len(regexp_extract_all(t, '[ÃÂâÐÑ][\x{80}-¿Œ-Ÿ–-›€™]|\x{FFFD}|[\x{80}-\x{9F}]')) / v)",
}
SQL = {
    "p8_counts": r"""WITH d AS (SELECT DISTINCT doc_id, coalesce(text, '') AS t FROM documents WHERE doc_id IS NOT NULL),
parts AS (SELECT doc_id, t, list_filter(string_split(t, chr(10)), lambda x: NOT regexp_full_match(x, '[\s\v\p{Z}]*')) AS ls,
 length(replace(replace(replace(t, ' ', ''), chr(10), ''), chr(9), '')) AS v, len(regexp_extract_all(t, '[^\s\v\p{Z}]+')) AS pieces,
 regexp_extract_all(lower(t), '[\p{L}\p{Nl}\p{No}]+(?:[''’][\p{L}\p{Nl}\p{No}]+)*') AS ws FROM d),
c AS (SELECT *, len(ls) AS k, len(ws) AS n FROM parts)
SELECT doc_id, CAST(length(t) AS BIGINT) AS n_chars, CASE WHEN k > 0 THEN n ELSE 0 END AS n_words, k AS n_lines, """
    + ", ".join(f"floor((CASE WHEN k > 0 THEN {ratio} ELSE 0 END) * 1e9 + 0.5) / 1e9 AS {name}" for name, ratio in _RATIOS.items())
    + " FROM c",
}
