"""Queries that mix sources, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table
from . import mixing


def p2_mixed(spark: SparkSession, d: str) -> DataFrame:
    """Records of every mix with the number of their uses."""
    return mixing.mix(table(spark, d, "annotations"), table(spark, d, "mix_targets"))[0]


def p2_shares(spark: SparkSession, d: str) -> DataFrame:
    """Target and actual share of every source in every mix."""
    report = mixing.mix(table(spark, d, "annotations"), table(spark, d, "mix_targets"))[1]
    return report.select("mix_name", "image_source", F.round("target_share", 6).alias("target_share"), F.round("actual_share", 6).alias("actual_share"), F.round("budget", 2).alias("budget"), "actual_size", "n_records", "most_repeats")


QUERIES = {"p2_mixed": p2_mixed, "p2_shares": p2_shares}

_NORMAL = "nullif(regexp_replace(lower(trim(image_source)), '/+$', ''), '')"
_WITH = f"""WITH rec AS (SELECT DISTINCT ann_id, {_NORMAL} AS source, coalesce(list_sum(list_transform(captions, lambda x: coalesce(len(x), 0))), 0)::BIGINT AS size FROM annotations),
keyed AS (SELECT *, ('0x' || substr(md5(ann_id || ':{mixing.SEED}'), 1, 8))::BIGINT AS key FROM rec),
summed AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, ann_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start, sum(size) OVER (PARTITION BY source) AS source_size FROM keyed WHERE source IS NOT NULL),
goals AS (SELECT mix_name, {_NORMAL} AS source, weight / sum(weight) OVER (PARTITION BY mix_name) AS target_share, max_repeats,
 (SELECT sum(size) FROM rec)::DOUBLE * size_ratio * (weight / sum(weight) OVER (PARTITION BY mix_name)) AS budget FROM mix_targets),
used AS (SELECT mix_name, s.source AS image_source, ann_id, least(floor(budget / source_size) + CASE WHEN start + size / 2 <= budget - floor(budget / source_size) * source_size THEN 1 ELSE 0 END, coalesce(max_repeats, 1000000000))::BIGINT AS repeats, size
 FROM summed s JOIN goals g ON s.source = g.source WHERE source_size > 0)"""

SQL = {
    "p2_mixed": f"{_WITH} SELECT * FROM used WHERE repeats > 0",
    "p2_shares": f"""{_WITH}, act AS (SELECT mix_name, image_source, sum(size * repeats) AS actual_size, count(*) AS n_records, max(repeats) AS most_repeats FROM used WHERE repeats > 0 GROUP BY 1, 2)
SELECT g.mix_name, g.source AS image_source, round(target_share, 6) AS target_share, round(coalesce(actual_size, 0)::DOUBLE / sum(actual_size) OVER (PARTITION BY g.mix_name), 6) AS actual_share,
 round(budget, 2) AS budget, coalesce(actual_size, 0)::BIGINT AS actual_size, coalesce(n_records, 0) AS n_records, coalesce(most_repeats, 0) AS most_repeats
FROM goals g LEFT JOIN act a ON g.mix_name = a.mix_name AND g.source = a.image_source""",
}
