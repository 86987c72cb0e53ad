"""Queries of problem 4."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.sources.tables import table

from . import truncation


def _detected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.detect(table(spark, sf_dir, "page_element"), table(spark, sf_dir, "judge_verdict"), table(spark, sf_dir, "documents"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The values that lost their end, one row per record and source."""
    return _detected(spark, sf_dir).filter("cut").select("tbl", "rec_id", "source").distinct()


def p4_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each model cuts, per column."""
    return _detected(spark, sf_dir).groupBy("tbl", "source", "label_id").agg(F.count("*").alias("n_values"), F.sum(F.col("cut").cast("long")).alias("n_cut"), F.avg(F.col("cut").cast("double")).alias("cut_share"))


def p4_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lengths at which a model's values pile up: its field limits."""
    e = table(spark, sf_dir, "page_element").filter("element_id is not null").select(F.lit("page_element").alias("tbl"), F.explode("content").alias("source", "text"))
    v = table(spark, sf_dir, "judge_verdict").filter("verdict_id is not null").select(F.lit("judge_verdict").alias("tbl"), F.coalesce("judge_model", F.lit("")).alias("source"), F.col("corrected").alias("text"))
    return truncation.field_limits(e.unionByName(v).select("tbl", "source", F.length(F.regexp_replace("text", r"\s+$", "")).alias("n_chars")))


QUERIES = {"p4_found": p4_found, "p4_rates": p4_rates, "p4_limits": p4_limits}

ORACLES = {
    "p4_limits": """WITH v AS (
  SELECT 'page_element' AS tbl, unnest(map_keys(content)) AS source, unnest(map_values(content)) AS t FROM page_element WHERE element_id IS NOT NULL
  UNION ALL SELECT 'judge_verdict', coalesce(judge_model, ''), corrected FROM judge_verdict WHERE verdict_id IS NOT NULL
), c AS (SELECT tbl, source, length(regexp_replace(t, '\\s+$', '')) AS n_chars, count(*) AS n_values FROM v GROUP BY ALL
), w AS (SELECT *, (sum(n_values) OVER (PARTITION BY tbl, source ORDER BY n_chars RANGE BETWEEN 6 PRECEDING AND 6 FOLLOWING) - n_values) / 12::DOUBLE AS around FROM c)
SELECT tbl, source, CAST(n_chars AS INT) AS n_chars, n_values FROM w WHERE n_values >= 8 AND n_values >= 6 * greatest(around, 1) AND n_chars > 48""",
}
