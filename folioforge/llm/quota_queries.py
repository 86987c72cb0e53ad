"""Queries of problem 5."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.sources.tables import table

from . import quota


def _plan(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return quota.plan(table(spark, sf_dir, "cluster_index"), table(spark, sf_dir, "allocation_run"), table(spark, sf_dir, "cluster_centroid"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """run_id and tier of every target that the run's pages cannot meet."""
    _, tiers, _ = _plan(spark, sf_dir)
    return tiers.filter("available < want").select("run_id", "tier")


def p5_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The drawn pages of every run."""
    pages, _, cells = _plan(spark, sf_dir)
    return quota.draw(pages, cells)


def p5_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target, availability and draw of every run and tier against the stored allocation."""
    _, tiers, _ = _plan(spark, sf_dir)
    return quota.report(tiers, table(spark, sf_dir, "allocation"))


def p5_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per run: pages drawn, each once."""
    return p5_sample(spark, sf_dir).groupBy("run_id").agg(F.count("*").alias("n_rows"), F.count_distinct("page_id").alias("n_pages"))


QUERIES = {"p5_found": p5_found, "p5_sample": p5_sample, "p5_report": p5_report, "p5_sizes": p5_sizes}

ORACLES = {
    "p5_sizes": """
WITH pages AS (
  SELECT DISTINCT run_id, page_id, arg_max(t, indexed_at) AS tier FROM (
    SELECT run_id, page_id, indexed_at,
           regexp_replace(regexp_replace(lower(tier), '[^a-z]', '', 'g'), '^tier', '') AS t
    FROM cluster_index WHERE run_id IS NOT NULL AND page_id IS NOT NULL)
  WHERE t IN ('easy', 'medium', 'hard', 'invalid')
  GROUP BY run_id, page_id
), have AS (
  SELECT run_id, tier, count(*) AS n FROM pages GROUP BY run_id, tier
), target AS (
  SELECT run_id, budget, min_per_tier, unnest(map_keys(target_mix)) AS tier, unnest(map_values(target_mix)) AS share
  FROM allocation_run
), q AS (
  SELECT t.run_id, t.tier, t.budget, coalesce(h.n, 0) AS available, least(coalesce(t.min_per_tier, 0), coalesce(h.n, 0)) AS least
  FROM target t LEFT JOIN have h ON h.run_id = t.run_id AND h.tier = t.tier
)
SELECT run_id, greatest(sum(least), least(any_value(budget), sum(available)))::BIGINT AS n_rows, greatest(sum(least), least(any_value(budget), sum(available)))::BIGINT AS n_pages FROM q GROUP BY run_id
""",
    "p5_found": """
WITH pages AS (
  SELECT DISTINCT run_id, page_id, arg_max(t, indexed_at) AS tier FROM (
    SELECT run_id, page_id, indexed_at,
           regexp_replace(regexp_replace(lower(tier), '[^a-z]', '', 'g'), '^tier', '') AS t
    FROM cluster_index WHERE run_id IS NOT NULL AND page_id IS NOT NULL)
  WHERE t IN ('easy', 'medium', 'hard', 'invalid')
  GROUP BY run_id, page_id
), have AS (
  SELECT run_id, tier, count(*) AS n FROM pages GROUP BY run_id, tier
), target AS (
  SELECT run_id, budget, min_per_tier, unnest(map_keys(target_mix)) AS tier, unnest(map_values(target_mix)) AS share
  FROM allocation_run
)
SELECT t.run_id, t.tier
FROM target t LEFT JOIN have h ON h.run_id = t.run_id AND h.tier = t.tier
WHERE coalesce(h.n, 0) < greatest(CAST(round_even(t.share * t.budget, 0) AS BIGINT), t.min_per_tier)
""",
}
