"""Queries of problem 1."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.sources.tables import table

from . import consensus


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """element_id and true tier of every element with a usable answer."""
    found, _ = consensus.consensus(table(spark, sf_dir, "annotation"), table(spark, sf_dir, "page_element"))
    return found.select("element_id", "tier")


def p1_raters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reliability of every annotator with its interval; -1 is the machine, -2 the stored tier."""
    _, theta = consensus.consensus(table(spark, sf_dir, "annotation"), table(spark, sf_dir, "page_element"))
    return consensus.reliability(theta).select(F.col("rater").alias("annotator_id"), "reliability", "low", "high", "weight")


def p1_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Krippendorff's alpha of the human answers."""
    return consensus.agreement(consensus.human_votes(table(spark, sf_dir, "annotation")))


def p1_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row: elements, and on how many the model of people's answers alone gives the same tier as with the machine raters."""
    annotation = table(spark, sf_dir, "annotation")
    both, _ = consensus.consensus(annotation, table(spark, sf_dir, "page_element"))
    people, _ = consensus.consensus(annotation, None)
    same = both.select("element_id", "tier").join(people.select("element_id", F.col("tier").alias("by_people")), "element_id")
    return same.agg(F.count("*").alias("n_elements"), F.sum((F.col("tier") == F.col("by_people")).cast("long")).alias("n_same"))


def p1_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row: elements that got a tier, each once."""
    return p1_found(spark, sf_dir).agg(F.count("*").alias("n_rows"), F.count_distinct("element_id").alias("n_elements"))


QUERIES = {"p1_found": p1_found, "p1_raters": p1_raters, "p1_agreement": p1_agreement, "p1_people": p1_people, "p1_coverage": p1_coverage}

ORACLES = {
    "p1_coverage": """SELECT count(DISTINCT element_id) AS n_rows, count(DISTINCT element_id) AS n_elements FROM annotation
WHERE element_id IS NOT NULL AND regexp_replace(regexp_replace(lower(tier), '[^a-z]', '', 'g'), '^tier', '') IN ('easy', 'medium', 'hard', 'invalid')""",
    "p1_agreement": """
WITH named AS (
  SELECT annotation_id, element_id, received_at,
         regexp_replace(regexp_replace(lower(tier), '[^a-z]', '', 'g'), '^tier', '') AS t
  FROM annotation
), once AS (
  SELECT element_id, t FROM (
    SELECT *, row_number() OVER (PARTITION BY annotation_id ORDER BY received_at DESC) AS rn
    FROM named WHERE t IN ('easy', 'medium', 'hard', 'invalid') AND element_id IS NOT NULL)
  WHERE rn = 1
), per AS (
  SELECT element_id,
         count(*) FILTER (t = 'easy') AS n0, count(*) FILTER (t = 'medium') AS n1,
         count(*) FILTER (t = 'hard') AS n2, count(*) FILTER (t = 'invalid') AS n3, count(*) AS m
  FROM once GROUP BY element_id HAVING count(*) > 1
), g AS (
  SELECT count(*) AS n_elements, CAST(sum(m) AS BIGINT) AS n_answers,
         sum(CAST(m * m - n0 * n0 - n1 * n1 - n2 * n2 - n3 * n3 AS DOUBLE) / (m - 1)) AS seen,
         CAST(sum(n0) AS DOUBLE) AS t0, CAST(sum(n1) AS DOUBLE) AS t1,
         CAST(sum(n2) AS DOUBLE) AS t2, CAST(sum(n3) AS DOUBLE) AS t3
  FROM per
)
SELECT n_elements, n_answers,
       round(1 - (n_answers - 1) * seen / (CAST(n_answers AS DOUBLE) * n_answers - t0*t0 - t1*t1 - t2*t2 - t3*t3), 6) AS alpha
FROM g
""",
}
