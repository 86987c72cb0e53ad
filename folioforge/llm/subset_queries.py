"""Queries of problem 2."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.session import materialize
from folioforge.sources.tables import table

from . import subset


def p2_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages of every request's subset."""
    pages = materialize(subset.masses(table(spark, sf_dir, "cluster_index")), "subset-masses")
    return subset.select(pages, table(spark, sf_dir, "subset_request"))


def p2_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per request: size, and the largest share of one earlier cell in the subset and among all pages of the subtask."""
    index = table(spark, sf_dir, "cluster_index").filter("page_id is not null and subtask is not null")
    latest = F.struct(F.coalesce(F.unix_micros("indexed_at"), F.lit(0)), "assign")
    pages = index.groupBy("page_id").agg(F.max_by("subtask", latest).alias("subtask"), F.max_by("assign", latest).alias("assign"))
    requests = table(spark, sf_dir, "subset_request")
    chosen = p2_subset(spark, sf_dir).join(pages, "page_id").groupBy("request_id", "assign").agg(F.count("*").alias("n"))
    pool = pages.groupBy("subtask", "assign").agg(F.count("*").alias("n")).groupBy("subtask").agg(F.sum("n").alias("n_pool"), F.max("n").alias("top_pool"), F.count("assign").alias("cells_pool"))
    got = chosen.groupBy("request_id").agg(F.sum("n").alias("n_chosen"), F.max("n").alias("top"), F.count("assign").alias("cells"))
    return requests.join(got, "request_id", "left").join(pool, "subtask", "left").select("request_id", "subset_size", F.coalesce("n_chosen", F.lit(0)).alias("n_chosen"), "cells", "cells_pool", F.round(F.col("top") / F.col("n_chosen"), 6).alias("top_share"), F.round(F.col("top_pool") / F.col("n_pool"), 6).alias("top_share_pool"))


def p2_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per request: pages chosen, each once."""
    return p2_subset(spark, sf_dir).groupBy("request_id").agg(F.count("*").alias("n_rows"), F.count_distinct("page_id").alias("n_pages"))


QUERIES = {"p2_subset": p2_subset, "p2_coverage": p2_coverage, "p2_sizes": p2_sizes}

ORACLES = {
    "p2_sizes": """WITH p AS (
  SELECT page_id, subtask FROM (SELECT page_id, subtask, row_number() OVER (PARTITION BY page_id ORDER BY coalesce(epoch_us(indexed_at), 0) DESC, subtask DESC) AS rn FROM cluster_index WHERE page_id IS NOT NULL AND subtask IS NOT NULL) WHERE rn = 1
), n AS (SELECT subtask, count(*) AS n FROM p GROUP BY subtask)
SELECT request_id, least(subset_size, n) AS n_rows, least(subset_size, n) AS n_pages FROM subset_request JOIN n USING (subtask) WHERE subset_size > 0""",
}
