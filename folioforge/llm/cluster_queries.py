"""Queries of problem 6."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.session import materialize
from folioforge.sources.tables import table

from . import clusters


def _groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize(clusters.cluster(table(spark, sf_dir, "cluster_index")), "cluster-groups")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audited pairs whose two pages lie in one group."""
    groups = _groups(spark, sf_dir).filter("grp >= 0").select("id", "grp")
    pairs = table(spark, sf_dir, "cluster_audit").select(F.least("page_x", "page_y").alias("page_a"), F.greatest("page_x", "page_y").alias("page_b")).filter("page_a < page_b").distinct()
    a = groups.select(F.col("id").alias("page_a"), F.col("grp").alias("ga"))
    b = groups.select(F.col("id").alias("page_b"), F.col("grp").alias("gb"))
    return pairs.join(a, "page_a").join(b, "page_b").filter("ga = gb").select("page_a", "page_b")


def p6_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size, spread and most typical pages of every group."""
    return clusters.describe(_groups(spark, sf_dir))


def p6_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per group: pages, and the share of them in the earlier run's most common cell of that group."""
    old = table(spark, sf_dir, "cluster_index").filter("page_id is not null").groupBy(F.col("page_id").alias("id")).agg(F.max_by("assign", F.coalesce(F.unix_micros("indexed_at"), F.lit(0))).alias("assign"))
    cells = _groups(spark, sf_dir).filter("grp >= 0").join(old, "id").groupBy("grp", "assign").agg(F.count("*").alias("n"))
    return cells.groupBy("grp").agg(F.sum("n").alias("n_records"), F.max_by("assign", F.struct("n", F.negate("assign"))).alias("old_cell"), (F.max("n") / F.sum("n")).alias("old_share"))


def p6_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size, spread and most typical documents of 64 clusters of documents by their words.

    Texts scatter widely, so the cells of the k-means are the clusters here and are not joined.
    """
    vectors = clusters.usable_vectors(clusters.text_vectors(table(spark, sf_dir, "documents"), "doc_id", "text"), "doc_id", "features")
    centres, n, _ = clusters.fit(vectors, 64)
    return clusters.describe(materialize(clusters.assign(vectors, centres, np.arange(len(n)), np.full(len(n), np.inf)), "cluster-documents"))


QUERIES = {"p6_found": p6_found, "p6_groups": p6_groups, "p6_drift": p6_drift, "p6_documents": p6_documents}
