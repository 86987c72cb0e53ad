"""Queries of problem 8."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.session import materialize
from folioforge.sources.tables import table

from . import packing


def p8_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, or part of one, with its container, for every profile."""
    return packing.pack(table(spark, sf_dir, "documents"), table(spark, sf_dir, "pack_profile"))


def p8_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers, their lower bound and the room in use, per profile."""
    return packing.fill_report(p8_containers(spark, sf_dir), table(spark, sf_dir, "pack_profile"))


def p8_fill_within_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same where every container is of one length bucket."""
    profiles = table(spark, sf_dir, "pack_profile")
    return packing.fill_report(packing.pack(table(spark, sf_dir, "documents"), profiles, top_up=False), profiles)


def p8_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per profile: documents that were placed, containers beyond the capacity, and documents placed in more parts than they fill containers."""
    profiles = table(spark, sf_dir, "pack_profile")
    packed = materialize(packing.pack(table(spark, sf_dir, "documents"), profiles), "packing-placed")
    room = packed.groupBy("profile_id", "container").agg(F.sum("tokens").alias("used")).join(profiles.select("profile_id", "capacity").distinct(), "profile_id").groupBy("profile_id").agg(F.sum((F.col("used") > F.col("capacity")).cast("long")).alias("n_over"))
    split = packed.groupBy("profile_id", "doc_id").agg(F.count("*").alias("parts"), F.sum("tokens").alias("size")).join(profiles.select("profile_id", "capacity").distinct(), "profile_id")
    split = split.groupBy("profile_id").agg(F.count("*").alias("n_docs"), F.sum((F.col("parts") > F.greatest(F.ceil(F.col("size") / F.col("capacity")), F.lit(1))).cast("long")).alias("n_split"))
    return split.join(room, "profile_id")


QUERIES = {"p8_containers": p8_containers, "p8_fill": p8_fill, "p8_fill_within_buckets": p8_fill_within_buckets, "p8_complete": p8_complete}

ORACLES = {
    "p8_complete": "SELECT DISTINCT profile_id, (SELECT count(DISTINCT doc_id) FROM documents) AS n_docs, 0::BIGINT AS n_split, 0::BIGINT AS n_over FROM pack_profile WHERE tokenizer IS NOT NULL AND capacity > 0",
}
