"""Queries of problem 9."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.sources.tables import table

from . import mojibake


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of which at least a passage was decoded with the wrong encoding."""
    return mojibake.restore(table(spark, sf_dir, "documents")).filter("garbled").select("doc_id")


def p9_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The affected documents with their operation chain and restored text."""
    return mojibake.restore(table(spark, sf_dir, "documents")).filter("garbled").drop("garbled")


def p9_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Affected documents, and those restored completely, by operation chain."""
    found = mojibake.restore(table(spark, sf_dir, "documents")).filter("garbled")
    return found.groupBy(F.coalesce("chain", F.lit("none")).alias("chain")).agg(F.count("*").alias("n_docs"), F.sum(F.col("complete").cast("long")).alias("n_complete"), F.sum("n_lines").alias("n_lines"))


QUERIES = {"p9_found": p9_found, "p9_restored": p9_restored, "p9_chains": p9_chains}
