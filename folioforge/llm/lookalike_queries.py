"""Queries of problem 3."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.sources.tables import table

from . import lookalike


def _odd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalike.canonical(lookalike.record_values(table(spark, sf_dir, "page_element"), table(spark, sf_dir, "sft_record")))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with a value that isn't its canonical form."""
    return _odd(spark, sf_dir).select("tbl", "rec_id").distinct()


def p3_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value of the records with its one form."""
    records = lookalike.record_values(table(spark, sf_dir, "page_element"), table(spark, sf_dir, "sft_record"))
    odd = lookalike.canonical(records).groupBy("tbl", "rec_id", "text").agg(F.min("canonical").alias("canonical"))
    values = records.select("tbl", "rec_id", F.explode("content").alias("source", "text"))
    return values.join(odd, ["tbl", "rec_id", "text"], "left").select("tbl", "rec_id", "source", "text", F.coalesce("canonical", "text").alias("canonical"))


QUERIES = {"p3_found": p3_found, "p3_canonical": p3_canonical}
