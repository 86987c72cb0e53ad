"""Queries of problem 7."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.sources.tables import table

from . import tokens


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, ids of every document by byte_bpe_50k."""
    return tokens.encode(table(spark, sf_dir, "documents"))


def p7_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per source: documents, ids, and texts that decoding does not give back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    back = tokens.decode(tokens.encode(docs)).withColumnRenamed("text", "back")
    return (
        docs.join(back, "doc_id")
        .groupBy("source")
        .agg(
            F.count("*").alias("n_docs"),
            F.count("text").alias("n_texts"),
            F.sum((~F.col("text").eqNullSafe(F.col("back"))).cast("long")).alias("n_lost"),
        )
    )


QUERIES = {"p7_ids": p7_ids, "p7_roundtrip": p7_roundtrip}

ORACLES = {
    "p7_roundtrip": """
SELECT source, count(*) AS n_docs, count(text) AS n_texts, CAST(0 AS BIGINT) AS n_lost
FROM documents GROUP BY source
""",
}
