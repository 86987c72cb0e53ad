"""Queries on consistency tiers and what is assembled from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions.constants import TAU
from folioforge.operators import assembly, consistency
from folioforge.sources.tables import table

from .inputs import CHEAP, SQL_ELEMENTS, TARGET, elements, sql_squash


def _sims(spark: SparkSession, d: str) -> DataFrame:
    e = elements(spark, d, "page_id", "etype", "tier", "content", "sims")
    s = [F.try_element_at("sims", F.lit(k)).alias(n) for k, n in (("M-P", "s_mp"), ("M-Q", "s_mq"), ("P-Q", "s_pq"))]
    return e.select("element_id", "page_id", "etype", "tier", "content", *s)


def _tiered(spark: SparkSession, d: str, three_way: bool = False) -> DataFrame:
    t = _sims(spark, d)
    m, p = (F.try_element_at("content", F.lit(k)) for k in (TARGET, CHEAP))
    tau = consistency.tau_of(F.col("etype"))
    found = F.when(consistency.no_evidence(m, p), "hard").otherwise(consistency.assign_tier(F.col("s_mp"), F.col("s_mq"), F.col("s_pq"), tau, three_way))
    return t.withColumn("derived", found)


def tier_assignment(spark: SparkSession, d: str) -> DataFrame:
    """The tier that every element's similarities imply."""
    return _tiered(spark, d).select("element_id", "derived")


def tier_agreement(spark: SparkSession, d: str) -> DataFrame:
    """Derived against stored tiers, with the stricter three-way rule beside."""
    strict = _tiered(spark, d, True).select("element_id", F.col("derived").alias("strict"))
    return _tiered(spark, d).join(strict, "element_id").groupBy("etype", "derived", "strict", "tier").agg(F.count("*").alias("n"))


def cascade_rate(spark: SparkSession, d: str) -> DataFrame:
    """Share of elements per type that need the expensive parser."""
    need = consistency.needs_expensive(F.col("s_mp"), consistency.tau_of(F.col("etype")))
    return _sims(spark, d).groupBy("etype").agg(F.count("*").alias("n"), F.round(F.avg(need.cast("double")), 6).alias("rate"))


def tau_calibration(spark: SparkSession, d: str) -> DataFrame:
    """Per type the least agreement from which the stored tier is easy in 90 of 100."""
    s = _sims(spark, d).filter("tier is not null").withColumn("correct", F.col("tier") == "easy")
    return consistency.calibrate_tau(s, "s_mp", "correct", ["etype"], target=0.9)


def weakness_by_type(spark: SparkSession, d: str) -> DataFrame:
    w = consistency.weakness(_sims(spark, d), "etype", F.col("s_mp"), F.col("s_mq"))
    return w.select("etype", F.round("weakness", 6).alias("weakness"))


def sft_assembly(spark: SparkSession, d: str) -> DataFrame:
    """Labels of the elements by their derived tier."""
    t = _tiered(spark, d).drop("tier").withColumnRenamed("derived", "tier")
    return assembly.assemble(t, TARGET, CHEAP).select("element_id", F.col("etype").alias("subtask"), "tier", "ready", "label_source", F.md5("label").alias("label_md5"))


def sft_counts(spark: SparkSession, d: str) -> DataFrame:
    return assembly.counts(sft_assembly(spark, d))


def manifest(spark: SparkSession, d: str) -> DataFrame:
    """Counts of the stored records per tier and subtask, with totals."""
    return assembly.manifest(table(spark, d, "sft_record").withColumn("stage", F.coalesce("tier", F.lit("none"))), "stage", "subtask")


QUERIES = {f.__name__: f for f in (tier_assignment, tier_agreement, cascade_rate, tau_calibration, weakness_by_type, sft_assembly, sft_counts, manifest)}

_TAU = "CASE etype WHEN 'table' THEN 0.95::DOUBLE WHEN 'formula' THEN 0.95::DOUBLE ELSE 0.92::DOUBLE END"
assert TAU["table"] == TAU["formula"] == 0.95 and TAU["text"] == 0.92

_SIMS = f"""{SQL_ELEMENTS}, s AS (
  SELECT element_id, etype, tier, content, content['{TARGET}'] AS m, content['{CHEAP}'] AS p, sims['M-P'] AS mp, sims['M-Q'] AS mq, sims['P-Q'] AS pq, {_TAU} AS tau FROM elements
), t AS (
  SELECT *, CASE WHEN m IS NULL OR p IS NULL OR ({sql_squash("m")} = '' AND {sql_squash("p")} = '') THEN 'hard'
                 WHEN mq IS NULL THEN CASE WHEN mp >= tau THEN 'easy' ELSE 'hard' END
                 WHEN coalesce(mp >= tau, false) OR mq >= tau THEN 'easy' WHEN pq >= tau THEN 'medium' ELSE 'hard' END AS derived,
            CASE WHEN m IS NULL OR p IS NULL OR ({sql_squash("m")} = '' AND {sql_squash("p")} = '') THEN 'hard' WHEN mq IS NULL THEN 'hard'
                 WHEN mp >= tau AND mq >= tau THEN 'easy' WHEN pq >= tau THEN 'medium' ELSE 'hard' END AS strict FROM s
), a AS (
  SELECT element_id, etype AS subtask, derived AS tier, CASE derived WHEN 'easy' THEN m WHEN 'medium' THEN p END AS reading,
         CASE derived WHEN 'easy' THEN '{TARGET}' WHEN 'medium' THEN '{CHEAP}' END AS src, CASE WHEN m <> '' THEN m WHEN p <> '' THEN p END AS draft FROM t
)"""

ORACLES = {
    "tier_assignment": f"WITH {_SIMS} SELECT element_id, derived FROM t",
    "tier_agreement": f"WITH {_SIMS} SELECT etype, derived, strict, tier, count(*) AS n FROM t GROUP BY ALL",
    "cascade_rate": f"WITH {_SIMS} SELECT etype, count(*) AS n, round(avg(CASE WHEN mp >= tau THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END), 6) AS rate FROM t GROUP BY etype",
    "tau_calibration": f"""WITH {_SIMS}, v AS (
  SELECT etype, greatest(least(CAST(floor((mp - 0.5::DOUBLE) / (0.499::DOUBLE / 199) + 1e-9::DOUBLE) AS INT) + 1, 200), 0) AS passed, tier = 'easy' AS ok FROM s WHERE mp IS NOT NULL AND tier IS NOT NULL
), g AS (
  SELECT etype, i, count(*) FILTER (passed > i) AS n, count(*) FILTER (passed > i AND ok) AS r, count(*) AS total FROM v, range(200) AS q(i) GROUP BY etype, i
), b AS (SELECT etype, min(i) AS i FROM g WHERE n >= 30 AND r::DOUBLE / n >= 0.9::DOUBLE GROUP BY etype)
SELECT e.etype, coalesce(round(0.5::DOUBLE + b.i * (0.499::DOUBLE / 199), 6), 1.0) AS tau, coalesce(round(g.r::DOUBLE / g.n, 6), 1.0) AS precision, coalesce(round(g.n::DOUBLE / g.total, 6), 0.0) AS coverage
FROM (SELECT DISTINCT etype FROM v) e LEFT JOIN b ON b.etype IS NOT DISTINCT FROM e.etype LEFT JOIN g ON g.etype IS NOT DISTINCT FROM b.etype AND g.i = b.i""",
    "weakness_by_type": f"""WITH {_SIMS}
SELECT etype, round(1 - avg(list_avg(list_filter([mp, mq], lambda x: x IS NOT NULL))), 6) AS weakness FROM t GROUP BY etype
HAVING avg(list_avg(list_filter([mp, mq], lambda x: x IS NOT NULL))) IS NOT NULL""",
    "sft_assembly": f"""WITH {_SIMS}
SELECT element_id, subtask, tier, reading IS NOT NULL AS ready, CASE WHEN reading IS NOT NULL THEN src END AS label_source, md5(coalesce(reading, draft)) AS label_md5 FROM a""",
    "sft_counts": f"""WITH {_SIMS}
SELECT d.subtask, count(a.element_id) FILTER (reading IS NOT NULL) AS n_ready, count(a.element_id) FILTER (reading IS NULL) AS n_waiting
FROM (VALUES ('layout'), ('text'), ('formula'), ('table')) d(subtask) LEFT JOIN a ON a.subtask = d.subtask GROUP BY d.subtask""",
    "manifest": """WITH r AS (SELECT coalesce(tier, 'none') AS stage, subtask FROM sft_record)
SELECT CASE WHEN grouping(stage) = 1 THEN 'all' ELSE stage END AS stage, CASE WHEN grouping(subtask) = 1 THEN 'all' ELSE subtask END AS subtask, count(*) AS n FROM r GROUP BY ROLLUP (stage, subtask)""",
}
