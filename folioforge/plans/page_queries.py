"""Queries on page results, features and workloads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions import sequence
from folioforge.operators import pages as ops
from folioforge.operators.evaluation import diversity
from folioforge.sources.tables import table

from .inputs import CHEAP, EXPENSIVE, SQL_ELEMENTS, TARGET, elements, sql_similarity, sql_squash


def page_results(spark: SparkSession, d: str) -> DataFrame:
    """The target parser's pages put together from their elements."""
    e = elements(spark, d, "page_id", "eid", "label", "content").filter("page_id is not null and page_id <> '0'").select("page_id", "eid", F.struct("eid", F.coalesce("label", F.lit("text")).alias("label"), F.try_element_at("content", F.lit(TARGET)).alias("content")).alias("b"))
    r = e.groupBy("page_id").agg(ops.page_result(F.array_sort(F.collect_list("b"))).alias("r"))
    return r.select("page_id", F.md5("r.text").alias("text_md5"), F.size("r.formulas").alias("n_formulas"), F.size("r.tables").alias("n_tables"))


def subtask_counts(spark: SparkSession, d: str) -> DataFrame:
    return elements(spark, d, "label").groupBy(ops.subtask_of(F.col("label")).alias("subtask")).agg(F.count("*").alias("n"))


def expert_tasks(spark: SparkSession, d: str) -> DataFrame:
    """How people would take up the hard elements: by the agreement of the two outside parsers."""
    e = elements(spark, d, "tier", "content").filter("tier = 'hard'")
    a, b = (F.try_element_at("content", F.lit(k)) for k in (CHEAP, EXPENSIVE))
    agreement = F.when(a.isNotNull() & b.isNotNull(), sequence.text_similarity(a, b))
    return ops.workload(e.select(ops.review_mode(agreement).alias("mode")), "mode")


def crop_boxes(spark: SparkSession, d: str) -> DataFrame:
    """Whole-pixel crops of all elements on pages of 1700 x 2400."""
    b = elements(spark, d, "box").select("element_id", ops.crop_box(F.transform("box", lambda v: v.cast("double")), F.lit(1700), F.lit(2400)).alias("c"))
    return b.select("element_id", *[F.col("c")[i].alias(n) for i, n in enumerate(("x1", "y1", "x2", "y2"))])


def pca_variance(spark: SparkSession, d: str) -> DataFrame:
    """Spread of the embeddings along their four main directions."""
    p = ops.centred_pca(table(spark, d, "embeddings"), "vec_id", "embedding", 4)
    return p.select(F.posexplode("projected").alias("direction", "x")).groupBy("direction").agg(F.round(F.avg("x"), 6).alias("mean"), F.round(F.var_pop("x"), 6).alias("variance"))


def synthetic_diversity(spark: SparkSession, d: str) -> DataFrame:
    """Effective scenarios of a made corpus, as large as the documents table."""
    c = ops.synthetic_corpus(spark, table(spark, d, "documents").count() * 10)
    return diversity(c.filter("tier <> 'invalid'"), c, "scenario")


QUERIES = {f.__name__: f for f in (page_results, subtask_counts, expert_tasks, crop_boxes, pca_variance, synthetic_diversity)}

ORACLES = {
    "page_results": f"""WITH {SQL_ELEMENTS}, b AS (SELECT page_id, eid, coalesce(label, 'text') AS label, content['{TARGET}'] AS c FROM elements WHERE page_id IS NOT NULL AND page_id <> '0')
SELECT page_id, md5(coalesce(string_agg(c, chr(10) ORDER BY eid, label, c) FILTER (label NOT IN ('formula', 'table') AND c IS NOT NULL), '')) AS text_md5,
       CAST(count(*) FILTER (label = 'formula' AND c IS NOT NULL) AS INT) AS n_formulas, CAST(count(*) FILTER (label = 'table' AND c IS NOT NULL) AS INT) AS n_tables FROM b GROUP BY page_id""",
    "subtask_counts": f"WITH {SQL_ELEMENTS} SELECT CASE WHEN label IN ('formula', 'table') THEN label ELSE 'text' END AS subtask, count(*) AS n FROM elements GROUP BY 1",
    "expert_tasks": f"""WITH {SQL_ELEMENTS}, h AS (SELECT {sql_squash(f"content['{CHEAP}']")} AS a, {sql_squash(f"content['{EXPENSIVE}']")} AS b, content['{CHEAP}'] IS NOT NULL AND content['{EXPENSIVE}'] IS NOT NULL AS two FROM elements WHERE tier = 'hard'
), s AS (SELECT CASE WHEN two THEN {sql_similarity("a", "b")} END AS s FROM h), m AS (SELECT CASE WHEN s IS NULL THEN 'retype' WHEN s >= 0.98::DOUBLE THEN 'quick_review' ELSE 'adjudicate' END AS mode FROM s)
SELECT d.mode, count(m.mode) AS n, round(count(m.mode)::DOUBLE / greatest((SELECT count(*) FROM m), 1), 6) AS share FROM (VALUES ('quick_review'), ('adjudicate'), ('retype')) d(mode) LEFT JOIN m USING (mode) GROUP BY d.mode""",
    "crop_boxes": f"""WITH {SQL_ELEMENTS}, f AS (SELECT element_id, len(box) = 4 AS ok, floor(box[1]::DOUBLE)::INT AS a, floor(box[2]::DOUBLE)::INT AS b, floor(box[3]::DOUBLE)::INT AS c, floor(box[4]::DOUBLE)::INT AS d FROM elements
), g AS (SELECT *, greatest(0, least(a, 1699)) AS x1, greatest(0, least(b, 2399)) AS y1 FROM f)
SELECT element_id, CASE WHEN ok THEN x1 END AS x1, CASE WHEN ok THEN y1 END AS y1, CASE WHEN ok THEN greatest(x1 + 1, least(c, 1700)) END AS x2, CASE WHEN ok THEN greatest(y1 + 1, least(d, 2400)) END AS y2 FROM g""",
}
