"""Inputs that several queries share, each with the SQL that states the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions.constants import TIERS
from folioforge.operators.clustering import local_sparsity, mean_vectors
from folioforge.sources.tables import table

#: Parsers of page_element.content: target, cheap, expensive.
TARGET, CHEAP, EXPENSIVE = "qwen3-vl-8b", "mistral-ocr-4", "paddleocr-vl"
WIDTH = 64


def tier_name(c: Column) -> Column:
    """A tier's name in lower case whatever its spelling, else NULL."""
    bare = F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z]", ""), "^tier", "")
    return F.when(bare.isin(TIERS), bare)


SQL_TIER = "CASE WHEN regexp_replace(regexp_replace(lower({0}), '[^a-z]', '', 'g'), '^tier', '') IN ('easy', 'medium', 'hard', 'invalid') THEN regexp_replace(regexp_replace(lower({0}), '[^a-z]', '', 'g'), '^tier', '') END"


def elements(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """element_id and *columns* of each element's latest delivery: one shuffle of just these, reduced before it."""
    e = table(spark, d, "page_element").groupBy("element_id").agg(F.max_by(F.struct(*columns), "loaded_at").alias("r"))
    return e.select("element_id", "r.*")


SQL_ELEMENTS = """elements AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY element_id ORDER BY loaded_at DESC) AS rn FROM page_element) WHERE rn = 1
)"""


def pages(spark: SparkSession, d: str) -> DataFrame:
    """(page_id, subtask, cid, tier) of the latest row of every page; unknown cells -1, unknown tiers invalid."""
    c = table(spark, d, "cluster_index").filter("page_id is not null")
    latest = F.struct("indexed_at", F.coalesce("assign", F.lit(-1)), "tier")
    row = F.struct("subtask", F.coalesce("assign", F.lit(-1)).alias("cid"), F.coalesce(tier_name(F.col("tier")), F.lit("invalid")).alias("tier"))
    return c.groupBy("page_id").agg(F.max_by(row, latest).alias("r")).select("page_id", "r.*")


SQL_PAGES = f"""pages AS (
  SELECT page_id, subtask, coalesce(assign, -1) AS cid, coalesce({SQL_TIER.format("tier")}, 'invalid') AS tier
  FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY indexed_at DESC, coalesce(assign, -1) DESC, tier DESC NULLS LAST) AS rn
        FROM cluster_index WHERE page_id IS NOT NULL) WHERE rn = 1
)"""


def page_sparsity(spark: SparkSession, d: str) -> DataFrame:
    """(page_id, sparsity) from the latest usable features of every page; a written table, as it is searched once and read more often."""
    p = table(spark, d, "cluster_index").filter("page_id is not null and size(features) = 32 and forall(features, x -> x is not null and not isnan(x) and abs(x) < 1e6)")
    p = p.groupBy("page_id").agg(F.max_by("features", "indexed_at").alias("features"))
    return local_sparsity(p, "page_id", "features", unit=True)


def cells(spark: SparkSession, d: str, share: float = 0.3) -> DataFrame:
    """(subtask, cid, tier, n, budget): the pages' cells, with a share of each subtask's pages as budget."""
    from pyspark.sql import Window

    c = pages(spark, d).filter("subtask is not null").groupBy("subtask", "cid", "tier").agg(F.count("*").alias("n"))
    return c.withColumn("budget", F.floor(F.sum("n").over(Window.partitionBy("subtask")) * share))


SQL_CELLS = f"""{SQL_PAGES}, cells AS (
  SELECT subtask, cid, tier, count(*) AS n, CAST(floor(sum(count(*)) OVER (PARTITION BY subtask) * 0.3::DOUBLE) AS BIGINT) AS budget
  FROM pages WHERE subtask IS NOT NULL GROUP BY subtask, cid, tier
)"""


def tree(spark: SparkSession, d: str) -> DataFrame:
    """(cid, path) of the earlier run's cells; the tail is a branch of its own."""
    c = table(spark, d, "cluster_centroid").filter("cid is not null and path is not null").groupBy("cid").agg(F.min("path").alias("path"))
    return c.unionByName(spark.createDataFrame([(-1, "tail")], "cid int, path string"))


SQL_TREE = """tree AS (
  SELECT cid, min(path) AS path FROM cluster_centroid WHERE cid IS NOT NULL AND path IS NOT NULL GROUP BY cid
  UNION ALL SELECT -1, 'tail'
)"""


def centroids(spark: SparkSession, d: str) -> DataFrame:
    """(label, centroid): mean embedding of each label to 6 digits."""
    return mean_vectors(table(spark, d, "embeddings"), "label", "embedding", WIDTH, 6)


SQL_NEAREST = f"""centroids AS (
  SELECT label AS cid, list(m ORDER BY i) AS c FROM (
    SELECT label, i, round(avg(embedding[i]::DOUBLE), 6) AS m FROM embeddings, range(1, {WIDTH + 1}) AS r(i) GROUP BY label, i)
  GROUP BY label
), pairs AS (
  SELECT e.vec_id, e.label, c.cid, list_sum(list_transform(list_zip(e.embedding, c.c), lambda z: (z[1]::DOUBLE - z[2]) * (z[1]::DOUBLE - z[2]))) AS d2
  FROM embeddings e, centroids c
), nearest AS (
  SELECT vec_id, label, cid, sqrt(d2) AS dist FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d2, cid) AS rn FROM pairs) WHERE rn = 1
)"""


def nearest(spark: SparkSession, d: str) -> DataFrame:
    """(vec_id, cid, dist, label) of every embedding."""
    from folioforge.operators.clustering import nearest_centroid

    e = table(spark, d, "embeddings")
    cs = [(r["label"], r["centroid"]) for r in centroids(spark, d).collect()]  # one row per label
    return nearest_centroid(e, cs, "vec_id", "embedding").join(e.select("vec_id", "label"), "vec_id")


_SPACES = "[\\s\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]+"


def sql_squash(c: str) -> str:
    """SQL of :func:`folioforge.functions.text.squash`."""
    return f"trim(regexp_replace(coalesce({c}, ''), '{_SPACES}', ' ', 'g'))"


def sql_similarity(a: str, b: str) -> str:
    """SQL of the edit similarity. DuckDB's edit distance counts bytes, so each character of the pair becomes one ASCII character."""
    signs = f"list_sort(list_distinct(list_transform(range(1, length({a} || {b}) + 1), lambda i: substr({a} || {b}, i, 1))))"
    ascii_signs = f"list_transform(range(1, len({signs}) + 1), lambda i: chr(i::INT))"
    coded = [f"translate({x}, array_to_string({signs}, ''), array_to_string({ascii_signs}, ''))" for x in (a, b)]
    return f"CASE WHEN greatest(length({a}), length({b})) = 0 THEN 1.0::DOUBLE ELSE 1 - levenshtein({coded[0]}, {coded[1]})::DOUBLE / greatest(length({a}), length({b})) END"
