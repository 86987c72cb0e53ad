"""Queries on clusters, duplicates, density and measures of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions.vector import unit
from folioforge.operators import clustering, evaluation
from folioforge.sources.tables import table

from .inputs import SQL_NEAREST, SQL_PAGES, WIDTH, centroids, nearest, page_sparsity, pages


def nearest_centroid(spark: SparkSession, d: str) -> DataFrame:
    return nearest(spark, d).select("vec_id", "cid", F.round("dist", 6).alias("dist"))


def kmeans_lloyd_step(spark: SparkSession, d: str) -> DataFrame:
    """New centroids after one assignment: size and all members of the mean."""
    n = nearest(spark, d).select("vec_id", "cid").join(table(spark, d, "embeddings").select("vec_id", "embedding"), "vec_id")
    return n.groupBy("cid").agg(F.count("*").alias("n"), *[F.round(F.avg(F.col("embedding")[i].cast("double")), 6).alias(f"m{i}") for i in range(WIDTH)])


def kmeans_flattened(spark: SparkSession, d: str) -> DataFrame:
    """Measures of a flattened k-means against the labels; ids of clusters are not compared."""
    e = table(spark, d, "embeddings")
    cs = list(enumerate(clustering.kmeans_flattened(e, "vec_id", "embedding", 10, rounds=2)))
    at = clustering.nearest_centroid(e, cs, "vec_id", "embedding").join(e.select("vec_id", "label"), "vec_id")
    return evaluation.purity_nmi(at, "cid", "label")


def hierarchical_cluster(spark: SparkSession, d: str) -> DataFrame:
    """Sizes and depths of a split tree over the pages' usable features."""
    p = table(spark, d, "cluster_index").filter("page_id is not null and size(features) = 32 and forall(features, x -> x is not null and not isnan(x) and abs(x) < 1e6)")
    p = p.groupBy("page_id").agg(F.max_by("features", "indexed_at").alias("features")).select("page_id", unit(F.col("features")).alias("features"))
    t = clustering.hierarchical(p, "page_id", "features", k=12, split=4, max_share=0.1, min_size=20)
    return t.groupBy("cid", "path").agg(F.count("*").alias("n"), F.avg("dist").alias("mean_dist"))


def tail_reservoir(spark: SparkSession, d: str) -> DataFrame:
    """Cells of the nearest-centroid assignment after the far and the small went to the tail."""
    return clustering.tail(nearest(spark, d), "cid", "dist", 95.0, 45).groupBy("cid").agg(F.count("*").alias("n"))


def lsh_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Pages kept by greedy near-duplicate removal inside cells, compared in 8 tables of 8 planes."""
    p = table(spark, d, "cluster_index").filter("page_id is not null and size(features) = 32 and forall(features, x -> x is not null and not isnan(x) and abs(x) < 1e6)")
    p = p.groupBy("page_id").agg(F.max_by(F.struct("assign", "features"), "indexed_at").alias("r")).select("page_id", "r.*")
    return clustering.dedup_in_buckets(p, "page_id", "assign", "features", bits=8, tables=8)


def _sparse(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings")
    return clustering.local_sparsity(e, "vec_id", "embedding").join(e.select("vec_id", "label"), "vec_id")


def local_sparsity(spark: SparkSession, d: str) -> DataFrame:
    return _sparse(spark, d).select("vec_id", F.round("sparsity", 5).alias("sparsity"))


def cluster_rarity(spark: SparkSession, d: str) -> DataFrame:
    return clustering.cluster_rarity(_sparse(spark, d), "label").select("label", F.round("rarity", 5).alias("rarity"))


def rarity_check(spark: SparkSession, d: str) -> DataFrame:
    """Does the local sparsity of a page's features tell medium and hard pages?"""
    p = pages(spark, d).select("page_id", "tier")
    return clustering.rarity_check(p.join(page_sparsity(spark, d), "page_id"))


def purity_nmi(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.purity_nmi(nearest(spark, d), "cid", "label")


def confusion(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.confusion(nearest(spark, d), "cid", "label")


def silhouette(spark: SparkSession, d: str) -> DataFrame:
    n = nearest(spark, d).select("vec_id", "cid").join(table(spark, d, "embeddings").select("vec_id", "embedding"), "vec_id")
    cs = [(r["label"], r["centroid"]) for r in centroids(spark, d).collect()]  # one row per label
    return evaluation.simplified_silhouette(n, cs, "embedding", "cid")


def diversity_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Effective number of cells among the hard pages, against all cells."""
    p = pages(spark, d)
    return evaluation.diversity(p.filter("tier = 'hard'"), p, "cid")


QUERIES = {f.__name__: f for f in (nearest_centroid, kmeans_lloyd_step, kmeans_flattened, hierarchical_cluster, tail_reservoir, lsh_dedup, local_sparsity, cluster_rarity, rarity_check, purity_nmi, confusion, silhouette, diversity_metrics)}

_SPARSE = """sp AS (
  SELECT a.vec_id, any_value(a.label) AS label, list_sort(list(list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[])))[16] AS sparsity
  FROM embeddings a, embeddings b WHERE a.embedding IS NOT NULL AND b.embedding IS NOT NULL GROUP BY a.vec_id)"""
_USABLE = "page_id IS NOT NULL AND len(features) = 32 AND len(list_filter(features, lambda x: x IS NULL OR isnan(x) OR abs(x) >= 1e6)) = 0"
#: The 16th nearest of all pages by the unit vectors of their latest usable features.
SQL_PAGE_SPARSITY = f"""pf AS (SELECT page_id, arg_max(features, indexed_at)::DOUBLE[] AS f FROM cluster_index WHERE {_USABLE} GROUP BY page_id
), pu AS (SELECT page_id, list_transform(f, lambda x: x / greatest(sqrt(list_inner_product(f, f)), 1e-9::DOUBLE)) AS v FROM pf
), ps AS (SELECT a.page_id, list_sort(list(list_distance(a.v, b.v)))[16] AS sparsity FROM pu a, pu b GROUP BY a.page_id)"""
# Greedy removal by id inside each cell, exactly: one step per row of a cell, with the vectors kept so far.
_GREEDY = f"""WITH RECURSIVE pf AS (
  SELECT page_id, coalesce(arg_max(struct_pack(a := assign), indexed_at).a, -1) AS c, arg_max(features, indexed_at)::DOUBLE[] AS v FROM cluster_index WHERE {_USABLE} GROUP BY page_id
), hd AS (SELECT c, list_transform(v, lambda x: x / greatest(sqrt(list_inner_product(v, v)), 1e-9::DOUBLE)) AS v, min(page_id) AS id FROM pf GROUP BY c, pf.v
), rw AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY id) AS r FROM hd
), g AS (
  SELECT c, r, [v] AS kept, [id] AS ids FROM rw WHERE r = 1
  UNION ALL
  SELECT c, r, CASE WHEN new THEN list_append(kept, v) ELSE kept END, CASE WHEN new THEN list_append(ids, id) ELSE ids END
  FROM (SELECT g.c, rw.r, g.kept, g.ids, rw.v, rw.id, len(list_filter(g.kept, lambda k: list_inner_product(k, rw.v) >= 0.98::DOUBLE)) = 0 AS new FROM g JOIN rw ON rw.c = g.c AND rw.r = g.r + 1)
), k AS (SELECT DISTINCT unnest(ids) AS id FROM (SELECT c, arg_max(ids, r) AS ids FROM g GROUP BY c))"""

_TABLE = f"""{SQL_NEAREST}, c AS (SELECT cid, label, count(*)::DOUBLE AS n FROM nearest GROUP BY cid, label), t AS (
  SELECT *, sum(n) OVER (PARTITION BY cid) AS nf, sum(n) OVER (PARTITION BY label) AS nt, sum(n) OVER () AS nn, max(n) OVER (PARTITION BY cid) AS top FROM c
)"""

ORACLES = {
    "nearest_centroid": f"WITH {SQL_NEAREST} SELECT vec_id, cid, round(dist, 6) AS dist FROM nearest",
    "kmeans_lloyd_step": f"""WITH {SQL_NEAREST}
SELECT n.cid, count(*) AS n, {", ".join(f"round(avg(e.embedding[{i + 1}]::DOUBLE), 6) AS m{i}" for i in range(WIDTH))} FROM nearest n JOIN embeddings e USING (vec_id) GROUP BY n.cid""",
    "lsh_dedup": f"{_GREEDY} SELECT page_id, page_id IN (SELECT id FROM k) AS kept FROM pf",
    "tail_reservoir": f"""WITH {SQL_NEAREST}, f AS (SELECT quantile_cont(dist, 0.95::DOUBLE) AS far FROM nearest), a AS (
  SELECT CASE WHEN dist > far THEN -1 ELSE cid END AS cid FROM nearest, f
), s AS (SELECT cid, count(*) AS n FROM a WHERE cid >= 0 GROUP BY cid HAVING count(*) < 45)
SELECT CASE WHEN s.cid IS NOT NULL THEN -1 ELSE a.cid END AS cid, count(*) AS n FROM a LEFT JOIN s ON s.cid = a.cid GROUP BY 1""",
    "local_sparsity": f"WITH {_SPARSE} SELECT vec_id, round(sparsity, 5) AS sparsity FROM sp",
    "cluster_rarity": f"""WITH {_SPARSE}, w AS (SELECT median(sparsity) AS m FROM sp)
SELECT label, round(greatest(least(median(sparsity) / any_value(m), 8.0::DOUBLE), 0.125::DOUBLE), 5) AS rarity FROM sp, w GROUP BY label""",
    "rarity_check": f"""WITH {SQL_PAGES}, {SQL_PAGE_SPARSITY}, t AS (
  SELECT round(sparsity, 12) AS s, (tier IN ('medium', 'hard'))::INT::DOUBLE AS y FROM pages JOIN ps USING (page_id) WHERE tier <> 'invalid' AND sparsity IS NOT NULL
), r AS (SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0::DOUBLE AS rx FROM t), g AS (
  SELECT count(*) AS n, CASE WHEN count(*) >= 100 AND var_pop(y) > 0 AND var_pop(rx) > 0 THEN corr(rx, y) ELSE 0 END AS rho FROM r)
SELECT n, round(rho, 6) AS rho, CASE WHEN rho <= 0.05::DOUBLE THEN 0.0::DOUBLE WHEN rho < 0.15::DOUBLE THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS tau FROM g""",
    "purity_nmi": f"""WITH {_TABLE}
SELECT round(sum(top * n / nf) / max(nn), 6) AS purity,
       round(2 * sum(n / nn * ln(n * nn / (nf * nt))) / (-sum(n / nn * ln(nf / nn)) - sum(n / nn * ln(nt / nn))), 6) AS nmi FROM t""",
    "confusion": f"WITH {_TABLE} SELECT label, sum(n)::BIGINT AS n, count(*) AS n_clusters, round(max(n) / sum(n), 6) AS top_share FROM t GROUP BY label",
    "silhouette": f"""WITH {SQL_NEAREST}, x AS (
  SELECT n.vec_id, min(sqrt(p.d2)) FILTER (p.cid = n.cid) AS a, min(sqrt(p.d2)) FILTER (p.cid <> n.cid) AS b FROM nearest n JOIN pairs p USING (vec_id) GROUP BY n.vec_id)
SELECT round(avg((b - a) / greatest(a, b, 1e-12::DOUBLE)), 6) AS silhouette FROM x""",
    "diversity_metrics": f"""WITH {SQL_PAGES}, h AS (SELECT cid, count(*)::DOUBLE AS n FROM pages WHERE tier = 'hard' GROUP BY cid), p AS (SELECT *, n / sum(n) OVER () AS p FROM h)
SELECT sum(n)::BIGINT AS n_sample, round(exp(-sum(p * ln(p))), 6) AS effective, round(max(p), 6) AS head_share, round(count(*)::DOUBLE / (SELECT count(DISTINCT cid) FROM pages), 6) AS coverage FROM p""",
}
