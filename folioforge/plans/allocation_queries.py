"""Queries on probes, budgets and draws."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions.constants import GAINS, PROBE, SAMPLER
from folioforge.operators import allocation, sampling
from folioforge.operators.clustering import cluster_rarity as rarity
from folioforge.sources.tables import table

from .cluster_queries import SQL_PAGE_SPARSITY
from .inputs import SQL_CELLS, SQL_NEAREST, SQL_PAGES, SQL_TREE, cells, nearest, page_sparsity, pages, tree

BUDGET = 300


def _sizes(spark: SparkSession, d: str) -> DataFrame:
    return pages(spark, d).groupBy("cid").agg(F.count("*").alias("n"))


def probe_sizes(spark: SparkSession, d: str) -> DataFrame:
    return _sizes(spark, d).select("cid", "n", allocation.probe_size(F.col("n")).alias("n_probe"))


def _probed(spark: SparkSession, d: str) -> DataFrame:
    """Per cell a probe of its size in seeded order."""
    p = pages(spark, d)
    return sampling.draw(p, probe_sizes(spark, d).select("cid", "n_probe"), ["cid"], "page_id", "n_probe")


def cluster_weights(spark: SparkSession, d: str) -> DataFrame:
    w = allocation.cluster_weights(_sizes(spark, d), _probed(spark, d).select("cid", "tier"), "text")
    return w.select("cid", "n_probe", *[F.round(c, 6).alias(c) for c in ("p0", "p1", "p2", "p3", "value", "se", "weight")], "dropped")


def expand_quota(spark: SparkSession, d: str) -> DataFrame:
    w = allocation.cluster_weights(_sizes(spark, d), _probed(spark, d).select("cid", "tier"), "text")
    stats = w.select("cid", "n", F.round("weight", 6).alias("weight"), "dropped", F.lit(BUDGET).cast("long").alias("budget"))
    return allocation.expand_quota(stats, ["budget"]).select("cid", "quota")


def allocate_flat(spark: SparkSession, d: str) -> DataFrame:
    return allocation.allocate(cells(spark, d), ["subtask"], "text").select("subtask", "cid", "tier", "n", "quota")


def hierarchical_weights(spark: SparkSession, d: str) -> DataFrame:
    """Tree weights of every subtask's cells."""
    sizes = cells(spark, d).groupBy("subtask", "cid").agg(F.sum("n").alias("n"))
    return allocation.hierarchical_weights(sizes.join(tree(spark, d), "cid"), ["subtask"]).select("subtask", "cid", F.round("weight", 9).alias("weight"))


def _weighted(spark: SparkSession, d: str) -> DataFrame:
    return cells(spark, d).join(hierarchical_weights(spark, d), ["subtask", "cid"], "left")


def allocate_tree(spark: SparkSession, d: str) -> DataFrame:
    return allocation.allocate(_weighted(spark, d), ["subtask"], "text", "weight").select("subtask", "cid", "tier", "n", "quota")


def allocate_nested(spark: SparkSession, d: str) -> DataFrame:
    return allocation.allocate_nested(_weighted(spark, d), ["subtask"], "text").select("subtask", "cid", "tier", "n", "quota")


def allocation_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Mix, coverage and entropy gain of the flat allocation."""
    m = allocation.allocation_metrics(allocate_flat(spark, d), ["subtask"])
    return m.select("subtask", "total", *[F.round(c, 6).alias(c) for c in ("coverage", "entropy_gain", "share_easy", "share_medium", "share_hard", "share_invalid")])


def strategy_comparison(spark: SparkSession, d: str) -> DataFrame:
    """Flat, tree and nested allocation side by side."""
    out = None
    for name, f in (("flat", allocate_flat), ("tree", allocate_tree), ("nested", allocate_nested)):
        m = allocation.allocation_metrics(f(spark, d), ["subtask"]).withColumn("strategy", F.lit(name))
        out = m if out is None else out.unionByName(m)
    return out.select("strategy", "subtask", "total", *[F.round(c, 6).alias(c) for c in ("coverage", "entropy_gain", "share_medium", "share_hard")])


def stratified_draw(spark: SparkSession, d: str) -> DataFrame:
    """Of every cell and tier its stored square-root share of pages, in seeded order."""
    p = pages(spark, d)
    quota = p.groupBy("cid", "tier").agg(F.ceil(F.sqrt(F.count("*").cast("double"))).alias("quota"))
    return sampling.draw(p, quota, ["cid", "tier"], "page_id").select("cid", "tier", "page_id", F.col("rank").cast("long").alias("rank"))


def stratified_sample(spark: SparkSession, d: str) -> DataFrame:
    """Embeddings to cells, cells to quotas by tree and tier, quotas to a seeded draw: the flagship.

    Tiers are the distance's quarters of a cell; paths group labels by parity.
    """
    n = nearest(spark, d)
    mean = n.groupBy("cid").agg(F.avg("dist").alias("m"))
    n = n.join(F.broadcast(mean), "cid")  # one row per label
    tier = F.when(F.col("dist") < 0.9 * F.col("m"), "easy").when(F.col("dist") < 1.05 * F.col("m"), "medium").otherwise("hard")
    n = n.select("vec_id", "cid", tier.alias("tier"))
    c = n.groupBy("cid", "tier").agg(F.count("*").alias("n")).withColumn("budget", F.lit(200).cast("long"))
    leaves = c.groupBy("budget", "cid").agg(F.sum("n").alias("n")).withColumn("path", F.concat_ws("/", (F.col("cid") % 2).cast("string"), F.col("cid").cast("string")))
    w = allocation.hierarchical_weights(leaves, ["budget"])
    q = allocation.allocate_nested(c.join(w.select("cid", "weight"), "cid"), ["budget"], "text")
    return sampling.draw(n, q.select("cid", "tier", "quota"), ["cid", "tier"], "vec_id").select("cid", "tier", "vec_id", F.col("rank").cast("long").alias("rank"))


def rarity_prior_allocation(spark: SparkSession, d: str) -> DataFrame:
    """Nested allocation with cells' rarity as prior, from the local sparsity of their pages' features."""
    r = rarity(pages(spark, d).select("page_id", "cid").join(page_sparsity(spark, d), "page_id"), "cid")
    return allocation.allocate_nested(_weighted(spark, d).join(r, "cid", "left"), ["subtask"], "text", prior="rarity").select("subtask", "cid", "tier", "n", "quota")


QUERIES = {f.__name__: f for f in (probe_sizes, cluster_weights, expand_quota, allocate_flat, hierarchical_weights, allocate_tree, allocate_nested, allocation_metrics, strategy_comparison, stratified_draw, stratified_sample, rarity_prior_allocation)}

_G = "CASE tier WHEN 'easy' THEN {}::DOUBLE WHEN 'medium' THEN {}::DOUBLE WHEN 'hard' THEN {}::DOUBLE ELSE 0.0::DOUBLE END".format(*GAINS["text"])
_ALPHA, _CAP, _FLOOR = SAMPLER["alpha"], SAMPLER["cap_ratio"], SAMPLER["floor"]

_PROBES = f"""{SQL_PAGES}, sz AS (SELECT cid, count(*) AS n FROM pages GROUP BY cid), pz AS (
  SELECT cid, n, least(least({PROBE["n_max"]}, n), greatest({PROBE["n_min"]}, CAST(round_even({PROBE["beta"]}::DOUBLE * sqrt(n), 0) AS BIGINT))) AS n_probe FROM sz)"""

_WEIGHTS = f"""{_PROBES}, pr AS (
  SELECT p.cid, p.tier FROM (SELECT *, row_number() OVER (PARTITION BY cid ORDER BY md5('7:' || page_id), page_id) AS rn FROM pages) p JOIN pz ON pz.cid = p.cid WHERE rn <= n_probe
), ct AS (SELECT cid, count(*) FILTER (tier = 'easy') AS c0, count(*) FILTER (tier = 'medium') AS c1, count(*) FILTER (tier = 'hard') AS c2, count(*) FILTER (tier = 'invalid') AS c3, count(*) AS m FROM pr GROUP BY cid
), g AS (SELECT sum(c0)::DOUBLE / sum(m) AS g0, sum(c1)::DOUBLE / sum(m) AS g1, sum(c2)::DOUBLE / sum(m) AS g2, sum(c3)::DOUBLE / sum(m) AS g3 FROM ct
), ps AS (SELECT ct.cid, sz.n, m AS n_probe, (c0 + 20 * g0) / (m + 20) AS p0, (c1 + 20 * g1) / (m + 20) AS p1, (c2 + 20 * g2) / (m + 20) AS p2, (c3 + 20 * g3) / (m + 20) AS p3 FROM ct JOIN sz USING (cid), g
), en AS (SELECT *, p0 + p1 + p2 AS s3 FROM ps
), ev AS (SELECT *, -(p0 / s3 * ln(p0 / s3) + p1 / s3 * ln(p1 / s3) + p2 / s3 * ln(p2 / s3)) / ln(3::DOUBLE) AS h FROM en
), vv AS (SELECT *, ({GAINS["text"][0]}::DOUBLE * p0 + {GAINS["text"][1]}::DOUBLE * p1 + {GAINS["text"][2]}::DOUBLE * p2) * (1 + 0.35::DOUBLE * h) AS value,
                 sqrt(greatest(p0 * (1 - p0), p1 * (1 - p1), p2 * (1 - p2), p3 * (1 - p3)) / n_probe) AS se, p3 > 0.5::DOUBLE AS dropped FROM ev
), ww AS (SELECT *, CASE WHEN dropped THEN 0 ELSE value * pow(n, {_ALPHA}::DOUBLE) END AS weight FROM vv)"""


def _rounds(first: str, by: str, n: int, remainder: bool) -> str:
    """SQL of *n* rounds of filling, from a table *first* (by, key columns, w, cap, budget); the last one deals the remainder."""
    out = [f"r0 AS (SELECT *, 0::BIGINT AS got FROM {first})"]
    for i in range(n):
        free = "(got < cap AND w > 0)"
        out.append(f"s{i} AS (SELECT *, sum(got) OVER (PARTITION BY {by}) AS used, sum(CASE WHEN {free} THEN w ELSE 0 END) OVER (PARTITION BY {by}) AS tw FROM r{i})")
        out.append(f"r{i + 1} AS (SELECT * EXCLUDE (used, tw) REPLACE (got + CASE WHEN {free} AND tw > 0 AND budget > used THEN least(CAST(floor((budget - used) * w / tw) AS BIGINT), cap - got) ELSE 0 END AS got) FROM s{i})")
    if remainder:
        out.append(f"q AS (SELECT *, sum(got) OVER (PARTITION BY {by}) AS used, row_number() OVER (PARTITION BY {by} ORDER BY (got < cap AND w > 0) DESC, w DESC, cid, tier) AS rn, got < cap AND w > 0 AS free FROM r{n})")
        out.append(f"rr AS (SELECT * REPLACE (got + CASE WHEN free AND rn <= budget - used THEN 1 ELSE 0 END AS got) FROM q)")
    else:
        out.append(f"rr AS (SELECT * FROM r{n})")
    return ", ".join(out)


def _nested(first: str, by: str) -> str:
    """SQL of the nested filling from a table *first* (by, cid, tier, w, g, cap, budget), to a table nn with got."""
    c = f"{by}, cid"
    out = [f"n0 AS (SELECT *, 0::BIGINT AS got, count(*) OVER (PARTITION BY {c}) AS k FROM {first})"]
    for i in range(SAMPLER["outer_rounds"]):
        out.append(f"o{i} AS (SELECT *, sum(got) OVER (PARTITION BY {by}) AS used, sum(got) OVER (PARTITION BY {c}) AS cg, sum(cap) OVER (PARTITION BY {c}) AS cc, row_number() OVER (PARTITION BY {c} ORDER BY tier) AS rn FROM n{i})")
        out.append(f"p{i} AS (SELECT *, fsum(CASE WHEN rn = 1 AND w > 0 AND cg < cc THEN w ELSE 0 END) OVER (PARTITION BY {by}) AS tw FROM o{i})")
        out.append(f"q{i}_0 AS (SELECT * EXCLUDE (used, cg, cc, rn, tw), CASE WHEN w > 0 AND cg < cc AND tw > 0 AND budget > used THEN least(CAST(floor((budget - used) * w / tw) AS BIGINT), cc - cg) ELSE 0 END AS share, 0::BIGINT AS ig, false AS fin FROM p{i})")
        for j in range(5):
            live = f"NOT fin AND {j} < k + 2 AND share > iu AND tg > 0 AND got + ig < cap"
            out.append(f"a{i}_{j} AS (SELECT *, sum(ig) OVER (PARTITION BY {c}) AS iu, fsum(CASE WHEN got + ig < cap THEN g ELSE 0 END) OVER (PARTITION BY {c}) AS tg FROM q{i}_{j})")
            out.append(f"b{i}_{j} AS (SELECT *, CASE WHEN {live} THEN least(CAST(floor((share - iu) * g / tg) AS BIGINT), cap - got - ig) ELSE 0 END AS ad FROM a{i}_{j})")
            out.append(f"c{i}_{j} AS (SELECT *, sum(ad) OVER (PARTITION BY {c}) AS sa, row_number() OVER (PARTITION BY {c} ORDER BY (got + ig < cap) DESC, g DESC, tier) AS rr FROM b{i}_{j})")
            out.append(f"q{i}_{j + 1} AS (SELECT * EXCLUDE (iu, tg, ad, sa, rr) REPLACE (ig + ad + CASE WHEN sa = 0 AND {live} AND rr <= share - iu THEN 1 ELSE 0 END AS ig, fin OR (sa = 0 AND share > iu) AS fin) FROM c{i}_{j})")
        out.append(f"n{i + 1} AS (SELECT * EXCLUDE (share, ig, fin) REPLACE (got + ig AS got) FROM q{i}_5)")
    out.append(f"nn AS (SELECT * FROM n{SAMPLER['outer_rounds']})")
    return ", ".join(out)


_TREE_W = f"""{SQL_CELLS}, {SQL_TREE}, lf AS (SELECT subtask, cid, sum(n) AS n FROM cells GROUP BY subtask, cid), st AS (
  SELECT lf.subtask, lf.cid, lf.n, array_to_string(string_split(path, '/')[1:d], '/') AS node, array_to_string(string_split(path, '/')[1:d - 1], '/') AS parent
  FROM (SELECT lf.*, path, unnest(range(1, len(string_split(path, '/')) + 1)) AS d FROM lf JOIN tree USING (cid)) lf
), nd AS (SELECT subtask, node, parent, pow(sum(n), {_ALPHA}::DOUBLE) AS mass FROM st GROUP BY subtask, node, parent
), sh AS (SELECT subtask, node, mass / sum(mass) OVER (PARTITION BY subtask, parent) AS share FROM nd
), tw AS (SELECT st.subtask, cid, round(exp(sum(ln(share))), 9) AS weight FROM st JOIN sh ON sh.subtask = st.subtask AND sh.node = st.node GROUP BY st.subtask, cid)"""

_FLAT = f"""{SQL_CELLS}, fw AS (
  SELECT *, {_G} * pow(sum(n) OVER (PARTITION BY subtask, cid), {_ALPHA}::DOUBLE) AS w0 FROM cells
), f0 AS (SELECT subtask, cid, tier, n, budget, w0 AS w, CASE WHEN w0 > 0 THEN CAST(floor({_CAP}::DOUBLE * n) AS BIGINT) ELSE 0 END AS cap FROM fw), {_rounds("f0", "subtask", 14, True)}"""
_RAISED = f"greatest(got, CASE WHEN w > 0 THEN least({_FLOOR}, cap) ELSE 0 END)"

_NESTED_Q = """, {0} AS (SELECT c.subtask, c.cid, c.tier, c.n, CASE WHEN nn.cid IS NULL THEN 0 ELSE CAST(greatest(got, least({1}, cap)) AS BIGINT) END AS quota FROM cells c LEFT JOIN nn ON nn.subtask = c.subtask AND nn.cid = c.cid AND nn.tier = c.tier)"""
_NESTED_F = f"""f0 AS (
  SELECT c.subtask, c.cid, tier, n, budget, coalesce(weight, 0){{prior}} AS w, {_G} AS g, CAST(floor({_CAP}::DOUBLE * n) AS BIGINT) AS cap
  FROM cells c LEFT JOIN tw ON tw.subtask = c.subtask AND tw.cid = c.cid {{join}} WHERE {_G} > 0)"""
_METRICS = """(WITH p AS (SELECT subtask, cid, sum(n)::DOUBLE AS pool, sum(quota)::DOUBLE AS o FROM {0} GROUP BY subtask, cid
), h AS (SELECT *, pool / sum(pool) OVER (PARTITION BY subtask) AS pp, o / sum(o) OVER (PARTITION BY subtask) AS po FROM p
), m AS (SELECT subtask, sum(o)::BIGINT AS total, round(avg((o > 0)::INT::DOUBLE), 6) AS coverage,
  round((sum(CASE WHEN po > 0 THEN -po * ln(po) ELSE 0 END) - sum(CASE WHEN pp > 0 THEN -pp * ln(pp) ELSE 0 END)) / greatest(ln(count(*)), 1e-9::DOUBLE), 6) AS entropy_gain FROM h GROUP BY subtask
), x AS (SELECT subtask, round(sum(CASE WHEN tier = 'medium' THEN quota ELSE 0 END)::DOUBLE / greatest(sum(quota), 1), 6) AS share_medium, round(sum(CASE WHEN tier = 'hard' THEN quota ELSE 0 END)::DOUBLE / greatest(sum(quota), 1), 6) AS share_hard FROM {0} GROUP BY subtask)
SELECT '{1}' AS strategy, * FROM m JOIN x USING (subtask))"""

ORACLES = {
    "rarity_prior_allocation": f"""WITH {_TREE_W}, {SQL_PAGE_SPARSITY}, sx AS (SELECT cid, sparsity FROM pages JOIN ps USING (page_id)
), rr0 AS (SELECT cid, greatest(least(median(sparsity) / (SELECT median(sparsity) FROM sx), 8.0::DOUBLE), 0.125::DOUBLE) AS rarity FROM sx GROUP BY cid
), {_NESTED_F.format(prior=" * coalesce(rarity, 1)", join="LEFT JOIN rr0 ON rr0.cid = c.cid")}, {_nested("f0", "subtask")}{_NESTED_Q.format("qq", _FLOOR)} SELECT * FROM qq""",
    "strategy_comparison": f"""SELECT * FROM (WITH {_FLAT}, fq AS (SELECT subtask, cid, tier, n, {_RAISED} AS quota FROM rr) {_METRICS.format("fq", "flat")[1:-1].replace("WITH p AS", ", p AS", 1)})
UNION ALL SELECT * FROM (WITH {_TREE_W}, f0 AS (
  SELECT c.subtask, c.cid, tier, n, budget, {_G} * coalesce(weight, 0) AS w, CASE WHEN {_G} * coalesce(weight, 0) > 0 THEN CAST(floor({_CAP}::DOUBLE * n) AS BIGINT) ELSE 0 END AS cap
  FROM cells c LEFT JOIN tw ON tw.subtask = c.subtask AND tw.cid = c.cid
), {_rounds("f0", "subtask", 14, True)}, tq AS (SELECT subtask, cid, tier, n, {_RAISED} AS quota FROM rr) {_METRICS.format("tq", "tree")[1:-1].replace("WITH p AS", ", p AS", 1)})
UNION ALL SELECT * FROM (WITH {_TREE_W}, {_NESTED_F.format(prior="", join="")}, {_nested("f0", "subtask")}{_NESTED_Q.format("nq", _FLOOR)} {_METRICS.format("nq", "nested")[1:-1].replace("WITH p AS", ", p AS", 1)})""",
    "probe_sizes": f"WITH {_PROBES} SELECT cid, n, n_probe FROM pz",
    "cluster_weights": f"WITH {_WEIGHTS} SELECT cid, n_probe, round(p0, 6) AS p0, round(p1, 6) AS p1, round(p2, 6) AS p2, round(p3, 6) AS p3, round(value, 6) AS value, round(se, 6) AS se, round(weight, 6) AS weight, dropped FROM ww",
    "expand_quota": f"""WITH {_WEIGHTS}, e0 AS (
  SELECT cid, '' AS tier, 0 AS b, {BUDGET}::BIGINT AS budget, CASE WHEN dropped THEN 0 ELSE round(weight, 6) END AS w, CASE WHEN dropped OR weight <= 0 THEN 0 ELSE CAST(floor({_CAP}::DOUBLE * n) AS BIGINT) END AS cap FROM ww
), {_rounds("e0", "b", 14, False)} SELECT cid, CAST({_RAISED} AS BIGINT) AS quota FROM rr""",
    "allocate_flat": f"WITH {_FLAT} SELECT subtask, cid, tier, n, CAST({_RAISED} AS BIGINT) AS quota FROM rr",
    "hierarchical_weights": f"WITH {_TREE_W} SELECT subtask, cid, weight FROM tw",
    "allocate_tree": f"""WITH {_TREE_W}, f0 AS (
  SELECT c.subtask, c.cid, tier, n, budget, {_G} * coalesce(weight, 0) AS w, CASE WHEN {_G} * coalesce(weight, 0) > 0 THEN CAST(floor({_CAP}::DOUBLE * n) AS BIGINT) ELSE 0 END AS cap
  FROM cells c LEFT JOIN tw ON tw.subtask = c.subtask AND tw.cid = c.cid
), {_rounds("f0", "subtask", 14, True)} SELECT subtask, cid, tier, n, CAST({_RAISED} AS BIGINT) AS quota FROM rr""",
    "allocate_nested": f"""WITH {_TREE_W}, f0 AS (
  SELECT c.subtask, c.cid, tier, n, budget, coalesce(weight, 0) AS w, {_G} AS g, CAST(floor({_CAP}::DOUBLE * n) AS BIGINT) AS cap
  FROM cells c LEFT JOIN tw ON tw.subtask = c.subtask AND tw.cid = c.cid WHERE {_G} > 0
), {_nested("f0", "subtask")}
SELECT c.subtask, c.cid, c.tier, c.n, CASE WHEN nn.cid IS NULL THEN 0 ELSE CAST(greatest(got, least({_FLOOR}, cap)) AS BIGINT) END AS quota FROM cells c LEFT JOIN nn ON nn.subtask = c.subtask AND nn.cid = c.cid AND nn.tier = c.tier""",
    "stratified_sample": f"""WITH {SQL_NEAREST}, mm AS (SELECT cid, avg(dist) AS m FROM nearest GROUP BY cid), tt AS (
  SELECT vec_id, n.cid, CASE WHEN dist < 0.9::DOUBLE * m THEN 'easy' WHEN dist < 1.05::DOUBLE * m THEN 'medium' ELSE 'hard' END AS tier FROM nearest n JOIN mm USING (cid)
), cl AS (SELECT cid, tier, count(*) AS n FROM tt GROUP BY cid, tier), lv AS (SELECT cid, cid % 2 AS p, sum(n) AS n FROM cl GROUP BY cid), pm AS (
  SELECT p, pow(sum(n), {_ALPHA}::DOUBLE) AS m FROM lv GROUP BY p
), wt AS (SELECT cid, exp(ln(pow(n, {_ALPHA}::DOUBLE) / sum(pow(n, {_ALPHA}::DOUBLE)) OVER (PARTITION BY lv.p)) + ln(m / (SELECT sum(m) FROM pm))) AS weight FROM lv JOIN pm ON pm.p = lv.p
), f0 AS (SELECT 1 AS b, cl.cid, tier, n, 200 AS budget, weight AS w, {_G} AS g, CAST(floor({_CAP}::DOUBLE * n) AS BIGINT) AS cap FROM cl JOIN wt USING (cid)
), {_nested("f0", "b")}, r AS (SELECT cid, tier, vec_id, row_number() OVER (PARTITION BY cid, tier ORDER BY md5('7:' || vec_id), vec_id) AS rank FROM tt)
SELECT r.cid, r.tier, vec_id, rank FROM r JOIN nn ON nn.cid = r.cid AND nn.tier = r.tier WHERE rank <= greatest(got, least({_FLOOR}, cap))""",
    "allocation_metrics": f"""WITH {_FLAT}, a AS (SELECT subtask, cid, tier, n, {_RAISED} AS quota FROM rr), p AS (
  SELECT subtask, cid, sum(n)::DOUBLE AS pool, sum(quota)::DOUBLE AS o FROM a GROUP BY subtask, cid
), h AS (SELECT *, pool / sum(pool) OVER (PARTITION BY subtask) AS pp, o / sum(o) OVER (PARTITION BY subtask) AS po FROM p
), m AS (SELECT subtask, sum(o)::BIGINT AS total, round(avg((o > 0)::INT::DOUBLE), 6) AS coverage,
                round((sum(CASE WHEN po > 0 THEN -po * ln(po) ELSE 0 END) - sum(CASE WHEN pp > 0 THEN -pp * ln(pp) ELSE 0 END)) / greatest(ln(count(*)), 1e-9::DOUBLE), 6) AS entropy_gain FROM h GROUP BY subtask
), x AS (SELECT subtask, {", ".join(f"round(sum(CASE WHEN tier = '{t}' THEN quota ELSE 0 END)::DOUBLE / greatest(sum(quota), 1), 6) AS share_{t}" for t in ("easy", "medium", "hard", "invalid"))} FROM a GROUP BY subtask)
SELECT * FROM m JOIN x USING (subtask)""",
    "stratified_draw": f"""WITH {SQL_PAGES}, q AS (SELECT cid, tier, CAST(ceil(sqrt(count(*))) AS BIGINT) AS quota FROM pages GROUP BY cid, tier), r AS (
  SELECT cid, tier, page_id, row_number() OVER (PARTITION BY cid, tier ORDER BY md5('7:' || page_id), page_id) AS rank FROM pages)
SELECT r.cid, r.tier, page_id, rank FROM r JOIN q USING (cid, tier) WHERE rank <= quota""",
}
