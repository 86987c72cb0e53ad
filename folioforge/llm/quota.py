"""Problem 5: a sample that matches target category proportions.

The category tree of a run is run -> tier -> cell group -> cell. Quotas are
handed down level by level by water filling: a child takes its weighted share
up to what its whole subtree holds, and what it cannot place goes to its
siblings first. Only what a whole branch cannot place reaches its cousins, one
level further up. All levels are window functions over the small table of
cells; the leaves then draw pages by their rank in a seeded permutation.

Defined results: a page counts once per run (its latest row with a known tier);
pages of unknown tier are never drawn; target_mix keys and tiers are compared
whatever their spelling; the wanted number of a tier is the larger of
round(share x budget), halves to even, and min_per_tier; the minimum holds even
where the minima together exceed the budget (over_budget tells); tiers outside
target_mix get nothing; a NULL mix or budget wants nothing; of repeated runs
the latest counts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.session import materialize

#: The tier names.
TIERS = ["easy", "medium", "hard", "invalid"]
#: Share of rows that one rank window should hold at most, as a power of two of hash buckets per cell.
RANK_BUCKET_ROWS = 100_000
SEED = 7


def tier_name(c: Column) -> Column:
    """The tier's name in lower case whatever its spelling, else NULL."""
    bare = F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z]", ""), "^tier", "")
    return F.when(bare.isin(TIERS), bare)


def run_pages(index: DataFrame) -> DataFrame:
    """(run_id, page_id, tier, cid): each page of a run once, by its latest row with a known tier."""
    rows = index.select("run_id", "page_id", tier_name(F.col("tier")).alias("tier"), F.coalesce(F.col("assign"), F.lit(-1)).alias("cid"), F.coalesce(F.unix_micros("indexed_at"), F.lit(0)).alias("at"))
    rank = reduce(lambda acc, k: acc.when(F.col("tier") == TIERS[k], F.lit(k)), range(len(TIERS)), F.when(F.lit(False), F.lit(0)))
    packed = F.col("cid").cast("long") * 4 + rank
    # Of rows indexed at one instant the larger packed value counts, so repeats give one result.
    once = (
        rows.filter("run_id is not null and page_id is not null and tier is not null")
        .withColumn("v", packed)
        .groupBy("run_id", "page_id")
        .agg(F.max_by("v", F.struct("at", "v")).alias("v"))
    )
    return once.select("run_id", "page_id", F.element_at(F.array(*[F.lit(t) for t in TIERS]), (F.pmod("v", F.lit(4)) + 1).cast("int")).alias("tier"), F.floor(F.col("v") / 4).cast("int").alias("cid"))


def wants(runs: DataFrame) -> DataFrame:
    """(run_id, tier, budget, min_per_tier, share, want) of every tier in a run's target_mix."""
    latest = runs.filter("run_id is not null").groupBy("run_id").agg(F.max_by(F.struct("budget", "min_per_tier", "target_mix"), F.coalesce(F.unix_micros("created_at"), F.lit(0))).alias("r")).select("run_id", "r.*")
    rows = latest.select("run_id", F.coalesce("budget", F.lit(0)).alias("budget"), F.coalesce("min_per_tier", F.lit(0)).alias("min_per_tier"), F.explode("target_mix").alias("k", "share"))
    named = rows.withColumn("tier", tier_name(F.col("k"))).filter("tier is not null").groupBy("run_id", "budget", "min_per_tier", "tier").agg(F.sum(F.coalesce("share", F.lit(0.0))).alias("share"))
    return named.withColumn("want", F.greatest(F.rint(F.col("share") * F.col("budget")).cast("long"), F.col("min_per_tier").cast("long")))


def fill(df: DataFrame, parent: list[str], quota: str, weight: str, cap: str, key: list[str], out: str) -> DataFrame:
    """Adds *out*: whole numbers that share *quota* among the rows of *parent* by *weight*, none above *cap*.

    Exact water filling without iteration: ordered by cap / weight, the rows up
    to some point take their cap and the rest share what is left by weight.
    Remainders go to the largest fractions. Rows of weight 0 take nothing.
    """
    c, w = F.col(cap).cast("double"), F.col(weight).cast("double")
    ratio = F.when(w > 0, c / w).otherwise(F.lit(0.0))
    order = [ratio.asc(), *key]
    p = Window.partitionBy(*parent)
    before = p.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    onward = p.orderBy(*order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    usable = F.when(w > 0, c).otherwise(F.lit(0.0))
    level = F.try_divide(F.col(quota).cast("double") - F.coalesce(F.sum(usable).over(before), F.lit(0.0)), F.sum(w).over(onward))
    df = df.withColumn("_full", F.when(w > 0, level >= ratio).otherwise(F.lit(True))).withColumn("_level", level).withColumn("_usable", usable).withColumn("_ratio", ratio)
    first_open = F.first(F.when(~F.col("_full"), F.col("_level")), ignorenulls=True).over(p.orderBy("_ratio", *key).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    share = F.when(F.col("_full"), F.col("_usable")).otherwise(F.greatest(first_open * w, F.lit(0.0)))
    df = df.withColumn("_share", share).withColumn("_base", F.least(F.floor(F.col("_share") + 1e-9), F.col("_usable").cast("long")))
    spare = F.least(F.col(quota).cast("long"), F.sum("_usable").over(p).cast("long")) - F.sum("_base").over(p)
    df = df.withColumn("_spare", spare).withColumn("_open", F.col("_base") < F.col("_usable"))
    turn = F.row_number().over(p.orderBy(F.col("_open").desc(), (F.col("_share") - F.col("_base")).desc(), *key))
    taken = F.col("_base") + F.when(F.col("_open") & (turn <= F.col("_spare")), 1).otherwise(0)
    return df.withColumn(out, taken.cast("long")).drop("_full", "_level", "_usable", "_ratio", "_share", "_base", "_spare", "_open")


def tier_quotas(target: DataFrame, cells: DataFrame) -> DataFrame:
    """(run_id, tier, ..., available, taken): the tree's first level.

    Each tier first takes its minimum, then its wanted number as far as the
    budget goes, then siblings with pages left take what others could not place.
    """
    have = cells.groupBy("run_id", "tier").agg(F.sum("n").alias("available"))
    t = target.join(have, ["run_id", "tier"], "left").withColumn("available", F.coalesce("available", F.lit(0)))
    p = Window.partitionBy("run_id")
    t = t.withColumn("least", F.least(F.col("min_per_tier").cast("long"), F.col("available")))
    t = t.withColumn("room", F.least("want", "available") - F.col("least")).withColumn("left", F.greatest(F.col("budget") - F.sum("least").over(p), F.lit(0)))
    t = fill(t, ["run_id"], "left", "share", "room", ["tier"], "by_share")
    t = t.withColumn("own", F.col("least") + F.col("by_share")).withColumn("left", F.greatest(F.col("budget") - F.sum("own").over(p), F.lit(0))).withColumn("room", F.col("available") - F.col("own"))
    t = fill(t, ["run_id"], "left", "share", "room", ["tier"], "passed_in")
    return t.withColumn("taken", F.col("own") + F.col("passed_in")).select("run_id", "tier", "budget", "min_per_tier", "share", "want", "available", "passed_in", "taken")


def cell_quotas(tiers: DataFrame, cells: DataFrame, groups: DataFrame) -> DataFrame:
    """(run_id, tier, grp, cid, n, q): the quota of every cell, group by group.

    *groups* is (cid, grp), the tree above the cells; unlisted cells are groups of their own.
    Weights are square roots of what a branch holds, so small branches stay visible.
    """
    g = cells.join(groups, "cid", "left").withColumn("grp", F.coalesce("grp", F.concat(F.lit("cell-"), F.col("cid").cast("string"))))
    up = g.groupBy("run_id", "tier", "grp").agg(F.sum("n").alias("n_grp")).join(tiers.select("run_id", "tier", "taken"), ["run_id", "tier"])
    up = fill(up.withColumn("weight", F.sqrt("n_grp")), ["run_id", "tier"], "taken", "weight", "n_grp", ["grp"], "q_grp").select("run_id", "tier", "grp", "q_grp")
    low = g.join(up, ["run_id", "tier", "grp"]).withColumn("weight", F.sqrt("n"))
    return fill(low, ["run_id", "tier", "grp"], "q_grp", "weight", "n", ["cid"], "q").select("run_id", "tier", "grp", "cid", "n", "q")


def draw(pages: DataFrame, quotas: DataFrame, seed: int = SEED) -> DataFrame:
    """(run_id, tier, cid, page_id, draw_rank): the first q pages of each cell in a seeded permutation.

    The permutation is the order of a 64-bit hash. A cell's pages are split
    into hash ranges sized by its row count, so a cell that holds any share of
    all rows is ranked in many tasks: rank = pages in earlier ranges + rank inside.
    Ranges that start beyond the quota are dropped before the ranking shuffle.
    """
    key = ["run_id", "tier", "cid"]
    wanted = quotas.filter("q > 0").withColumn("ranges", F.ceil(F.col("n") / RANK_BUCKET_ROWS).cast("int")).select(*key, "q", "ranges")
    hashed = pages.join(wanted, key).withColumn("h", F.xxhash64(F.lit(seed), "run_id", "page_id"))
    hashed = hashed.withColumn("range", F.floor((F.shiftrightunsigned(F.col("h"), 11) * F.col("ranges")) / F.lit(float(1 << 53))).cast("int"))
    w = Window.partitionBy(*key).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    before = hashed.groupBy(*key, "range").agg(F.count("*").alias("c")).withColumn("before", F.coalesce(F.sum("c").over(w), F.lit(0))).drop("c")
    split = hashed.join(before, [*key, "range"]).filter("before < q")
    inside = F.dense_rank().over(Window.partitionBy(*key, "range").orderBy(F.shiftrightunsigned("h", 11), "page_id"))
    return split.withColumn("draw_rank", F.col("before") + inside).filter("draw_rank <= q").select(*key, "page_id", "draw_rank")


def plan(index: DataFrame, runs: DataFrame, centroids: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(pages, tier level, cell level) of every run."""
    pages = materialize(run_pages(index), "quota-pages")
    cells = materialize(pages.groupBy("run_id", "tier", "cid").agg(F.count("*").alias("n")), "quota-cells")
    groups = centroids.filter("cid is not null").groupBy("cid").agg(F.min(F.split_part("path", F.lit("/"), F.lit(1))).alias("grp"))
    tiers = materialize(tier_quotas(wants(runs), cells), "quota-tiers")
    return pages, tiers, cell_quotas(tiers, cells, groups)


def report(tiers: DataFrame, allocation: DataFrame) -> DataFrame:
    """Per run and tier: target, what there is, what was taken, what is missing, and the stored figures."""
    stored = (
        allocation.select("run_id", "cid", tier_name(F.col("tier")).alias("tier"), "available", "quota")
        .filter("tier is not null")
        .groupBy("run_id", "tier", "cid")
        .agg(F.max("available").alias("available"), F.max("quota").alias("quota"))
        .groupBy("run_id", "tier")
        .agg(F.sum("available").alias("stored_available"), F.sum("quota").alias("stored_quota"))
    )
    p = Window.partitionBy("run_id")
    out = tiers.join(stored, ["run_id", "tier"], "left")
    total = F.sum("taken").over(p)
    return out.select(
        "run_id", "tier", "budget", "min_per_tier", "share", "want", "available", "passed_in", "taken",
        F.when(total > 0, F.round(F.col("taken") / total, 6)).alias("got_share"),
        F.greatest(F.col("want") - F.col("available"), F.lit(0)).alias("missing"),
        (total > F.col("budget")).alias("over_budget"), "stored_available", "stored_quota",
    )
