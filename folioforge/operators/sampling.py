"""Deterministic draws, queues and splits. Every random order is that of md5(seed:id)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def order_key(seed: int, *ids: str) -> Column:
    """A permutation that depends on nothing but the seed and the ids, and is the same in other SQL engines."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(i).cast("string") for i in ids]))


def draw(members: DataFrame, quotas: DataFrame, cell: list[str], id_col: str, quota: str = "quota", seed: int = 7, ranges: int = 4096) -> DataFrame:
    """Of every cell of *members* its first *quota* ids in seeded order; all where there are fewer.

    A cell is ranked in *ranges* ranges of the order's leading digits: pages in
    earlier ranges are counted, ranges beyond the quota dropped, and only inside
    a range rows are sorted, so a cell of any size is spread over tasks.
    """
    wanted = quotas.filter(F.col(quota) > 0).select(*cell, F.col(quota).alias("_q"))
    rows = members.join(wanted, cell).withColumn("_k", order_key(seed, id_col))
    rows = rows.withColumn("_r", F.floor(F.conv(F.left("_k", F.lit(4)), 16, 10).cast("int") * ranges / 65536))
    before = F.coalesce(F.sum("_c").over(Window.partitionBy(*cell).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = rows.groupBy(*cell, "_r").agg(F.count("*").alias("_c")).withColumn("_b", before).drop("_c")
    near = rows.join(counts, [*cell, "_r"]).filter("_b < _q")
    rank = F.col("_b") + F.row_number().over(Window.partitionBy(*cell, "_r").orderBy("_k", id_col))
    return near.withColumn("rank", rank).filter("rank <= _q").drop("_q", "_k", "_r", "_b")


def first_share(df: DataFrame, id_col: str, rate: float, seed: int = 7) -> DataFrame:
    """max(1, rate x rows, halves to even) rows in seeded order; none of an empty table. Drawn as one cell, in many tasks."""
    n = df.count()
    k = max(1, round(n * rate)) if n else 0
    one = df.sparkSession.createDataFrame([(0, k)], "_all int, quota long")
    return draw(df.withColumn("_all", F.lit(0)), one, ["_all"], id_col, seed=seed).drop("_all", "rank")


def queue_quotas(queue: DataFrame, weakness: DataFrame, by: str, budget: int, floor: int) -> DataFrame:
    """(by, n, quota): the budget shared by weakness, with a floor, and what is left dealt by falling weakness.

    Everything is selected where the queue fits the budget. The floor may exceed
    the budget; nothing is left to deal then.
    """
    sizes = queue.groupBy(by).agg(F.count("*").alias("n")).join(weakness, by, "left").withColumn("score", F.greatest(F.coalesce("weakness", F.lit(0.0)), F.lit(1e-6)))
    w = Window.partitionBy()  # one row per subtask
    least = F.least(F.lit(floor), F.floor(F.lit(budget) / F.count("*").over(w)))
    t = sizes.withColumn("base", F.least("n", F.greatest(least, F.floor(budget * F.col("score") / F.sum("score").over(w))))).withColumn("all", F.sum("n").over(w))
    room = F.col("n") - F.col("base")
    order = w.orderBy(F.desc("score"), by)
    t = t.withColumn("left", F.greatest(F.lit(budget) - F.sum("base").over(w), F.lit(0))).withColumn("room", room).withColumn("ahead", F.coalesce(F.sum(room).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    extra = F.greatest(F.least(F.col("room"), F.col("left") - F.col("ahead")), F.lit(0))
    return t.select(by, "n", F.when(F.col("all") <= budget, F.col("n")).otherwise(F.col("base") + extra).cast("long").alias("quota"))


def priority(items: DataFrame, weakness: DataFrame, by: str, id_col: str, min_confidence: float = 0.70, budget: int = 0) -> DataFrame:
    """Items by: located and sure first, then falling weakness, then falling confidence, then id; *budget* 0 is no limit."""
    sure = F.when(F.coalesce(F.col("located") & (F.col("confidence") >= min_confidence), F.lit(False)), 0).otherwise(1)
    t = items.join(F.broadcast(weakness), by, "left")  # one row per subtask
    t = t.orderBy(sure, F.desc(F.coalesce("weakness", F.lit(0.0))), F.desc(F.coalesce("confidence", F.lit(0.0))), id_col)
    return t.limit(budget) if budget else t


def split_stages(records: DataFrame, weakness: DataFrame, by: str, id_col: str, verifiable: list[str], ratio: float = 0.30) -> DataFrame:
    """*records* with stage: at most *ratio* of all, the verifiable of the weakest subtasks first, go to reinforcement.

    Ranks are needed for whole subtasks but one, so sizes decide all but the subtask at the edge.
    """
    n = records.groupBy(by).agg(F.count("*").alias("n")).join(weakness, by, "left")
    w = Window.partitionBy()  # one row per subtask
    open_rows = n.filter(F.col(by).isin(verifiable)).withColumn("ahead", F.coalesce(F.sum("n").over(w.orderBy(F.desc(F.coalesce("weakness", F.lit(0.0))), by).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    cap = int(records.count() * ratio)
    quota = open_rows.select(by, F.greatest(F.least(F.col("n"), F.lit(cap) - F.col("ahead")), F.lit(0)).alias("quota"))
    chosen = draw(records, quota, [by], id_col).select(id_col, F.lit("reinforce").alias("stage"))
    return records.join(chosen, id_col, "left").withColumn("stage", F.coalesce("stage", F.lit("finetune")))
