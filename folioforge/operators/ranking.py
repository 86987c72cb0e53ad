"""Exact percentiles of columns of any length, without gathering them in one task."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Values that one task sorts; longer stretches are narrowed first.
HELD_VALUES = 1_000_000
#: Accuracy of the approximate cuts (ranks are off by a ten-thousandth of the rows at most) and ranges of a grouped ranking.
ACCURACY, RANGES = 10_000, 1_000


def value_at(df: DataFrame, rank: int, n: int) -> float:
    """The value of *rank* (from 0) among the *n* rows of (x): an interval around it is narrowed until one task can sort it."""
    below, reach = 0, 2 / ACCURACY
    while n > HELD_VALUES:
        share = (rank - below) / n
        low, high = df.agg(F.percentile_approx("x", [max(share - reach, 0.0), min(share + reach, 1.0)], ACCURACY)).first()[0]
        under, inside = df.agg(F.count(F.when(F.col("x") < low, 1)), F.count(F.when(F.col("x").between(low, high), 1))).first()
        if not below + under <= rank < below + under + inside:
            reach *= 4
            continue
        if low == high:
            return low
        if inside == n:  # no narrower: the interval's inner part lies between its ends
            ends = df.agg(F.count(F.when(F.col("x") == low, 1)), F.count(F.when(F.col("x") == high, 1))).first()
            if rank < below + ends[0]:
                return low
            if rank >= below + n - ends[1]:
                return high
            df, below, n = df.filter((F.col("x") > low) & (F.col("x") < high)), below + ends[0], n - ends[0] - ends[1]
            continue
        df, below, n = df.filter(F.col("x").between(low, high)), below + under, inside
    upto = F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.groupBy("x").agg(F.count("*").alias("n")).select("x", upto.alias("upto")).filter(F.col("upto") > rank - below).agg(F.min("x")).first()[0]


def exact_percentiles(df: DataFrame, value: Column | str, shares: list[float]) -> list[float | None]:
    """Percentiles with linear interpolation; NULL values are left out, None for each share where nothing is left."""
    rows = df.select((F.col(value) if isinstance(value, str) else value).cast("double").alias("x")).filter("x is not null")
    n = rows.count()
    out: list[float | None] = []
    for share in shares:
        if not n:
            out.append(None)
            continue
        at = share * (n - 1)
        low, high = value_at(rows, int(at), n), None
        if at > int(at):
            high = value_at(rows, int(at) + 1, n)
        out.append(low if high is None or high == low else (int(at) + 1 - at) * low + (at - int(at)) * high)
    return out


def group_medians(df: DataFrame, by: str, value: str, out: str) -> DataFrame:
    """(by, out): each group's median, NULL values left out.

    Rows are counted per group and range between approximate cuts of all values;
    only the range in which a group's middle lies is ranked, so that a group with
    any share of all rows is spread over tasks.
    """
    rows = df.filter(F.col(value).isNotNull()).select(by, F.col(value).cast("double").alias("x"))
    cuts = sorted(set(rows.agg(F.percentile_approx("x", [i / RANGES for i in range(1, RANGES)], ACCURACY)).first()[0] or []))
    splits = [-float("inf"), *cuts, float("inf")]
    rows = Bucketizer(splits=splits, inputCol="x", outputCol="_r").transform(rows) if cuts else rows.withColumn("_r", F.lit(0.0))
    counts = rows.groupBy(by, "_r").agg(F.count("*").alias("_n"))
    w = Window.partitionBy(by)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(w.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("_all", F.sum("_n").over(w))
    low, high = F.floor((F.col("_all") - 1) / 2), F.floor(F.col("_all") / 2)
    wanted = counts.filter((F.col("_before") <= high) & (F.col("_before") + F.col("_n") > low)).select(by, "_r", "_before", low.alias("_low"), high.alias("_high"))
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in (by, "_r")]
    near = rows.alias("a").join(wanted.alias("b"), same).select(f"a.{by}", "a._r", "x", "_before", "_low", "_high")
    rank = F.col("_before") + F.row_number().over(Window.partitionBy(by, "_r").orderBy("x")) - 1
    return near.withColumn("_k", rank).filter((F.col("_k") == F.col("_low")) | (F.col("_k") == F.col("_high"))).groupBy(by).agg(F.avg("x").alias(out))
