"""Analysis of model-call logs and the content-keyed result cache."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def call_stats(log: DataFrame, by: str, failed: Column, latency: str) -> DataFrame:
    """Per model: calls, failures, failure share, mean latency of the successful."""
    return log.groupBy(by).agg(F.count("*").alias("n_calls"), F.sum(failed.cast("long")).alias("n_failed"), F.round(F.avg(failed.cast("double")), 6).alias("failed_share"), F.round(F.avg(F.when(~failed, F.col(latency))), 6).alias("mean_latency"))


def failure_streaks(log: DataFrame, by: str, order: list[str], failed: Column, least: int = 2) -> DataFrame:
    """(by, first_at, n): runs of at least *least* failures in a row, as a breaker would see them.

    A run is named by the successes before it. They are counted per hour first
    and then inside each hour, so that a key with any share of all calls is
    handled in as many tasks as it has hours. *order* starts with the time.
    """
    t = log.withColumn("_f", failed).withColumn("_hour", F.date_trunc("hour", order[0]))
    ok = (~F.col("_f")).cast("int")
    hours = t.groupBy(by, "_hour").agg(F.sum(ok).alias("_ok"))
    hours = hours.select(by, "_hour", F.coalesce(F.sum("_ok").over(Window.partitionBy(by).orderBy("_hour").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    w = Window.partitionBy(by, "_hour").orderBy(*order)
    t = t.join(hours, [by, "_hour"]).withColumn("_island", F.col("_before") + F.sum(ok).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return t.filter("_f").groupBy(by, "_island").agg(F.min(order[0]).alias("first_at"), F.count("*").alias("n")).filter(F.col("n") >= least).drop("_island")


def cache_key(*parts: Column) -> Column:
    """SHA-256 of the parts with a separator no part holds; NULL and '' differ."""
    return F.sha2(F.concat_ws("\x1f", *[F.coalesce(F.concat(F.lit("="), p.cast("string")), F.lit("~")) for p in parts]), 256)


def cache_misses(requests: DataFrame, cache: DataFrame, key: str = "key") -> DataFrame:
    """Requests whose key isn't cached, each key once, to be computed and appended."""
    return requests.join(cache.select(key), key, "left_anti").dropDuplicates([key])
