"""Assembling training records from tiered elements, and counting them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.functions.constants import SUBTASKS

from .consistency import label_source


def assemble(elements: DataFrame, target: str, cheap: str) -> DataFrame:
    """*elements* with label_source, label and ready: easy takes the target's reading, medium the cheap parser's.

    Without that reading an element waits for people (ready false) with the best
    draft there is: the target's, else the cheap parser's; '' is no draft.
    """
    c = lambda k: F.try_element_at("content", F.lit(k))
    source = label_source(F.col("tier"), target, cheap)
    reading = F.when(source == target, c(target)).when(source == cheap, c(cheap))
    some = lambda x: F.when(F.length(x) > 0, x)
    ready = reading.isNotNull()
    return elements.withColumn("ready", ready).withColumn("label_source", F.when(ready, source)).withColumn("label", F.when(ready, reading).otherwise(F.coalesce(some(c(target)), some(c(cheap)))))


def counts(records: DataFrame) -> DataFrame:
    """(subtask, n_ready, n_waiting) for all subtasks, 0 where there are none."""
    dim = records.sparkSession.createDataFrame([(s,) for s in SUBTASKS], "subtask string")
    per = records.groupBy("subtask").agg(F.sum(F.col("ready").cast("long")).alias("n_ready"), F.sum((~F.col("ready")).cast("long")).alias("n_waiting"))
    return dim.join(per, "subtask", "left").na.fill(0, ["n_ready", "n_waiting"])


def manifest(records: DataFrame, stage: str, subtask: str) -> DataFrame:
    """(stage, subtask, n) with totals per stage and of all in rows named 'all'."""
    t = records.rollup(stage, subtask).agg(F.count("*").alias("n"), F.grouping(stage).alias("gs"), F.grouping(subtask).alias("gt"))
    return t.select(F.when(F.col("gs") == 1, "all").otherwise(F.col(stage)).alias("stage"), F.when(F.col("gt") == 1, "all").otherwise(F.col(subtask)).alias("subtask"), "n")
