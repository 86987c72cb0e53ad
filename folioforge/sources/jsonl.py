"""JSON lines, staged exports and labelled directories."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Records by a declared schema: unknown keys are dropped, missing ones NULL, blank lines skipped, gzip by suffix."""
    return spark.read.schema(schema).json(path)


def write_jsonl(df: DataFrame, path: str, append: bool = False, compress: bool = True) -> int:
    """Writes records and returns their number, counted while writing. NULL fields are kept as null."""
    from pyspark.sql import Observation

    seen = Observation("written")
    out = df.observe(seen, F.count(F.lit(1)).alias("n"))
    out.write.mode("append" if append else "overwrite").option("ignoreNullFields", "false").option("compression", "gzip" if compress else "none").json(path)
    return int(seen.get["n"])


def export_stages(records: DataFrame, path: str, stage: str = "stage", subtask: str = "subtask") -> dict:
    """Writes records by stage as parquet and a manifest of the counts beside them; returns the manifest."""
    records.write.mode("overwrite").partitionBy(stage).parquet(f"{path}/records")
    rows = records.groupBy(stage, subtask).agg(F.count("*").alias("n")).orderBy(stage, subtask).collect()
    counts: dict = {}
    for r in rows:
        counts.setdefault(str(r[stage]), {})[str(r[subtask])] = r["n"]
    manifest = {"stages": {k: {"n": sum(v.values()), "subtasks": v} for k, v in counts.items()}, "n": sum(r["n"] for r in rows)}
    spark = records.sparkSession
    spark.createDataFrame([(json.dumps(manifest, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/manifest")
    return manifest


def labelled_files(spark: SparkSession, root: str, cap: int) -> DataFrame:
    """(path, label, length): files of the directories of *root*, the directory's name as label, at most *cap* a label."""
    from pyspark.sql import Window

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "length")
    t = files.withColumn("label", F.regexp_extract("path", "([^/]+)/[^/]+$", 1))
    return t.withColumn("_n", F.row_number().over(Window.partitionBy("label").orderBy("path"))).filter(F.col("_n") <= cap).drop("_n")


def page_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """(page_id, path, content) of image files, sorted by their path when collected; bytes stay with the row."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(root)
    return files.select(F.regexp_extract("path", "([^/]+)$", 1).alias("page_id"), "path", "content")


def first_of_base(files: DataFrame, path: str, suffix: str = "(_aug\\d*|_rot\\d*|-copy\\d*)?\\.[^.]+$") -> DataFrame:
    """One file of each base name: variants that differ in *suffix* only count once, the first by path."""
    base = F.regexp_replace(F.col(path), suffix, "")
    return files.join(files.groupBy(base.alias("_b")).agg(F.min(path).alias(path)).select(path), path, "left_semi")
