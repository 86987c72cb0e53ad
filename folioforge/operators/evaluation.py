"""Measures of a clustering or a sample against known classes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def contingency(df: DataFrame, found: str, true: str) -> DataFrame:
    return df.groupBy(found, true).agg(F.count("*").alias("n"))


def purity_nmi(df: DataFrame, found: str, true: str) -> DataFrame:
    """One row: purity and normalised mutual information (arithmetic mean); 1 and 1 where both have one class."""
    c = contingency(df, found, true)
    whole = Window.partitionBy()  # the contingency table
    t = c.withColumn("nf", F.sum("n").over(Window.partitionBy(found))).withColumn("nt", F.sum("n").over(Window.partitionBy(true))).withColumn("total", F.sum("n").over(whole)).withColumn("top", F.max("n").over(Window.partitionBy(found)))
    n = F.col("total").cast("double")
    mi = F.sum(F.col("n") / n * F.ln(F.col("n") * n / (F.col("nf") * F.col("nt"))))
    hf, ht = -F.sum(F.col("n") / n * F.ln(F.col("nf") / n)), -F.sum(F.col("n") / n * F.ln(F.col("nt") / n))
    best = F.sum(F.col("top") * F.col("n") / F.col("nf")) / F.max(n)
    g = t.agg(best.alias("purity"), mi.alias("mi"), hf.alias("hf"), ht.alias("ht"))
    return g.select(F.round("purity", 6).alias("purity"), F.round(F.when(F.col("hf") + F.col("ht") <= 1e-12, 1.0).otherwise(2 * F.col("mi") / (F.col("hf") + F.col("ht"))), 6).alias("nmi"))


def confusion(df: DataFrame, found: str, true: str) -> DataFrame:
    """Per true class its most frequent cluster and that cluster's share of the class."""
    c = contingency(df, found, true)
    return c.groupBy(true).agg(F.sum("n").alias("n"), F.max("n").alias("top"), F.count("*").alias("n_clusters")).select(true, "n", "n_clusters", F.round(F.col("top") / F.col("n"), 6).alias("top_share"))


def diversity(sample: DataFrame, pool: DataFrame, cls: str) -> DataFrame:
    """One row: effective number of classes exp(H) of the sample, share of its largest class, and classes covered."""
    per = sample.groupBy(cls).agg(F.count("*").alias("n"))
    whole = Window.partitionBy()  # one row per class
    t = per.withColumn("p", F.col("n") / F.sum("n").over(whole))
    classes = pool.select(cls).distinct().count()
    g = t.agg(F.exp(-F.sum(F.col("p") * F.ln("p"))).alias("effective"), F.max("p").alias("head"), F.count("*").alias("seen"), F.sum("n").alias("n_sample"))
    return g.select("n_sample", F.round("effective", 6).alias("effective"), F.round("head", 6).alias("head_share"), F.round(F.col("seen") / F.lit(max(classes, 1)), 6).alias("coverage"))


def simplified_silhouette(df: DataFrame, centroids: list[tuple[int, list[float]]], vec: str, cid: str) -> DataFrame:
    """One row: mean of (b - a) / max(a, b), with a and b the distances to the own and the nearest other centroid.

    Distances to centroids stand for those to all rows of a cluster, so no pairs
    of rows are formed; the centroids are a bounded matrix, multiplied per batch.
    """
    ordered = sorted(centroids)
    sent = df.sparkSession.sparkContext.broadcast((np.array([k for k, _ in ordered]), np.array([v for _, v in ordered], np.float64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, c = sent.value
        for b in batches:
            if not len(b):
                continue
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(b), -1)
            d = np.sqrt(np.maximum(((x[:, None, :] - c[None, :, :]) ** 2).sum(2), 0.0))
            own = ids[None, :] == b.column(0).to_numpy()[:, None]
            yield pa.RecordBatch.from_arrays([pa.array(np.where(own, d, np.inf).min(1)), pa.array(np.where(own, np.inf, d).min(1))], names=["a", "b"])

    t = df.filter(F.col(vec).isNotNull()).select(F.col(cid).cast("int"), vec).mapInArrow(run, "a double, b double")
    return t.agg(F.round(F.avg((F.col("b") - F.col("a")) / F.greatest("a", "b", F.lit(1e-12))), 6).alias("silhouette"))


def probe_error(estimated: DataFrame, true: DataFrame, by: str, shares: list[str]) -> DataFrame:
    """One row: median over clusters of the largest difference between an estimated and a true share."""
    e, t = estimated.alias("e"), true.alias("t")
    worst = F.greatest(*[F.abs(F.col(f"e.{c}") - F.col(f"t.{c}")) for c in shares]) if len(shares) > 1 else F.abs(F.col(f"e.{shares[0]}") - F.col(f"t.{shares[0]}"))
    return e.join(t, by).agg(F.count("*").alias("n"), F.round(F.percentile(worst, 0.5), 6).alias("median_error"))  # one row per cluster


def sample_quality(sample: DataFrame, by: list[str], cls: str, tier: str, gain: str) -> DataFrame:
    """Per group: rows, effective number of classes exp(H), shares of the largest class, of the smaller half of the classes and of waste (invalid), and the rows' mean gain as signal."""
    rank = F.percent_rank().over(Window.partitionBy(*by).orderBy("n", cls))  # one row per class
    per = sample.groupBy(*by, cls).agg(F.count("*").alias("n"), F.sum((F.col(tier) == "invalid").cast("long")).alias("bad"), F.sum(gain).alias("gain"))
    t = per.withColumn("total", F.sum("n").over(Window.partitionBy(*by))).withColumn("p", F.col("n") / F.col("total")).withColumn("small", rank < 0.5)
    return t.groupBy(*by).agg(
        F.sum("n").alias("n_rows"), F.round(F.exp(-F.sum(F.col("p") * F.ln("p"))), 6).alias("effective"), F.round(F.max("p"), 6).alias("head_share"), F.round(F.sum(F.when(F.col("small"), F.col("p")).otherwise(0.0)), 6).alias("tail_share"),
        F.round(F.sum("bad") / F.sum("n"), 6).alias("waste"), F.round(F.sum("gain") / F.sum("n"), 6).alias("signal"),
    )


def evaluate_candidates(df: DataFrame, id_col: str, label: str, candidates: dict[str, str], k: int, seed: int = 0) -> DataFrame:
    """(candidate, purity, nmi, silhouette, best): a k-means at *k* clusters of each candidate's vectors against the labels.

    The best candidate has the largest NMI, ties the first name. The candidates
    are few; each is one k-means and one pass.
    """
    from .clustering import kmeans_flattened, nearest_centroid

    rows = []
    for name, vec in sorted(candidates.items()):
        centres = list(enumerate(kmeans_flattened(df, id_col, vec, k, 0, seed)))
        if not centres:
            continue
        at = nearest_centroid(df, centres, id_col, vec).join(df.select(id_col, label, vec), id_col)
        p = purity_nmi(at, "cid", label).first()
        rows.append((name, p["purity"], p["nmi"], simplified_silhouette(at, centres, vec, "cid").first()[0]))
    best = max(rows, key=lambda r: (r[2] or 0.0, [-ord(c) for c in r[0]]))[0] if rows else None
    return df.sparkSession.createDataFrame([(*r, r[0] == best) for r in rows], "candidate string, purity double, nmi double, silhouette double, best boolean")


def assignment_listing(assigned: DataFrame, cid: str, id_col: str, label: str, n: int = 20) -> DataFrame:
    """(cid, members): the first *n* members of each cluster by id, with their labels; the nearest of each salt are kept first."""
    salt = assigned.withColumn("_s", F.pmod(F.xxhash64(id_col), F.lit(64)))
    first = salt.withColumn("_r", F.row_number().over(Window.partitionBy(cid, "_s").orderBy(id_col))).filter(F.col("_r") <= n)
    top = first.withColumn("_r", F.row_number().over(Window.partitionBy(cid).orderBy(id_col))).filter(F.col("_r") <= n)
    return top.groupBy(cid).agg(F.array_sort(F.collect_list(F.struct(id_col, label))).alias("members"))
