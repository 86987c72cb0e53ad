"""Checks of finished labels, of annotators against each other, and of scans."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.functions.constants import SCAN
from folioforge.functions.text import squash

from .ranking import exact_percentiles

#: Characters per thousand square pixels above which a label is too long for its box.
MAX_DENSITY = 12.0


def label_issues(content: Column, subtask: Column, box_area: Column, known_bad: Column) -> Column:
    """Codes of what is wrong with a label: blank, broken_table, same_as_rejected, too_long, unread.

    A blank label has no further issues. An unknown box or rejected draft is no issue.
    """
    s = squash(content)
    blank = F.length(s) == 0
    table = (subtask == "table") & ~content.rlike("(?is)<t[dh]\\b")
    same = (F.length(known_bad) > 0) & (squash(known_bad) == s)
    dense = (box_area > 0) & (F.length(s) / (box_area / 1000.0) > MAX_DENSITY)
    rest = F.array_compact(F.array(F.when(table, "broken_table"), F.when(same, "same_as_rejected"), F.when(dense, "too_long"), F.when(F.contains(content, F.lit("[?]")), "unread")))
    return F.when(blank, F.array(F.lit("blank"))).otherwise(rest)


def issue_counts(checked: DataFrame, issues: str = "issues") -> DataFrame:
    """(code, n) by falling count."""
    return checked.select(F.explode(issues).alias("code")).groupBy("code").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "code")


def clean_share(checked: DataFrame, by: list[str], issues: str = "issues") -> DataFrame:
    """(by, n, n_clean, clean_share): labels without an issue."""
    clean = (F.size(issues) == 0).cast("long")
    return checked.groupBy(*by).agg(F.count("*").alias("n"), F.sum(clean).alias("n_clean"), F.round(F.avg(clean.cast("double")), 6).alias("clean_share"))


def item_agreement(labels: DataFrame, item: str, label: str) -> DataFrame:
    """(item, n_pairs, agree): pairs of an item's labels and the share of equal ones, from the labels' counts: no pair is formed."""
    per = labels.filter(f"{item} is not null and {label} is not null").groupBy(item, label).agg(F.count("*").cast("double").alias("k"))
    g = per.groupBy(item).agg(F.sum("k").alias("m"), F.sum(F.col("k") * (F.col("k") - 1) / 2).alias("same"))
    pairs = F.col("m") * (F.col("m") - 1) / 2
    return g.filter("m > 1").select(item, pairs.cast("long").alias("n_pairs"), (F.col("same") / pairs).alias("agree"))


def worst_pairs(pairs: DataFrame, least: int = 1, n: int = 10) -> DataFrame:
    """The *n* pairs of annotators that agree least, of those with *least* common items; ties go to the lower numbers."""
    return pairs.filter(F.col("n") >= least).orderBy("agree", "annotator_a", "annotator_b").limit(n)


def annotator_pairs(labels: DataFrame, item: str, annotator: str, label: str) -> DataFrame:
    """(annotator_a, annotator_b, n, agree): items both labelled, each pair of annotators once.

    An item's labels are first counted per annotator and label; pairs are formed
    of annotators within an item, of which there are few, never of items.
    """
    per = labels.filter(f"{item} is not null and {annotator} is not null and {label} is not null").select(item, annotator, label).distinct()
    a, b = per.alias("a"), per.alias("b")
    joined = a.join(b, (F.col(f"a.{item}") == F.col(f"b.{item}")) & (F.col(f"a.{annotator}") < F.col(f"b.{annotator}")))
    return joined.groupBy(F.col(f"a.{annotator}").alias("annotator_a"), F.col(f"b.{annotator}").alias("annotator_b")).agg(F.count("*").alias("n"), F.round(F.avg((F.col(f"a.{label}") == F.col(f"b.{label}")).cast("double")), 6).alias("agree"))


def scan_reasons(blur: Column, ink: Column, contrast: Column, width: Column, height: Column, cfg: dict = SCAN) -> Column:
    """Why a scan should be dropped: small, blurred, blank or black, flat. Skew is no reason."""
    return F.array_compact(F.array(
        F.when(F.least(width, height) < cfg["side"], "small"), F.when(blur < cfg["blur"], "blurred"),
        F.when(ink < cfg["ink_min"], "blank").when(ink > cfg["ink_max"], "black"), F.when(contrast < cfg["contrast"], "flat"),
    ))


def scan_thresholds(scans: DataFrame, measures: list[str], readable: str, recall: float = 0.99) -> DataFrame:
    """One row: per measure the value that keeps *recall* of the readable scans (linear interpolation)."""
    good = scans.filter(readable)
    least = [exact_percentiles(good, m, [1 - recall])[0] for m in measures]
    return scans.sparkSession.range(1).select(*[F.round(F.lit(x).cast("double"), 6).alias(f"min_{m}") for m, x in zip(measures, least)])


#: Kernel of the Laplacian: what a pixel differs from its four neighbours by.
LAPLACIAN = np.array([[0, 1, 0], [1, -4, 1], [0, 1, 0]], np.float64)


def _ink_level(levels: np.ndarray, counts: np.ndarray) -> float:
    """The gray level that splits the pixels into two classes with the least variance inside them; up to it is ink.

    One level alone is no two classes: it is ink only if it is black.
    """
    if len(levels) < 2:
        return 0.0
    n, s, q = (np.cumsum(counts * levels**e) for e in (0, 1, 2))
    inside = (q - s * s / n)[:-1] + (q[-1] - q - (s[-1] - s) ** 2 / np.maximum(n[-1] - n, 1))[:-1]
    return float(levels[int(inside.argmin())])


def _tilt(ink: np.ndarray) -> float:
    """The whole degree, within SCAN["skew"], along which ink gathers in the fewest lines: the largest sum of squared line counts.

    Of equal degrees the one nearest to 0 (then the lower); 0 without ink.
    """
    y, x = np.nonzero(ink)
    if not len(y):
        return 0.0
    degrees = np.arange(-int(SCAN["skew"]), int(SCAN["skew"]) + 1)
    degrees = degrees[np.lexsort((degrees, abs(degrees)))]
    best, at = -1, 0
    for d in degrees.tolist():
        line = np.rint(y * np.cos(np.deg2rad(d)) - x * np.sin(np.deg2rad(d))).astype(np.int64)
        mass = int((np.bincount(line - line.min()) ** 2).sum())
        if mass > best:
            best, at = mass, d
    return float(at)


def _measure(gray: np.ndarray) -> tuple[float, float, float, float]:
    """(blur, ink, contrast, skew) of a gray image: variance of the Laplacian, share of ink, deviation, tilt of the lines."""
    if not gray.size:
        return 0.0, 0.0, 0.0, 0.0
    levels, inverse, counts = np.unique(gray, return_inverse=True, return_counts=True)
    ink = (levels <= _ink_level(levels.astype(np.float64), counts.astype(np.float64)))[inverse].reshape(gray.shape)
    blur = 0.0
    if min(gray.shape) >= 3:
        edges = np.einsum("ijkl,kl->ij", np.lib.stride_tricks.sliding_window_view(gray.astype(np.float64), (3, 3)), LAPLACIAN)
        blur = float(edges.var())
    return blur, float(ink.mean()), float(gray.std()), _tilt(ink & ~ink.all())


def _measure_all(it: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for pixels, width in it:
        rows = [_measure(np.asarray(p, np.float64).reshape(-1, int(w))) if p is not None and w else (None,) * 4 for p, w in zip(pixels, width)]
        yield pd.DataFrame(rows, columns=["blur", "ink", "contrast", "skew"])


def scan_measures(pixels: Column | str, width: Column | str) -> Column:
    """STRUCT<blur, ink, contrast, skew> of gray images given as (pixels row by row, width); NULLs for no image."""
    return F.pandas_udf(_measure_all, "struct<blur:double,ink:double,contrast:double,skew:double>")(pixels, width)


def error_fixed(content: Column, must: Column, must_not: Column) -> Column:
    """Is a known error mended: does the label hold *must* and not *must_not*? NULL *must_not* forbids nothing; no label mends nothing."""
    gone = F.coalesce(~F.contains(content, must_not), F.lit(True))
    return F.coalesce(F.contains(content, must), F.lit(False)) & gone
