"""Boxes: coordinates, areas, overlap, and the matching of two layouts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def absolute_box(box: Column, width: Column, height: Column, space: str) -> Column:
    """A box in pixels of the page, corners in order and inside it; NULL where it is no box.

    *space* is abs, norm1, norm1000 or auto. auto guesses by the largest value
    and misreads small boxes, so name the space where it is known. Boxes under a
    pixel, of other than four members or with NULL or non-finite ones are none.
    """
    v = [F.try_element_at(box, F.lit(i + 1)).cast("double") for i in range(4)]
    most = F.greatest(*[F.abs(x) for x in v])
    unit = {"abs": F.lit(0.0), "norm1": F.lit(1.0), "norm1000": F.lit(1000.0)}.get(space)
    if unit is None:
        unit = F.when(most <= 1.5, 1.0).when(most <= 1000.5, 1000.0).otherwise(0.0)
    w, h = width.cast("double"), height.cast("double")
    x = [F.when(unit > 0, c / F.when(unit > 0, unit).otherwise(1.0) * side).otherwise(c) for c, side in zip(v, (w, h, w, h))]
    x1, x2 = F.greatest(F.least(x[0], x[2]), F.lit(0.0)), F.least(F.greatest(x[0], x[2]), w)
    y1, y2 = F.greatest(F.least(x[1], x[3]), F.lit(0.0)), F.least(F.greatest(x[1], x[3]), h)
    whole = (F.size(box) == 4) & F.forall(box, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.when(whole & (x2 - x1 >= 1) & (y2 - y1 >= 1), F.array(x1, y1, x2, y2))


def area(b: Column) -> Column:
    """Area of a box; NULL where it is unknown."""
    return F.when(b.isNotNull(), F.greatest(b[2] - b[0], F.lit(0.0)) * F.greatest(b[3] - b[1], F.lit(0.0)))


def intersection(a: Column, b: Column) -> Column:
    """Area that two boxes share; NULL where one is unknown."""
    shared = F.greatest(F.least(a[2], b[2]) - F.greatest(a[0], b[0]), F.lit(0.0)) * F.greatest(F.least(a[3], b[3]) - F.greatest(a[1], b[1]), F.lit(0.0))
    return F.when(a.isNotNull() & b.isNotNull(), shared)


def iou(a: Column, b: Column) -> Column:
    """Intersection over union, with areas taken as they are and a union of 1e-6 at least."""
    i = intersection(a, b)
    raw = lambda x: (x[2] - x[0]) * (x[3] - x[1])
    return i / F.greatest(raw(a) + raw(b) - i, F.lit(1e-6))


def layout_f1(a: Column, b: Column, threshold: float = 0.5) -> Column:
    """F1 of a greedy one-to-one matching of equally labelled boxes; arrays of STRUCT<label, box>.

    Pairs are taken by falling overlap (ties: later boxes first) in one fold
    that carries which boxes are used. Both empty -> 1, one empty -> 0.
    """
    pairs = F.flatten(F.transform(a, lambda x, i: F.transform(b, lambda y, j: F.struct(F.when(x["label"] == y["label"], iou(x["box"], y["box"])).otherwise(0.0).alias("v"), i.alias("i"), j.alias("j")))))
    good = F.reverse(F.array_sort(F.filter(pairs, lambda p: p["v"] >= threshold)))
    none = F.array().cast("array<int>")
    start = F.struct(none.alias("ua"), none.alias("ub"))

    def step(acc: Column, p: Column) -> Column:
        free = ~F.array_contains(acc["ua"], p["i"]) & ~F.array_contains(acc["ub"], p["j"])
        return F.when(free, F.struct(F.concat(acc["ua"], F.array(p["i"])).alias("ua"), F.concat(acc["ub"], F.array(p["j"])).alias("ub"))).otherwise(acc)

    matched = F.aggregate(good, start, step, lambda acc: F.size(acc["ua"]).cast("double"))
    na, nb = F.size(a), F.size(b)
    return F.when((na == 0) & (nb == 0), F.lit(1.0)).when((na == 0) | (nb == 0), F.lit(0.0)).otherwise(2 * matched / (na + nb))
