"""Page elements: matching regions across parsers, wrapper removal, layout vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioforge.functions.box import area, intersection, iou


def best_match(anchors: DataFrame, blocks: DataFrame, keys: list[str], threshold: float = 0.5) -> DataFrame:
    """Every anchor with the content of the block of its page and label that overlaps it most.

    *anchors* is (*keys, anchor_id, box), *blocks* (*keys, pos, box, content).
    Several anchors may meet one block. Less overlap than *threshold* is no
    match (NULL); of equal overlaps the first block counts. The winner is kept
    by a partial maximum before the shuffle, so pages with many boxes stay cheap.
    """
    a, b = anchors.alias("a"), blocks.alias("b")
    on = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys]
    overlap = iou(F.col("a.box"), F.col("b.box"))
    pairs = a.join(b, on, "left").select(F.col("a.anchor_id").alias("anchor_id"), F.when(overlap >= threshold, overlap).alias("iou"), F.col("b.pos").alias("pos"), F.col("b.content").alias("content"))
    best = F.max(F.when(F.col("iou").isNotNull(), F.struct("iou", F.negate("pos").alias("back"), "content")))
    return pairs.groupBy("anchor_id").agg(best.alias("m")).select("anchor_id", F.col("m.iou").alias("iou"), F.col("m.content").alias("content"))


def readings_by_box(anchors: DataFrame, blocks: DataFrame, keys: list[str], models: list[str], threshold: float = 0.5) -> DataFrame:
    """(anchor_id, a column per model): what each model read where the anchor lies, by :func:`best_match` of all models in one join.

    *blocks* has a column model besides; models are matched apart.
    """
    each = anchors.select(*keys, F.col("anchor_id").alias("_id"), "box", F.explode(F.array(*[F.lit(m) for m in models])).alias("model"))
    each = each.select(*keys, "model", "box", F.struct(F.col("_id").alias("id"), "model").alias("anchor_id"))
    found = best_match(each, blocks, [*keys, "model"], threshold).select("anchor_id.id", "anchor_id.model", "content")
    of = lambda m: F.max(F.when(F.col("model") == m, F.col("content")))
    return found.groupBy(F.col("id").alias("anchor_id")).agg(*[of(m).alias(m) for m in models])


def drop_wrappers(boxes: DataFrame, page: str, box_id: str, parent: str, inside: float = 0.85, least: int = 2, share: float = 0.5) -> DataFrame:
    """*boxes* without the *parent* boxes that only frame others.

    A smaller box is a child if *inside* of it lies in the parent; a parent with
    *least* children that fill *share* of it is a frame. Judged on all boxes at
    once, so nested frames are judged apart.
    """
    p = boxes.filter(F.col("label") == parent).select(page, F.col(box_id).alias("pid"), F.col("box").alias("pbox"))
    c = boxes.select(page, F.col(box_id).alias("cid"), F.col("box").alias("cbox"))
    ca, pa = area(F.col("cbox")), area(F.col("pbox"))
    child = (F.col("pid") != F.col("cid")) & (ca > 0) & (ca < pa) & (intersection(F.col("pbox"), F.col("cbox")) >= inside * ca)
    frames = p.join(c, page).filter(child).groupBy("pid").agg(F.count("*").alias("n"), F.sum(ca).alias("filled"), F.max(pa).alias("whole")).filter((F.col("n") >= least) & (F.col("filled") >= share * F.col("whole")))
    return boxes.join(frames.select(F.col("pid").alias(box_id)), box_id, "left_anti")


def confident(boxes: DataFrame, confidence: str, least: float = 0.6) -> DataFrame:
    """*boxes* that the detector is sure enough of; an unknown confidence is not."""
    return boxes.filter(F.col(confidence) >= least)


def label_difference(a: DataFrame, b: DataFrame, label: str) -> DataFrame:
    """(label, side): labels that only one of two tables has; no row where both have the same."""
    x, y = a.select(label).distinct(), b.select(label).distinct()
    return x.exceptAll(y).withColumn("side", F.lit("left")).unionByName(y.exceptAll(x).withColumn("side", F.lit("right")))


def column_count(boxes: DataFrame, page: str, width: str, gap: float = 0.04, most: int = 6) -> DataFrame:
    """(page, n_cols): columns told by gaps between the boxes' centres wider than *gap* of the page."""
    centre = (F.col("box")[0] + F.col("box")[2]) / 2
    before = F.lag("x").over(Window.partitionBy(page).orderBy("x"))
    gaps = boxes.select(page, width, centre.alias("x")).withColumn("wide", (F.col("x") - before > gap * F.col(width)).cast("int"))
    return gaps.groupBy(page).agg(F.least(F.coalesce(F.sum("wide"), F.lit(0)) + 1, F.lit(most)).cast("int").alias("n_cols"))


def layout_vector(boxes: DataFrame, pages: DataFrame, page: str, text: list[str], image: str = "picture", table: str = "table") -> DataFrame:
    """(page, vector[24]) of every page: area shares, shape, columns one-hot, content shares, font places (0).

    *pages* is (page, width, height). A page without boxes has its blank flag set.
    """
    a = area(F.col("box"))
    is_text, is_image, is_table = F.col("label").isin(text), F.col("label") == image, F.col("label") == table
    n = lambda c: F.coalesce(F.sum(c.cast("int")), F.lit(0))
    s = lambda c: F.coalesce(F.sum(F.when(c, a)), F.lit(0.0))
    per = boxes.groupBy(page).agg(n(is_text).alias("nt"), n(is_image).alias("ni"), n(is_table).alias("nb"), s(is_text).alias("at"), s(is_image).alias("ai"), F.count("*").alias("n"))
    cols = column_count(boxes.filter(is_text).join(pages.select(page, "width"), page), page, "width")
    p = pages.join(per, page, "left").join(cols, page, "left").na.fill(0, ["nt", "ni", "nb", "at", "ai", "n"]).withColumn("n_cols", F.coalesce("n_cols", F.lit(1)))
    whole = F.greatest(F.col("width") * F.col("height"), F.lit(1e-6))
    text_share, image_share = F.col("at") / whole, F.col("ai") / whole
    white = F.greatest(1 - text_share - image_share, F.lit(0.0))
    n_text = F.greatest(F.col("nt"), F.lit(1))
    blocks = F.col("nt") + F.col("ni")
    vector = [
        text_share, image_share, white, F.when(F.col("height") > 0, F.col("width") / F.col("height")).otherwise(0.0), F.col("nt") / (whole / 1e6), F.lit(0.0),
        *[(F.col("n_cols") == k + 1).cast("double") for k in range(6)],
        F.when(blocks > 0, F.col("ni") / blocks).otherwise(0.0), F.col("nb") / n_text, F.when(F.col("nt") > 0, (F.col("nt") - F.col("nb")) / n_text).otherwise(0.0), (F.col("n") == 0).cast("double"), white, image_share,
        *[F.lit(0.0)] * 6,
    ]
    return p.select(page, F.array(*[v.cast("double") for v in vector]).alias("vector"))


def running_ordinal(blocks: DataFrame, page: str, pos: str, label: str) -> DataFrame:
    """*blocks* with nth: the block's number among those of its label on the page, in reading order from 0."""
    return blocks.withColumn("nth", F.row_number().over(Window.partitionBy(page, label).orderBy(pos)) - 1)
