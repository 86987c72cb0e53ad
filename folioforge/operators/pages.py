"""Page results from blocks, element features, workload modes, and reports of stages."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from folioforge.functions.constants import LABEL_SUBTASK
from folioforge.functions.vector import unit


def subtask_of(label: Column) -> Column:
    """The subtask that a canonical label belongs to; unknown labels are text."""
    return reduce(lambda acc, kv: acc.when(label == kv[0], kv[1]), LABEL_SUBTASK.items(), F.when(F.lit(False), "")).otherwise("text")


def page_result(blocks: Column) -> Column:
    """STRUCT<text, formulas, tables> of a page's blocks (STRUCT<label, content>) in reading order.

    Formulas and tables go to lists of their own, all other contents are lines of
    the text; unknown contents are left out. NULL blocks stay NULL: an unread page
    is not a blank one.
    """
    known = F.filter(blocks, lambda b: b["content"].isNotNull())
    of = lambda want: F.transform(F.filter(known, lambda b: want(b["label"])), lambda b: b["content"])
    prose = of(lambda x: ~x.isin("formula", "table"))
    return F.when(blocks.isNotNull(), F.struct(F.array_join(prose, "\n").alias("text"), of(lambda x: x == "formula").alias("formulas"), of(lambda x: x == "table").alias("tables")))


def crop_box(box: Column, width: Column, height: Column) -> Column:
    """Whole-pixel bounds of a crop, inside the page and at least one pixel in both directions."""
    x1, y1 = (F.greatest(F.lit(0), F.least(F.floor(box[i]).cast("int"), side - 1)) for i, side in ((0, width), (1, height)))
    x2, y2 = (F.greatest(low + 1, F.least(F.floor(box[i]).cast("int"), side)) for i, side, low in ((2, width, x1), (3, height, y1)))
    return F.when(F.size(box) == 4, F.array(x1, y1, x2, y2))


def element_feature(crop: Column, box: Column, width: Column, height: Column) -> Column:
    """The crop's vector and six numbers of its place (centre, size, area, shape) as one unit vector."""
    w, h = (box[2] - box[0]) / width, (box[3] - box[1]) / height
    place = [(box[0] + box[2]) / 2 / width, (box[1] + box[3]) / 2 / height, w, h, w * h, w / F.greatest(w + h, F.lit(1e-9))]
    return F.when(crop.isNotNull() & (F.size(box) == 4), unit(F.concat(F.transform(crop, lambda x: x.cast("double")), F.array(*[p.cast("double") for p in place]))))


def review_mode(agreement: Column, quick: float = 0.98) -> Column:
    """How people take up a task: retype without two drafts, quick_review where they agree, else adjudicate."""
    return F.when(agreement.isNull(), "retype").when(agreement >= quick, "quick_review").otherwise("adjudicate")


def workload(tasks: DataFrame, mode: str) -> DataFrame:
    """(mode, n, share) of all three modes, 0 where there are none."""
    dim = tasks.sparkSession.createDataFrame([("quick_review",), ("adjudicate",), ("retype",)], "mode string")
    per = tasks.groupBy(F.col(mode).alias("mode")).agg(F.count("*").alias("n"))
    n = F.coalesce("n", F.lit(0))
    total = F.greatest(F.sum(n).over(Window.partitionBy()), F.lit(1))  # three rows
    return dim.join(per, "mode", "left").select("mode", n.alias("n"), F.round(n / total, 6).alias("share"))


def response_text(reply: Column) -> Column:
    """Text of a chat or generate reply: message content, whole or in parts, or the candidates' parts."""
    parts = lambda path: F.array_join(F.transform(F.from_json(F.get_json_object(reply, path), "array<struct<text:string>>"), lambda p: p["text"]), "")
    content = F.get_json_object(reply, "$.choices[0].message.content")
    chat = F.when(content.startswith("[{"), parts("$.choices[0].message.content")).otherwise(content)
    return F.coalesce(chat, F.when(F.get_json_object(reply, "$.candidates[0].content.parts").isNotNull(), parts("$.candidates[0].content.parts")))


def centred_pca(vectors: DataFrame, id_col: str, vec_col: str, k: int) -> DataFrame:
    """(id, projected[k]): vectors less their mean on the k main directions. NULL vectors are left out."""
    rows = vectors.filter(F.col(vec_col).isNotNull()).select(id_col, array_to_vector(F.col(vec_col).cast("array<double>")).alias("f"))
    if rows.isEmpty():
        return rows.select(id_col, F.array().cast("array<double>").alias("projected"))
    model = PCA(k=k, inputCol="f", outputCol="p").fit(rows)
    at = model.transform(rows).select(id_col, vector_to_array("p").alias("p"))
    mean = at.agg(*[F.avg(F.col("p")[i]) for i in range(k)]).first()
    return at.select(id_col, F.array(*[F.col("p")[i] - mean[i] for i in range(k)]).alias("projected"))


def observed(df: DataFrame, stage: str) -> tuple[DataFrame, Observation]:
    """*df* and an observation of its rows, filled when it is written; no pass of its own."""
    seen = Observation(stage)
    return df.observe(seen, F.count(F.lit(1)).alias("n")), seen


def synthetic_corpus(spark, n: int, scenarios: int = 24, width: int = 16, zipf: float = 1.25, seed: int = 0) -> DataFrame:
    """(id, scenario, tier, features): blobs of Zipf sizes, rarer ones harder, the last two junk.

    Scenarios are drawn by the inverse distribution function, a comparison with
    fixed bounds, so rows are made where they are needed, without a shuffle.
    """
    mass = [1 / (r + 1) ** zipf for r in range(scenarios)]
    bounds, acc = [], 0.0
    for m in mass:
        acc += m / sum(mass)
        bounds.append(acc)
    u = F.rand(seed)
    t = spark.range(n).withColumn("u", u).withColumn("v", F.rand(seed + 1))
    scenario = F.size(F.filter(F.array(*[F.lit(b) for b in bounds[:-1]]), lambda b: F.col("u") > b))
    t = t.withColumn("scenario", scenario)
    rank = F.col("scenario") / scenarios
    tier = F.when(F.col("scenario") >= scenarios - 2, "invalid").when(F.col("v") < 0.7 - 0.5 * rank, "easy").when(F.col("v") < 0.85 - 0.3 * rank, "medium").otherwise("hard")
    centre = [F.sin((F.col("scenario") + 1) * (i + 1) * 12.9898) * 3 for i in range(width)]
    return t.select("id", "scenario", tier.alias("tier"), F.array(*[(c + F.randn(seed + 2 + i)).cast("float") for i, c in enumerate(centre)]).alias("features"))
