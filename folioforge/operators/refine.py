"""The judge-and-refine loop over hard samples, with verdicts from a table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.functions.text import edit_similarity, squash


def render_error(content: Column, subtask: Column) -> Column:
    """Why a formula or table cannot be drawn, told from its structure; NULL where it can be, or is neither.

    Formulas: unequal braces, environments or fences; tables: no row with a cell.
    """
    times = lambda pattern: F.regexp_count(content, F.lit(pattern))
    bare = F.regexp_replace(content, r"\\\\[{}]", "")
    braces = F.regexp_count(bare, F.lit("\\{")) != F.regexp_count(bare, F.lit("\\}"))
    formula = F.when(braces, "braces").when(times(r"\\begin\{") != times(r"\\end\{"), "environments").when(times(r"\\left[^a-zA-Z]") != times(r"\\right[^a-zA-Z]"), "fences")
    table = F.when(~content.rlike("(?is)<tr\\b.*<t[dh]\\b") & ~content.rlike("(?m)^\\s*\\|.*\\|\\s*$"), "no_cells")
    return F.when(subtask == "formula", formula).when(subtask == "table", table)


def unparsed_as_error(verdict: Column) -> Column:
    """The verdict, or where a reply held none, an error of confidence 0 without a correction."""
    return F.coalesce(verdict, F.struct(F.lit(True).alias("has_error"), F.lit(0.0).alias("confidence"), F.lit(None).cast("string").alias("corrected"), F.lit("unreadable reply").alias("note")))


def refine(items: DataFrame, verdicts: DataFrame, key: str, judgeable: list[str], rounds: int = 3, converge: float = 0.995, render=None) -> DataFrame:
    """(key, outcome, content, rounds, confidence): how each item leaves the loop.

    *items* is (key, subtask, draft), *verdicts* (key, round, has_error,
    confidence, corrected). Exits in this order: no_draft, no_judge_path,
    render_failed (with *render*, which maps content and subtask to an error or
    NULL; it counts the rounds before), no_verdict (the judge gave none in that
    round), refined, no_fix (keeps the content), stuck (the correction changes
    nothing), oscillating (it was seen before), max_rounds; the last three hand
    over the correction. The verdicts are pivoted to one row per item, so the
    rounds unroll into one expression and the loop needs a single shuffle.
    """
    v = verdicts.filter(F.col("round").between(1, rounds)).groupBy(key).pivot("round", list(range(1, rounds + 1))).agg(F.first(F.struct("has_error", "confidence", "corrected")))
    t = items.join(v, key, "left")
    blank = F.length(F.coalesce("draft", F.lit(""))) == 0
    start = F.when(blank, "no_draft").when(~F.col("subtask").isin(judgeable), "no_judge_path")
    t = t.select(key, "subtask", *[F.col(str(r)).alias(f"v{r}") for r in range(1, rounds + 1)], start.alias("outcome"), F.col("draft").alias("content"), F.array("draft").alias("seen"), F.lit(0).alias("n"), F.lit(None).cast("double").alias("confidence"))

    def step(t: DataFrame, r: int) -> DataFrame:
        x = F.col(f"v{r}")
        fixed = F.when(x["corrected"].rlike("(?U)\\S"), x["corrected"])
        live = F.col("outcome").isNull()
        failed = render(F.col("content"), F.col("subtask")).isNotNull() if render else F.lit(False)
        stuck = edit_similarity(squash(F.col("content")), squash(fixed)) >= converge
        out: Column = reduce(
            lambda acc, kv: acc.when(kv[0], kv[1]),
            [(failed, "render_failed"), (x.isNull() | x["has_error"].isNull(), "no_verdict"), (~x["has_error"], "refined"), (fixed.isNull(), "no_fix"), (stuck, "stuck"), (F.array_contains("seen", fixed), "oscillating")],
            F.when(F.lit(False), ""),
        )
        judged = live & ~failed & x.isNotNull() & x["has_error"].isNotNull()
        took = judged & x["has_error"] & fixed.isNotNull()
        return t.select(
            key, "subtask", *[c for c in t.columns if c.startswith("v")], F.when(live, out).otherwise(F.col("outcome")).alias("outcome"), F.when(took, fixed).otherwise(F.col("content")).alias("content"),
            F.when(took, F.array_append("seen", fixed)).otherwise(F.col("seen")).alias("seen"), F.when(judged, F.lit(r)).otherwise(F.col("n")).alias("n"), F.when(judged, F.coalesce(x["confidence"], F.lit(0.0))).otherwise(F.col("confidence")).alias("confidence"),
        )

    for r in range(1, rounds + 1):
        t = step(t, r)
    return t.select(key, "subtask", F.coalesce("outcome", F.lit("max_rounds")).alias("outcome"), "content", F.col("n").alias("rounds"), "confidence")


def to_sft(outcomes: DataFrame, key: str, judge: str) -> DataFrame:
    """(key, subtask, tier, label_source, content) of the refined items: still hard, labelled by the judge's loop."""
    return outcomes.filter("outcome = 'refined'").select(key, "subtask", F.lit("hard").alias("tier"), F.lit(f"judge-refine:{judge}").alias("label_source"), "content")


def to_experts(outcomes: DataFrame, key: str) -> DataFrame:
    """(key, subtask, reason, draft, confidence) of the items that people must finish."""
    return outcomes.filter("outcome <> 'refined'").select(key, "subtask", F.col("outcome").alias("reason"), F.col("content").alias("draft"), "confidence")


def reasons(outcomes: DataFrame) -> DataFrame:
    """(subtask, outcome, n): how often items leave the loop in which way."""
    return outcomes.groupBy("subtask", "outcome").agg(F.count("*").alias("n"))


def summary(outcomes: DataFrame) -> DataFrame:
    """Per subtask: items, share refined, mean rounds of judged items."""
    judged = F.when(F.col("rounds") > 0, F.col("rounds"))
    return outcomes.groupBy("subtask").agg(F.count("*").alias("n"), F.round(F.avg((F.col("outcome") == "refined").cast("double")), 6).alias("resolve_rate"), F.round(F.avg(judged), 6).alias("mean_rounds"))
