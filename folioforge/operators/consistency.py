"""Consistency tiers: how several parsers agree on a sample, and what follows from it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.functions.constants import TAU
from folioforge.functions.sequence import formula_similarity, table_rows, table_similarity, text_similarity
from folioforge.functions.text import edit_similarity, norm_text


def tau_of(subtask: Column, taus: dict[str, float] | None = None) -> Column:
    """A subtask's threshold; unknown subtasks count as text."""
    t = taus or TAU
    return reduce(lambda acc, kv: acc.when(subtask == kv[0], F.lit(kv[1])), t.items(), F.when(F.lit(False), F.lit(0.0))).otherwise(F.lit(t["text"]))


def assign_tier(s_mp: Column, s_mq: Column, s_pq: Column, tau: Column | float, three_way: bool = False) -> Column:
    """easy, medium or hard from the pairwise similarities of target, cheap and expensive parser.

    Without the expensive parser (NULL s_mq) agreement of the other two is easy,
    anything else hard; with *three_way* it cannot be confirmed and is hard. With
    it, agreement with the target is easy (with both, if *three_way*), agreement
    of the others medium. An unknown similarity is no agreement.
    """
    t = tau if isinstance(tau, Column) else F.lit(tau)
    mp, mq, pq = (F.coalesce(s >= t, F.lit(False)) for s in (s_mp, s_mq, s_pq))
    easy = (mp & mq) if three_way else (mp | mq)
    two = F.lit("hard") if three_way else F.when(mp, "easy").otherwise("hard")
    return F.when(s_mq.isNull(), two).when(easy, "easy").when(pq, "medium").otherwise("hard")


def needs_expensive(s_mp: Column, tau: Column | float, three_way: bool = False) -> Column:
    """Is the expensive parser needed? Not where target and cheap parser agree already."""
    t = tau if isinstance(tau, Column) else F.lit(tau)
    return F.lit(True) if three_way else ~F.coalesce(s_mp >= t, F.lit(False))


def label_source(tier: Column, target: str, cheap: str) -> Column:
    """The parser whose reading becomes the label: easy -> target, medium -> cheap, else none."""
    return F.when(tier == "easy", target).when(tier == "medium", cheap)


def cascade(pages: DataFrame, expensive, key: str, s_mp: str, tau: Column | float, three_way: bool = False) -> DataFrame:
    """*pages* with the expensive parser's columns only where it was needed, and used_expensive.

    *expensive* maps the rows that need it to (key, ...). Its result is joined
    back, so that a model call behind it runs once per row that needs it.
    """
    need = needs_expensive(F.col(s_mp), tau, three_way)
    called = expensive(pages.filter(need))
    return pages.join(called, key, "left").withColumn("used_expensive", need)


def no_evidence(a: Column, b: Column) -> Column:
    """Two readings that tell nothing: one unknown, or both blank."""
    blank = lambda c: ~c.rlike("(?U)\\S")
    return a.isNull() | b.isNull() | (blank(a) & blank(b))


def pair_similarities(readings: DataFrame, subtask: str, target: str, cheap: str, expensive: str, compatibility: bool = True) -> DataFrame:
    """*readings* with s_mp, s_mq and s_pq of its three columns of readings.

    The similarity follows the subtask: formulas by tokens, tables by structure
    and cells, all else by text. It is NULL where a reading is unknown. Without
    *compatibility* composition texts are compared as written but for white space.
    """
    sides = (target, cheap, expensive)
    # Parsed tables and normal texts are columns of their own, so each reading is prepared once for its two pairs.
    t = readings.withColumns({f"_rows_{c}": table_rows(F.when(F.col(subtask) == "table", F.col(c))) for c in sides})
    if compatibility:
        t = t.withColumns({f"_text_{c}": norm_text(F.col(c)) for c in sides})

    def similarity(a: str, b: str) -> Column:
        prose = edit_similarity(F.col(f"_text_{a}"), F.col(f"_text_{b}")) if compatibility else text_similarity(F.col(a), F.col(b))
        sim = F.when(F.col(subtask) == "formula", formula_similarity(F.col(a), F.col(b))).when(F.col(subtask) == "table", table_similarity(F.col(f"_rows_{a}"), F.col(f"_rows_{b}"))).otherwise(prose)
        return F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), sim)

    pairs = {"s_mp": (target, cheap), "s_mq": (target, expensive), "s_pq": (cheap, expensive)}
    return t.withColumns({n: similarity(*ab) for n, ab in pairs.items()}).drop(*[f"_rows_{c}" for c in sides], *[f"_text_{c}" for c in sides])


def element_tiers(readings: DataFrame, subtask: str, target: str, cheap: str, expensive: str, three_way: bool = False, compatibility: bool = True) -> DataFrame:
    """*readings* with similarities and tier; readings that tell nothing have no similarities and are hard."""
    t = pair_similarities(readings, subtask, target, cheap, expensive, compatibility)
    nothing = no_evidence(F.col(target), F.col(cheap))
    t = t.withColumns({c: F.when(~nothing, F.col(c)) for c in ("s_mp", "s_mq", "s_pq")})
    return t.withColumn("derived", F.when(nothing, "hard").otherwise(assign_tier(F.col("s_mp"), F.col("s_mq"), F.col("s_pq"), tau_of(F.col(subtask)), three_way)))


def gated(items: DataFrame, valid: Column, tiering) -> DataFrame:
    """*tiering* of the valid items only; the others are invalid without a model's call, with NULLs in the columns that tiering adds."""
    ok = F.coalesce(valid, F.lit(False))
    tiered = tiering(items.filter(ok))
    return tiered.unionByName(items.filter(~ok).withColumn("derived", F.lit("invalid")), allowMissingColumns=True)


def calibrate_tau(sims: DataFrame, sim: str, correct: str, by: list[str], target: float = 0.98, support: int = 30, steps: int = 200) -> DataFrame:
    """Per group the least of *steps* thresholds in [0.5, 0.999] from which *target* of the pairs are right.

    (tau, precision, coverage); 1, 1, 0 where no threshold has *support* pairs.
    Every pair is reduced to the number of grid points it passes, so what is
    shuffled is one row per group and grid point, whatever the number of pairs.
    """
    step = 0.499 / (steps - 1)
    passed = F.least(F.greatest(F.floor((F.col(sim) - 0.5) / step + 1e-9) + 1, F.lit(0)), F.lit(steps)).cast("int")
    per = sims.filter(F.col(sim).isNotNull() & F.col(correct).isNotNull()).groupBy(*by, passed.alias("passed")).agg(F.count("*").alias("n"), F.sum(F.col(correct).cast("long")).alias("right"))
    grid = per.select(*by, "n", "right", F.col("passed"), F.explode(F.sequence(F.lit(0), F.lit(steps - 1))).alias("i"))
    at = grid.groupBy(*by, "i").agg(F.sum(F.when(F.col("passed") > F.col("i"), F.col("n")).otherwise(0)).alias("n_at"), F.sum(F.when(F.col("passed") > F.col("i"), F.col("right")).otherwise(0)).alias("right_at"), F.sum("n").alias("total"))
    good = (F.col("n_at") >= support) & (F.col("right_at") / F.col("n_at") >= target)
    best = F.min(F.when(good, F.struct("i", "n_at", "right_at", "total")))
    return at.groupBy(*by).agg(best.alias("b")).select(
        *by, F.coalesce(F.round(0.5 + F.col("b.i") * step, 6), F.lit(1.0)).alias("tau"), F.coalesce(F.round(F.col("b.right_at") / F.col("b.n_at"), 6), F.lit(1.0)).alias("precision"), F.coalesce(F.round(F.col("b.n_at") / F.col("b.total"), 6), F.lit(0.0)).alias("coverage")
    )


def weakness(sims: DataFrame, by: str, s_mp: Column, s_mq: Column) -> DataFrame:
    """(by, weakness): 1 - mean over rows of the mean known agreement of the target with the others."""
    known = F.filter(F.array(s_mp, s_mq), lambda x: x.isNotNull())
    mean = F.when(F.size(known) > 0, F.aggregate(known, F.lit(0.0), lambda a, x: a + x) / F.size(known))
    return sims.select(by, mean.alias("m")).groupBy(by).agg((1 - F.avg("m")).alias("weakness")).filter("weakness is not null")


def tier_or_invalid(tier: Column, error: Column) -> Column:
    """A sample whose parser failed has no tier of its own: it is invalid, whatever its similarities say."""
    return F.when(error.isNotNull(), "invalid").otherwise(tier)
