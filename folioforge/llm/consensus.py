"""Problem 1: consensus of several annotators by a variational confusion model.

Model: every element has one true class; rater r answers class c with the
probability theta[r, true, c]. Class shares and every row theta[r, true, :]
have Dirichlet priors; mean-field updates alternate between element posteriors
and Dirichlet counts. Both halves are group-bys: the log-likelihood of an
element is a sum over its votes (a window over the element key, already sorted
in the cached table), the new counts are a sum over (rater, answer). Digammas
are column expressions, so no row-level data reaches the driver.

What the pipeline knew before people looked at an element enters as raters of
their own: the machine rater answers with the tier that the stored similarities
and contents imply, the stored rater with the stored tier. Their confusion is
learned like anyone's, so a poor machine rater gets little weight.

Defined results: answers that name no class are unusable; a redelivered
annotation_id counts once (its latest usable delivery); an element without a
usable human answer is absent; votes without an annotator share one rater;
ties in the posterior go to the class listed first; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.session import discard, materialize

#: Class names and the agreement thresholds of the machine tiering.
TIERS = ["easy", "medium", "hard", "invalid"]
TAU = {"text": 0.92, "table": 0.95, "formula": 0.95}
TAU_DEFAULT = 0.92

MACHINE, STORED, UNKNOWN = -1, -2, -3
#: Raters up to which the confusion table is broadcast (16 doubles per rater); beyond, it is joined by shuffle.
BROADCAST_RATERS = 20_000
CLASSES = range(len(TIERS))


def tier_code(c: Column) -> Column:
    """0-3 for a tier name whatever its spelling, else NULL."""
    bare = F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z]", ""), "^tier", "")
    return reduce(lambda acc, k: acc.when(bare == TIERS[k], F.lit(k)), CLASSES, F.when(F.lit(False), F.lit(0)))


def machine_code(content: Column, sims: Column, etype: Column) -> Column:
    """The tier that similarities imply; without any readable content, invalid."""
    tau = reduce(lambda acc, kv: acc.when(etype == kv[0], F.lit(kv[1])), TAU.items(), F.when(F.lit(False), F.lit(0.0))).otherwise(TAU_DEFAULT)
    mp, mq, pq = (F.try_element_at(sims, F.lit(k)) for k in ("M-P", "M-Q", "P-Q"))
    readable = F.coalesce(F.exists(F.map_values(content), lambda v: F.coalesce(v.rlike("(?U)\\S"), F.lit(False))), F.lit(False))
    agree = F.coalesce(mp >= tau, F.lit(False)) | F.coalesce(mq >= tau, F.lit(False))
    return F.when(~readable, F.lit(3)).when(agree, F.lit(0)).when(F.coalesce(pq >= tau, F.lit(False)), F.lit(1)).otherwise(F.lit(2))


def human_votes(annotation: DataFrame) -> DataFrame:
    """element_id, rater, label: one row per annotation_id with a usable answer."""
    usable = annotation.select(
        "annotation_id", "element_id", F.coalesce(F.col("annotator_id").cast("long"), F.lit(UNKNOWN)).alias("rater"), tier_code(F.col("tier")).alias("label"), "received_at"
    ).filter("label is not null and element_id is not null")
    packed = F.col("rater") * 4 + F.col("label")
    by = F.coalesce(F.unix_micros("received_at"), F.lit(0))
    once = usable.filter("annotation_id is not null").groupBy("annotation_id").agg(F.max_by("element_id", by).alias("element_id"), F.max_by(packed, by).alias("v"))
    loose = usable.filter("annotation_id is null").select("element_id", packed.alias("v"))
    return once.select("element_id", "v").unionByName(loose).select("element_id", F.floor(F.col("v") / 4).alias("rater"), F.pmod("v", F.lit(4)).cast("int").alias("label"))


def machine_votes(elements: DataFrame, among: DataFrame) -> DataFrame:
    """The machine and the stored rater's votes on the elements of *among*, latest row each."""
    packed = machine_code(F.col("content"), F.col("sims"), F.col("etype")) * 8 + F.coalesce(tier_code(F.col("tier")), F.lit(7))
    latest = (
        elements.filter("element_id is not null")
        .select("element_id", packed.alias("v"), F.coalesce(F.unix_micros("loaded_at"), F.lit(0)).alias("at"))
        .groupBy("element_id")
        .agg(F.max_by("v", "at").alias("v"))
        .join(among.select("element_id").distinct(), "element_id", "left_semi")
    )
    both = F.array(F.struct(F.lit(MACHINE).cast("long").alias("rater"), F.floor(F.col("v") / 8).cast("int").alias("label")), F.struct(F.lit(STORED).cast("long").alias("rater"), F.pmod("v", F.lit(8)).cast("int").alias("label")))
    return latest.select("element_id", F.inline(both)).filter("label < 4")


def digamma(x: Column) -> Column:
    """Recurrence up to x + 6, then the asymptotic series (error below 1e-9 for x > 0)."""
    y = x + 6
    r = 1 / (y * y)
    series = F.ln(y) - 0.5 / y - r * (F.lit(1 / 12) - r * (F.lit(1 / 120) - r / 252))
    return reduce(lambda acc, i: acc - 1 / (x + i), range(6), series)


def _log_theta(counts: DataFrame, diagonal: float, off: float) -> DataFrame:
    """(rater, label, l0..l3): expected log confusion from expected counts (rater, label, c0..c3)."""
    w = Window.partitionBy("rater")
    raters = counts.select("rater").distinct()
    grid = raters.select("rater", F.explode(F.array(*[F.lit(k) for k in CLASSES])).alias("label")).join(counts, ["rater", "label"], "left")
    for k in CLASSES:
        grid = grid.withColumn(f"a{k}", F.coalesce(F.col(f"c{k}"), F.lit(0.0)) + off + F.when(F.col("label") == k, F.lit(diagonal)).otherwise(0.0))
    return grid.select("rater", "label", *[F.col(f"a{k}") for k in CLASSES], *[(digamma(F.col(f"a{k}")) - digamma(F.sum(f"a{k}").over(w))).alias(f"l{k}") for k in CLASSES])


def fit(votes: DataFrame, rounds: int = 25, tolerance: float = 2e-3, diagonal: float = 2.0, off: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """(posterior per element, Dirichlet counts per rater and answer).

    *votes* is (element_id, rater, label). Equal votes are summed before the
    shuffle, so an element that holds any share of all votes leaves at most
    four rows per rater. Stops when no expected share moves by *tolerance*.
    """
    spark = votes.sparkSession
    held = votes.groupBy("element_id", "rater", "label").agg(F.count("*").cast("double").alias("n")).repartition("element_id").sortWithinPartitions("element_id").persist(StorageLevel.MEMORY_AND_DISK)
    w = Window.partitionBy("element_id")
    pairs = held.select("rater", "label").distinct()
    theta = materialize(pairs.select("rater", "label", *[F.when(F.col("label") == k, F.lit(0.0)).otherwise(F.lit(-2.0)).alias(f"l{k}") for k in CLASSES]), "consensus-theta")
    small = theta.select("rater").distinct().count() <= BROADCAST_RATERS
    prior = [0.0] * len(TIERS)
    digammas = None

    def posterior(theta: DataFrame, prior: list[float]) -> DataFrame:
        known = theta.select("rater", "label", *[f"l{k}" for k in CLASSES])
        joined = held.join(F.broadcast(known) if small else known, ["rater", "label"])
        scored = joined.select("element_id", "rater", "label", "n", *[(F.sum(F.col("n") * F.col(f"l{k}")).over(w) + F.lit(prior[k])).alias(f"s{k}") for k in CLASSES])
        top = F.greatest(*[F.col(f"s{k}") for k in CLASSES])
        weights = scored.select("element_id", "rater", "label", "n", *[F.exp(F.col(f"s{k}") - top).alias(f"e{k}") for k in CLASSES])
        total = reduce(lambda a, b: a + b, [F.col(f"e{k}") for k in CLASSES])
        return weights.select("element_id", "rater", "label", "n", *[(F.col(f"e{k}") / total).alias(f"q{k}") for k in CLASSES])

    last: list | None = None
    for _ in range(rounds):
        q = posterior(theta, prior)
        # Class mass: each vote carries its element's posterior over its share of the element's votes.
        share = q.withColumn("u", F.col("n") / F.sum("n").over(w))
        counts = share.groupBy("rater", "label").agg(*[F.sum(F.col("n") * F.col(f"q{k}")).alias(f"c{k}") for k in CLASSES], *[F.sum(F.col("u") * F.col(f"q{k}")).alias(f"m{k}") for k in CLASSES])
        counts = materialize(counts, "consensus-counts")
        new = materialize(_log_theta(counts.drop(*[f"m{k}" for k in CLASSES]), diagonal, off), "consensus-theta")
        mass = counts.agg(*[F.coalesce(F.sum(f"m{k}"), F.lit(0.0)).alias(f"m{k}") for k in CLASSES])
        digammas = mass.select(*[(digamma(F.col(f"m{k}") + 1) - digamma(reduce(lambda a, b: a + b, [F.col(f"m{j}") + 1 for j in CLASSES]))).alias(f"p{k}") for k in CLASSES])
        prior = list(digammas.first())
        total = [F.sum(f"a{k}").over(Window.partitionBy("rater")) for k in CLASSES]
        now = new.select("rater", "label", *[(F.col(f"a{k}") / total[k]).alias(f"t{k}") for k in CLASSES])
        if last is not None:
            change = now.alias("x").join(last[0].alias("y"), ["rater", "label"]).agg(F.max(F.greatest(*[F.abs(F.col(f"x.t{k}") - F.col(f"y.t{k}")) for k in CLASSES]))).first()[0]
        else:
            change = 1.0
        discard(counts)
        discard(last[1] if last else theta)
        last, theta = (now, new), new
        if change is None or change < tolerance:
            break
    final = posterior(theta, prior).groupBy("element_id").agg(*[F.first(f"q{k}").alias(f"q{k}") for k in CLASSES])
    return final, theta


def consensus(annotation: DataFrame, elements: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """(element_id, tier, posterior) and the raters' Dirichlet counts; without *elements* people are the only raters."""
    people = human_votes(annotation)
    votes = people if elements is None else people.unionByName(machine_votes(elements, people))
    posterior, theta = fit(votes)
    best = F.greatest(*[F.col(f"q{k}") for k in CLASSES])
    name = reduce(lambda acc, k: acc.when(F.col(f"q{k}") == F.col("best"), F.lit(TIERS[k])), CLASSES, F.when(F.lit(False), F.lit("")))
    return posterior.withColumn("best", best).select("element_id", name.alias("tier"), F.col("best").alias("posterior")), theta


def reliability(theta: DataFrame, z: float = 1.96) -> DataFrame:
    """Per rater: expected share of right answers, its 95 % interval, and votes' weight.

    Each row of a confusion is a Dirichlet; a right answer's share is averaged
    over the classes by the rater's own mix of (estimated) true classes.
    """
    w = Window.partitionBy("rater")
    long = theta.select("rater", "label", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"a{k}").alias("a")) for k in CLASSES])).alias("s")).select("rater", "label", "s.k", "s.a")
    rows = long.groupBy("rater", "k").agg(F.sum("a").alias("total"), F.sum(F.when(F.col("label") == F.col("k"), F.col("a"))).alias("hit"))
    rows = rows.withColumn("mix", F.col("total") / F.sum("total").over(w)).withColumn("p", F.col("hit") / F.col("total"))
    out = rows.groupBy("rater").agg(
        F.sum(F.col("mix") * F.col("p")).alias("reliability"),
        F.sqrt(F.sum(F.col("mix") * F.col("mix") * F.col("p") * (1 - F.col("p")) / (F.col("total") + 1))).alias("sd"),
        F.sum("total").alias("weight"),
    )
    return out.select("rater", "reliability", F.greatest(F.col("reliability") - z * F.col("sd"), F.lit(0.0)).alias("low"), F.least(F.col("reliability") + z * F.col("sd"), F.lit(1.0)).alias("high"), "weight")


def agreement(votes: DataFrame) -> DataFrame:
    """One row: Krippendorff's nominal alpha over elements with two or more answers.

    NULL alpha where fewer than two such answers or only one class occur.
    """
    per = votes.groupBy("element_id").agg(*[F.sum((F.col("label") == k).cast("long")).alias(f"n{k}") for k in CLASSES]).withColumn("m", reduce(lambda a, b: a + b, [F.col(f"n{k}") for k in CLASSES])).filter("m > 1")
    same = reduce(lambda a, b: a + b, [F.col(f"n{k}") * F.col(f"n{k}") for k in CLASSES])
    g = per.agg(F.count("*").alias("n_elements"), F.coalesce(F.sum("m"), F.lit(0)).alias("n_answers"), F.sum((F.col("m") * F.col("m") - same) / (F.col("m") - 1)).alias("seen"), *[F.sum(f"n{k}").alias(f"t{k}") for k in CLASSES])
    expected = F.col("n_answers") * F.col("n_answers") - reduce(lambda a, b: a + b, [F.col(f"t{k}") * F.col(f"t{k}") for k in CLASSES])
    return g.select("n_elements", "n_answers", F.round(F.when(expected > 0, 1 - (F.col("n_answers") - 1) * F.col("seen") / expected), 6).alias("alpha"))
