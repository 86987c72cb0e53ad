"""The confusion model on made votes, against brute force, and on odd rows."""

from datetime import datetime, timedelta

import numpy as np
from pyspark.sql import functions as F

from folioforge.llm import consensus

ANNOTATION = "annotation_id long, element_id long, annotator_id int, tier string, received_at timestamp, rater string, label string"
ELEMENT = "element_id long, etype string, content map<string,string>, sims map<string,double>, tier string, loaded_at timestamp, label string"
T0 = datetime(2025, 1, 1)


def votes(n=300, seed=3):
    rng = np.random.default_rng(seed)
    truth = rng.integers(0, 4, n)
    rows, k = [], 0
    for e in range(n):
        for a in rng.choice(6, 4, replace=False).tolist():
            good = 0.93 if a < 3 else 0.35
            c = int(truth[e]) if rng.random() < good else 1 if a == 5 else int(rng.integers(0, 4))
            k += 1
            rows.append((k, e, a, consensus.TIERS[c], T0, None, None))
    return truth, rows


def test_recovers_truth_and_raters(spark):
    truth, rows = votes()
    found, theta = consensus.consensus(spark.createDataFrame(rows, ANNOTATION), spark.createDataFrame([], ELEMENT))
    got = {r.element_id: r.tier for r in found.collect()}
    right = np.mean([got[e] == consensus.TIERS[t] for e, t in enumerate(truth)])
    majority = np.mean([max(consensus.TIERS, key=lambda t: sum(r[3] == t for r in rows if r[1] == e)) == consensus.TIERS[t] for e, t in enumerate(truth)])
    assert right > 0.9 and right > majority
    rel = {r.rater: r for r in consensus.reliability(theta).collect()}
    assert rel[0].reliability > 0.85 > 0.6 > rel[4].reliability
    assert all(r.low <= r.reliability <= r.high for r in rel.values())


def test_digamma(spark):
    x = spark.createDataFrame([(0.5,), (1.0,), (4.0,), (10.0,)], "x double").select(consensus.digamma(F.col("x"))).collect()
    for got, want in zip(x, (-1.9635100260214235, -0.5772156649015329, 1.2561176684318, 2.2517525890667)):
        assert abs(got[0] - want) < 1e-6


def test_odd_rows(spark):
    late = T0 + timedelta(days=3)
    rows = [
        (1, 10, 1, " Tier.EASY", T0, "x", "y"), (1, 10, 1, "hard", late, None, None),  # delivered twice: the later counts
        (2, 11, 2, "?", T0, None, None), (3, 11, 2, None, T0, None, None),  # unusable
        (4, None, 2, "easy", T0, None, None), (None, 12, None, "Medium", None, None, None), (None, 12, None, "Medium", None, None, None),
    ]
    a = spark.createDataFrame(rows, ANNOTATION)
    got = consensus.human_votes(a).collect()
    assert sorted((r.element_id, r.rater, r.label) for r in got) == [(10, 1, 2), (12, -3, 1), (12, -3, 1)]
    found, _ = consensus.consensus(a, spark.createDataFrame([(10, None, None, None, None, None, None), (None, "text", {}, {}, "easy", T0, None)], ELEMENT))
    assert {r.element_id for r in found.collect()} == {10, 12}
    empty = consensus.consensus(spark.createDataFrame([], ANNOTATION), spark.createDataFrame([], ELEMENT))[0]
    assert empty.columns == ["element_id", "tier", "posterior"] and empty.collect() == []
    assert consensus.agreement(consensus.human_votes(spark.createDataFrame([], ANNOTATION))).collect()[0].alpha is None


def test_machine_evidence(spark):
    rows = [(1, "text", {"a": "x"}, {"M-P": 0.95, "M-Q": None, "P-Q": None}), (2, "table", {"a": "x"}, {"M-P": 0.94, "M-Q": 0.1, "P-Q": 0.96}), (3, "text", {"a": " "}, {"M-P": 1.0, "M-Q": None, "P-Q": None}), (4, None, None, None), (5, "text", {"a": "x"}, {})]
    df = spark.createDataFrame(rows, "id long, etype string, content map<string,string>, sims map<string,double>")
    got = {r.id: r.c for r in df.select("id", consensus.machine_code(F.col("content"), F.col("sims"), F.col("etype")).alias("c")).collect()}
    assert got == {1: 0, 2: 1, 3: 3, 4: 3, 5: 2}


def test_alpha_against_pairs(spark):
    _, rows = votes(60)
    v = consensus.human_votes(spark.createDataFrame(rows, ANNOTATION))
    units = {}
    for r in v.collect():
        units.setdefault(r.element_id, []).append(r.label)
    values = [x for u in units.values() for x in u]
    n = len(values)
    seen = sum(sum(a != b for i, a in enumerate(u) for j, b in enumerate(u) if i != j) / (len(u) - 1) for u in units.values()) / n
    expected = sum(a != b for i, a in enumerate(values) for j, b in enumerate(values) if i != j) / (n * (n - 1))
    assert abs(consensus.agreement(v).collect()[0].alpha - (1 - seen / expected)) < 1e-6


def test_hot_element_and_partitions(spark):
    rows = [(i, 1 if i % 3 == 0 else i, i % 7, ["easy", "hard"][i % 2], T0, None, None) for i in range(900)]
    e = spark.createDataFrame([], ELEMENT)
    a, b = (consensus.consensus(spark.createDataFrame(rows, ANNOTATION).repartition(k), e)[0] for k in (1, 5))
    assert {(r.element_id, r.tier) for r in a.collect()} == {(r.element_id, r.tier) for r in b.collect()}
