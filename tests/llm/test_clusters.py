"""Groups of made blobs, odd vectors, independence of partitions."""

from datetime import datetime

import numpy as np

from folioforge.llm import clusters

SCHEMA = "page_id long, features array<float>, indexed_at timestamp, id string, v string"
T0 = datetime(2025, 1, 1)


def blobs(seed=2):
    rng = np.random.default_rng(seed)
    rows, truth = [], {}
    for g, (n, spread) in enumerate([(300, 0.02), (150, 0.06), (80, 0.03), (40, 0.05)]):
        centre = rng.normal(size=16)
        centre /= np.linalg.norm(centre)
        for _ in range(n):
            v = (centre + rng.normal(size=16) * spread) * rng.choice([1.0, 40.0])
            truth[len(rows)] = g
            rows.append((len(rows), v.tolist(), T0, None, None))
    return rows, truth


def test_groups(spark):
    rows, truth = blobs()
    bad = [(5000, None, T0, None, None), (5001, [float("nan")] * 16, T0, None, None), (5002, [0.0] * 16, T0, None, None), (5003, [1.0, None], T0, None, None), (5004, [1.0] * 3, T0, None, None), (5005, [], T0, None, None), (None, [1.0] * 16, T0, None, None), (5006, [float("inf")] * 16, T0, None, None)]
    rows += bad + rows[:5]  # repeated rows count once
    got = {r.id: r for r in clusters.cluster(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}
    assert set(got) == set(truth)
    groups = {}
    for i, g in truth.items():
        groups.setdefault(g, []).append(got[i].grp)
    main = [max(set(x), key=x.count) for x in groups.values()]
    assert len(set(main)) == 4 and min(main) >= 0
    assert all(np.mean([y == m for y in x]) > 0.95 for m, x in zip(main, groups.values()))
    told = {r.grp: r for r in clusters.describe(clusters.cluster(spark.createDataFrame(rows, SCHEMA))).collect()}
    assert told[0].n_records >= told[1].n_records and len(told[0].typical) == 5


def test_strays_are_in_no_group(spark):
    rows, _ = blobs()
    rng = np.random.default_rng(9)
    rows += [(9000 + i, rng.normal(size=16).tolist(), T0, None, None) for i in range(15)]
    got = {r.id: r.grp for r in clusters.cluster(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert np.mean([got[9000 + i] == -1 for i in range(15)]) > 0.8


def test_empty_and_latest(spark):
    assert clusters.cluster(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(1, [1.0, 0.0], T0, None, None), (1, None, datetime(2025, 2, 1), None, None), (1, [0.0, 2.0], datetime(2025, 1, 9), None, None)]
    v = clusters.usable_vectors(spark.createDataFrame(rows, SCHEMA), "page_id", "features", "indexed_at").collect()
    assert [(r.id, np.frombuffer(r.v, np.float32).tolist()) for r in v] == [(1, [0.0, 1.0])]


def test_nearest_against_brute_force():
    rng = np.random.default_rng(0)
    x, c = rng.normal(size=(50, 6)), rng.normal(size=(9, 6))
    best, d = clusters.nearest(x, c)
    full = ((x[:, None] - c[None]) ** 2).sum(2)
    assert (best == full.argmin(1)).all() and np.allclose(d, full.min(1))


def test_words_are_counted_per_text():
    owner, token, times = clusters._word_counts(["a b A, b a", "", "b-b", "ÍİX x"])
    assert np.bincount(owner, minlength=4).tolist() == [2, 0, 1, 2] and sorted(times[owner == 0].tolist()) == [2, 3] and times[owner == 2].tolist() == [2]
    assert set(token[owner == 2]) <= set(token[owner == 0])


def test_texts_of_like_words_are_near(spark):
    words = [["alpha", "beta", "gamma", "delta"], ["один", "два", "три", "пять"]]
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(rng.choice(words[i % 2], 30))) for i in range(40)] + [(90, None), (91, ""), (92, "-- --"), (None, "alpha")]
    got = {r.doc_id: np.array(r.features) for r in clusters.text_vectors(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), "doc_id", "text").collect()}
    assert set(got) == set(range(40))
    cos = lambda a, b: got[a] @ got[b] / np.linalg.norm(got[a]) / np.linalg.norm(got[b])
    assert cos(0, 2) > 0.7 and cos(1, 3) > 0.7 and abs(cos(0, 1)) < 0.5


def test_many_groups_get_more_cells(spark):
    rng = np.random.default_rng(4)
    rows, truth = [], []
    for g in range(60):
        c = rng.normal(size=24)
        for _ in range(40):
            rows.append((len(rows), (c / np.linalg.norm(c) + rng.normal(size=24) * 0.01).tolist(), T0, None, None))
            truth.append(g)
    got = {r.id: r.grp for r in clusters.cluster(spark.createDataFrame(rows, SCHEMA), cells=16).collect()}
    assert len(set(got.values()) - {-1}) == 60
