"""Water filling against brute force, draws, and odd rows."""

import random
from datetime import datetime

from pyspark.sql import functions as F

from folioforge.llm import quota

INDEX = "run_id int, page_id long, tier string, assign int, indexed_at timestamp, n long, q long, h long"
RUN = "run_id int, budget long, min_per_tier int, target_mix map<string,double>, created_at timestamp, left string"
CELL = "cid int, path string, n long"
T0 = datetime(2025, 1, 1)


def brute(rows, q):
    """Shares by repeated filling of equal levels."""
    share = {k: 0.0 for k, *_ in rows}
    left, open_rows = float(q), [r for r in rows if r[1] > 0 and r[2] > 0]
    while left > 1e-12 and open_rows:
        step = min(left / sum(w for _, w, _ in open_rows), min((c - share[k]) / w for k, w, c in open_rows))
        for k, w, _ in open_rows:
            share[k] += step * w
        left -= step * sum(w for _, w, _ in open_rows)
        open_rows = [r for r in open_rows if share[r[0]] < r[2] - 1e-9]
    return share


def test_fill_against_brute_force(spark):
    rnd = random.Random(5)
    rows, want = [], {}
    for p in range(40):
        q = rnd.randint(0, 60)
        cells = [(k, rnd.choice([0.0, 0.3, 1.0, 2.5, 7.0]), rnd.randint(0, 14)) for k in range(rnd.randint(1, 8))]
        want[p] = (brute(cells, q), min(q, sum(c for _, w, c in cells if w > 0)))
        rows += [(p, k, q, w, c) for k, w, c in cells]
    rows += [(100, 0, 9, 0.0, 5), (100, 1, 9, 0.0, 0), (101, 0, 0, 1.0, 5)]
    want |= {100: ({0: 0.0, 1: 0.0}, 0), 101: ({0: 0.0}, 0)}
    df = spark.createDataFrame(rows, "p int, k int, q long, w double, c long").repartition(4)
    got = {}
    for r in quota.fill(df, ["p"], "q", "w", "c", ["k"], "x").collect():
        assert 0 <= r.x <= r.c
        got.setdefault(r.p, {})[r.k] = r.x
    for p, (share, total) in want.items():
        assert sum(got[p].values()) == total
        assert all(abs(got[p][k] - share[k]) < 1 + 1e-9 for k in share)


def test_plan_and_draw(spark):
    tiers = ["easy"] * 50 + ["Tier.MEDIUM"] * 30 + [" hard"] * 4 + [None, "?"]
    rows = [(1, i, t, i % 5, T0, None, None, None) for i, t in enumerate(tiers)] + [(1, 3, "easy", 1, T0, 1, 2, 3)] * 3 + [(None, 7, "easy", 1, T0, None, None, None), (1, None, "easy", 1, T0, None, None, None)]
    runs = [(1, 40, 6, {"Easy": 0.25, "medium": 0.5, "hard": 0.25}, T0, "x"), (2, 10, 12, {"easy": 0.5, "hard": 0.5}, T0, None), (3, None, None, None, None, None), (None, 5, 1, {"easy": 1.0}, T0, None)]
    index = spark.createDataFrame(rows, INDEX)
    pages, levels, cells = quota.plan(index, spark.createDataFrame(runs, RUN), spark.createDataFrame([(0, "0/0", 1), (1, "0/1", 1), (2, "1/0", 1)], CELL))
    got = {(r.run_id, r.tier): r for r in levels.collect()}
    assert {k for k, r in got.items() if r.available < r.want} == {(1, "hard"), (2, "easy"), (2, "hard")}
    assert sum(got[1, t].taken for t in ("easy", "medium", "hard")) == 40 and got[1, "hard"].taken == 4
    drawn = quota.draw(pages, cells).collect()
    assert len(drawn) == 40 == len({(r.run_id, r.page_id) for r in drawn})
    again = quota.draw(pages.repartition(7), cells).collect()
    assert {(r.page_id, r.draw_rank) for r in drawn} == {(r.page_id, r.draw_rank) for r in again}
    report = {(r.run_id, r.tier): r for r in quota.report(levels, spark.createDataFrame([(1, 2, " Hard", 9, 5), (1, 2, "hard", 9, 5)], "run_id int, cid int, tier string, available long, quota long")).collect()}
    assert report[1, "hard"].missing == 6 and report[1, "hard"].stored_available == 9


def test_hot_cell_is_ranked_in_ranges(spark, monkeypatch):
    monkeypatch.setattr(quota, "RANK_BUCKET_ROWS", 50)
    pages = spark.range(1000).select(F.lit(1).alias("run_id"), F.col("id").alias("page_id"), F.lit("easy").alias("tier"), F.lit(0).alias("cid"))
    cells = spark.createDataFrame([(1, "easy", 0, 1000, 137)], "run_id int, tier string, cid int, n long, q long")
    got = quota.draw(pages, cells).collect()
    assert sorted(r.draw_rank for r in got) == list(range(1, 138))


def test_empty(spark):
    _, levels, cells = quota.plan(spark.createDataFrame([], INDEX), spark.createDataFrame([], RUN), spark.createDataFrame([], CELL))
    assert levels.collect() == [] and cells.collect() == []
