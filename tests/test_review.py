"""Tiers from readings, gates, drawing checks, exact ranks, runner faults, and several plane tables."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioforge.functions import prompts, sequence, text
from folioforge.operators import clustering, consistency, elements, evaluation, quality, ranking, refine
from folioforge.sources import runners


def test_element_tiers(spark):
    same = "The table lists the survey map."
    rows = [
        (1, "text", same, same, None), (2, "text", "x", same, same), (3, "text", "x", "y", "z"), (4, "text", None, same, same), (5, "text", " ", "", "q"),
        (6, "formula", "\\dfrac{a}{b}", "\\frac{a}{b}", None), (7, "table", "<table><tr><td>1</td></tr></table>", "<table><tr><td>1</td><td>2</td></tr></table>", None), (8, None, "ａ" * 9, "a" * 9, None),
    ]
    df = spark.createDataFrame(rows, "id int, etype string, m string, p string, q string")
    got = {r.id: (r.derived, r.s_mp) for r in consistency.element_tiers(df, "etype", "m", "p", "q").collect()}
    assert {k: v[0] for k, v in got.items()} == {1: "easy", 2: "medium", 3: "hard", 4: "hard", 5: "hard", 6: "easy", 7: "hard", 8: "easy"}
    assert got[4][1] is None and got[5][1] is None and 0 < got[7][1] < 1
    plain = {r.id: r.derived for r in consistency.element_tiers(df, "etype", "m", "p", "q", compatibility=False).collect()}
    assert plain[8] == "hard"
    gate = consistency.gated(df, F.col("m").isNotNull(), lambda x: consistency.element_tiers(x, "etype", "m", "p", "q")).collect()
    assert {r.id: r.derived for r in gate}[4] == "invalid" and len(gate) == 8
    assert consistency.element_tiers(df.filter("false"), "etype", "m", "p", "q").collect() == []


def test_readings_by_box(spark):
    a = spark.createDataFrame([("p", "text", 1, [0.0, 0.0, 10.0, 10.0]), ("p", "title", 2, [0.0, 0.0, 10.0, 10.0])], "page string, label string, anchor_id int, box array<double>")
    b = spark.createDataFrame([("p", "text", 0, [0.0, 0.0, 10.0, 9.0], "near", "m"), ("p", "text", 1, [0.0, 0.0, 10.0, 10.0], "best", "m"), ("p", "text", 0, [50.0, 0.0, 60.0, 9.0], "far", "p")], "page string, label string, pos int, box array<double>, content string, model string")
    got = {r.anchor_id: (r.m, r.p) for r in elements.readings_by_box(a, b, ["page", "label"], ["m", "p"]).collect()}
    assert got == {1: ("best", None), 2: (None, None)}


def test_sets_and_confidence(spark):
    a, b = spark.createDataFrame([("x",), ("x",), ("y",)], "l string"), spark.createDataFrame([("y",), ("z",)], "l string")
    assert {(r.l, r.side) for r in elements.label_difference(a, b, "l").collect()} == {("x", "left"), ("z", "right")}
    c = spark.createDataFrame([(1, 0.6), (2, 0.59), (3, None)], "id int, c double")
    assert [r.id for r in elements.confident(c, "c").collect()] == [1]


def test_render_errors(spark):
    rows = [("formula", "\\frac{a}{b}"), ("formula", "\\frac{a}{b"), ("formula", "\\{x\\}"), ("formula", "\\begin{matrix} a"), ("formula", "\\begin{matrix} a \\end{matrix}"), ("formula", "\\left( a"), ("formula", "\\leftarrow a"), ("table", "<table><tr><td>1"), ("table", "words"), ("table", "| a | b |"), ("text", "{"), ("formula", None), (None, "{")]
    df = spark.createDataFrame(rows, "s string, c string").coalesce(1)
    assert [r[0] for r in df.select(refine.render_error(F.col("c"), F.col("s"))).collect()] == [None, "braces", None, "environments", None, "fences", None, None, "no_cells", None, None, None, None]


def test_refine_draws_before_it_judges(spark):
    items = spark.createDataFrame([(1, "formula", "{"), (2, "formula", "a"), (3, "formula", "a")], "k int, subtask string, draft string")
    v = spark.createDataFrame([(1, 1, False, 0.9, None), (2, 1, True, 0.5, "b{"), (2, 2, False, 0.9, None), (3, 1, False, 0.8, None)], "k int, round int, has_error boolean, confidence double, corrected string")
    out = refine.refine(items, v, "k", ["formula"], render=refine.render_error)
    assert {r.k: (r.outcome, r.content, r.rounds) for r in out.collect()} == {1: ("render_failed", "{", 0), 2: ("render_failed", "b{", 1), 3: ("refined", "a", 1)}
    assert [(r.k, r.tier, r.label_source) for r in refine.to_sft(out, "k", "j").collect()] == [(3, "hard", "judge-refine:j")]
    assert {(r.k, r.reason) for r in refine.to_experts(out, "k").collect()} == {(1, "render_failed"), (2, "render_failed")}
    assert {(r.outcome, r.n) for r in refine.reasons(out).collect()} == {("render_failed", 2), ("refined", 1)}
    raw = spark.createDataFrame([('{"has_error": false}',), ("none",), (None,)], "t string").coalesce(1)
    assert [(r.v.has_error, r.v.confidence) for r in raw.select(refine.unparsed_as_error(text.verdict(F.col("t"))).alias("v")).collect()] == [(False, 0.0), (True, 0.0), (True, 0.0)]


def test_label_quality(spark):
    df = spark.createDataFrame([("a", ["x"]), ("a", []), ("b", [])], "s string, issues array<string>")
    assert {(r.s, r.n, r.n_clean, r.clean_share) for r in quality.clean_share(df, ["s"]).collect()} == {("a", 2, 1, 0.5), ("b", 1, 1, 1.0)}
    v = spark.createDataFrame([(1, "x"), (1, "x"), (1, "y"), (2, "x"), (3, None), (None, "x")], "i int, l string")
    assert [(r.i, r.n_pairs, round(r.agree, 6)) for r in quality.item_agreement(v, "i", "l").collect()] == [(1, 3, round(1 / 3, 6))]
    pairs = spark.createDataFrame([(1, 2, 5, 0.5), (1, 3, 1, 0.1), (2, 3, 5, 0.5)], "annotator_a int, annotator_b int, n long, agree double")
    assert [(r.annotator_a, r.annotator_b) for r in quality.worst_pairs(pairs, least=2, n=2).collect()] == [(1, 2), (2, 3)]


def test_sample_quality_and_candidates(spark):
    rows = [("t", c, t, g) for c, t, g in ((1, "easy", 0.1), (1, "hard", 0.5), (1, "invalid", 0.0), (2, "medium", 1.0))]
    r = evaluation.sample_quality(spark.createDataFrame(rows, "s string, c int, t string, g double"), ["s"], "c", "t", "g").first()
    assert (r.n_rows, r.head_share, r.tail_share, r.waste, r.signal) == (4, 0.75, 0.25, 0.25, 0.4)
    rng = np.random.default_rng(1)
    rows = [(i, i % 3, (np.eye(3)[i % 3] * 5 + rng.normal(size=3) * 0.1).tolist(), rng.normal(size=3).tolist()) for i in range(90)]
    got = {r.candidate: r for r in evaluation.evaluate_candidates(spark.createDataFrame(rows, "id int, label int, good array<double>, bad array<double>"), "id", "label", {"good": "good", "bad": "bad"}, 3).collect()}
    assert got["good"].best and not got["bad"].best and got["good"].nmi > got["bad"].nmi
    listing = evaluation.assignment_listing(spark.createDataFrame([(0, i, "a") for i in range(9)], "cid int, id int, label string"), "cid", "id", "label", n=3).first()
    assert [m.id for m in listing.members] == [0, 1, 2]


def test_markdown_results_and_prompts(spark):
    md = "Intro $$x+1$$ mid\n| a | b |\n|---|---|\n| 1 | 2 |\n<table><tr><td>q</td></tr></table> end "
    df = spark.createDataFrame([(md,), ("",), (None,)], "t string").coalesce(1)
    r = [x[0] for x in df.select(text.markdown_result(F.col("t"))).collect()]
    assert r[0].formulas == ["x+1"] and len(r[0].tables) == 2 and r[0].text.startswith("Intro") and "<table" not in r[0].text and r[0].text.endswith("end") and r[1].text == "" and r[2] is None
    p = df.select(prompts.judge_prompt(F.col("t"), F.lit("formula"), F.lit(True)), prompts.draft_prompt(F.lit("other")), prompts.blocks_prompt()).collect()
    assert "LaTeX" in p[0][0] and p[2][0] is None and "text" in p[0][1]


def test_table_spans_and_many_tokens(spark):
    rows = [('<table><tr><td rowspan="²" colspan="99999999999999">a</td></tr></table>',), ("<table><tr><td rowspan=\"3\">b",), ("<![x",), (None,)]
    got = [r[0] for r in spark.createDataFrame(rows, "h string").coalesce(1).select(sequence.table_rows("h")).collect()]
    assert (got[0][0][0].rs, got[0][0][0].cs) == (1, sequence.MAX_SPAN) and got[1][0][0].rs == 3 and got[2] == [] and got[3] == []
    n = 7000
    df = spark.createDataFrame([([str(i) for i in range(n)], [str(i) for i in range(n - 1)] + ["x"])], "a array<string>, b array<string>")
    assert abs(df.select(sequence.token_similarity(F.col("a"), F.col("b"))).first()[0] - (1 - 1 / n)) < 1e-12


@pytest.mark.parametrize("kind", ["spread", "ties", "huge"])
def test_percentiles_are_exact_when_narrowed(spark, monkeypatch, kind):
    monkeypatch.setattr(ranking, "HELD_VALUES", 50)
    rng = np.random.default_rng(2)
    x = {"spread": rng.normal(size=3001), "ties": np.repeat([1.0, 2.0, 3.0], [2000, 5, 1000]), "huge": np.concatenate((rng.normal(size=2000), [1e300, -1e300]))}[kind]
    df = spark.createDataFrame([(float(v), int(i % 3)) for i, v in enumerate(x)] + [(None, 0)], "v double, g int").repartition(3)
    assert np.allclose(ranking.exact_percentiles(df, "v", [0.0, 0.5, 0.95, 1.0]), np.quantile(x, [0.0, 0.5, 0.95, 1.0]))
    med = {r.g: r.m for r in ranking.group_medians(df, "g", "v", "m").collect()}
    assert all(abs(med[g] - np.median(x[g::3])) < 1e-9 for g in range(3))
    assert ranking.exact_percentiles(df.filter("false"), "v", [0.5]) == [None] and ranking.group_medians(df.filter("false"), "g", "v", "m").collect() == []


def exact_greedy(rows, cosine=0.98):
    kept, out = {}, {}
    for i, c, v in sorted(rows):
        u = np.array(v) / np.linalg.norm(v)
        out[i] = all(u @ h < cosine for h in kept.get(c, []))
        if out[i]:
            kept.setdefault(c, []).append(u)
    return out


def test_several_tables_find_nearly_all_duplicates(spark, monkeypatch):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(120, 24))
    rows = [(i, int(i % 3), (centres[rng.integers(120)] + rng.normal(size=24) * 0.09).tolist()) for i in range(1500)]
    want = exact_greedy(rows)
    df = spark.createDataFrame(rows, "id int, c int, v array<double>").repartition(3)
    got = {r.id: r.kept for r in clustering.dedup_in_buckets(df, "id", "c", "v", bits=8, tables=8).collect()}
    removed = {i for i, k in want.items() if not k}
    assert len(removed) > 300 and len(removed & {i for i, k in got.items() if not k}) / len(removed) >= 0.9
    assert np.mean([got[i] == want[i] for i in want]) > 0.98
    monkeypatch.setattr(clustering, "BUCKET_ROWS", 25)  # parts of large buckets change nothing
    assert {r.id: r.kept for r in clustering.dedup_in_buckets(df.repartition(7), "id", "c", "v", bits=8, tables=8).collect()} == got


def test_calls_are_made_once_and_faults_are_data(spark, tmp_path):
    def call(t):
        n = len(os.listdir(tmp_path))
        (tmp_path / f"{t}-{n}-{os.getpid()}-{os.urandom(4).hex()}").write_text("x")
        if t == "mangled":
            raise runners.UnreadableReply("no json")
        if t == "gone":
            raise runners.MissingPage("page 9", 404)
        return t.upper()

    df = spark.createDataFrame([("k1", "ok"), ("k2", "mangled"), ("k3", "gone"), ("k1", "ok")], "key string, t string").coalesce(1)
    result, fresh = runners.cached_run(df, spark.createDataFrame([], "key string, value string"), "key", "t", call)
    assert {(r.key, r.value) for r in result.collect()} == {("k1", "OK"), ("k2", None), ("k3", None)} and [r.key for r in fresh.collect()] == ["k1"]
    names = sorted(f.split("-")[0] for f in os.listdir(tmp_path))
    assert names == ["gone", "mangled", "mangled", "ok"]  # one re-ask, no call twice
    out = runners.run_model(df.dropDuplicates(["key"]), "key", "t", call)
    faults = {r.key: r.fault for r in out.collect()}
    assert faults["k1"] is None and (faults["k3"].kind, faults["k3"].status, faults["k3"].retryable) == ("missing", 404, False)
    q = {(r.key, r.role, r.kind) for r in runners.quarantined({"m": out, "p": out.filter("key = 'k3'")}, "key").collect()}
    assert q == {("k2", "m", "unreadable"), ("k3", "m", "missing"), ("k3", "p", "missing")}


def test_breaker_probes_after_a_rest():
    now = [0.0]
    b = runners.Breaker(2, rest=10.0, clock=lambda: now[0])
    b.note(True)
    b.note(True)
    assert not b.lets()
    now[0] = 10.0
    assert b.lets()
    b.note(True)  # the probe failed: open again, from now
    assert not b.lets()
    now[0] = 20.0
    b.note(False)
    assert b.lets()
    never = runners.Breaker(1, clock=lambda: now[0])
    never.note(True)
    now[0] = 1e9
    assert not never.lets()


def test_endpoints():
    e = runners.Endpoint("m", temperature=None, token_limit=5, token_limit_name="max_completion_tokens")
    assert e.request("hi") == {"model": "m", "messages": [{"role": "user", "content": "hi"}], "max_completion_tokens": 5}
    assert runners.configured({"judge": e, "cheap": None}) == ({"judge": e}, ["cheap"])
