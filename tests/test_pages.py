"""Page results, features and workloads on hand-made rows."""

from pyspark.sql import functions as F

from folioforge.operators import pages


def test_page_result_keeps_unread_apart_from_blank(spark):
    b = "b array<struct<label:string,content:string>>"
    rows = [([("title", "T"), ("formula", "x"), ("text", None), ("list", "l"), ("table", "<table>")],), ([],), (None,)]
    got = [r[0] for r in spark.createDataFrame(rows, b).select(pages.page_result(F.col("b"))).collect()]
    assert (got[0].text, got[0].formulas, got[0].tables) == ("T\nl", ["x"], ["<table>"])
    assert (got[1].text, got[1].formulas) == ("", []) and got[2] is None


def test_crops_and_features(spark):
    df = spark.createDataFrame([([-3.0, 2.7, 2000.0, 2.9],), ([5.0, 5.0, 5.0, 5.0],), (None,), ([1.0],)], "b array<double>")
    got = [r[0] for r in df.select(pages.crop_box(F.col("b"), F.lit(100), F.lit(50))).collect()]
    assert got == [[0, 2, 100, 3], [5, 5, 6, 6], None, None]
    f = spark.createDataFrame([([1.0, 2.0], [0.0, 0.0, 50.0, 25.0]), (None, [0.0] * 4)], "c array<double>, b array<double>").select(pages.element_feature(F.col("c"), F.col("b"), F.lit(100), F.lit(50))).collect()
    assert len(f[0][0]) == 8 and abs(sum(x * x for x in f[0][0]) - 1) < 1e-9 and f[1][0] is None


def test_modes(spark):
    df = spark.createDataFrame([(None,), (0.99,), (0.98,), (0.5,)], "a double").select(pages.review_mode(F.col("a")).alias("mode"))
    assert {r.mode: (r.n, r.share) for r in pages.workload(df, "mode").collect()} == {"quick_review": (2, 0.5), "adjudicate": (1, 0.25), "retype": (1, 0.25)}
    assert {r.n for r in pages.workload(df.filter("false"), "mode").collect()} == {0}


def test_replies(spark):
    rows = ['{"choices":[{"message":{"content":"plain"}}]}', '{"choices":[{"message":{"content":[{"text":"a"},{"text":"b"}]}}]}', '{"candidates":[{"content":{"parts":[{"text":"x"},{"text":"y"}]}}]}', "broken", None]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in rows], "r string").select(pages.response_text(F.col("r"))).collect()]
    assert got == ["plain", "ab", "xy", None, None]


def test_pca_and_corpus(spark):
    df = spark.createDataFrame([(i, [float(i), 2.0 * i, 5.0]) for i in range(20)] + [(99, None)], "id int, v array<double>")
    p = [r.projected[0] for r in pages.centred_pca(df, "id", "v", 1).collect()]
    assert len(p) == 20 and abs(sum(p)) < 1e-9
    assert pages.centred_pca(df.filter("false"), "id", "v", 1).collect() == []
    c = pages.synthetic_corpus(spark, 3000)
    sizes = {r.scenario: r["count"] for r in c.groupBy("scenario").count().collect()}
    assert sizes[0] > sizes[5] > 0 and c.filter("scenario >= 22 and tier <> 'invalid'").count() == 0


def test_observed(spark):
    df, seen = pages.observed(spark.range(7), "stage")
    df.write.format("noop").mode("overwrite").save()
    assert seen.get["n"] == 7


def test_subtasks(spark):
    df = spark.createDataFrame([("list",), ("table",), ("odd",), (None,)], "l string")
    assert [r[0] for r in df.select(pages.subtask_of(F.col("l"))).collect()] == ["text", "table", "text", "text"]
