"""Sources, sinks, runners and streams."""

import gzip
import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge import session
from folioforge.sources import jsonl, runners
from folioforge.streaming import health


def test_jsonl_round_trip(spark, tmp_path):
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType()), T.StructField("c", T.ArrayType(T.FloatType()))])
    path = str(tmp_path / "x")
    df = spark.createDataFrame([(1, None, [1.0]), (2, "", None)], schema)
    assert jsonl.write_jsonl(df, path) == 2 and jsonl.write_jsonl(df, path, append=True) == 2
    got = jsonl.read_jsonl(spark, path, schema).collect()
    assert len(got) == 4 and {r.b for r in got} == {None, ""}
    with gzip.open(tmp_path / "y.jsonl.gz", "wt") as f:
        f.write('{"a": 5, "zzz": 1}\n\n{"b": "q"}\n')
    assert [(r.a, r.b) for r in jsonl.read_jsonl(spark, str(tmp_path / "y.jsonl.gz"), schema).collect() if r.a or r.b] == [(5, None), (None, "q")]


def test_export(spark, tmp_path):
    df = spark.createDataFrame([("sft", "text", 1), ("sft", "table", 2), ("hard", "text", 3)], "stage string, subtask string, x int")
    m = jsonl.export_stages(df, str(tmp_path / "out"))
    assert m["n"] == 3 and m["stages"]["sft"]["subtasks"] == {"table": 1, "text": 1}
    assert spark.read.parquet(str(tmp_path / "out/records")).filter("stage = 'hard'").count() == 1
    assert json.loads(spark.read.text(str(tmp_path / "out/manifest")).first()[0]) == m


def test_files(spark, tmp_path):
    for label in ("a", "b"):
        (tmp_path / "d" / label).mkdir(parents=True)
        for i in range(3):
            (tmp_path / "d" / label / f"{i}.png").write_bytes(b"x" * i)
    got = jsonl.labelled_files(spark, str(tmp_path / "d"), 2).groupBy("label").count().collect()
    assert {r.label: r["count"] for r in got} == {"a": 2, "b": 2}
    assert jsonl.page_files(spark, str(tmp_path / "d"), "1.png").count() == 2


def test_variants_count_once(spark):
    df = spark.createDataFrame([("a/x.png",), ("a/x_aug1.png",), ("a/x_rot2.jpg",), ("a/y.png",)], "path string")
    assert [r.path for r in jsonl.first_of_base(df, "path").orderBy("path").collect()] == ["a/x.png", "a/y.png"]


def test_runner_and_cache(spark):
    df = spark.createDataFrame([("k1", "ok"), ("k2", "boom"), ("k3", "again"), ("k1", "ok")], "key string, t string")

    def call(t):
        if t == "boom":
            raise ValueError("no")
        if t == "again":
            raise runners.RetryableError("busy")
        return t.upper()

    out = {r.key: r for r in runners.run_model(df, "key", "t", call).collect()}
    assert out["k1"].value == "OK" and out["k2"].error.startswith("ValueError") and out["k3"].tries == 3
    cache = spark.createDataFrame([("k2", "cached")], "key string, value string")
    result, fresh = runners.cached_run(df, cache, "key", "t", call)
    assert {(r.key, r.value) for r in result.collect()} == {("k1", "OK"), ("k2", "cached"), ("k3", None)} and [r.key for r in fresh.collect()] == ["k1"]


def test_breaker_and_limiter():
    waits, now = [], [0.0]
    limit = runners.Limiter(2.0, 1, clock=lambda: now[0], sleep=lambda s: (waits.append(s), now.__setitem__(0, now[0] + s)))
    for _ in range(3):
        limit.take()
    assert waits == [0.5, 0.5]


def test_streams_end_with_the_batch_result(spark, tmp_path):
    events = spark.range(500).select(F.col("id").alias("event_id"), (F.lit("2024-01-01").cast("timestamp") + F.make_interval(mins=F.col("id").cast("int") * 7)).alias("ts"), (F.col("id") % 5).alias("user_id"), F.when(F.col("id") % 4 == 0, "error").otherwise("ok").alias("event_type"))
    events = events.union(events.limit(10))
    events.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    q = health.distinct_events(stream, "event_id", "ts", "20 days").writeStream.format("memory").queryName("distinct_out").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.sql("select * from distinct_out").count() == health.distinct_events(events, "event_id", "ts").count() == 500
    q = health.tumbling_health(stream, "ts", "user_id", F.col("event_type") == "error").writeStream.format("memory").queryName("health_out").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    key = lambda df: {(r.window_start, r.user_id, r.n, r.n_failed) for r in df.collect()}
    assert key(spark.sql("select * from health_out")) == key(health.tumbling_health(events, "ts", "user_id", F.col("event_type") == "error"))
    assert health.sessions(events, "ts", "user_id").agg(F.sum("n")).first()[0] == 510


def test_shared_folder(spark):
    held = session.materialize(spark.range(5), "t")
    assert held.count() == 5 and session.shared_dir(spark) in held._folioforge_path
    session.discard(held)
    session.discard(None)
