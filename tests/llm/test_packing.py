"""Buckets against brute force, whole packings, and odd rows."""

import itertools
import random

import numpy as np

from folioforge.llm import packing

DOC = "doc_id long, text string, container string, rest string"
PROFILE = "profile_id int, tokenizer string, capacity int"


def test_buckets_are_optimal():
    rnd = random.Random(1)
    for _ in range(30):
        lengths = np.array(sorted(rnd.sample(range(1, 60), 9)))
        counts = np.array([rnd.randint(1, 20) for _ in lengths], float)
        got = packing.bucket_bounds(lengths, counts, 3)

        def padding(bounds):
            up = np.array(bounds)[np.searchsorted(bounds, lengths)]
            return float((counts * (up - lengths)).sum())

        best = min(padding(list(sorted(c)) + [int(lengths[-1])]) for c in itertools.combinations(lengths[:-1].tolist(), 2))
        assert padding(got.tolist()) == best and len(got) <= 3


def test_patterns_hold_all_items():
    bounds, counts = np.array([3, 7, 20, 64]), np.array([100, 31, 9, 2])
    plan = packing.patterns(bounds, counts, 64)
    assert all(sum(int(bounds[b]) * k for b, k in use.items()) <= 64 for _, use in plan)
    for b in range(4):
        assert sum(t * use.get(b, 0) for t, use in plan) == counts[b]


def test_packing(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANK_ROWS", 20)
    rnd = random.Random(3)
    docs = [(i, " ".join(rnd.choice(["alpha", "beta", "gamma"]) for _ in range(rnd.randint(1, 60))), "x", None) for i in range(200)]
    docs += [(500, None, None, None), (501, "", None, None), (502, "word " * 400, None, None), (3, "alpha", None, None)]
    df = spark.createDataFrame(docs, DOC).repartition(3)
    profiles = spark.createDataFrame([(1, "byte_bpe_50k", 128), (2, "word_bpe_49k", 64), (3, None, 5), (4, "byte_bpe_50k", None)], PROFILE)
    got = packing.pack(df, profiles).collect()
    sizes = {}
    for r in packing.token_sizes(df, ["byte_bpe_50k", "word_bpe_49k"]).collect():
        for p, n in ((1, r.byte_bpe_50k), (2, r.word_bpe_49k)):
            sizes[p, r.doc_id] = sizes.get((p, r.doc_id), 0) + n
    placed, room = {}, {}
    for r in got:
        placed[r.profile_id, r.doc_id] = placed.get((r.profile_id, r.doc_id), 0) + r.tokens
        room[r.profile_id, r.container] = room.get((r.profile_id, r.container), 0) + r.tokens
    assert placed == sizes
    assert all(n <= {1: 128, 2: 64}[p] for (p, _), n in room.items())
    for p, cap in ((1, 128), (2, 64)):
        used = [n for (q, _), n in room.items() if q == p]
        assert sum(used) / (len(used) * cap) > 0.9
    parts = {(r.profile_id, r.doc_id): 0 for r in got}
    for r in got:
        parts[r.profile_id, r.doc_id] += 1
    assert all(n == 1 for (p, d), n in parts.items() if d not in (502, 3) and sizes[p, d] <= {1: 128, 2: 64}[p])


def test_partitions_do_not_matter(spark):
    rnd = random.Random(5)
    docs = [(i % 90, "alpha " * rnd.randint(0, 70), "x", None) for i in range(100)] + [(None, "beta " * 90, None, None)] * 2
    profiles = spark.createDataFrame([(1, "byte_bpe_50k", 64)], PROFILE)
    at = lambda n: sorted(map(str, packing.pack(spark.createDataFrame(docs, DOC).repartition(n), profiles).collect()))
    two = at(2)
    assert two == at(7)
    room = {}
    for r in packing.pack(spark.createDataFrame(docs, DOC), profiles, top_up=False).collect():
        room[r.container] = room.get(r.container, 0) + r.tokens
    assert max(room.values()) <= 64


def test_empty(spark):
    assert packing.pack(spark.createDataFrame([], DOC), spark.createDataFrame([(1, "byte_bpe_50k", 8)], PROFILE)).collect() == []
    assert packing.pack(spark.createDataFrame([(1, "x", None, None)], DOC), spark.createDataFrame([], PROFILE)).collect() == []
