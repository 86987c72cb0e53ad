"""Distances to the k-th nearest row, part by part, against brute force."""

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

from folioforge.operators import clustering, nearest


def test_sparsity_compares_near_parts_only(tmp_path, monkeypatch):
    rng = np.random.default_rng(9)
    sites = np.eye(6) * 50
    x = (sites[np.arange(1200) % 6] + rng.normal(size=(1200, 6))).astype(np.float32)
    parts = []
    for c in range(6):
        rows = pa.table({"part": np.full(200, c, np.int32), "id": np.arange(c, 1200, 6), "v": pa.array(x[c::6].tolist(), pa.list_(pa.float32())), "counts": np.ones(200, np.int32)})
        t = nearest.part(rows, False)
        pq.write_table(t, f"{tmp_path}/{c}.parquet")
        parts.append((f"file://{tmp_path}/{c}.parquet", sites[c], t.column("centre")[0].as_py(), t.column("radius")[0].as_py(), 200))
    members, read = nearest._members, []
    monkeypatch.setattr(nearest, "_members", lambda path: read.append(path) or members(path))
    ids, far = nearest.searcher(parts, 16, False)(2)
    own = x[2::6].astype(float)
    want = np.sort(np.linalg.norm(own[:, None] - x[None].astype(float), axis=2), axis=1)[:, 15]
    assert ids.to_pylist() == list(range(2, 1200, 6)) and np.abs(far - want).max() < 1e-9 and set(read) == {parts[2][0]}


def test_sparsity_of_copies_and_odd_rows(spark, monkeypatch):
    rng = np.random.default_rng(10)
    x = np.concatenate((np.repeat(rng.normal(size=(3, 8)), 30, axis=0), np.zeros((40, 8)), rng.normal(size=(130, 8)) * 100, rng.normal(size=(100, 8)) * 1e-3 + 5))
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(900, [float("nan")] * 8), (901, None)]
    df = spark.createDataFrame(rows, "id long, v array<double>").repartition(3)
    monkeypatch.setattr(clustering, "REFERENCE_BLOCK", 32)
    for unit in (False, True):
        u = x / np.maximum(np.linalg.norm(x, axis=1), 1e-9)[:, None] if unit else x
        want = np.sort(np.linalg.norm(u[:, None] - u[None], axis=2), axis=1)[:, 15]
        got = {r.id: r.sparsity for r in clustering.local_sparsity(df, "id", "v", unit=unit).collect()}
        assert len(got) == 361 and np.isnan(got[900]) and all(abs(got[i] - want[i]) < 1e-9 for i in range(360))
    few = clustering.local_sparsity(df.filter("id in (1, 100, 200)"), "id", "v").collect()
    assert all(abs(r.sparsity - np.linalg.norm(x[r.id] - x[[1, 100, 200]], axis=1).max()) < 1e-9 for r in few) and len(few) == 3
    assert clustering.local_sparsity(df.filter("false"), "id", "v").collect() == []


def test_rarity_reads_its_rows_once(spark):
    rng = np.random.default_rng(11)
    x, c = rng.random(300), np.arange(300) % 3
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.createDataFrame([(int(k), float(v)) for k, v in zip(c, x, strict=True)], "c int, sparsity double").mapInArrow(counted, "c int, sparsity double")
    got = {r.c: r.rarity for r in clustering.cluster_rarity(df, "c").collect()}
    assert all(abs(got[k] - np.median(x[c == k]) / np.median(x)) < 1e-9 for k in range(3)) and seen.value == 300
