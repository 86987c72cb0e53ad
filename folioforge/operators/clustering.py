"""Clustering, near-duplicate removal and density over vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import Bucketizer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from folioforge.functions.constants import CLUSTER
from folioforge.functions.vector import dot, norm
from folioforge.session import discard, materialize

from . import nearest
from .ranking import exact_percentiles, group_medians

#: Centroids up to which they are broadcast as one matrix.
BROADCAST_ROWS = 200_000
#: Rows of a part in which near rows are searched, about; parts at most, and rows for each of them that place the cells.
REFERENCE_BLOCK, CELLS, CELL_ROWS = 4_096, 1_024, 64
#: Distances that a task holds at once.
DISTANCES = 1 << 22
#: Ranges in which values are ranked side by side.
RANK_RANGES = 256
#: Different vectors in a bucket up to which one task compares it; larger ones are cut into parts of about so many.
BUCKET_ROWS = 20_000


def _matrix(rows: list) -> np.ndarray:
    return np.array(rows, np.float64)


def _batch(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def nearest_centroid(vectors: DataFrame, centroids: list[tuple[int, list[float]]], id_col: str, vec_col: str) -> DataFrame:
    """(id, cid, dist) of every vector: its nearest centroid (ties: lowest cid) and the distance.

    The centroids are a bounded matrix on the driver; each Arrow batch is one
    matrix product. NULL vectors are left out.
    """
    if len(centroids) > BROADCAST_ROWS:
        raise ValueError("too many centroids to broadcast")
    ordered = sorted(centroids)
    sent = vectors.sparkSession.sparkContext.broadcast((np.array([c for c, _ in ordered]), _matrix([v for _, v in ordered])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, c = sent.value
        half = (c * c).sum(1)
        for b in batches:
            x = _batch(b.column(1))
            if not len(x):
                continue
            d = half[None, :] - 2 * (x @ c.T)
            best = d.argmin(1)
            dist = np.sqrt(np.maximum(((x - c[best]) ** 2).sum(1), 0.0))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids[best].astype(np.int32)), pa.array(dist)], names=["id", "cid", "dist"])

    rows = vectors.filter(F.col(vec_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v"))
    return rows.mapInArrow(run, "id long, cid int, dist double").select(F.col("id").alias(id_col), "cid", "dist")


def mean_vectors(df: DataFrame, by: str, vec_col: str, width: int, digits: int | None = None) -> DataFrame:
    """(by, centroid): mean vector of each group; sums are partial before the shuffle."""
    mean = [F.avg(F.col(vec_col)[i].cast("double")) for i in range(width)]
    return df.groupBy(by).agg(F.array(*[F.round(m, digits) if digits is not None else m for m in mean]).alias("centroid"))


def kmeans_flattened(vectors: DataFrame, id_col: str, vec_col: str, k: int, rounds: int = CLUSTER["flatten_rounds"], seed: int = 0) -> list[list[float]]:
    """Centroids of a k-means that weighs every row by 1 / its cluster's size, refitted in *rounds*.

    In expectation what resampling by that weight gives, without its noise. Dense
    regions attract fewer centroids than by their rows.
    """
    held = materialize(vectors.filter(F.col(vec_col).isNotNull()).select(id_col, vec_col), "flatten-vectors")
    n = held.count()
    if not n:
        return []
    fit = held.select(id_col, vec_col, array_to_vector(F.col(vec_col).cast("array<double>")).alias("f"), F.lit(1.0).alias("w"))
    model = KMeans(k=max(2, min(k, n)), featuresCol="f", weightCol="w", seed=seed, maxIter=10).fit(fit)
    for r in range(rounds):
        centres = [(i, c.tolist()) for i, c in enumerate(model.clusterCenters())]
        at = nearest_centroid(held, centres, id_col, vec_col)
        sizes = at.groupBy("cid").agg(F.count("*").alias("n"))
        weighted = at.join(F.broadcast(sizes), "cid").select(id_col, (1.0 / F.col("n")).alias("w"))  # at most k sizes
        model = KMeans(k=len(centres), featuresCol="f", weightCol="w", seed=seed + r + 1, maxIter=10).fit(fit.drop("w").join(weighted, id_col))
    out = [c.tolist() for c in model.clusterCenters()]
    discard(held)
    return out


def hierarchical(vectors: DataFrame, id_col: str, vec_col: str, k: int, split: int, max_share: float, min_size: int, depth: int = CLUSTER["depth"], tail_pct: float = CLUSTER["tail_pct"], rounds: int = 1, seed: int = 0) -> DataFrame:
    """(id, cid, path, dist): clusters split where they are too large, the far and the small in the tail (cid -1).

    A cluster is large above *max_share* of all rows, with rows for *split*
    clusters of *min_size*. There are at most 1 / max_share large ones a level,
    and the driver only holds their centroids.
    """
    n = vectors.filter(F.col(vec_col).isNotNull()).count()
    base = vectors.filter(F.col(vec_col).isNotNull()).select(id_col, vec_col)
    centres = list(enumerate(kmeans_flattened(base, id_col, vec_col, k, rounds, seed)))
    if not centres:
        return base.select(id_col, F.lit(-1).alias("cid"), F.lit("tail").alias("path"), F.lit(None).cast("double").alias("dist"))
    at = materialize(nearest_centroid(base, centres, id_col, vec_col).withColumn("path", F.col("cid").cast("string")), "tree-level")
    next_id = len(centres)
    for level in range(depth - 1):
        sizes = at.groupBy("cid", "path").agg(F.count("*").alias("n"))
        big = sizes.filter((F.col("n") > max_share * n) & (F.col("n") >= split * min_size)).orderBy("cid").collect()
        if not big:
            break
        parts = [at.filter(~F.col("cid").isin([r["cid"] for r in big]))]
        for r in big:
            inside = base.join(at.filter(F.col("cid") == r["cid"]).select(id_col), id_col)
            sub = kmeans_flattened(inside, id_col, vec_col, split, rounds, seed + level + 1)
            named = [(next_id + j, c) for j, c in enumerate(sub)]
            moved = nearest_centroid(inside, named, id_col, vec_col)
            parts.append(moved.withColumn("path", F.concat(F.lit(r["path"] + "/"), (F.col("cid") - next_id).cast("string"))))
            next_id += len(sub)
        merged = parts[0]
        for p in parts[1:]:
            merged = merged.unionByName(p)
        new = materialize(merged, "tree-level")
        discard(at)
        at = new
    return tail(at, "cid", "dist", tail_pct, min_size)


def tail(assigned: DataFrame, cid: str, dist: str, pct: float = CLUSTER["tail_pct"], min_size: int = CLUSTER["min_size"]) -> DataFrame:
    """*assigned* with rows beyond the distances' percentile (strictly), then those of small clusters, at cid -1.

    The percentile is one number and the sizes are one row per cluster.
    """
    far = exact_percentiles(assigned, dist, [pct / 100])[0]
    t = assigned.withColumn(cid, F.when(F.col(dist) > F.lit(far).cast("double"), -1).otherwise(F.col(cid)))
    sizes = t.filter(F.col(cid) >= 0).groupBy(cid).agg(F.count("*").alias("_n")).filter(F.col("_n") < min_size).select(F.col(cid), F.lit(True).alias("_small"))
    t = t.join(sizes, cid, "left").withColumn(cid, F.when(F.col("_small"), -1).otherwise(F.col(cid))).drop("_small")
    return t.withColumn("path", F.when(F.col(cid) == -1, "tail").otherwise(F.col("path"))) if "path" in t.columns else t


def _unit_rows(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def _bucketed(bits: int, seed: int, tables: int):
    """Every row once per table, with the side of each of the table's random planes that its vector lies on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, list[np.ndarray]] = {}
        weight = 1 << np.arange(bits, dtype=np.int64)
        for b in batches:
            x = _batch(b.column(2))
            if not len(x):
                continue
            width = x.shape[1]
            if width not in planes:
                planes[width] = [np.random.default_rng(seed + t).normal(size=(width, 2 * bits))[:, :bits] for t in range(tables)]
            for t, p in enumerate(planes[width]):
                code = (x @ p > 0).astype(np.int64) @ weight if bits else np.zeros(len(x), np.int64)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(len(x), t, np.int32)), pa.array(code)], names=["id", "c", "v", "kept", "t", "code"])

    return run


def _look_back(cosine: float):
    """For each undecided row of one part of a bucket: is a near duplicate before it kept, is one before it undecided?

    Rows come sorted by bucket, parts and id; a bucket's rows are compared when its last one has come.
    """
    names = ["id", "after_kept", "after_open"]

    def judge(ids: np.ndarray, x: np.ndarray, kept: np.ndarray, part: np.ndarray, apart: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        asked = np.flatnonzero(~kept)
        after_kept, after_open = np.zeros(len(asked), bool), np.zeros(len(asked), bool)
        step = max(1, DISTANCES // len(x))
        for s in range(0, len(asked), step):
            rows = asked[s : s + step]
            upto = rows[-1]  # sorted by id: nothing behind the last of them counts
            near = (x[rows] @ x[:upto].T >= cosine) & (ids[:upto][None, :] < ids[rows][:, None])
            if apart:  # rows of one part are compared in the task of that part
                near &= part[:upto][None, :] != part[rows][:, None]
            after_kept[s : s + step], after_open[s : s + step] = (near & kept[:upto]).any(1), (near & ~kept[:upto]).any(1)
        return ids[asked], after_kept, after_open

    def whole(t: pa.Table, ends: list[int]) -> pa.RecordBatch:
        x = _unit_rows(_batch(pa.concat_arrays(t.column("v").chunks)))
        ids, part, own, other = (t.column(c).to_numpy() for c in ("id", "part", "p1", "p2"))
        kept = t.column("kept").to_numpy().astype(bool)
        found = [judge(ids[s:e], x[s:e], kept[s:e], part[s:e], own[s] != other[s]) for s, e in zip([0, *ends], ends)]
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for b in batches:
            if not len(b):
                continue
            t = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
            changes = np.zeros(len(t) - 1, bool)
            for c in ("c", "t", "code", "p1", "p2"):
                changes |= np.diff(t.column(c).to_numpy()) != 0
            ends = (np.flatnonzero(changes) + 1).tolist()
            if ends:
                yield whole(t.slice(0, ends[-1]), ends)
            held = t.slice(ends[-1]) if ends else t
        if held is not None:
            yield whole(held, [len(held)])

    return run


def dedup_in_buckets(df: DataFrame, id_col: str, cid: str, vec_col: str, cosine: float = CLUSTER["dedup_cosine"], bits: int = 24, seed: int = 0, tables: int = 1) -> DataFrame:
    """(id, kept): first-come greedy removal of near duplicates inside each cluster.

    A row is removed if a kept row before it (by id) has *cosine* with it; a
    removed row removes none. Rows are compared that share a bucket, the code of
    *bits* random planes, in at least one of *tables* independent tables: at a
    cosine of 0.98, 8 tables of 8 bits miss fewer than one pair in a thousand.

    Equal vectors are collapsed before, so a group of exact copies of any size is
    one row. All tables are decided together, in rounds: a row without an
    undecided or kept near duplicate before it is kept, one behind a kept row is
    removed; a round decides at least the first undecided row of every chain. A
    bucket of more than BUCKET_ROWS different vectors is cut into parts by a hash
    and every two parts are compared in a task of their own, so no task holds an
    unbounded group, and the result is that of the whole bucket. NULL vectors are
    left out.
    """
    rows = df.filter(F.col(vec_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(cid), F.lit(-1)).cast("int").alias("c"), F.col(vec_col).cast("array<double>").alias("v"))
    heads = rows.groupBy("c", F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), "v").alias("h2")).agg(F.min("id").alias("id"), F.first("v").alias("v"))
    state = materialize(heads.select("id", "c", "v", F.lit(False).alias("kept")), "dedup-rows")
    keyed = "id long, c int, v array<double>, kept boolean, t int, code long"
    undecided = not state.isEmpty()
    while undecided:
        at = state.mapInArrow(_bucketed(bits, seed, tables), keyed)
        key = ["c", "t", "code"]
        # Buckets of one row, and those without an undecided one, have nothing to compare.
        sizes = at.groupBy(*key).agg(F.count("*").alias("n"), F.bool_or(~F.col("kept")).alias("open")).filter("open and n > 1")
        parts = sizes.select(*key, F.ceil(F.col("n") / BUCKET_ROWS).cast("int").alias("parts"))
        part = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part")
        cut = at.join(parts, key).select("*", part).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        cut = cut.select("id", "v", "kept", *key, "part", F.least("part", "with").alias("p1"), F.greatest("part", "with").alias("p2"))
        sorted_rows = cut.repartition(*key, "p1", "p2").sortWithinPartitions(*key, "p1", "p2", "id")
        seen = sorted_rows.mapInArrow(_look_back(cosine), "id long, after_kept boolean, after_open boolean").groupBy("id").agg(F.bool_or("after_kept").alias("after_kept"), F.bool_or("after_open").alias("after_open"))
        decided = state.join(seen, "id", "left").na.fill(False, ["after_kept", "after_open"])
        left = Observation("undecided")
        new = decided.filter("kept or not after_kept").select("id", "c", "v", (F.col("kept") | ~F.col("after_open")).alias("kept"))
        new = materialize(new.observe(left, F.count(F.when(~F.col("kept"), 1)).alias("n")), "dedup-rows")
        undecided = left.get["n"]
        discard(state)
        state = new
    kept = state.select("id", F.lit(True).alias("kept"))
    return rows.select("id").join(kept, "id", "left").select(F.col("id").alias(id_col), F.coalesce("kept", F.lit(False)).alias("kept"))


def _counted(rows: DataFrame, n: int, reference: int, seed: int) -> DataFrame:
    """*rows* with counts: 1 for the first *reference* of the *n* rows in seeded order, else 0.

    Rows are counted in ranges of the order's leading digits, so only the range in which the set ends is ranked.
    """
    if n <= reference:
        return rows.withColumn("counts", F.lit(1))
    keyed = rows.withColumn("k", F.md5(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string"))))
    ranges = keyed.filter("k is not null").groupBy(F.left("k", F.lit(4)).alias("range")).agg(F.count("*").alias("n")).orderBy("range").collect()  # 65,536 at most
    left = reference
    for r in ranges:
        if r["n"] >= left:
            break
        left -= r["n"]
    ranked = keyed.filter(F.left("k", F.lit(4)) == r["range"]).select("k", "id", F.row_number().over(Window.partitionBy(F.left("k", F.lit(4))).orderBy("k", "id")).alias("rank"))
    last = ranked.filter(F.col("rank") == left).first()
    within = (F.col("k") < last["k"]) | ((F.col("k") == last["k"]) & (F.col("id") <= last["id"]))
    return keyed.withColumn("counts", F.coalesce(within, F.lit(False)).cast("int")).drop("k")


def local_sparsity(vectors: DataFrame, id_col: str, vec_col: str, k: int = 16, reference: int = 2_000_000, seed: int = 7, unit: bool = False) -> DataFrame:
    """(id, sparsity): distance to the k-th nearest of the first *reference* rows in seeded order, or of all rows where there are no more.

    All rows are searched exactly. The rows are written in parts, one for each of
    many cells, and a task compares a part with the parts whose balls reach into
    what its rows found so far. Which cells there are changes the work, not the
    result, which is a written table. A row that is in the set is its own nearest. All rows get a value.
    *unit*: vectors are brought to length 1 first.
    """
    kind = vectors.schema[vec_col].dataType.simpleString()
    v = F.col(vec_col) if kind == "array<float>" else F.col(vec_col).cast("array<double>")
    rows = vectors.filter(F.col(vec_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), v.alias("v"))
    n = rows.count()
    cells = min(CELLS, -(-n // REFERENCE_BLOCK))
    every = F.pmod(F.xxhash64("id"), F.lit(max(1, n // (cells * CELL_ROWS)))) == 0 if n else F.lit(False)
    some = rows.filter(every).select("v").limit(2 * CELLS * CELL_ROWS).toArrow().column("v")
    centres = nearest.cells(nearest.lengthened(nearest.matrix(some), unit), max(1, cells)) if len(some) else None

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = nearest.lengthened(nearest.matrix(b.column(1)), unit)
            at = nearest.nearest(x, centres) if centres is not None else np.zeros(len(x))
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), *b.columns], names=["part", "id", "v", "counts"])

    placed = _counted(rows, n, reference, seed).mapInArrow(place, f"part int, id long, v {'array<float>' if kind == 'array<float>' else 'array<double>'}, counts int")
    held = materialize(placed.groupBy("part").applyInArrow(lambda t: nearest.part(t, unit), nearest.PART), "sparsity-parts", maxRecordsPerFile=1)
    known = held.select(F.input_file_name(), "part", "centre", "radius", F.expr("size(filter(weights, w -> w > 0))"), F.expr("aggregate(weights, 0L, (s, w) -> s + w)"), "other", F.expr("size(ids)")).collect()  # one row per cell
    known = sorted(known, key=lambda r: -r[7])
    inside = sum(r[5] for r in known)
    wanted = min(k, inside + sum(r[6] for r in known))
    sent = vectors.sparkSession.sparkContext.broadcast([(r[0], centres[r[1]] if centres is not None else r[2], *r[2:5]) for r in known])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = nearest.searcher(sent.value, wanted, unit)
        for b in batches:
            for i in b.column(0).to_pylist():
                ids, far = search(i) if inside >= wanted else nearest.unknown(sent.value[i][0])
                yield pa.RecordBatch.from_arrays([ids, pa.array(far)], names=["id", "sparsity"])

    todo = vectors.sparkSession.range(0, len(known), 1, max(1, len(known)))
    out = materialize(todo.mapInArrow(run, "id long, sparsity double").select(F.col("id").alias(id_col), "sparsity"), "sparsity")
    discard(held)
    sent.destroy()
    return out


def cluster_rarity(sparsity: DataFrame, cid: str, tau: float = 1.0, clip: float = 8.0) -> DataFrame:
    """(cid, rarity): median sparsity of the cluster over that of all, to the power tau, within [1/clip, clip]."""
    rows = materialize(sparsity.select(cid, "sparsity"), "rarity-rows")  # read for every pass of the medians
    all_rows = exact_percentiles(rows, "sparsity", [0.5])[0] or 1.0
    per = materialize(group_medians(rows, cid, "sparsity", "mc"), "rarity-medians")  # one row per cluster
    discard(rows)
    return per.select(cid, F.greatest(F.least(F.pow(F.col("mc") / all_rows, F.lit(tau)), F.lit(clip)), F.lit(1 / clip)).alias("rarity"))


def rarity_check(probed: DataFrame, least: int = 100) -> DataFrame:
    """One row: rank correlation of sparsity with being medium or hard, and the exponent it recommends.

    *probed* is (sparsity, tier); invalid rows are out. Ranks are averaged over
    ties; distances that agree in 12 digits are ties, so that rounding does not
    rank them. Too few rows or one class only: 0, 0.
    """
    t = probed.filter((F.col("tier") != "invalid") & F.col("sparsity").isNotNull()).select(F.round("sparsity", 12).alias("sparsity"), F.col("tier").isin("medium", "hard").cast("double").alias("y"))
    t = materialize(t, "rarity-probed")  # read for the cuts and for each side of the ranking
    # Average ranks from value counts: rows of one value share a rank. Values are ranked inside ranges between
    # approximate quantiles, whose totals are added up first, so no task sorts them all.
    values = t.groupBy("sparsity").agg(F.count("*").alias("n"), F.sum("y").alias("ny"))
    cuts = t.agg(F.percentile_approx("sparsity", [i / RANK_RANGES for i in range(1, RANK_RANGES)])).first()[0] or []
    splits = [-float("inf"), *sorted(set(cuts)), float("inf")]
    values = Bucketizer(splits=splits, inputCol="sparsity", outputCol="range").transform(values) if len(splits) > 2 else values.withColumn("range", F.lit(0.0))
    earlier = F.coalesce(F.sum("m").over(Window.partitionBy(F.lit(0)).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # one row per range
    totals = values.groupBy("range").agg(F.sum("n").alias("m")).select("range", earlier.alias("earlier"))
    inside = F.coalesce(F.sum("n").over(Window.partitionBy("range").orderBy("sparsity").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = values.join(F.broadcast(totals), "range").withColumn("rx", F.col("earlier") + inside + (F.col("n") + 1) / 2)
    g = ranked.agg(F.sum("n").alias("n"), F.sum("ny").alias("ny"), F.sum(F.col("n") * F.col("rx")).alias("sx"), F.sum(F.col("n") * F.col("rx") * F.col("rx")).alias("sxx"), F.sum(F.col("ny") * F.col("rx")).alias("sxy"))
    n, ny = F.col("n").cast("double"), F.col("ny")
    cov = F.col("sxy") - F.col("sx") * ny / n
    var_x, var_y = F.col("sxx") - F.col("sx") * F.col("sx") / n, ny - ny * ny / n
    rho = F.when((n >= least) & (var_x > 0) & (var_y > 0), cov / F.sqrt(var_x * var_y)).otherwise(0.0)
    out = materialize(g.select(F.coalesce("n", F.lit(0)).alias("n"), F.coalesce(rho, F.lit(0.0)).alias("rho")), "rarity-check")
    discard(t)
    return out.select("n", F.round("rho", 6).alias("rho"), F.when(F.col("rho") <= 0.05, 0.0).when(F.col("rho") < 0.15, 0.5).otherwise(1.0).alias("tau"))


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / F.greatest(norm(a) * norm(b), F.lit(1e-9))
