"""Problem 6: groups of similar records.

Vectors are scaled to unit length (direction counts), k-means runs distributed
with parallel oversampled seeding, and its cells - many more than groups - are
joined into groups where they touch. Every pass over the data is one
``mapInArrow`` with matrix products per Arrow batch and partial sums per
partition; only sums of the size cells x dimensions are shuffled.

A cell that is cut out of one group lies close to its neighbour compared with
the spread of both, whatever the group's spread, size or length; cells of
different groups lie far apart compared with it. So two cells touch when
|c1 - c2|^2 <= link x (s1 + s2), s being the unbiased mean square spread, and
groups are the connected cells. Their number starts at ``cells`` and is doubled
while there are more groups than GROUPED of the cells, or more rows than LOOSE in
cells too wide for one group, and that helps (and rows are enough for the cells),
so a corpus of many groups is not squeezed into few cells.
The cells' table is small, so it is joined on the driver.

Texts become vectors by signed hashing of their words' weights, sublinear in the
text and inverse to the texts that hold the word (:func:`text_vectors`).

Defined results: rows without a usable vector (NULL, empty, NULL or non-finite
values, all zeros, another length than the most frequent) are in no group, nor
are rows far outside their cell's spread. A record with several rows counts
once, by its latest usable row.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.session import materialize

from .tokens import slice_keys, text_runs

#: Cells that the k-means begins with, and rows that a cell has at least on average.
CELLS, ROWS_PER_CELL = 384, 15
#: Rounds and draws per round of the oversampled seeding.
SEED_ROUNDS, SEED_DRAWS = 5, 300
LLOYD_ROUNDS = 8
#: Groups for a cell, and share of rows in cells too wide for a group, from which the cells are doubled.
GROUPED, LOOSE = 0.25, 0.2
#: Touching cells: squared distance against the sum of the cells' mean square spreads.
LINK = 2.2
#: A record farther out than this times its cell's (pooled) spread is like no group.
REACH = 3.2
#: Records that a group needs.
MIN_GROUP = 5
#: Dimensions of hashed features, and slots in which the texts that hold a word are counted.
HASH_BUCKETS, WORD_SLOTS = 64, 1 << 18


def usable_vectors(df: DataFrame, id_col: str, vec_col: str, at_col: str | None = None) -> DataFrame:
    """(id, v): one unit vector per id, the latest usable one, as a written table; v is packed 32-bit floats.

    Vectors are checked and scaled per Arrow batch, so that what is shuffled and
    read again is one string of bytes a row. The most frequent length is told
    from the written table.
    """
    at = F.coalesce(F.unix_micros(at_col), F.lit(0)) if at_col else F.lit(0).cast("long")
    rows = df.filter(F.col(id_col).isNotNull() & (F.size(vec_col) > 0)).select(F.col(id_col).cast("long").alias("id"), at.alias("at"), F.col(vec_col).cast("array<float>").alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            column = b.column(2)
            ends = column.offsets.to_numpy()
            flat = column.values.slice(ends[0], ends[-1] - ends[0]).to_numpy(zero_copy_only=False).astype(np.float64)  # NULL members become NaN
            sizes = np.diff(ends)
            for width in np.unique(sizes).tolist():
                at_rows = np.flatnonzero(sizes == width)
                if not width or not len(at_rows):
                    continue
                x = flat[(ends[at_rows] - ends[0])[:, None] + np.arange(width)]
                with np.errstate(invalid="ignore", over="ignore"):
                    length = np.sqrt((x * x).sum(1))
                    good = np.isfinite(length) & (length > 1e-6)
                x = np.ascontiguousarray((x[good] / length[good, None]).astype(np.float32))
                part = b.take(pa.array(at_rows[good]))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(np.full(len(x), width, np.int32)), pack(x)], names=["id", "at", "d", "v"])

    once = rows.mapInArrow(run, "id long, at long, d int, v binary").groupBy("id", "d").agg(F.max(F.struct("at", "v")).alias("r")).select("id", "d", F.col("r.v").alias("v"))
    held = materialize(once, "cluster-vectors")  # stays for the caller's passes
    width = held.groupBy("d").count().orderBy(F.desc("count"), F.desc("d")).first()
    return held.filter(F.col("d") == (width["d"] if width else 0)).select("id", "v")


def pack(x: np.ndarray) -> pa.Array:
    """Rows of a matrix of 32-bit floats as strings of bytes, without a copy of each row."""
    ends = np.arange(len(x) + 1, dtype=np.int32) * (x.shape[1] * 4 if x.ndim == 2 else 0)
    return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(ends), pa.py_buffer(x.tobytes())])


def hashed_features(owner: np.ndarray, tokens: np.ndarray, weights: np.ndarray, n: int, buckets: int = HASH_BUCKETS) -> np.ndarray:
    """Signed hashed weights of the *tokens* of *n* texts, folded into *buckets* dimensions."""
    h = tokens.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    at = owner * buckets + ((h >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)
    return np.bincount(at, weights=np.where((h >> np.uint64(39)) & np.uint64(1) > 0, -weights, weights), minlength=n * buckets).reshape(n, buckets)


def _word_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, token, times) of the different words of each text; a token is the hash of a run of letters and digits, case aside."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    codes = np.frombuffer(("\x01" + "\x01".join(texts)).lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    if len(codes) != sizes.sum():  # a lower case of more than one sign: text by text
        parts = [_word_counts([t]) if len(t.lower()) == len(t) else _word_counts(["".join(c.lower()[0] for c in t)]) for t in texts]
        return tuple(np.concatenate([np.full(len(p[0]), i) if k == 0 else p[k] for i, p in enumerate(parts)]) for k in range(3))
    starts = np.cumsum(sizes) - sizes
    edge = np.diff(_wordlike()[codes].astype(np.int8), prepend=0, append=0)
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(begin):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    owner = np.searchsorted(starts, begin, side="right") - 1
    token = slice_keys(codes, begin, end)
    order = np.lexsort((token, owner))
    first = np.flatnonzero((np.diff(owner[order], prepend=-1) != 0) | (np.diff(token[order].view(np.int64), prepend=token[order[:1]].view(np.int64) + 1) != 0))
    return owner[order][first], token[order][first], np.diff(first, append=len(order))


@cache
def _wordlike() -> np.ndarray:
    t = np.zeros(0x110000, bool)
    for i in (*range(0x30, 0x3100), *range(0x3400, 0xA000), *range(0xAC00, 0xD7A4)):
        t[i] = chr(i).isalnum()
    return t


def text_vectors(df: DataFrame, id_col: str, text_col: str, buckets: int = HASH_BUCKETS) -> DataFrame:
    """(id, features): hashed weights of each text's words, (1 + ln times) x ln(texts / texts with the word).

    Texts with a word are counted in WORD_SLOTS slots, a table of fixed size that
    is sent to the workers. NULL texts and texts without a word have no features.
    """
    rows = df.filter(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = np.zeros(WORD_SLOTS, np.int64), 0
        for b in batches:
            for part in text_runs(b.column(1).to_pylist()):
                owner, token, _ = _word_counts(part)
                held += np.bincount((token % np.uint64(WORD_SLOTS)).astype(np.int64), minlength=WORD_SLOTS)
                n += len(part)
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(held[at], n))], names=["slot", "n"])

    got = rows.mapInArrow(count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()  # WORD_SLOTS rows at most
    slot, n = got.column("slot").to_numpy(), got.column("n").to_numpy()
    total, seen = int(n[slot == -1].sum()), np.zeros(WORD_SLOTS, np.int64)
    seen[slot[slot >= 0]] = n[slot >= 0]
    sent = rows.sparkSession.sparkContext.broadcast(np.log(max(total, 1) / np.maximum(seen, 1)).clip(0.0).astype(np.float32))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = 0
            for part in text_runs(b.column(1).to_pylist()):
                owner, token, times = _word_counts(part)
                weight = (1 + np.log(times)) * sent.value[(token % np.uint64(WORD_SLOTS)).astype(np.int64)] if len(token) else np.zeros(0)
                x = hashed_features(owner, token, weight, len(part), buckets).astype(np.float32)
                some = (x != 0).any(1)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(part)).filter(pa.array(some)), pa.array(list(x[some]), pa.list_(pa.float32()))], names=["id", "features"])
                at += len(part)

    return rows.mapInArrow(vectors, "id long, features array<float>").select(F.col("id").alias(id_col), "features")


def matrix(column: pa.Array) -> np.ndarray:
    """A column of packed vectors of one length as a matrix, without a copy of each row."""
    if not len(column):
        return np.zeros((0, 0), np.float32)
    _, ends, data = column.buffers()
    bounds = np.frombuffer(ends, np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]].view(np.float32).reshape(len(column), -1)


def nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of and squared distance to the nearest centre; ties go to the lowest index."""
    d = (centres * centres).sum(1)[None, :] - 2.0 * (x @ centres.T)
    best = d.argmin(1)
    return best, np.maximum(d[np.arange(len(x)), best] + (x * x).sum(1), 0.0)


def _uniform(ids: np.ndarray, seed: int) -> np.ndarray:
    """A number in [0, 1) per id and seed that does not depend on partitions."""
    with np.errstate(over="ignore"):
        h = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(31)
        h *= np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
    return (h >> np.uint64(11)).astype(np.float64) / float(1 << 53)


def _seed_pass(vectors: DataFrame, centres: np.ndarray, draws: float, total: float | None, seed: int) -> DataFrame:
    """One pass of seeding: rows drawn by their share of the cost, and the cost per partition.

    Without *total* only the cost is summed. Yields (id, v, cost).
    """
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.BinaryType()), T.StructField("cost", T.DoubleType())])
    sent = vectors.sparkSession.sparkContext.broadcast(centres)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cost = 0.0
        for b in batches:
            x = matrix(b.column(1)).astype(np.float32)
            _, d = nearest(x, sent.value)
            cost += float(d.sum())
            if total:
                hit = np.flatnonzero(_uniform(b.column(0).to_numpy(), seed) < draws * d / total)
                if len(hit):
                    part = b.take(pa.array(hit))
                    yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(d[hit].astype(float))], names=schema.names)
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([None], pa.binary()), pa.array([cost])], names=schema.names)

    return vectors.mapInArrow(run, schema)


def _cell_sums(vectors: DataFrame, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(count, vector sum, sum of squared distances) of each cell; partial sums per partition are added by a group-by."""
    schema = "cell int, n long, sum array<double>, ss double"
    sent = vectors.sparkSession.sparkContext.broadcast(centres)
    k, dims = centres.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, q = np.zeros(k, np.int64), np.zeros((k, dims)), np.zeros(k)
        for b in batches:
            x = matrix(b.column(0)).astype(np.float32)
            cell, d = nearest(x, sent.value)
            n += np.bincount(cell, minlength=k)
            q += np.bincount(cell, weights=d, minlength=k)
            order = np.argsort(cell, kind="stable")
            at = np.flatnonzero(np.diff(cell[order], prepend=-1))
            if len(at):
                s[cell[order][at]] += np.add.reduceat(x[order].astype(np.float64), at, axis=0)
        has = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(has.astype(np.int32)), pa.array(n[has]), pa.array(list(s[has]), pa.list_(pa.float64())), pa.array(q[has])], names=["cell", "n", "sum", "ss"])

    parts = vectors.select("v").mapInArrow(run, schema)
    total = parts.groupBy("cell").agg(F.sum("n").alias("n"), F.sum("ss").alias("ss"), F.array(*[F.sum(F.col("sum")[i]) for i in range(dims)]).alias("sum")).collect()
    n, s, q = np.zeros(k), np.zeros((k, dims)), np.zeros(k)
    for r in total:
        n[r["cell"]], s[r["cell"]], q[r["cell"]] = r["n"], r["sum"], r["ss"]
    return n, s, q


def _weighted_seeds(points: np.ndarray, weight: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k-means++ over the weighted candidates of the oversampling, then a few Lloyd rounds."""
    rng = np.random.default_rng(seed)
    k = min(k, len(points))
    chosen = [int(rng.choice(len(points), p=weight / weight.sum()))]
    d = ((points - points[chosen[0]]) ** 2).sum(1)
    while len(chosen) < k:
        p = weight * d
        if p.sum() <= 0:
            break
        chosen.append(int(rng.choice(len(points), p=p / p.sum())))
        d = np.minimum(d, ((points - points[chosen[-1]]) ** 2).sum(1))
    centres = points[chosen]
    for _ in range(10):
        cell, _ = nearest(points, centres)
        n = np.bincount(cell, weights=weight, minlength=len(centres))
        s = np.zeros_like(centres)
        np.add.at(s, cell, points * weight[:, None])
        centres = np.where(n[:, None] > 0, s / np.maximum(n, 1e-12)[:, None], centres)
    return centres


def fit_groups(vectors: DataFrame, cells: int = CELLS, seed: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(centres, group of each, reach of each), with twice the cells as long as there may be more groups than they can tell apart."""

    def grouped(cells: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int, float, float]:
        centres, n, spread = fit(vectors, cells, seed)
        group, reach = join_cells(centres, n, spread)
        return centres, group, reach, int(group.max(initial=-1)) + 1, float(n[group < 0].sum() / max(n.sum(), 1)), float(n.sum())

    now = grouped(cells)
    while now[5] >= 2 * cells * ROWS_PER_CELL and (now[3] > GROUPED * cells or now[4] > LOOSE):
        cells *= 2
        more = grouped(cells)
        if more[3] <= now[3] and more[4] > 0.8 * now[4]:
            break
        now = more
    return now[:3]


def fit(vectors: DataFrame, cells: int = CELLS, seed: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(centres, rows, mean square spread) of the k-means cells that hold rows.

    Seeding draws about SEED_DRAWS rows (more for more cells than CELLS, in
    proportion) in each of SEED_ROUNDS passes, each row by its share of the
    present cost; the candidates are weighted by their cells and reduced to
    *cells* centres.
    """
    first = vectors.orderBy(F.xxhash64(F.lit(seed), "id"), "id").limit(1).collect()
    if not first:
        return np.zeros((0, 1)), np.zeros(0), np.zeros(0)
    candidates = np.frombuffer(first[0]["v"], np.float32)[None, :]
    draws = max(SEED_DRAWS, cells * SEED_DRAWS // CELLS)
    total = _seed_pass(vectors, candidates, 0, None, seed).agg(F.sum("cost")).first()[0]
    for i in range(SEED_ROUNDS):
        if not total:
            break
        rows = _seed_pass(vectors, candidates, draws, total, seed + i + 1).collect()
        total = sum(r["cost"] for r in rows if r["v"] is None)
        drawn = sorted((r["id"], bytes(r["v"])) for r in rows if r["v"] is not None)
        if drawn:
            candidates = np.vstack([candidates, *[np.frombuffer(v, np.float32) for _, v in drawn]])
    n, _, _ = _cell_sums(vectors, candidates)
    # Spreads rest on enough rows.
    k = int(max(8, min(cells, n.sum() // ROWS_PER_CELL)))
    centres = _weighted_seeds(candidates.astype(np.float64), n + 1e-9, k, seed)
    n, s, q = _cell_sums(vectors, centres)
    for _ in range(LLOYD_ROUNDS):
        new = np.where(n[:, None] > 0, s / np.maximum(n, 1)[:, None], centres)
        moved = float(np.abs(new - centres).max())
        centres = new
        n, s, q = _cell_sums(vectors, centres)
        if moved < 1e-4:
            break
    keep = n > 0
    centres, n, s, q = centres[keep], n[keep], s[keep], q[keep]
    mean = s / n[:, None]
    spread = np.maximum(q - n * ((mean - centres) ** 2).sum(1), 0.0)
    return mean, n, spread / np.maximum(n - 1, 1)


def join_cells(centres: np.ndarray, n: np.ndarray, spread: np.ndarray, link: float = LINK) -> tuple[np.ndarray, np.ndarray]:
    """(group of each cell or -1, reach of each cell), groups numbered by their rows, largest first.

    Cells of very few rows have no spread of their own: they count as part of
    the nearest firm cell if they lie within its reach, else as a tail.
    """
    k = len(n)
    if not k:
        return np.zeros(0, int), np.zeros(0)
    firm = np.flatnonzero(n >= 4)
    if not len(firm):
        return np.full(k, -1), np.zeros(k)
    length = (centres * centres).sum(1)
    d = np.maximum(length[:, None] + length[None, :] - 2 * centres @ centres.T, 0.0)
    # A cell that gathers strays is wide: its spread tells no neighbourhood. It is measured against the firm cells' nearest ones.
    parent = np.arange(k)

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    tight = firm[spread[firm] <= STRAY_SPREAD]
    for a in range(len(tight)):
        i = tight[a]
        for j in tight[a + 1 :]:
            if d[i, j] <= link * (spread[i] + spread[j]):
                parent[root(i)] = root(j)
    label = np.full(k, -1)
    for i in tight:
        label[i] = root(i)
    reach = REACH * spread
    for i in range(k):
        if label[i] < 0 and len(tight):
            j = tight[d[i, tight].argmin()]
            own = spread[i] if n[i] > 1 else 0.0
            if n[i] < 4 and d[i, j] + own <= reach[j]:
                label[i], reach[i] = label[j], reach[j]
    sizes = {g: n[label == g].sum() for g in set(label[label >= 0].tolist())}
    rank = {g: r for r, (g, _) in enumerate(sorted(((g, c) for g, c in sizes.items() if c >= MIN_GROUP), key=lambda x: (-x[1], x[0])))}
    return np.array([rank.get(int(g), -1) for g in label]), reach


#: Mean square spread (of unit vectors: 1 - |mean|^2) above which a cell holds strays, not a group.
STRAY_SPREAD = 0.3


def assign(vectors: DataFrame, centres: np.ndarray, group: np.ndarray, reach: np.ndarray) -> DataFrame:
    """(id, grp, cell, dist): group -1 for rows beyond their cell's reach; dist is 1 - cosine to the cell's centre."""
    schema = "id long, grp int, cell int, dist double"
    sent = vectors.sparkSession.sparkContext.broadcast((centres, group, reach))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, g, r = sent.value
        length = np.linalg.norm(c, axis=1)
        for b in batches:
            x = matrix(b.column(1)).astype(np.float64)
            cell, d = nearest(x, c)
            grp = np.where(d <= r[cell], g[cell], -1)
            cos = (x * c[cell]).sum(1) / np.maximum(length[cell], 1e-12)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(grp.astype(np.int32)), pa.array(cell.astype(np.int32)), pa.array(1.0 - cos)], names=["id", "grp", "cell", "dist"])

    if not len(centres):
        return vectors.select("id", F.lit(-1).alias("grp"), F.lit(-1).alias("cell"), F.lit(None).cast("double").alias("dist"))
    return vectors.select("id", "v").mapInArrow(run, schema)


def cluster(df: DataFrame, id_col: str = "page_id", vec_col: str = "features", at_col: str | None = "indexed_at", cells: int = CELLS, seed: int = 1) -> DataFrame:
    """(id, grp, cell, dist) of every record with a usable vector."""
    vectors = usable_vectors(df, id_col, vec_col, at_col)
    return assign(vectors, *fit_groups(vectors, cells, seed))


def describe(assigned: DataFrame, typical: int = 5) -> DataFrame:
    """(grp, n_records, mean_dist, typical): each group's size and the *typical* records nearest to their cell's centre.

    The nearest of each (group, partition) are kept before the shuffle, so no
    group is gathered in one task.
    """
    from pyspark.sql import Window

    part = assigned.filter("grp >= 0").withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(64)))
    near = part.withColumn("rk", F.row_number().over(Window.partitionBy("grp", "salt").orderBy("dist", "id"))).filter(F.col("rk") <= typical)
    top = near.withColumn("rk", F.row_number().over(Window.partitionBy("grp").orderBy("dist", "id"))).filter(F.col("rk") <= typical).groupBy("grp").agg(F.transform(F.array_sort(F.collect_list(F.struct("rk", "id"))), lambda s: s["id"]).alias("typical"))
    return part.groupBy("grp").agg(F.count("*").alias("n_records"), F.avg("dist").alias("mean_dist")).join(top, "grp")
