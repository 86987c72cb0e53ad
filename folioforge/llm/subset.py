"""Problem 2: a subset that shows the variety of the data.

Every record has mass in its similarity group and, less, in the few nearest
k-means cells; the subset maximises the sum over groups and cells of the square
root of its mass there. A crowded group fills up soon and then gains little, so
it cannot take most of the places.

Selection runs in rounds with a falling threshold. A round computes every
record's gain over what is selected, in one pass; records whose gain reaches the
threshold line up behind the others of their main slot (the group, else the
nearest cell), by gain, and each counts those before it in line as selected
already. A line is cut where the gain falls below the threshold. As a record
that fails behind its batch's records fails behind all of them too, a batch
hands on only the part of its lines that passes; the rest of a line is ranked in
salted parts first, so that a group with any share of all records is one task's
only where it is short. Records that passed stand in the line of each of their
slots once more, and stay if their gain behind all before them there still
reaches the threshold. What is selected is a table; the driver holds the mass
vectors (requests x slots) and one count per request.

Defined results: a record counts once (its latest row), under its latest
subtask; records without a usable vector have no mass and are taken only when
nothing else is left; a request for more than there is gets all there is; ties
go to the lower hash of the id, and nothing depends on partitions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioforge.operators.ranking import value_at
from folioforge.operators.sampling import draw
from folioforge.session import discard, materialize

from . import clusters

#: Cells a record spreads its mass over, the cosine from which a cell counts, and their mass against the group's 1.
NEAREST, LEAST_COSINE, CELL_MASS = 3, 0.3, 0.03
#: A round's threshold as a share of the best gain left, and the gain below which records count as without any.
FALL, LEAST_GAIN = 0.7, 1e-9
#: Parts in which a line is ranked before it is ranked whole.
SALTS = 64

LINED = "request_id int, page_id long, slot int, held double, mass float, rest double, gain double, tie double"


def masses(index: DataFrame) -> DataFrame:
    """(page_id, subtask, idx, mass): each record's nearest cells and its mass in them."""
    vectors = clusters.usable_vectors(index, "page_id", "features", "indexed_at")
    centres, group, reach = clusters.fit_groups(vectors)
    norm = np.linalg.norm(centres, axis=1, keepdims=True)
    unit = (centres / np.maximum(norm, 1e-12)).astype(np.float32)
    sent = vectors.sparkSession.sparkContext.broadcast((unit, centres, group, reach))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not len(b):
                continue
            unit, centres, group, reach = sent.value
            x = clusters.matrix(b.column(1)).astype(np.float32)
            cos = x @ unit.T
            k = min(NEAREST, cos.shape[1])
            idx = np.argpartition(-cos, k - 1, axis=1)[:, :k]
            m = np.maximum((np.take_along_axis(cos, idx, 1) - LEAST_COSINE) / (1 - LEAST_COSINE), 0.0) ** 2
            m *= CELL_MASS / np.maximum(m.sum(1, keepdims=True), 1e-9)
            cell, d = clusters.nearest(x.astype(np.float64), centres)
            inside = (group[cell] >= 0) & (d <= reach[cell])
            idx = np.column_stack([idx, len(centres) + np.maximum(group[cell], 0)])
            m = np.column_stack([m, inside])
            ends = pa.array(np.arange(len(b) + 1, dtype=np.int32) * (k + 1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(ends, pa.array(idx.ravel().astype(np.int32))), pa.ListArray.from_arrays(ends, pa.array(m.ravel().astype(np.float32)))], names=["page_id", "idx", "mass"])

    with_mass = vectors.select("id", "v").mapInArrow(run, "page_id long, idx array<int>, mass array<float>") if len(centres) else None
    pages = index.filter("page_id is not null and subtask is not null").groupBy("page_id").agg(F.max_by("subtask", F.struct(F.coalesce(F.unix_micros("indexed_at"), F.lit(0)), "subtask")).alias("subtask"))
    if with_mass is None:
        return pages.select("page_id", "subtask", F.array().cast("array<int>").alias("idx"), F.array().cast("array<float>").alias("mass"))
    empty = F.array().cast("array<int>"), F.array().cast("array<float>")
    return pages.join(with_mass, "page_id", "left").select("page_id", "subtask", F.coalesce("idx", empty[0]).alias("idx"), F.coalesce("mass", empty[1]).alias("mass"))


def _dense(idx: pa.Array, mass: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Equal-width matrices of cells and masses; short rows are padded with mass 0."""
    ends = idx.offsets.to_numpy()
    sizes = np.diff(ends)
    width = int(sizes.max()) if len(sizes) else 0
    place = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    row = np.repeat(np.arange(len(sizes)), sizes)
    i, m = np.zeros((len(sizes), max(width, 1)), np.int64), np.zeros((len(sizes), max(width, 1)))
    i[row, place] = idx.flatten().to_numpy()
    m[row, place] = mass.flatten().to_numpy()
    return i, m


def gains(i: np.ndarray, m: np.ndarray, held: np.ndarray) -> np.ndarray:
    """What each record adds to the sum of square roots over *held* masses."""
    now = held[i]
    return (np.sqrt(now + m) - np.sqrt(now)).sum(1)


def _order(ids: np.ndarray) -> np.ndarray:
    """A fixed pseudo-random number per id, for ties."""
    return clusters._uniform(ids, 5)


def line_up(slot: np.ndarray, gain: np.ndarray, tie: np.ndarray, held: np.ndarray, mass: np.ndarray, rest: np.ndarray, threshold: float) -> np.ndarray:
    """The rows that pass: by slot, in order of gain and tie, up to the first whose gain behind those before it misses the threshold."""
    order = np.lexsort((tie, -gain, slot))
    s = slot[order]
    place = np.arange(len(s)) - np.searchsorted(s, s)
    before = held[order] + place * mass[order]
    fails = np.sqrt(before + mass[order]) - np.sqrt(before) + rest[order] < threshold
    return order[np.cumsum(fails) - np.concatenate(([0], np.cumsum(fails)))[np.searchsorted(s, s)] == 0]


def _pass(todo: dict[int, tuple[np.ndarray, float]]):
    """Records that pass in their batch's lines, and with a NULL id the best gain below the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, float] = {}
        for b in batches:
            if not len(b):
                continue
            ids, asked = b.column(1).to_numpy(), b.column(0).to_numpy()
            i, m = _dense(b.column(2), b.column(3))
            for k in np.unique(asked).tolist():
                held, threshold = todo[k]
                at = np.flatnonzero(asked == k)
                now = held[i[at]]
                each = np.sqrt(now + m[at]) - np.sqrt(now)
                gain = each.sum(1)
                low = gain < threshold
                if low.any():
                    best[k] = max(best.get(k, 0.0), float(gain[low].max()))
                at, each, gain = at[~low], each[~low], gain[~low]
                if not len(at):
                    continue
                main = m[at].argmax(1)[:, None]
                slot, mass = (np.take_along_axis(x[at], main, 1)[:, 0] for x in (i, m))
                rest = gain - np.take_along_axis(each, main, 1)[:, 0]
                tie = _order(ids[at])
                keep = line_up(slot, gain, tie, held[slot], mass, rest, threshold)
                if len(keep) < len(at):  # what was cut gains just less than the threshold
                    best[k] = threshold
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keep), k, np.int32)), pa.array(ids[at][keep]), pa.array(slot[keep].astype(np.int32)), pa.array(held[slot][keep]), pa.array(mass[keep].astype(np.float32)), pa.array(rest[keep]), pa.array(gain[keep]), pa.array(tie[keep])], names=[f.split()[0] for f in LINED.split(", ")])
        for k, g in best.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([None], pa.int64()), pa.array([None], pa.int32()), pa.array([None], pa.float64()), pa.array([None], pa.float32()), pa.array([None], pa.float64()), pa.array([g]), pa.array([None], pa.float64())], names=[f.split()[0] for f in LINED.split(", ")])

    return run


def _cut(lined: DataFrame, thresholds: dict[int, float], *by: str) -> DataFrame:
    """The part of each line that passes, lines being parted by *by* besides request and slot."""
    w = Window.partitionBy("request_id", "slot", *by).orderBy(F.desc("gain"), "tie", "page_id")
    limit = F.element_at(F.create_map(*[F.lit(x) for kv in thresholds.items() for x in kv]), F.col("request_id"))
    before = F.col("held") + (F.row_number().over(w) - 1) * F.col("mass")
    fails = F.sqrt(before + F.col("mass")) - F.sqrt(before) + F.col("rest") < limit - 1e-12
    return lined.withColumn("fails", fails).withColumn("failed", F.max("fails").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))).filter("not failed").drop("fails", "failed")


def _settle(passed: DataFrame, candidates: DataFrame, todo: dict[int, tuple[np.ndarray, float]]) -> DataFrame:
    """(request_id, page_id, gain) of the *passed* whose gain behind all before them, in the lines of all their slots, reaches the threshold."""
    slots = passed.select("request_id", "page_id", "gain", "tie").join(candidates, ["request_id", "page_id"]).select("request_id", "page_id", "gain", "tie", F.explode(F.arrays_zip("idx", "mass")).alias("s")).select("request_id", "page_id", "gain", "tie", F.col("s.idx").alias("slot"), F.col("s.mass").cast("double").alias("m")).filter("m > 0")
    w = Window.partitionBy("request_id", "slot").orderBy(F.desc("gain"), "tie", "page_id").rowsBetween(Window.unboundedPreceding, -1)
    now = passed.sparkSession.createDataFrame([(k, i, float(h)) for k, (held, _) in todo.items() for i, h in enumerate(held.tolist()) if h] or [(-1, -1, 0.0)], "request_id int, slot int, h double")
    at = slots.withColumn("before", F.coalesce(F.sum("m").over(w), F.lit(0.0))).join(F.broadcast(now), ["request_id", "slot"], "left").withColumn("before", F.col("before") + F.coalesce("h", F.lit(0.0)))
    each = F.sqrt(F.col("before") + F.col("m")) - F.sqrt("before")
    limit = F.element_at(F.create_map(*[F.lit(x) for k, (_, t) in todo.items() for x in (k, t)]), F.col("request_id"))
    return at.groupBy("request_id", "page_id").agg(F.sum(each).alias("gain")).filter(F.col("gain") >= limit - 1e-9)


def select(pages: DataFrame, requests: DataFrame) -> DataFrame:
    """(request_id, page_id, turn, gain) of every request's subset: the round that took the record, and its gain behind those before it.

    The requests are few; their subsets are of any size.
    """
    spark = pages.sparkSession
    wanted = requests.filter("request_id is not null and subtask is not null and subset_size > 0").groupBy("request_id").agg(F.max(F.struct("subtask", "subset_size")).alias("r")).select("request_id", "r.*").collect()
    names = spark.createDataFrame([(r["request_id"], r["subtask"]) for r in wanted], "request_id int, subtask string")
    left = {r["request_id"]: int(r["subset_size"]) for r in wanted}
    slots = (pages.agg(F.max(F.array_max("idx"))).first()[0] if left else None) or 0
    held = {k: np.zeros(slots + 1) for k in left}
    threshold = dict.fromkeys(left, np.inf)  # the first pass only looks for the best gain
    chosen: DataFrame | None = None
    turn = 0
    candidates = pages.join(F.broadcast(names), "subtask").select("request_id", "page_id", "idx", "mass")  # one row per request
    while left:
        open_rows = candidates.filter(F.col("request_id").isin(list(left)))
        if chosen is not None:
            open_rows = open_rows.join(chosen.select("request_id", "page_id"), ["request_id", "page_id"], "left_anti").select("request_id", "page_id", "idx", "mass")
        todo = {k: (held[k], threshold[k]) for k in left}
        ends = {k for k in left if threshold[k] <= 0}
        lined = materialize(open_rows.mapInArrow(_pass(todo), LINED), "subset-lines")
        rows = lined.filter("page_id is not null")
        passed = rows.filter(~F.col("request_id").isin(list(ends))) if ends else rows
        salted = _cut(passed.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS))), {k: t for k, t in threshold.items() if k in left}, "salt").drop("salt")
        taken = _settle(_cut(salted, {k: t for k, t in threshold.items() if k in left}), candidates, todo)
        if ends:  # records without gain, by their hash alone
            taken = taken.unionByName(rows.filter(F.col("request_id").isin(list(ends))).select("request_id", "page_id", "gain"))
        taken = materialize(taken, "subset-taken")
        count = {r["request_id"]: r["n"] for r in taken.groupBy("request_id").agg(F.count("*").alias("n")).collect()}
        over = {k: left[k] for k, n in count.items() if n > left[k]}
        if over:  # the last round of these: their best, by a cut in their gains, and of those on the cut the first by hash
            cuts = {k: value_at(taken.filter(F.col("request_id") == k).select(F.round("gain", 12).alias("x")), count[k] - n, count[k]) for k, n in over.items()}
            cut = F.element_at(F.create_map(*[F.lit(x) for k in count for x in (k, cuts.get(k, -1.0))]), F.col("request_id"))
            gain = F.round("gain", 12)
            above = taken.filter(gain > cut)
            n_above = {r["request_id"]: r["n"] for r in above.groupBy("request_id").agg(F.count("*").alias("n")).collect()}
            quotas = spark.createDataFrame([(k, n - n_above.get(k, 0)) for k, n in over.items()], "request_id int, quota long")
            part = materialize(above.unionByName(draw(taken.filter(gain == cut), quotas, ["request_id"], "page_id").select("request_id", "page_id", "gain")), "subset-drawn")
            discard(taken)
            taken = part
        best = {r["request_id"]: (r["below"], r["offered"]) for r in lined.groupBy("request_id").agg(F.max(F.when(F.col("page_id").isNull(), F.col("gain"))).alias("below"), F.count("page_id").alias("offered")).collect()}
        for r in taken.join(candidates, ["request_id", "page_id"]).select("request_id", F.explode(F.arrays_zip("idx", "mass")).alias("s")).groupBy("request_id", F.col("s.idx").alias("i")).agg(F.sum("s.mass").alias("m")).collect():  # requests x slots
            held[r["request_id"]][r["i"]] += r["m"]
        discard(lined)
        new = taken.withColumn("turn", F.lit(turn))
        if chosen is not None:
            new = chosen.unionByName(new)
        new = materialize(new, "subset-chosen")
        discard(taken)
        discard(chosen)
        chosen, turn = new, turn + 1
        for k in list(left):
            below, offered = best.get(k, (None, 0))
            got = min(count.get(k, 0), left[k])
            left[k] -= got
            if left[k] <= 0 or k in ends or k not in best:
                del left[k]
                continue
            # Where a line was cut, gains reach just below the threshold; else follow the best gain left.
            top = threshold[k] if np.isfinite(threshold[k]) and offered > got else min(below or 0.0, threshold[k])
            threshold[k] = FALL * top if top > LEAST_GAIN else 0.0
    if chosen is None:
        return spark.createDataFrame([], "request_id int, page_id long, turn int, gain double")
    return chosen.select("request_id", "page_id", "turn", "gain")
