"""Distances to the k-th nearest row of a set, exactly, part by part.

A part is the rows of one cell. Its copies are one vector with a weight; a file
holds it, so that a task reads just the parts that may hold near rows.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs

#: Rows of a part that are searched at once, rows that they are compared with at once, and rows that give a first bound.
QUERIES, ROWS, FIRST = 512, 2048, 1024
#: Distances that wait to be merged, as a multiple of those that are kept.
WAITING = 4
#: Bytes of parts that a Python worker keeps.
KEPT_BYTES = 160 << 20
#: Slack of bounds that are computed in double precision, as a share of the lengths or squares that they come from.
SLACK, SQUARE_SLACK = 1e-6, 1e-11

PART = "part int, ids array<long>, at array<int>, vectors binary, kind string, weights array<int>, centre array<double>, radius double, other long"


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def lengthened(x: np.ndarray, unit: bool) -> np.ndarray:
    """Rows in double precision, at length 1 where *unit*; a zero row stays zero."""
    x = x.astype(np.float64)
    return x / np.maximum(np.sqrt((x * x).sum(1)), 1e-9)[:, None] if unit else x


def cells(sample: np.ndarray, n: int, rounds: int = 5) -> np.ndarray:
    """Centres of about *n* cells: a short k-means over some rows. They say where a row is kept, not what is found."""
    sample = np.unique(sample[np.isfinite(sample).all(1)], axis=0)
    if not len(sample):
        return np.zeros((1, sample.shape[1]))
    c = sample[np.random.default_rng(0).permutation(len(sample))[:n]]
    for _ in range(rounds):
        at = nearest(sample, c)
        order, counts = np.argsort(at, kind="stable"), np.bincount(at, minlength=len(c))
        used = counts > 0
        c = np.add.reduceat(sample[order], (np.cumsum(counts) - counts)[used], axis=0) / counts[used][:, None]
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    half, step = (c * c).sum(1) / 2, max(1, (1 << 22) // len(c))
    return np.concatenate([np.zeros(0, np.int64), *[(half - x[s : s + step] @ c.T).argmin(1) for s in range(0, len(x), step)]])


def part(rows: pa.Table, unit: bool) -> pa.Table:
    """One row with the part that *rows* (part, id, v, counts) are: its different vectors, those of the set with their number of rows."""
    raw, counts = matrix(rows.column("v")), rows.column("counts").to_numpy().astype(np.int64)
    raw = np.ascontiguousarray(raw + raw.dtype.type(0))
    with np.errstate(all="ignore"):
        good = np.isfinite(lengthened(raw, unit)).all(1)
    held, back = np.unique(raw[good].view(np.dtype((np.void, raw.dtype.itemsize * raw.shape[1]))).ravel(), return_inverse=True)
    at = np.full(len(raw), -1, np.int32)
    at[good] = back
    weights = np.bincount(back, counts[good], minlength=len(held)).astype(np.int32)
    inside = lengthened(held.view(raw.dtype).reshape(-1, raw.shape[1])[weights > 0], unit)
    centre = inside.mean(0) if len(inside) else np.zeros(raw.shape[1])
    radius = np.sqrt(((inside - centre) ** 2).sum(1).max()) if len(inside) else 0.0
    values = [rows.column("part")[0].as_py(), rows.column("id").combine_chunks(), at, held.tobytes(), raw.dtype.str, weights, centre, radius, int(counts[~good].sum())]
    lists = {"ids": pa.list_(pa.int64()), "at": pa.list_(pa.int32()), "weights": pa.list_(pa.int32()), "centre": pa.list_(pa.float64())}
    names = [c.split()[0] for c in PART.split(", ")]
    one = {n: pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), pa.array(v, lists[n].value_type)) if n in lists else pa.array([v], {"part": pa.int32(), "other": pa.int64()}.get(n)) for n, v in zip(names, values, strict=True)}
    return pa.table(one)


_PARTS: OrderedDict[str, tuple[np.ndarray, np.ndarray]] = OrderedDict()


def _table(path: str, columns: list[str]) -> pa.Table:
    system, name = fs.FileSystem.from_uri(path)
    with system.open_input_file(name) as f:
        return pq.read_table(f, columns=columns)


def _vectors(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    weights = t.column("weights").combine_chunks().flatten().to_numpy()
    x = np.frombuffer(t.column("vectors")[0].as_buffer(), np.dtype(t.column("kind")[0].as_py()))
    return x.reshape(len(weights), -1), weights


def _members(path: str) -> tuple[np.ndarray, np.ndarray]:
    """Vectors and weights of the part's rows that are in the set; a worker keeps those it used last."""
    if path in _PARTS:
        _PARTS.move_to_end(path)
    else:
        x, w = _vectors(_table(path, ["vectors", "kind", "weights"]))
        _PARTS[path] = (x, w) if w.all() else (x[w > 0], w[w > 0])
        while len(_PARTS) > 1 and sum(x.nbytes for x, _ in _PARTS.values()) > KEPT_BYTES:
            _PARTS.popitem(last=False)
    return _PARTS[path]


class _Best:
    """The k smallest squared distances of each row so far, counted with weights."""

    def __init__(self, n: int, k: int, most: np.ndarray) -> None:
        self.k, self.kept, self.most = k, np.full((n, k), np.inf), most
        self.rows: list[np.ndarray] = []
        self.found: list[np.ndarray] = []
        self.waiting = 0

    def add(self, rows: np.ndarray, found: np.ndarray, weights: np.ndarray) -> None:
        if (weights > 1).any():
            times = np.minimum(weights, self.k)
            rows, found = np.repeat(rows, times), np.repeat(found, times)
        self.rows.append(rows)
        self.found.append(found)
        self.waiting += len(rows)
        if self.waiting > WAITING * self.kept.size:
            self.merge()

    def merge(self) -> None:
        if not self.waiting:
            return
        rows, found = np.concatenate(self.rows), np.concatenate(self.found)
        order = np.argsort(rows.astype(np.int16), kind="stable")
        rows, found = rows[order], found[order]
        counts = np.bincount(rows, minlength=len(self.kept))
        wide = np.full((len(self.kept), self.k + counts.max()), np.inf)
        wide[:, : self.k] = self.kept
        wide[rows, self.k + np.arange(len(rows)) - (np.cumsum(counts) - counts)[rows]] = found
        wide.partition(self.k - 1, axis=1)
        self.kept = wide[:, : self.k].copy()
        np.minimum(self.most, self.kept[:, -1], out=self.most)
        self.rows, self.found, self.waiting = [], [], 0


def _true(mask: np.ndarray) -> np.ndarray:
    """Places of the few true values, found by words of eight."""
    flat = mask.reshape(-1, 8)
    words = np.flatnonzero(flat.view(np.uint64).ravel() != 0)
    at = np.flatnonzero(flat[words])
    return words[at >> 3] * 8 + (at & 7)


class _Tile:
    """Some rows of a part, about *origin*, and the parts that may hold near rows of theirs."""

    def __init__(self, q: np.ndarray, origin: np.ndarray, start: np.ndarray, k: int) -> None:
        self.q, self.a = q, q - origin
        self.na = (self.a * self.a).sum(1)
        # Any k rows of the set bound the k-th nearest from above; with fewer, all of them.
        b = start - origin
        d = (b * b).sum(1) - 2 * (self.a @ b.T)
        near = np.argpartition(d, k - 1, axis=1)[:, :k] if d.shape[1] > k else np.broadcast_to(np.arange(d.shape[1]), d.shape)
        self.best = _Best(len(q), k, ((q[:, None, :] - start[near]) ** 2).sum(2).max(1) * (1 + SLACK))

    def bounds(self, parts: _Known, own: int, origin: np.ndarray) -> None:
        """Least distances to the rows of every part: they lie in a ball, and nearer to their cell's site than to the site of the tile's cell."""
        squares = []
        for c in (parts.centres - origin, parts.sites - origin):
            nc = (c * c).sum(1)
            squares.append((self.na[:, None] + nc - 2 * (self.a @ c.T), np.sqrt(self.na)[:, None] + np.sqrt(nc)))
        (to_centre, lengths), (to_site, reach) = squares
        ball = np.sqrt(np.maximum(to_centre, 0)) - parts.radii - SLACK * (lengths + parts.radii)
        apart = np.sqrt(((parts.sites - parts.sites[own]) ** 2).sum(1))
        half = (to_site - to_site[:, own : own + 1] - SQUARE_SLACK * (reach + reach[:, own : own + 1]) ** 2) / (2 * np.where(apart > 0, apart, np.inf))
        self.bound = np.maximum(ball, half)

    def compare(self, p: int, x: np.ndarray, weights: np.ndarray, nb: np.ndarray, right: np.ndarray) -> None:
        """Add the near rows *x* of part *p*.

        A product in single precision leaves out pairs that are farther by more than
        its error; the others are measured by their differences in double precision.
        """
        best = self.best
        which = np.flatnonzero(self.bound[:, p] <= np.sqrt(best.most))
        if not len(which):
            return
        reach = np.sqrt(self.na[which].max()) + np.sqrt(nb.max())
        error = 2 * (x.shape[1] + 8) * np.finfo(right.dtype).eps * reach * reach + 1e-30
        left = np.empty((len(which), x.shape[1] + 2), right.dtype)
        left[:, :-2], left[:, -2] = self.a[which], 1
        for s in range(0, right.shape[1], ROWS):
            left[:, -1] = np.minimum((best.most[which] - self.na[which] + error) / 2, reach * reach)
            at = _true(left @ right[:, s : s + ROWS] >= 0)
            if not len(at):
                continue
            rows, cols = np.divmod(at, min(ROWS, right.shape[1] - s))
            rows, cols = which[rows], cols + s
            d = ((self.q[rows] - x[cols]) ** 2).sum(1)
            near = d <= best.most[rows]
            best.add(rows[near], d[near], weights[cols[near]])


class _Known:
    """What a task knows of all parts, from (path, site, centre, radius, different vectors of the set)."""

    def __init__(self, parts: list[tuple]) -> None:
        self.paths = [p[0] for p in parts]
        self.sites, self.centres, self.radii, self.sizes = (np.array([p[i] for p in parts]) for i in (1, 2, 3, 4))


def search(parts: _Known, own: int, k: int, unit: bool) -> tuple[pa.Array, np.ndarray]:
    """Ids of a part's rows and their distances to the k-th nearest row of the set, NaN for rows that are not finite."""
    t = _table(parts.paths[own], ["ids", "at", "vectors", "kind", "weights"])
    queries, tiles = lengthened(_vectors(t)[0], unit), []
    if len(queries):
        origin = queries.mean(0)
        order = np.argsort(((parts.centres - origin) ** 2).sum(1), kind="stable")
        order = order[parts.sizes[order] > 0]
        first = order[: np.searchsorted(np.cumsum(parts.sizes[order]), k) + 1]
        start = np.concatenate([_members(parts.paths[p])[0] for p in first])
        start = lengthened(start[:: max(1, len(start) // max(FIRST, k))], unit)
        tiles = [_Tile(queries[s : s + QUERIES], origin, start, k) for s in range(0, len(queries), QUERIES)]
        for tile in tiles:
            tile.bounds(parts, own, origin)
        widest = np.sqrt(max(tile.na.max() for tile in tiles))
        for p in order:
            if not any((tile.bound[:, p] <= np.sqrt(tile.best.most)).any() for tile in tiles):
                continue
            x, w = _members(parts.paths[p])
            x = lengthened(x, unit)
            b = x - origin
            nb = (b * b).sum(1)
            kind = np.dtype(np.float32 if widest + np.sqrt(nb.max()) < 1e15 else np.float64)
            right = np.zeros((b.shape[1] + 2, -(-len(b) // 8) * 8), kind)
            right[-2] = np.finfo(kind).min  # columns beyond the rows are near to none
            right[:-2, : len(b)], right[-2, : len(b)], right[-1, : len(b)] = b.T, -nb / 2, 1
            for tile in tiles:
                tile.compare(p, x, w, nb, right)
                if p == order[0]:
                    tile.best.merge()
    for tile in tiles:
        tile.best.merge()
    at = t.column("at").combine_chunks().flatten().to_numpy()
    return t.column("ids").combine_chunks().flatten(), np.sqrt(np.concatenate([*[tile.best.kept[:, -1] for tile in tiles], [np.nan]]))[at]


def unknown(path: str) -> tuple[pa.Array, np.ndarray]:
    """Ids of a part's rows, where too few rows of the set are finite."""
    ids = _table(path, ["ids"]).column("ids").combine_chunks().flatten()
    return ids, np.full(len(ids), np.nan)


def searcher(parts: list[tuple], k: int, unit: bool) -> Callable[[int], tuple[pa.Array, np.ndarray]]:
    """Search by a part's number in *parts*."""
    known = _Known(parts)
    return lambda own: search(known, own, k, unit)
