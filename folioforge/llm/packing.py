"""Problem 8: documents in containers of fixed capacity, in tokens.

Sizes are counted once per document and tokenizer. Their global histogram (at
most *capacity* lengths) goes to the driver, where dynamic programming chooses
the length buckets with the least padding. Each bucket counts as its upper
bound, so a container is a handful of bucket counts: containers are filled
longest bucket first, and one such pattern is repeated while its buckets last.
There are about as many patterns as buckets, whatever the number of documents.
A document's rank within its bucket - counted in hash ranges, so that a bucket
with any share of all documents is ranked in many tasks - tells its container.

Buckets alone would leave half a container beside every item longer than half
the capacity, so a batch begun in one bucket is topped up from shorter ones;
without *top_up* every container is of one bucket.

Defined results: an item longer than the capacity is cut into full containers
and a rest that is packed like any other; empty and NULL texts have no tokens
and are spread over the containers; documents that share an id are packed
apart; an empty table gives no rows. Ranks follow the hash of a document's id,
sizes and number among equal ones, so nothing depends on partitions.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.session import materialize

from . import tokens
from .tokens import TOKENIZER_DIR, encoder, text_runs, unique_slices

#: Length buckets per profile.
BUCKETS = 256
#: Rows that one ranking task should hold at most.
RANK_ROWS = 100_000
#: Words whose counts a worker holds before it starts afresh.
CACHE_WORDS = 1 << 20

_UNITS = re.compile(r" *[^ ]+| +$")


class ByteCounter:
    """Counts of byte-level vocabularies that share one pattern: words are located once for all of them."""

    def __init__(self, names: list[str], directory: str):
        self.encoders = [encoder(n, directory) for n in names]
        self.known: dict[str, tuple[int, ...]] = {}

    def count(self, texts: list[str]) -> list[np.ndarray]:
        out = [np.zeros(len(texts), np.int64) for _ in self.encoders]
        at = 0
        for part in text_runs(texts):
            sizes = np.fromiter(map(len, part), np.int64, len(part))
            joined = "\n" + "\n".join(part)
            codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
            starts = np.zeros(len(part), np.int64)
            np.cumsum(sizes[:-1] + 1, out=starts[1:])
            begin = tokens.find_slices(codes, starts)
            end = np.append(begin[1:], len(codes))
            mark = np.zeros(len(codes), bool)
            mark[starts] = True
            keep = ~mark[begin]
            begin, end = begin[keep], end[keep]
            if len(begin):
                first, inverse = unique_slices(joined, codes, begin, end, ~mark)
                counts = np.array([self._word(joined[a:b]) for a, b in zip(begin[first].tolist(), end[first].tolist())], np.int64)
                owner = np.searchsorted(starts, begin, side="right") - 1
                for k in range(len(self.encoders)):
                    out[k][at : at + len(part)] = np.bincount(owner, weights=counts[inverse, k], minlength=len(part))
            at += len(part)
        return out

    def _word(self, word: str) -> tuple[int, ...]:
        got = self.known.get(word)
        if got is None:
            piece = word.encode("utf-8", "replace")
            got = tuple(1 if piece in e.ranks else len(e.merge(piece)) for e in self.encoders)
            if len(self.known) >= CACHE_WORDS:
                self.known.clear()
            self.known[word] = got
        return got


class WordCounter:
    """Counts of a vocabulary that drops white space: a text has the sum of its words' tokens."""

    def __init__(self, name: str, directory: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(os.path.join(directory, f"{name}.json"))
        self.tok.encode_special_tokens = True
        self.known: dict[str, int] = {}

    def count(self, texts: list[str]) -> list[np.ndarray]:
        known, out = self.known, []
        for t in texts:
            n = 0
            for w in t.split():
                c = known.get(w)
                if c is None:
                    if len(known) >= CACHE_WORDS:
                        known.clear()
                    c = known[w] = len(self.tok.encode(w, add_special_tokens=False).ids)
                n += c
            out.append(n)
        return [np.array(out, np.int64)]


class PieceCounter:
    """Counts of a piece vocabulary whose pieces hold blanks only in front: units of blanks and a word are counted once."""

    def __init__(self, name: str, directory: str):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=os.path.join(directory, f"{name}.model"))
        self.known: dict[str, int] = {}

    def count(self, texts: list[str]) -> list[np.ndarray]:
        known, out = self.known, []
        for t in texts:
            n = 0
            for i, u in enumerate(_UNITS.findall(t)):
                if i and u[0] == " ":
                    u = u[1:]  # the model puts a blank before every text
                    if not u:
                        n += 1
                        continue
                c = known.get(u)
                if c is None:
                    if len(known) >= CACHE_WORDS:
                        known.clear()
                    c = known[u] = len(self.sp.encode(u))
                n += c
            out.append(n)
        return [np.array(out, np.int64)]


@cache
def counters(names: tuple[str, ...], directory: str) -> list:
    """(counter, names it counts) of the tokenizers, by the kind of their file."""
    files = set(os.listdir(directory))
    byte = [n for n in names if f"{n}.tiktoken" in files]
    out: list = [(ByteCounter(byte, directory), byte)] if byte else []
    for n in names:
        if n in byte:
            continue
        if f"{n}.model" in files:
            out.append((PieceCounter(n, directory), [n]))
        elif f"{n}.json" in files:
            with open(os.path.join(directory, f"{n}.json")) as f:
                drops = "Replace" in json.dumps(json.load(f)["normalizer"])
            if not drops:
                raise ValueError(f"{n}: its words aren't apart at white space")
            out.append((WordCounter(n, directory), [n]))
        else:
            raise ValueError(f"no tokenizer {n} in {directory}")
    return out


def token_sizes(docs: DataFrame, names: list[str], directory: str = TOKENIZER_DIR) -> DataFrame:
    """(doc_id, one column per tokenizer) with every document's number of tokens; one narrow pass."""
    names = sorted(set(names))
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *[T.StructField(n, T.LongType()) for n in names]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            got: dict[str, np.ndarray] = {}
            for counter, own in counters(tuple(names), directory):
                got |= dict(zip(own, counter.count(texts)))
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(got[n]) for n in names]], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def bucket_bounds(lengths: np.ndarray, counts: np.ndarray, buckets: int = BUCKETS) -> np.ndarray:
    """Upper bounds of at most *buckets* buckets over the sorted *lengths* with the least total padding.

    Dynamic programming over buckets; as padding obeys the quadrangle
    inequality, best split points are monotone, so each layer is solved by
    halving: all middles of one depth are evaluated in one vectorised step.
    """
    m = len(lengths)
    if m <= buckets:
        return lengths
    number, mass = np.concatenate(([0.0], np.cumsum(counts))), np.concatenate(([0.0], np.cumsum(counts * lengths)))

    def padding(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Padding of a bucket of lengths[i:j]."""
        return (number[j] - number[i]) * lengths[j - 1] - (mass[j] - mass[i])

    best = np.concatenate(([0.0], padding(np.zeros(m, int), np.arange(1, m + 1))))
    splits = []
    for _ in range(buckets - 1):
        new, at = best.copy(), np.zeros(m + 1, int)
        jobs = [(1, m, 0, m - 1)]
        while jobs:
            a = np.array(jobs)
            mid = (a[:, 0] + a[:, 1]) // 2
            low, high = a[:, 2], np.minimum(a[:, 3], mid - 1)
            size = high - low + 1
            offset = np.cumsum(size) - size
            i = np.arange(size.sum()) - np.repeat(offset - low, size)
            value = best[i] + padding(i, np.repeat(mid, size))
            least = np.minimum.reduceat(value, offset)
            first = np.flatnonzero(value == np.repeat(least, size))
            pick = first[np.searchsorted(first, offset)]
            new[mid], at[mid] = least, i[pick]
            jobs = []
            for (lo, hi, ol, oh), m_, o in zip(a.tolist(), mid.tolist(), i[pick].tolist()):
                if lo <= m_ - 1:
                    jobs.append((lo, m_ - 1, ol, o))
                if m_ + 1 <= hi:
                    jobs.append((m_ + 1, hi, o, oh))
        splits.append(at)
        best = new
        best[0] = 0.0
    bounds, j = [], m
    for at in reversed(splits):
        bounds.append(j)
        j = int(at[j])
        if j == 0:
            break
    else:
        bounds.append(j) if j else None
    return lengths[np.array(sorted(set(b for b in bounds if b > 0))) - 1]


def patterns(bounds: np.ndarray, counts: np.ndarray, capacity: int, top_up: bool = True) -> list[tuple[int, dict[int, int]]]:
    """(repeats, {bucket: items}) of containers that hold all items, filled longest bucket first; of one bucket each without *top_up*.

    A pattern is repeated until one of its buckets runs short, so there are
    only about two patterns per bucket.
    """
    left = counts.astype(np.int64).copy()
    out = []
    while left.any():
        room, use = capacity, {}
        for b in range(len(bounds) - 1, -1, -1):
            if left[b] and bounds[b] <= room and (top_up or not use):
                k = int(min(left[b], room // bounds[b]))
                use[b] = k
                room -= k * int(bounds[b])
        times = min(int(left[b]) // k for b, k in use.items())
        for b, k in use.items():
            left[b] -= k * times
        out.append((times, use))
    return out


#: Uses of one bucket are at most so many ranks apart, so that bucket and rank make one number.
RANK_SPAN = 1 << 40


def _place(use_rows: list[tuple]):
    """(profile_id, bucket, rank, ...) -> the same with the number of the container; the uses are a sorted table of patterns x buckets."""
    keys = {k: g for g, k in enumerate(sorted({(a, b) for a, b, *_ in use_rows}))}
    uses = np.array(sorted((keys[a, b] * RANK_SPAN + low, low, first, per) for a, b, low, _, first, per in use_rows), np.int64).reshape(-1, 4)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            profile, bucket, rank = (batch.column(i).to_numpy() for i in range(3))
            pairs, inverse = np.unique(np.stack((profile, bucket)), axis=1, return_inverse=True)
            group = np.array([keys[int(a), int(b)] for a, b in pairs.T], np.int64)[inverse.ravel()]
            at = np.searchsorted(uses[:, 0], group * RANK_SPAN + rank, side="right") - 1
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(uses[at, 2] + (rank - uses[at, 1]) // uses[at, 3]), *batch.columns[3:]], names=["profile_id", "number", *batch.schema.names[3:]])

    return run


def pack(docs: DataFrame, profiles: DataFrame, directory: str = TOKENIZER_DIR, buckets: int = BUCKETS, top_up: bool = True) -> DataFrame:
    """(profile_id, container, doc_id, part, start, tokens): where every document, or part of one, goes."""
    spark = docs.sparkSession
    plans = profiles.filter("profile_id is not null and tokenizer is not null and capacity > 0").groupBy("profile_id").agg(F.max(F.struct("tokenizer", "capacity")).alias("p")).select("profile_id", "p.*").collect()
    names = sorted({p["tokenizer"] for p in plans})
    if not plans:
        return docs.filter("false").select(F.lit(0).alias("profile_id"), F.lit("").alias("container"), "doc_id", F.lit(0).alias("part"), F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("tokens"))
    # Equal rows are counted and numbered, so that every row has an id of its own whatever the partitions.
    counted = token_sizes(docs, names, directory).groupBy("doc_id", *names).agg(F.count("*").alias("n"))
    counted = counted.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))).drop("n")
    sizes = materialize(counted.withColumn("uid", F.xxhash64("doc_id", *names, "copy")).drop("copy"), "packing-sizes")
    of = F.array(*[F.struct(F.lit(p["profile_id"]).alias("profile_id"), F.lit(p["capacity"]).cast("long").alias("capacity"), F.col(p["tokenizer"]).alias("size")) for p in plans])
    items = sizes.select("doc_id", "uid", F.explode(of).alias("s")).select("doc_id", "uid", "s.*")
    items = items.withColumn("rest", F.when(F.col("size") == 0, F.lit(0)).otherwise((F.col("size") - 1) % F.col("capacity") + 1)).withColumn("full", F.floor((F.col("size") - F.col("rest")) / F.col("capacity")))

    # Histogram -> bounds -> patterns, per profile. One row per profile and length, at most the capacities' sum.
    hist: dict[int, dict[int, int]] = {p["profile_id"]: {} for p in plans}
    for r in items.filter("rest > 0").groupBy("profile_id", "rest").agg(F.count("*").alias("n")).collect():
        hist[r["profile_id"]][r["rest"]] = r["n"]
    bucket_rows, use_rows, totals = [], [], []
    for p in plans:
        h = hist[p["profile_id"]]
        container = 0
        if h:
            lengths = np.array(sorted(h))
            counts = np.array([h[x] for x in lengths.tolist()], np.int64)
            bounds = bucket_bounds(lengths, counts.astype(float), buckets)
            bucket_of = np.searchsorted(bounds, lengths)
            per_bucket = np.bincount(bucket_of, weights=counts, minlength=len(bounds)).astype(np.int64)
            bucket_rows += [(p["profile_id"], int(x), int(b)) for x, b in zip(lengths, bucket_of)]
            offset = np.zeros(len(bounds), np.int64)
            for times, use in patterns(bounds, per_bucket, p["capacity"], top_up):
                for b, k in use.items():
                    use_rows.append((p["profile_id"], int(b), int(offset[b]), int(offset[b]) + times * k, container, k))
                    offset[b] += times * k
                container += times
        totals.append((p["profile_id"], max(container, 1)))
    lengths_df = spark.createDataFrame(bucket_rows, "profile_id int, rest long, bucket int")
    total_df = spark.createDataFrame(totals, "profile_id int, n_containers long")

    # Rank within the bucket: hash ranges, their offsets, and the rank inside.
    held = items.filter("rest > 0").join(F.broadcast(lengths_df), ["profile_id", "rest"])
    in_bucket = {(a, b): 0 for a, b, *_ in use_rows}
    for a, b, _, to, *_ in use_rows:
        in_bucket[(a, b)] = max(in_bucket[(a, b)], to)
    ranges = spark.createDataFrame([(a, b, int(-(-n // RANK_ROWS))) for (a, b), n in in_bucket.items()], "profile_id int, bucket int, ranges int")
    held = held.join(F.broadcast(ranges), ["profile_id", "bucket"]).withColumn("h", F.xxhash64("uid")).withColumn("rng", F.pmod("h", F.col("ranges")).cast("int"))
    key = ["profile_id", "bucket"]
    before = held.groupBy(*key, "rng").agg(F.count("*").alias("c")).withColumn("before", F.coalesce(F.sum("c").over(Window.partitionBy(*key).orderBy("rng").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("c")
    inside = F.row_number().over(Window.partitionBy(*key, "rng").orderBy("h", "uid")) - 1
    ranked = held.withColumn("inside", inside).join(F.broadcast(before), [*key, "rng"]).withColumn("rank", F.col("before") + F.col("inside"))
    placed = ranked.select("profile_id", "bucket", "rank", "doc_id", F.col("full").cast("int").alias("part"), (F.col("full") * F.col("capacity")).alias("start"), F.col("rest").alias("tokens"))
    doc = placed.schema["doc_id"].dataType.simpleString()
    placed = placed.mapInArrow(_place(use_rows), f"profile_id int, number long, doc_id {doc}, part int, start long, tokens long")
    packed = placed.select("profile_id", F.concat(F.lit("c"), F.col("number").cast("string")).alias("container"), "doc_id", "part", "start", "tokens")
    fulls = items.filter("full > 0").select("profile_id", "doc_id", "uid", "capacity", F.explode(F.sequence(F.lit(0), F.col("full").cast("int") - 1)).alias("part"))
    fulls = fulls.select("profile_id", F.concat_ws("-", F.lit("f"), F.hex("uid"), "doc_id", "part").alias("container"), "doc_id", "part", (F.col("part") * F.col("capacity")).alias("start"), F.col("capacity").alias("tokens"))
    empty = items.filter("size = 0").join(F.broadcast(total_df), "profile_id").select("profile_id", F.concat(F.lit("c"), F.pmod(F.xxhash64("uid"), F.col("n_containers")).cast("string")).alias("container"), "doc_id", F.lit(0).alias("part"), F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("tokens"))
    return packed.unionByName(fulls).unionByName(empty)


def fill_report(packed: DataFrame, profiles: DataFrame) -> DataFrame:
    """Per profile: containers, the least number that could do, and the share of room in use."""
    per = packed.groupBy("profile_id", "container").agg(F.sum("tokens").alias("used"), F.count("*").alias("n"))
    out = per.groupBy("profile_id").agg(F.count("*").alias("n_containers"), F.sum("n").alias("n_parts"), F.sum("used").alias("n_tokens"), F.max("used").alias("most"))
    return out.join(profiles.select("profile_id", F.col("capacity").cast("long").alias("capacity")).distinct(), "profile_id").select("profile_id", "capacity", "n_containers", "n_parts", "n_tokens", "most", F.ceil(F.col("n_tokens") / F.col("capacity")).alias("least_containers"), F.round(F.col("n_tokens") / (F.col("n_containers") * F.col("capacity")), 6).alias("filled"))
