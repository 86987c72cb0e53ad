"""Problem 4: values that were cut at a field limit or in transfer.

A backward character n-gram model: the contexts that end a value, read from its
end, are counted once as ends and once wherever they occur at all, for several
context lengths and per label. The model is a table keyed by each context's
64-bit hash. Copies of a value (one text under one label, as folded) count once.
It holds only contexts that some value ends in: a bitmap of fixed
size that is broadcast drops most others where they are counted, and the table
by full key the rest, so no two contexts are added up. A value's score is the
log-odds of "ends here" against "goes on" after its own final context, with the
value itself, and so all its copies, left out of the counts.

A context also holds how deep the text stands in brackets, environments, tags
and rows at that point, as far as that can be told from the left.

The model adapts to the element: the estimate from all values is the prior of the
same estimate from the other models' readings of the element (of a verdict: all
its element's readings), whole, at the contexts of LOCAL_ORDERS. Other readings
are one more source of counts; no rule overrides the log-odds.

A value is cut if its log-odds are below the threshold of its language and
column: the emptiest stretch between the two humps of the group's histogram.
Languages are told by a model trained on labelled documents (``language``).

Defined results: NULL, blank and invisible values are no values; a record delivered twice
counts once per source; labels that are NULL are a column of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.session import discard, materialize

from .charfold import flatten, folded
from .language import Languages, fit_languages

#: Context lengths.
ORDERS = (2, 4, 7, 12)
#: Size of the bitmap of ending contexts as a power of two: least and most. It only spares work; beyond its size more contexts pass it.
FILTER_BITS = (18, 26)
#: Weight of the shorter context's estimate, in occurrences, and what that estimate is at least:
#: nested contexts repeat one observation, so their doubts must not multiply.
BACKOFF, BACKOFF_LEAST = 2.0, 0.02
#: Characters handed to the counter at once, and occurrences that a task holds before it adds them up.
CHUNK, HELD = 1 << 18, 1 << 20
#: Context lengths of the counts in an element's other readings, and the weight of the shorter context's estimate there.
LOCAL_ORDERS, LOCAL_BACKOFF = (7, 12), 4.0
#: Slots of the table of elements that have verdicts, which is broadcast to leave most others out of a shuffle.
ELEMENT_SLOTS = 1 << 20
#: A length is a field limit of a source if it is met this often as its neighbours within LIMIT_REACH, and LIMIT_LEAST times.
LIMIT_TIMES, LIMIT_REACH, LIMIT_LEAST = 6.0, 6, 8
#: Range and bins of the score histograms; the threshold of an empty histogram, and how many rows the histogram of all values weighs in a group's.
LOW, HIGH, BINS = -12.0, 8.0, 80
DEFAULT_THRESHOLD, PRIOR_ROWS = -2.5, 200

PAD = max(ORDERS)
BASE = 0x9E3779B97F4A7C15


@cache
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (BASE, pow(BASE, -1, 1 << 64)):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        with np.errstate(over="ignore"):
            out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def _sizes(n: int) -> int:
    return 1 << max(10, (n - 1).bit_length())


@cache
def steps() -> np.ndarray:
    """+1 for opening, -1 for closing brackets."""
    t = np.zeros(0x110000, np.int8)
    t[[40, 91, 123]], t[[41, 93, 125]] = 1, -1
    return t


class Laid:
    """Values laid end to end, each after PAD cells, with the state at every cell."""

    def __init__(self, texts: list[str], labels: np.ndarray, languages: Languages | None = None):
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        gap = "\x01" * PAD
        codes = np.frombuffer((gap + gap.join(texts)).encode("utf-32-le", "surrogatepass"), np.uint32)
        self.n = len(texts)
        if languages is not None:
            self.languages = languages.of(codes, np.cumsum(sizes + PAD) - sizes - PAD)
        c = folded(True)[codes]
        if not c.all():  # drop what leaves no trace
            kept = c != 0
            sizes = np.bincount(np.repeat(np.arange(self.n), sizes + PAD)[kept], minlength=self.n) - PAD
            c = c[kept]
        self.first = np.cumsum(sizes + PAD) - sizes  # first character of each value
        self.last = self.first + sizes - 1
        self.codes = c
        self.holds: np.ndarray | None = None
        step = steps()[c].astype(np.int32)
        # Tags and environments count at the last character that tells them, so the state knows nothing of what follows.
        for mark, words in ((60, (("<ta", 1), ("</ta", -1))), (92, (("\\be", 1), ("\\en", -1), ("\\lef", 1), ("\\rig", -1)))):
            at = np.flatnonzero(c[: len(c) - 4] == mark)
            for word, by in words:
                hit = at
                for k, letter in enumerate(word[1:], 1):
                    hit = hit[c[hit + k] == ord(letter)]
                step[hit + len(word) - 1] += by
        run = np.cumsum(step, dtype=np.int32)
        per_value = sizes + PAD
        depth = np.clip(run - np.repeat(run[self.first - 1], per_value), -1, 2) + 1
        state = np.repeat(labels.astype(np.int32) * 16, per_value) + depth * 4
        for i in np.flatnonzero((c[self.first] == 124) & (sizes > 2)):
            self._rows(state, int(self.first[i]), int(self.last[i]) + 1)
        self.state = state.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        code = c.astype(np.uint64) + np.uint64(0x2545F491)
        power, self.inverse = powers(_sizes(len(c) + 1))
        with np.errstate(over="ignore"):
            self.prefix = np.concatenate((np.zeros(1, np.uint64), np.cumsum(code * power[: len(c)])))

    def _rows(self, state: np.ndarray, start: int, end: int) -> None:
        """In a pipe table: is the row at each cell as full as the first one?"""
        c = self.codes[start:end]
        breaks = np.flatnonzero(c == 10)
        if len(breaks):
            pipe = np.cumsum(c == 124)
            head = pipe[breaks[0]]
            row = np.searchsorted(breaks, np.arange(len(c)), side="right")
            before = np.concatenate(([0], pipe[breaks]))[row]
            state[start:end] += 1 + (pipe - before == head)

    def slots(self, order: int, at: np.ndarray) -> np.ndarray:
        """Key of the context of ORDERS[order] characters that ends at each cell of *at*."""
        n = ORDERS[order]
        with np.errstate(over="ignore"):
            key = (self.prefix[at + 1] - self.prefix[at + 1 - n]) * self.inverse[at + 1 - n]
            return self._key(key ^ self.state[at], order)

    def everywhere(self, order: int) -> np.ndarray:
        """The same at every cell that holds a character; contiguous, without a gather."""
        n = ORDERS[order]
        if self.holds is None:
            self.holds = np.ones(len(self.codes), bool)
            for k in range(1, PAD + 1):
                self.holds[self.first - k] = False
        with np.errstate(over="ignore"):
            key = (self.prefix[n:] - self.prefix[:-n]) * self.inverse[: len(self.prefix) - n]
            key ^= self.state[n - 1 :]
        return self._key(key[self.holds[n - 1 :]], order)

    def whole(self) -> np.ndarray:
        """Key of each whole value."""
        with np.errstate(over="ignore"):
            key = (self.prefix[self.last + 1] - self.prefix[self.first]) * self.inverse[self.first]
            return self._key(key ^ (self.state[self.first - 1] + (self.last - self.first).astype(np.uint64)), len(ORDERS))

    @staticmethod
    def _key(key: np.ndarray, table: int) -> np.ndarray:
        """*key* mixed one to one, differently in each table."""
        key = key ^ np.uint64((table + 1) * 0x9FB21C651E98DF25 % (1 << 64))
        key = (key ^ (key >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        key = (key ^ (key >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
        return (key ^ (key >> np.uint64(31))).view(np.int64)


def _chunks(labels: list, texts: list[str]) -> Iterator[tuple[int, int]]:
    start = held = 0
    for i, t in enumerate(texts):
        if i > start and held + len(t) > CHUNK:
            yield start, i
            start, held = i, 0
        held += len(t) + PAD
    if texts:
        yield start, len(texts)


LOCAL = [f"{c}{n}" for n in LOCAL_ORDERS for c in ("local_end", "local_all")]
KEEP = ["tbl", "rec_id", "source", "n_chars", "label_id", *LOCAL]
KEYS = [f"k{k}" for k in range(len(ORDERS))]


def readable(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, pa.Array, list[str]]:
    """(row, place, all sources, values without trailing blanks) of the values in a batch's content maps."""
    rows, places, sources, texts = flatten(b)
    texts = [t.rstrip() if t else "" for t in texts]
    leaves = folded(True)
    keep = np.flatnonzero(np.fromiter((any(leaves[ord(c)] for c in t) for t in texts), bool, len(texts)))
    return rows[keep], places[keep], sources, [texts[i] for i in keep.tolist()]


def spelt_plainly(texts: list[str]) -> list[str]:
    """The texts as base letters of one alphabet, each after PAD cells, so readings in several spellings compare."""
    gap = "\x01" * PAD
    out = []
    for s, e in _chunks([], texts):
        codes = folded(False)[np.frombuffer(gap.join(["", *texts[s:e]]).encode("utf-32-le", "surrogatepass"), np.uint32)]
        out += [gap + t for t in codes[codes != 0].tobytes().decode("utf-32-le", "surrogatepass").split(gap)[1:]]
    return out


def local_counts(text: str, others: list[str]) -> list[int]:
    """For each of LOCAL_ORDERS: how many of *others* end in the final context of *text*, and how often they hold it."""
    out = []
    for n in LOCAL_ORDERS:
        tail = text[-n:]
        out += [sum(o.endswith(tail) for o in others), sum(o.count(tail) for o in others)]
    return out


def final_contexts(values: DataFrame, languages: Languages) -> DataFrame:
    """Every value with its language, its own key (whole) and its counts in the element's other readings.

    The first of its kind in a batch has its final contexts' keys k0, k1, ...
    and its text; these are NULL for the others.
    """
    known = values.sparkSession.sparkContext.broadcast(languages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, places, sources, texts = readable(b)
            if not texts:
                continue
            labels = b.column("label_id").to_numpy()[rows]
            lengths = np.fromiter(map(len, texts), np.int32, len(texts))
            beside = b.column("readings").to_pylist()
            plain = spelt_plainly(texts)
            local = np.zeros((len(texts), len(LOCAL)), np.int32)
            bounds = np.flatnonzero(np.diff(rows, prepend=-1)).tolist() + [len(rows)]
            for s, e in zip(bounds, bounds[1:]):
                given = beside[rows[s]]
                given = spelt_plainly([t.rstrip() for t in given if t]) if given else []
                if given or e - s > 1:
                    for i in range(s, e):
                        local[i] = local_counts(plain[i], plain[s:i] + plain[i + 1 : e] + given)
            wholes, keys, langs = np.zeros(len(texts), np.int64), np.zeros((len(ORDERS), len(texts)), np.int64), []
            for s, e in _chunks(labels, texts):
                laid = Laid(texts[s:e], labels[s:e], known.value)
                wholes[s:e], langs = laid.whole(), [*langs, *laid.languages]
                for k in range(len(ORDERS)):
                    keys[k, s:e] = laid.slots(k, laid.last)
            repeats = np.ones(len(texts), bool)
            repeats[np.unique(wholes, return_index=True)[1]] = False
            row = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [b.column("tbl").take(row), b.column("rec_id").take(row), sources.take(pa.array(places)), pa.array(lengths), pa.array(labels.astype(np.int32)), *[pa.array(x) for x in local.T], pa.array(langs, pa.string()), pa.array(wholes), pa.array([None if r else t for t, r in zip(texts, repeats.tolist())], pa.string()), *[pa.array(x, mask=repeats) for x in keys]],
                names=[*KEEP, "lang", "whole", "text", *KEYS],
            )

    counts = ", ".join(f"{c} int" for c in LOCAL)
    return values.mapInArrow(run, f"tbl string, rec_id long, source string, n_chars int, label_id int, {counts}, lang string, whole long, text string, " + ", ".join(f"{c} long" for c in KEYS))


def ending_filter(contexts: DataFrame) -> np.ndarray:
    """A bitmap of the leading digits of all keys that some value ends in; its size is a power of two within FILTER_BITS."""
    firsts = contexts.filter("text is not null")
    bits = int(np.clip((32 * len(ORDERS) * max(firsts.count(), 1)).bit_length(), *FILTER_BITS))
    at = firsts.select(F.explode(F.array(*[F.shiftrightunsigned(k, 64 - bits) + 1 for k in KEYS])).alias("at"))
    parts = at.groupBy(F.bitmap_bucket_number("at").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    out = np.zeros((1 << bits) // 8, np.uint8)
    for r in parts.collect():  # parts of 4 KB, 2,048 at most
        out[(r["part"] - 1) * 4096 : r["part"] * 4096] = np.frombuffer(r["bits"], np.uint8)
    return out


def _totals(order: int, held: list[np.ndarray], ends: bool) -> pa.RecordBatch:
    """How often each key is among *held*."""
    keys = np.sort(np.concatenate(held))
    first = np.flatnonzero(np.concatenate((np.ones(min(len(keys), 1), bool), keys[1:] != keys[:-1])))
    n, none = np.diff(first, append=len(keys)), np.zeros(len(first), np.int64)
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(first), order, np.int32)), pa.array(keys[first]), pa.array(n if ends else none), pa.array(none if ends else n)], names=["o", "key", "n_end", "n_all"])


def count_contexts(contexts: DataFrame) -> DataFrame:
    """(o, key, n_end, n_all) of every context that some value ends in: how many different values do, and how often it occurs anywhere in them."""
    sent = contexts.sparkSession.sparkContext.broadcast(ending_filter(contexts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = sent.value
        shift = np.uint64(64 - (len(wanted) * 8).bit_length() + 1)
        held: dict[tuple[int, bool], list] = {}
        size = 0
        before = np.zeros(0, np.int64)
        for b in batches:
            whole = b.column("whole").to_numpy()
            new = np.flatnonzero(np.diff(np.concatenate((before, whole))) if len(before) else np.diff(whole, prepend=~whole[:1]))  # copies stand side by side
            before = whole[-1:] if len(whole) else before
            labels, texts = b.column("label_id").to_numpy()[new], b.column("text").take(pa.array(new)).to_pylist()
            for s, e in _chunks(labels, texts):
                laid = Laid(texts[s:e], labels[s:e])
                for k in range(len(ORDERS)):
                    keys = laid.everywhere(k)
                    at = keys.view(np.uint64) >> shift
                    hit = (wanted[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
                    held.setdefault((k, False), []).append(keys[hit])
                    held.setdefault((k, True), []).append(laid.slots(k, laid.last))
                    size += int(hit.sum())
                if size > HELD:
                    yield from (_totals(k, x, ends) for (k, ends), x in held.items())
                    held, size = {}, 0
        yield from (_totals(k, x, ends) for (k, ends), x in held.items())

    firsts = contexts.filter("text is not null").select("whole", "label_id", "text")
    rows = firsts.repartition("whole").sortWithinPartitions("whole").mapInArrow(run, "o int, key long, n_end long, n_all long")
    return rows.groupBy("o", "key").agg(F.sum("n_end").alias("n_end"), F.sum("n_all").alias("n_all")).filter("n_end > 0")


def score(contexts: DataFrame, counts: DataFrame) -> DataFrame:
    """*contexts* with logodds: ends here against goes on, after the value's final context. One score per different value."""
    g = counts.filter("o = 0").agg(F.sum("n_end").alias("ends"), F.sum(F.greatest("n_all", "n_end")).alias("all")).first()
    values = contexts.filter("text is not null").groupBy("whole").agg(*[F.first(k).alias(k) for k in KEYS])
    looked = values.select("whole", F.explode(F.array(*KEYS)).alias("key")).join(counts, "key")
    of = lambda c, k: F.max(F.when(F.col("o") == k, F.col(c)))
    values = looked.groupBy("whole").agg(*[of(c, k).alias(f"{c}{k}") for k in range(len(ORDERS)) for c in ("n_end", "n_all")])
    p = F.lit(float((g["ends"] or 0) + 1) / float((g["all"] or 0) + 2))
    for k in range(len(ORDERS)):
        n_end, n_all = (F.greatest(F.col(f"{c}{k}") - 1, F.lit(0)) for c in ("n_end", "n_all"))
        values = values.withColumn("p", (n_end + BACKOFF * F.greatest(p, F.lit(BACKOFF_LEAST))) / (F.greatest(n_all, n_end) + BACKOFF))
        p = F.col("p")
    scored = contexts.select(*KEEP, "lang", "whole").join(values.select("whole", p.alias("p")), "whole").drop("whole")
    return scored.withColumn("general", log_odds(F.col("p"))).withColumn("logodds", log_odds(adapted(F.col("p")))).drop("p")


def log_odds(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-9)), F.lit(1 - 1e-9))
    return F.log(p) - F.log1p(-p)


def adapted(p: Column) -> Column:
    """The chance of an end *p* after the counts in the element's other readings."""
    for n in LOCAL_ORDERS:
        ends, everywhere = F.col(f"local_end{n}"), F.col(f"local_all{n}")
        p = (ends + LOCAL_BACKOFF * p) / (F.greatest(everywhere, ends) + LOCAL_BACKOFF)
    return p


# Labels, in the order of their ids; what is none of them has the next id.
LABELS = ["text", "title", "list", "caption", "formula", "table"]


def label_id(label: Column) -> Column:
    """0-5, or 6 for a label that is NULL or unknown."""
    return F.coalesce(F.array_position(F.array(*[F.lit(x) for x in LABELS]), label), F.lit(0)).cast("int") - 1 + F.when(label.isin(LABELS), 0).otherwise(7)


def page_values(elements: DataFrame) -> DataFrame:
    """(tbl, rec_id, label_id, content, readings): an element's readings; they are compared with each other."""
    return elements.filter("element_id is not null and content is not null").select(F.lit("page_element").alias("tbl"), F.col("element_id").alias("rec_id"), label_id(F.col("label")).alias("label_id"), "content", F.lit(None).cast("array<string>").alias("readings"))


def judge_values(verdicts: DataFrame, elements: DataFrame) -> DataFrame:
    """The same of a verdict's correction, under its element's label and beside its element's readings, whole.

    Elements without a verdict are left out before the shuffle as far as a
    table of at most ELEMENT_SLOTS rows can tell, the rest of them by the join.
    """
    v = verdicts.filter("verdict_id is not null and length(trim(corrected)) > 0").select("verdict_id", F.coalesce("judge_model", F.lit("")).alias("judge_model"), "element_id", "corrected")
    slot = F.pmod(F.xxhash64("element_id"), F.lit(ELEMENT_SLOTS)).cast("int")
    e = elements.filter("element_id is not null").select("element_id", F.struct("loaded_at", label_id(F.col("label")).alias("label_id"), F.map_values("content").alias("readings")).alias("r"))
    e = e.withColumn("slot", slot).join(F.broadcast(v.select(slot.alias("slot")).distinct()), "slot", "left_semi").drop("slot")
    e = e.groupBy("element_id").agg(F.max("r").alias("r")).select("element_id", "r.label_id", "r.readings")
    return v.join(e, "element_id", "left").select(F.lit("judge_verdict").alias("tbl"), F.col("verdict_id").alias("rec_id"), F.coalesce("label_id", F.lit(6)).alias("label_id"), F.create_map("judge_model", "corrected").alias("content"), F.filter("readings", lambda t: t.isNotNull()).alias("readings"))


def field_limits(values: DataFrame) -> DataFrame:
    """(tbl, source, n_chars, n_values): lengths at which a source's values pile up."""
    w = Window.partitionBy("tbl", "source").orderBy("n_chars").rangeBetween(-LIMIT_REACH, LIMIT_REACH)
    counts = values.groupBy("tbl", "source", "n_chars").agg(F.count("*").alias("n_values"))
    around = (F.sum("n_values").over(w) - F.col("n_values")) / (2 * LIMIT_REACH)
    return counts.withColumn("around", around).filter((F.col("n_values") >= LIMIT_LEAST) & (F.col("n_values") >= LIMIT_TIMES * F.greatest("around", F.lit(1.0))) & (F.col("n_chars") > 4 * PAD)).drop("around")


def thresholds(scored: DataFrame) -> DataFrame:
    """(tbl, label_id, lang, threshold): the emptiest stretch of each group's histogram of log-odds.

    The table of counts has at most bins x languages x columns rows. The
    histogram of all values weighs PRIOR_ROWS rows in each group's, so that few
    rows decide little, without a switch at some number of them.
    """
    width = (HIGH - LOW) / BINS
    bin_of = F.greatest(F.least(F.floor((F.col("logodds") - LOW) / width), F.lit(BINS - 1)), F.lit(0)).cast("int")
    counts: dict[tuple, np.ndarray] = {}
    for r in scored.groupBy("tbl", "label_id", "lang", bin_of.alias("bin")).agg(F.count("*").alias("n")).collect():
        counts.setdefault((r["tbl"], r["label_id"], r["lang"]), np.zeros(BINS))[r["bin"]] = r["n"]
    everything = sum(counts.values(), np.zeros(BINS))
    prior = everything * (PRIOR_ROWS / max(everything.sum(), 1.0))
    rows = [(*k, float(valley(h + prior, width))) for k, h in sorted(counts.items())]
    return scored.sparkSession.createDataFrame(rows, "tbl string, label_id int, lang string, threshold double")


def valley(histogram: np.ndarray, width: float) -> float:
    """Middle of the emptiest stretch between the two humps: between the mean of what is below the default and of what is above.

    It is no higher than 0, where an end and a continuation are equally likely.
    """
    middle = LOW + (np.arange(len(histogram)) + 0.5) * width
    below = middle < DEFAULT_THRESHOLD
    if not histogram[below].sum() or not histogram[~below].sum():
        return DEFAULT_THRESHOLD
    ends = [np.average(middle[side], weights=histogram[side]) for side in (below, ~below)]
    between = np.flatnonzero((middle > ends[0]) & (middle < min(ends[1], 0.0)))
    if not len(between):
        return DEFAULT_THRESHOLD
    smooth = np.convolve(histogram, np.ones(3) / 3, mode="same")[between]
    low = between[smooth <= smooth.min() * (1 + 1e-9)]
    return float(middle[min(low, key=lambda i: abs(middle[i] - DEFAULT_THRESHOLD))])  # of equally empty ones the nearest to the default


def detect(elements: DataFrame, verdicts: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """Every value: tbl, rec_id, source, label_id, lang, n_chars, its counts in other readings, general, logodds, threshold, cut.

    *general* is the log-odds without the element's own counts; *labelled*
    (doc_id, text, lang) trains the languages.
    """
    values = page_values(elements).unionByName(judge_values(verdicts, elements))
    contexts = materialize(final_contexts(values, fit_languages(labelled)), "truncation-contexts")
    counts = materialize(count_contexts(contexts), "truncation-counts")
    scored = materialize(score(contexts, counts), "truncation-scores")
    discard(counts)
    discard(contexts)
    out = scored.join(F.broadcast(thresholds(scored)), ["tbl", "label_id", "lang"], "left")
    return out.withColumn("cut", F.col("logodds") < F.coalesce("threshold", F.lit(DEFAULT_THRESHOLD)))
