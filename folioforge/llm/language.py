"""Languages of texts, by a naive Bayes model over hashed letter trigrams that is trained on labelled rows.

The fit reads a bounded sample (:data:`SAMPLE` labelled rows, the first in the order of their ids' hashes); every
text is then classified whole. Without a labelled row all texts are ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows that the fit reads at most, slots of the trigrams as a power of two, and the share of the sample from which a label is a language.
SAMPLE, SLOT_BITS, LEAST_SHARE = 2_000, 14, 0.01
#: Name of the language of texts that no fitted language is known for.
UNKNOWN = "und"


@cache
def letters() -> np.ndarray:
    """Code points in lower case; all that are no letters are one blank."""
    t = np.full(0x110000, 32, np.uint32)
    for i in (*range(0x41, 0x3100), *range(0x3400, 0xA000), *range(0xAC00, 0xD7A4)):
        c = chr(i)
        if c.isalpha():
            t[i] = ord(c.lower()[0])
    return t


def trigram_slots(codes: np.ndarray) -> np.ndarray:
    """Slot of the trigram that ends at each cell."""
    c = letters()[codes].astype(np.uint64)
    with np.errstate(over="ignore"):
        key = c * np.uint64(0x9E3779B97F4A7C15)
        key[1:] += c[:-1] * np.uint64(0xC2B2AE3D27D4EB4F)
        key[2:] += c[:-2] * np.uint64(0x165667B19E3779F9)
        key ^= key >> np.uint64(29)
        key *= np.uint64(0xBF58476D1CE4E5B9)
    return (key >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def language_name(c: Column) -> Column:
    """The first two letters of a language tag in lower case; NULL where there are none."""
    return F.nullif(F.left(F.regexp_replace(F.lower(c), "[^a-z]", ""), F.lit(2)), F.lit(""))


class Languages:
    """Fitted names and log-likelihoods (slots x names)."""

    def __init__(self, names: list[str], weights: np.ndarray):
        self.names, self.weights = names, weights

    def of(self, codes: np.ndarray, starts: np.ndarray) -> list[str]:
        """Language of each text of *codes*, texts beginning at *starts*; equal likelihoods go to the first name."""
        if len(self.names) < 2:
            return [self.names[0] if self.names else UNKNOWN] * len(starts)
        slots = trigram_slots(codes)
        sums = np.stack([np.add.reduceat(w[slots], starts) for w in self.weights.T])
        return [self.names[i] for i in sums.argmax(0).tolist()]


def fit_languages(labelled: DataFrame | None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> Languages:
    """The model from *labelled* rows; counts are added up in the workers, slots x languages reach the driver."""
    if labelled is None:
        return Languages([], np.zeros((1 << SLOT_BITS, 0)))
    rows = labelled.filter(F.col(text_col).isNotNull()).select(F.xxhash64(id_col).alias("h"), language_name(F.col(lang_col)).alias("lang"), F.col(text_col).alias("text")).filter("lang is not null")
    last = rows.select("h").orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    if last is None:
        return Languages([], np.zeros((1 << SLOT_BITS, 0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
                counts = held.setdefault(lang, np.zeros((1 << SLOT_BITS) + 1, np.int64))
                if len(codes):
                    counts[:-1] += np.bincount(trigram_slots(codes), minlength=1 << SLOT_BITS)
                counts[-1] += 1  # the rows are counted behind the last slot
        for lang, counts in held.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at), pa.array(counts[at])], names=["lang", "slot", "n"])

    counted = rows.filter(F.col("h") <= last).select("lang", "text").mapInArrow(run, "lang string, slot long, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n")).toArrow()
    lang, slot, n = (counted.column(c).to_numpy() for c in ("lang", "slot", "n"))
    total = n[slot == 1 << SLOT_BITS].sum()
    size = {x: int(k) for x, k in zip(lang[slot == 1 << SLOT_BITS], n[slot == 1 << SLOT_BITS])}
    names = sorted(x for x, k in size.items() if k >= LEAST_SHARE * total)
    weights = np.full((1 << SLOT_BITS, len(names)), 0.5)
    for j, name in enumerate(names):
        own = (lang == name) & (slot < 1 << SLOT_BITS)
        weights[slot[own], j] += n[own]
    return Languages(names, np.log(weights / weights.sum(0)).astype(np.float32))
