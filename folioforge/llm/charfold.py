"""Code-point tables shared by the text operators, and content maps as flat values."""

from __future__ import annotations

import unicodedata
from functools import cache

import numpy as np
import pyarrow as pa

# Letters of other alphabets and the Latin letters that they look like.
LOOK_ALIKE = "авсеһіјкмнорԛѕтухԁԝαβεικνορτυχհոսօցզɡ"
LATIN = "abcehijkmhopqstyxdwabeiknoptyxhnuogqg"


@cache
def folded(one_digit: bool) -> np.ndarray:
    """Code points as base letters in lower case, blanks as one, look-alike letters as Latin.

    0 marks what leaves no trace: combining marks and invisible signs. So one
    reading in several spellings folds to one string. *one_digit* makes all
    digits one.
    """
    t = np.arange(0x110000, dtype=np.uint32)
    for i in (*range(0x20, 0x3100), *range(0xFB00, 0x10000)):
        c = chr(i)
        if unicodedata.combining(c) or unicodedata.category(c) == "Cf":
            t[i] = 0
            continue
        low = unicodedata.normalize("NFKD", c)[0].lower()[0]
        t[i] = 0x30 if one_digit and low.isdigit() else 0x20 if c.isspace() else ord(low)
    t[[0x85, 0x180E, 0x34F, 0x115F, 0x1160]] = 0
    t[0x111] = t[0x110] = ord("d")
    for c, base in zip(LOOK_ALIKE, LATIN):
        t[ord(c)] = t[ord(c.upper()[0])] = ord(base)
    return t


def flatten(b: pa.RecordBatch, column: str = "content") -> tuple[np.ndarray, np.ndarray, pa.Array, list[str | None]]:
    """(row, place, all keys, all values) of a batch's map column, without a loop over rows."""
    m = b.column(column)
    ends = m.offsets.to_numpy()
    keys, items = m.keys.slice(ends[0], ends[-1] - ends[0]), m.items.slice(ends[0], ends[-1] - ends[0])
    return np.repeat(np.arange(len(b)), np.diff(ends)), np.arange(len(items)), keys, items.to_pylist()
