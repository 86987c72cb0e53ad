"""Problem 3: text that looks the same and differs in its characters.

Every value is brought to ordinary signs first: composed letters, normal widths,
ordinary blanks, nothing invisible (:func:`mapped`). Whether its words are spelt
with the right letters is decided by classes: every word of every value, mapped
to a skeleton (look-alike letters to one alphabet), is grouped with all words of
the corpus under Spark's accent- and case-sensitive ``UNICODE`` collation. A class
has one canonical member per alphabet of the value around it: of the spellings in
a single alphabet the one that is met most often, ties by the alphabet around and
the order of the words; for a word of mixed letters, which is no word of either
alphabet, those in the alphabet around come first. The pure spellings of a word, in Latin and in Russian
letters, count as members that are met 0 times, so that a class without a pure
spelling gets one. Canonical members are joined back to the values' words, and a
value is not in ordinary form if that or the mapping changes it.

The alphabet around is told by the letters that only one alphabet has. Words of a
single alphabet in a value of that alphabet stand as they are. Values of nothing
but look-alike letters have no alphabet of their own (2, beside 0 for Latin and 1
for Russian): their words are decided by the classes over all values.

Defined results: NULL and '' stay; symbols that look different (fractions,
superscripts, single Greek letters, numero signs) stay; Latin words of one or two
letters in a Russian value count as words between two Russian words only, else
they are marks or codes and stay, as do such words of a value without an alphabet;
joiners and selectors that an emoji or a script needs stay; repeated rows give one
row per record.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.session import discard, materialize

from .charfold import flatten
from .tokens import slice_keys

# Letters of other alphabets and the Latin letters that they look like.
CYRILLIC_LOOK = "авсеһіјкмнорԛѕтухԁԝү" "АВСЕҺІЈКМНОРԚЅТУХԜҮ"
CYRILLIC_LATIN = "abcehijkmhopqstyxdwy" "ABCEHIJKMHOPQSTYXWY"
GREEK_LOOK, GREEK_LATIN = "αικνορτυχΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "aikvoptuxABEZHIKMNOPTYX"
OTHER_LOOK, OTHER_LATIN = "հոսօցզɡ", "hnuogqg"
# Latin letters that Russian words are misspelt with.
LATIN_IN_RUSSIAN, RUSSIAN = "acekopxyABCEHKMOPTXY", "асекорхуАВСЕНКМОРТХУ"
# Cyrillic look-alikes that no Russian word holds.
NOT_RUSSIAN = set("һіјԛѕԁԝүҺІЈԚЅԜҮ")
# Blanks other than the ordinary one, and signs without a width.
ODD_BLANKS = "               　"
INVISIBLE = "­͏؜ᅟᅠ឴឵᠎​‌‍‎‏‪‫‬‭‮⁠⁡⁢⁣⁤⁦⁧⁨⁩️﻿"
LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st"}

WIDE = "".join(chr(i) for i in range(0xFF01, 0xFF5F))
NARROW = "".join(chr(i - 0xFEE0) for i in range(0xFF01, 0xFF5F))
TO_LATIN = dict(zip(CYRILLIC_LOOK + GREEK_LOOK + OTHER_LOOK, CYRILLIC_LATIN + GREEK_LATIN + OTHER_LATIN))
TO_RUSSIAN = dict(zip(LATIN_IN_RUSSIAN, RUSSIAN))
FOREIGN = "Ͱ-ϿЀ-ԯ԰-֏ɡ"



def skeleton(c: Column) -> Column:
    """The value with look-alikes as Latin letters, ordinary widths and blanks, and nothing invisible."""
    source = "".join(TO_LATIN) + WIDE + ODD_BLANKS + INVISIBLE
    target = "".join(TO_LATIN.values()) + NARROW + " " * len(ODD_BLANKS)
    c = F.translate(c, source, target)
    for one, many in LIGATURES.items():
        c = F.replace(c, F.lit(one), F.lit(many))
    return c


def spellings(word: Column) -> Column:
    """The word in Latin and in Russian letters, as (word, pure)."""
    latin, russian = F.translate(word, "".join(TO_LATIN), "".join(TO_LATIN.values())), F.translate(word, LATIN_IN_RUSSIAN, RUSSIAN)
    return F.array(F.struct(latin.alias("word"), (~latin.rlike(f"[{FOREIGN}]")).alias("pure"), F.lit("L").alias("of")), F.struct(russian.alias("word"), russian.rlike("^[а-яёА-ЯЁ]+$").alias("pure"), F.lit("C").alias("of")))


def collated(c: Column) -> Column:
    """Under the collation that tells accents and case apart but not compositions."""
    return F.collate(c, "UNICODE")


@cache
def script(ch: str) -> str:
    """L, C, G, A for Latin, Cyrillic, Greek, Armenian letters; J for CJK; else ''."""
    o = ord(ch)
    if o < 0x250 or 0x1E00 <= o < 0x1F00:
        return "L" if ch.isalpha() else ""
    if 0x400 <= o < 0x530:
        return "C"
    if 0x370 <= o < 0x400 or 0x1F00 <= o < 0x2000:
        return "G" if ch.isalpha() else ""
    if 0x530 <= o < 0x590:
        return "A"
    if o == 0x261:
        return "A"  # a phonetic sign: foreign to every ordinary alphabet
    if 0x3040 <= o < 0xA000 or 0xAC00 <= o < 0xD7B0:
        return "J"
    return ""


def _pictograph(ch: str) -> bool:
    return bool(ch) and (unicodedata.category(ch) in ("So", "Sk") or ord(ch) == 0xFE0F or 0x1F000 <= ord(ch) < 0x20000)


def _joining(ch: str) -> bool:
    """Letters of scripts that need joiners or marks of direction."""
    return bool(ch) and (0x590 <= ord(ch) < 0x900 or 0x900 <= ord(ch) < 0x1000 or 0x1780 <= ord(ch) < 0x1800 or 0xFB50 <= ord(ch) < 0xFE00)


def visible(text: str) -> str:
    """The text without invisible signs, apart from those that an emoji or a script needs."""
    out = []
    for i, ch in enumerate(text):
        if ch in INVISIBLE:
            before, after = text[i - 1 : i] if i else "", text[i + 1 : i + 2]
            if ch == "‍" and _pictograph(before) and _pictograph(after):
                pass
            elif ch == "️" and (_pictograph(before) or before in "#*0123456789©®‼⁉™↔↕"):
                pass
            elif ch in "‌‍‎‏‫‬⁧⁩" and (_joining(before) or _joining(after)):
                pass
            else:
                continue
        out.append(ch)
    return "".join(out)


def mapped(text: str) -> str:
    """The value in ordinary signs: composed, of normal width, with ordinary blanks and nothing invisible."""
    t = unicodedata.normalize("NFC", visible(text))
    cjk = any(script(ch) == "J" for ch in t)
    out = []
    for ch in t:
        o = ord(ch)
        if 0xFF01 <= o <= 0xFF5E:
            small = chr(o - 0xFEE0)
            ch = small if small.isalnum() or not cjk else ch
        elif ch in ODD_BLANKS:
            ch = " "
        out.append(LIGATURES.get(ch, ch))
    return "".join(out)


# Bits of a code point: a sign that ordinary form may not hold, a letter or mark, a letter of the Latin, Cyrillic, Greek
# alphabet, one of no alphabet in use, one that has a look-alike in Latin or in Russian, a small Russian letter.
SIGN, LETTER, LATIN, CYRILLIC, GREEK, ODD, AS_LATIN, AS_RUSSIAN, SMALL_RUSSIAN = (1 << i for i in range(9))
ALPHABETS = LATIN | CYRILLIC | GREEK
#: Characters handed to the scan at once; different words that a worker counts before it hands them on.
CHUNK, HELD_WORDS = 1 << 18, 1 << 18


@cache
def code_bits() -> np.ndarray:
    t = np.zeros(0x110000, np.uint16)
    for i in range(0x3100):
        c = chr(i)
        if c.isalpha() or unicodedata.combining(c):
            t[i] |= LETTER
        if unicodedata.combining(c):
            t[i] |= SIGN
        t[i] |= {"L": LATIN, "C": CYRILLIC, "G": GREEK, "A": ODD}.get(script(c), 0)
    for c in ODD_BLANKS + INVISIBLE + WIDE + "".join(LIGATURES) + "\u212a\u212b\u2126":
        t[ord(c)] |= SIGN
    for c in NOT_RUSSIAN:
        t[ord(c)] |= ODD
    for c in TO_LATIN:
        t[ord(c)] |= AS_LATIN
    for c in TO_RUSSIAN:
        t[ord(c)] |= AS_RUSSIAN
    t[0x430:0x450] |= SMALL_RUSSIAN
    t[0x451] |= SMALL_RUSSIAN
    return t


class Words:
    """The words of values that are in ordinary signs, laid end to end, each value after one cell.

    For each word: its value (owner), the alphabet around it (0, 1 or 2), whether
    it is of one alphabet (pure), whether that is the one around it (fits), and
    whether another spelling may be the right one (open).
    """

    def __init__(self, texts: list[str], skip: np.ndarray | None = None):
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        self.joined = "\x01" + "\x01".join(texts)
        codes = np.frombuffer(self.joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        starts = np.cumsum(sizes) - sizes
        bits = code_bits()[codes]
        self.signs = np.bitwise_or.reduceat(bits, starts) & SIGN > 0
        edge = np.diff((bits & LETTER > 0).astype(np.int8), prepend=0, append=0)
        begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        owner = np.searchsorted(starts, begin, side="right") - 1
        if skip is not None:
            kept = ~skip[owner]
            begin, end, owner = begin[kept], end[kept], owner[kept]
        self.codes, self.begin, self.end, self.owner = codes, begin, end, owner
        size = end - begin
        cuts = np.stack((begin, end), axis=1).ravel()
        padded = np.append(bits, 0)
        some = np.bitwise_or.reduceat(padded, cuts)[::2] if len(begin) else np.zeros(0, np.uint16)
        every = np.bitwise_and.reduceat(padded, cuts)[::2] if len(begin) else np.zeros(0, np.uint16)
        depth = np.cumsum((codes == 60).astype(np.int32) - (codes == 62))
        text = (depth[begin] - depth[starts[owner]] <= 0) & (codes[begin - 1] != 92)  # not in a tag, not a command
        # Letters that only one alphabet has tell the alphabet around; look-alikes do not.
        n = len(texts)
        sums = [np.concatenate(([0], np.cumsum((bits & (kind | alike)) == kind, dtype=np.int64))) for kind, alike in ((LATIN, AS_RUSSIAN), (CYRILLIC, AS_LATIN))]
        latin, russian = (np.bincount(owner, text * (c[end] - c[begin]), n) for c in sums)
        self.value_around = np.where((latin + russian == 0) & (np.bincount(owner, text, n) > 0), 2, np.where(russian > latin, 1, 0))
        a = self.value_around[owner]
        kinds = some & ALPHABETS
        self.pure = ((kinds & (kinds - 1)) == 0) & (some & ODD == 0)
        own = np.where(a == 1, kinds & (LATIN | GREEK) == 0, kinds & (CYRILLIC | GREEK) == 0)
        self.fits = np.where(a == 2, True, own)
        before, after = padded[np.maximum(begin - 2, 0)], padded[np.minimum(end + 1, len(codes))]
        between = (codes[begin - 1] == 32) & (np.append(codes, 0)[end] == 32) & (before & (SMALL_RUSSIAN | AS_RUSSIAN) > 0) & (after & (SMALL_RUSSIAN | AS_RUSSIAN) > 0)
        mark = np.where(a == 1, (kinds == LATIN) & (size < 3) & ~between, np.where(a == 2, self.pure & (size < 3), (kinds == GREEK) & (size < 2)))
        alike = np.where(a == 1, every & AS_RUSSIAN > 0, np.where(a == 2, every & (AS_LATIN | AS_RUSSIAN) > 0, every & AS_LATIN > 0))
        self.open = ~mark & (~self.pure | (alike & ~(self.fits & (a < 2))))
        self.counted = ~mark
        self.around = a

    def word(self, i: int) -> str:
        return self.joined[self.begin[i] : self.end[i]]

    def counts(self) -> Iterator[tuple[tuple[int, str, bool, bool], int]]:
        """((alphabet around, word, pure, fits), times) of every word that is no mark."""
        at = np.flatnonzero(self.counted)
        if len(at):
            keys = slice_keys(self.codes, self.begin[at], self.end[at]) ^ self.around[at].astype(np.uint64)
            _, first, n = np.unique(keys, return_index=True, return_counts=True)
            for i, k in zip(at[first].tolist(), n.tolist()):
                yield (int(self.around[i]), self.word(i), bool(self.pure[i]), bool(self.fits[i])), k


def _chunks(texts: list[str]) -> Iterator[tuple[int, int]]:
    start = held = 0
    for i, t in enumerate(texts):
        if i > start and held + len(t) > CHUNK:
            yield start, i
            start, held = i, 0
        held += len(t) + 1
    if texts:
        yield start, len(texts)


def _values(b: pa.RecordBatch) -> tuple[np.ndarray, list[str]]:
    rows, _, _, texts = flatten(b)
    keep = [i for i, t in enumerate(texts) if t]
    return rows[keep], [texts[i] for i in keep]


def scan_words(records: DataFrame) -> DataFrame:
    """One pass over all values: the counts of all words, and the values that the mapping changes or that hold open words.

    Value rows are (tbl, rec_id, text, form, around, open_words), word rows
    (around, word, pure, fits, n) with a NULL tbl; a worker adds its counts up first.
    """
    schema = "tbl string, rec_id long, text string, form string, open_words array<string>, around int, word string, pure boolean, fits boolean, n long"
    names = [f.split()[0] for f in schema.split(", ")]

    def values(b: pa.RecordBatch, rows: np.ndarray, texts: list[str], forms: list[str], words: Words) -> Iterator[pa.RecordBatch]:
        found: dict[int, set[str]] = {i: set() for i, (t, f) in enumerate(zip(texts, forms)) if t is not f and t != f}
        for i in np.flatnonzero(words.open).tolist():
            found.setdefault(int(words.owner[i]), set()).add(words.word(i))
        if found:
            at = sorted(found)
            row, none = pa.array(rows[at]), pa.nulls(len(at))
            yield pa.RecordBatch.from_arrays(
                [b.column("tbl").take(row), b.column("rec_id").take(row), pa.array([texts[i] for i in at]), pa.array([forms[i] for i in at]), pa.array([sorted(found[i]) for i in at], pa.list_(pa.string())), pa.array(words.value_around[at].astype(np.int32)), none.cast(pa.string()), none.cast(pa.bool_()), none.cast(pa.bool_()), none.cast(pa.int64())],
                names=names,
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for b in batches:
            rows, texts = _values(b)
            for s, e in _chunks(texts):
                part, own = texts[s:e], rows[s:e]
                words = Words(part)
                odd = np.flatnonzero(words.signs)
                if len(odd):  # values in other signs are read in ordinary ones
                    raw = [part[i] for i in odd.tolist()]
                    forms = [mapped(t) for t in raw]
                    again = Words(forms)
                    yield from values(b, own[odd], raw, forms, again)
                    held.update(dict(again.counts()))
                    words = Words(part, words.signs)
                yield from values(b, own, part, part, words)
                for key, n in words.counts():
                    held[key] += n
            if len(held) > HELD_WORDS:
                yield _word_rows(held, names)
                held.clear()
        if held:
            yield _word_rows(held, names)

    return records.mapInArrow(run, schema)


def _word_rows(words: Counter, names: list[str]) -> pa.RecordBatch:
    none = pa.nulls(len(words))
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.string())]
    around, word, pure, fits = zip(*words)
    return pa.RecordBatch.from_arrays([*[none.cast(k) for k in kinds], pa.array(around, pa.int32()), pa.array(word), pa.array(pure), pa.array(fits), pa.array(list(words.values()), pa.int64())], names=names)


def word_classes(words: DataFrame, asked: DataFrame) -> DataFrame:
    """(around, word, real) of the words in *asked* whose class has another canonical member.

    All of *words* (around, word, pure, fits, n) are grouped under the collation,
    and with them the pure spellings of *asked* (around, word). For N (2) a class
    has the words of all values.
    """
    counts = words.groupBy("around", "word").agg(F.max("pure").alias("pure"), F.max("fits").alias("fits"), F.sum("n").alias("n"))
    fits = (F.col("around") == 2) | ((F.col("around") == 1) == (F.col("s.of") == "C"))
    made = asked.select("around", F.explode(spellings(F.col("word"))).alias("s")).select("around", "s.word", "s.pure", fits.alias("fits"), F.lit(0).cast("long").alias("n"))
    undecided = asked.filter("around = 2").select(skeleton(F.col("word")).alias("skel")).distinct()
    anywhere = counts.filter("around <> 2").withColumn("skel", skeleton(F.col("word"))).join(undecided, "skel", "left_semi").select(F.lit(2).alias("around"), "word", "pure", "fits", "n")
    members = counts.unionByName(made).unionByName(anywhere).groupBy("around", "word").agg(F.max("pure").alias("pure"), F.max("fits").alias("fits"), F.sum("n").alias("n"))
    skel = collated(skeleton(F.col("word")))
    best = members.groupBy("around", skel.alias("skel")).agg(F.max_by("word", F.struct("pure", "n", "fits", "word")).alias("most"), F.max_by("word", F.struct("pure", "fits", "n", "word")).alias("nearest"))
    mixed = F.col("word").rlike(f"[{FOREIGN}]") & F.col("word").rlike(r"\p{IsLatin}")
    found = asked.withColumn("skel", skel).join(best, ["around", "skel"]).select("around", "word", F.when(mixed, F.col("nearest")).otherwise(F.col("most")).alias("real"))
    return found.filter(F.col("real") != F.col("word"))


def canonical(records: DataFrame) -> DataFrame:
    """(tbl, rec_id, text, canonical) of the values that are not in ordinary form."""
    passed = materialize(scan_words(records), "lookalike-scanned")
    values = passed.filter("tbl is not null").select("tbl", "rec_id", "text", "form", "around", "open_words")
    open_words = values.filter(F.size("open_words") > 0).select("tbl", "rec_id", "text", "around", F.explode("open_words").alias("word"))
    real = word_classes(passed.filter("tbl is null").select("around", "word", "pure", "fits", "n"), open_words.select("around", "word").distinct())
    changes = open_words.join(real, ["around", "word"]).groupBy("tbl", "rec_id", "text").agg(F.map_from_entries(F.collect_set(F.struct("word", "real"))).alias("changes"))
    # Each change replaces the whole word wherever it stands in the value.
    apply = F.expr("aggregate(map_entries(changes), form, (f, e) -> regexp_replace(f, concat('(?<![\\\\p{L}\\\\p{M}])', e.key, '(?![\\\\p{L}\\\\p{M}])'), e.value))")
    out = values.join(changes, ["tbl", "rec_id", "text"], "left").withColumn("canonical", F.when(F.col("changes").isNotNull(), apply).otherwise(F.col("form")))
    out = materialize(out.filter(F.col("canonical") != F.col("text")).select("tbl", "rec_id", "text", "canonical"), "lookalike-canonical")
    discard(passed)
    return out


def record_values(elements: DataFrame, records: DataFrame) -> DataFrame:
    """(tbl, rec_id, content) of page_element and sft_record, both with their values in a map."""
    e = elements.filter("element_id is not null and content is not null").select(F.lit("page_element").alias("tbl"), F.col("element_id").alias("rec_id"), "content")
    r = records.filter("record_id is not null and content is not null").select(F.lit("sft_record").alias("tbl"), F.col("record_id").alias("rec_id"), F.create_map(F.lit("content"), "content").alias("content"))
    return e.unionByName(r)
