"""Problem 9: text that was decoded with the wrong character encoding.

Each suspicious line is the start of a best-first graph search. Its edges are
"encode with X, decode with Y" for pairs of character sets, and unescapings;
its states are texts, kept apart by hash; its order is a cost that says how
implausible the characters are next to each other. The cheapest text reached
is taken if it costs clearly less than the line.

Lines are told suspicious by the same cost, computed for all characters of an
Arrow batch at once, so the search only sees the few that need it. Nothing is
shuffled: every document is repaired in the partition that reads it.

Defined results: NULL, empty and plain texts come back unchanged; replacement
characters inside words tell a wrong decoding that cannot be undone (complete
is false); a garbled sample that stands by itself in quotation marks is a
quotation, and a document with nothing else is no case.
"""

from __future__ import annotations

import heapq
import html
import re
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Character classes of the cost.
(ASCII_L, ASCII_U, DIGIT, BLANK, PUNCT, LAT1_L, LAT1_U, LATX_L, LATX_U, VIET_L, VIET_U, CYR_L, CYR_U, CYR_X, HAN, WIDE, GREEK, CONTROL, SIGN, QUOTE, TYPO, GRAPHIC, LOST, OTHER, MARK) = range(25)
N_CLASSES = 25

#: Cost of one character of a class: letters cost little, what only wrong decodings produce costs much.
CHAR_COST = {
    ASCII_L: 0.1, ASCII_U: 0.15, DIGIT: 0.1, BLANK: 0.05, PUNCT: 0.1, LAT1_L: 0.6, LAT1_U: 1.0, LATX_L: 0.6, LATX_U: 0.8, VIET_L: 0.6, VIET_U: 0.8,
    CYR_L: 0.3, CYR_U: 0.5, CYR_X: 4.0, HAN: 0.7, WIDE: 0.7, GREEK: 1.2, CONTROL: 6.0, SIGN: 1.5, QUOTE: 0.4, TYPO: 0.5, GRAPHIC: 3.0, LOST: 7.0, OTHER: 4.0, MARK: 0.8,
}
#: Cost of a pair of neighbours, and what a line must gain to count as repaired.
PAIR_COST, MIN_GAIN, MIN_RATIO = 3.0, 4.0, 0.8
#: A line is searched if a pair or a character of it costs this much.
SUSPECT = 3.0
#: Operations in a chain, and what each costs, so that of two readings the nearer one is tried first.
MAX_DEPTH, STEP_COST = 4, 1.5

# Character sets that texts are commonly confused between.
WESTERN, CYRILLIC = ["cp1252", "mac_roman", "cp437", "cp850", "cp1250", "cp1258", "iso8859-15"], ["cp1251", "koi8-r", "cp866", "iso8859-5"]
WIDE_SETS = ["gb18030", "big5", "shift_jis", "euc_kr"]
OPENERS, CLOSERS = "«“„\"'‘‚「『(<[`", "»”“\"'’‘」』)>]`"


@cache
def classes() -> np.ndarray:
    t = np.full(0x110000, OTHER, np.uint8)
    t[:32] = t[127:160] = CONTROL
    t[[9, 10, 13]] = BLANK
    for a, b, c in ((33, 48, PUNCT), (48, 58, DIGIT), (58, 65, PUNCT), (65, 91, ASCII_U), (91, 97, PUNCT), (97, 123, ASCII_L), (123, 127, PUNCT), (0xA0, 0xC0, SIGN), (0xC0, 0xDF, LAT1_U), (0xDF, 0x100, LAT1_L), (0x300, 0x370, MARK), (0x370, 0x400, GREEK), (0x400, 0x410, CYR_X), (0x410, 0x430, CYR_U), (0x430, 0x450, CYR_L), (0x450, 0x530, CYR_X), (0x2010, 0x2028, TYPO), (0x2030, 0x205F, TYPO), (0x2000, 0x200E, BLANK), (0x20A0, 0x20C0, SIGN), (0x2100, 0x2150, SIGN), (0x2190, 0x2600, GRAPHIC), (0x3000, 0x3040, WIDE), (0x3040, 0x3100, WIDE), (0x3400, 0xA000, HAN), (0xAC00, 0xD7A4, WIDE), (0xE000, 0xF900, LOST), (0xFF00, 0xFFF0, WIDE), (0xFFFD, 0xFFFE, LOST)):
        t[a:b] = c
    for a in (*range(0x100, 0x180), 0x1A0, 0x1A1, 0x1AF, 0x1B0, *range(0x218, 0x21C)):
        t[a] = LATX_L if chr(a).islower() else LATX_U
    for a in range(0x1E00, 0x1F00):
        t[a] = VIET_L if chr(a).islower() else VIET_U
    t[32] = BLANK
    t[[0xA0, 0xAD, 0x202F, 0xFEFF, 0x200E, 0x200F, 0x2060]] = BLANK
    t[0xD7] = t[0xF7] = SIGN
    t[[0x401]], t[[0x451]] = CYR_U, CYR_L
    t[[ord(c) for c in "«»“”„‘’‚"]] = QUOTE
    return t


@cache
def pair_costs() -> np.ndarray:
    """Cost of neighbours (first class, second class)."""
    m = np.zeros((N_CLASSES, N_CLASSES))
    latin_l, latin_u = [ASCII_L, LAT1_L, LATX_L, VIET_L], [ASCII_U, LAT1_U, LATX_U, VIET_U]
    latin, cyr = latin_l + latin_u, [CYR_L, CYR_U, CYR_X]
    foreign = [LAT1_L, LAT1_U, LATX_L, LATX_U, VIET_L, VIET_U]
    odd = [CONTROL, SIGN, GRAPHIC, LOST, CYR_X, OTHER]
    for a in foreign + cyr:
        for b in odd:
            m[a, b] = m[b, a] = PAIR_COST
    for a in foreign:
        m[a, TYPO] = PAIR_COST  # as in the remains of a dash or a quotation mark
        m[a, QUOTE] = 1.0
        for b in foreign:
            m[a, b] = 0.6
    for a in (LAT1_L, LAT1_U):
        m[a, LAT1_U] = m[a, LAT1_L] = 1.2
    for a in latin:
        for b in cyr + [HAN, GREEK]:
            m[a, b] = m[b, a] = PAIR_COST
        m[a, GRAPHIC] = m[GRAPHIC, a] = m[a, OTHER] = m[OTHER, a] = PAIR_COST
        m[a, LOST] = m[LOST, a] = PAIR_COST
    for a in latin_l:
        for b in (LAT1_U, LATX_U, VIET_U):
            m[a, b] = PAIR_COST
    m[CYR_L, CYR_U] = PAIR_COST
    for a in (SIGN, GRAPHIC, TYPO):
        for b in (SIGN, GRAPHIC, TYPO):
            m[a, b] = max(m[a, b], 1.0)
    m[GRAPHIC, GRAPHIC] = 0.5
    for a in (HAN, GREEK, GRAPHIC, SIGN, TYPO, CYR_L, CYR_U):
        m[a, LOST] = m[LOST, a] = PAIR_COST
    for a in cyr:
        for b in (HAN, GREEK, GRAPHIC):
            m[a, b] = m[b, a] = PAIR_COST
    return m


@cache
def char_costs() -> np.ndarray:
    return np.array([CHAR_COST[c] for c in range(N_CLASSES)])


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def cost(text: str) -> float:
    """How implausible a text's characters are, summed."""
    c = classes()[codes_of(text)]
    return float(char_costs()[c].sum() + pair_costs()[c[:-1], c[1:]].sum())


_RUN = re.compile(r"[^\x00-\x7f]+")
_FOREIGN = re.compile("[À-ÖØ-öø-ÿ]{3}|[─-╿]{2}")
_CASE = re.compile("[а-яё][А-ЯЁ]{2}|[Ђ-Џђ-џ°-»]")
_ESCAPE = re.compile(r"&(?:#\d{2,7}|#x[0-9a-fA-F]{2,6}|[A-Za-z]{2,8});|\\u[0-9a-fA-F]{4}|\\x[0-9a-fA-F]{2}|(?:%[89A-Fa-f][0-9A-Fa-f]){2,}|(?:=[89A-F][0-9A-F]){2,}")


@cache
def byte_of(codec: str) -> dict[str, int]:
    """The byte of every character above ASCII. Undefined bytes, and in cp1252 all of 80-9f, also stand for controls."""
    out = {chr(i): i for i in range(0x80, 0xA0)}
    for i in range(0x80, 0x100):
        try:
            out[bytes([i]).decode(codec)] = i
        except UnicodeDecodeError:
            pass
    return out


@cache
def utf8_in(codec: str) -> re.Pattern:
    """Sequences of a single-byte set's characters whose bytes are one UTF-8 character."""
    byte = byte_of(codec)

    def among(low: int, high: int) -> str:
        return "[" + "".join(re.escape(c) for c, i in byte.items() if low <= i <= high) + "]"

    rest = among(0x80, 0xBF)
    return re.compile(f"{among(0xC2, 0xDF)}{rest}|{among(0xE0, 0xEF)}{rest}{{2}}|{among(0xF0, 0xF4)}{rest}{{3}}")


def from_utf8(text: str, codec: str) -> str:
    """Edge "encode with *codec*, decode with UTF-8" on every sound sequence of a line."""
    byte = byte_of(codec)

    def swap(m: re.Match) -> str:
        try:
            return bytes(byte[c] for c in m.group()).decode("utf-8")
        except UnicodeDecodeError:
            return m.group()

    return utf8_in(codec).sub(swap, text)


def from_utf8_wide(text: str, codec: str) -> str:
    """The same for a set of two-byte characters, which may have swallowed or lost the last byte of a run."""

    def one(run: str) -> str:
        try:
            raw = run.encode(codec)
        except UnicodeEncodeError:
            return run
        try:
            return raw.decode("utf-8")
        except UnicodeDecodeError as e:
            if e.start < 2 or len(raw) - e.start > 3:
                return run
            return raw[: e.start].decode("utf-8") + "\ufffd"

    return _RUN.sub(lambda m: "".join(p if p == "\ufffd" or not p else one(p) for p in re.split("(\ufffd)", m.group())), text)


def from_single(text: str, encode_with: str, decode_with: str) -> str:
    """Edge between two single-byte sets, on every run that the first can encode."""
    byte = byte_of(encode_with)

    def swap(m: re.Match) -> str:
        try:
            return bytes(byte[c] for c in m.group()).decode(decode_with)
        except (KeyError, UnicodeDecodeError):
            return m.group()

    return _RUN.sub(swap, text)


def neighbours(text: str, cost_now: float) -> Iterator[tuple[str, str, float, bool]]:
    """(operation, text, its cost, is it plain) of every edge that changes the text.

    Sound UTF-8 inside another set hardly arises by chance, so edges between
    single-byte sets are only tried where no set explains most of the line so.
    """
    if _ESCAPE.search(text):
        out = unescape(text)
        yield "unescape", out, *rated(out)
    if text.isascii():
        return
    high = sum(map(len, _RUN.findall(text)))
    found = False
    for codec in WESTERN + CYRILLIC:
        out = from_utf8(text, codec)
        if out != text:
            rating = rated(out)
            found |= 2 * sum(map(len, utf8_in(codec).findall(text))) >= high and rating[0] < 0.7 * cost_now
            yield f"{codec}>utf-8", out, *rating
    if _HAN_RUN.search(text):
        for codec in WIDE_SETS:
            out = from_utf8_wide(text, codec)
            if out != text:
                found = True
                yield f"{codec}>utf-8", out, *rated(out)
    if not found:
        sources = (WESTERN[:3] if _FOREIGN.search(text) else []) + (CYRILLIC if _CASE.search(text) else [])
        for x in sources:
            for y in CYRILLIC:
                if x != y:
                    out = from_single(text, x, y)
                    if out != text:
                        yield f"{x}>{y}", out, *rated(out)


_HAN_RUN = re.compile("[\u3400-\u9fff\uac00-\ud7a3\uff61-\uff9f]")


def unescape(text: str) -> str:
    """The text without HTML, backslash, percent and quoted-printable escapes of non-ASCII characters."""

    def swap(m: re.Match) -> str:
        s = m.group()
        if s[0] == "&":
            out = html.unescape(s)
            return out if len(out) == 1 and ord(out) > 127 else s
        if s[0] == "\\":
            return chr(int(s[2:], 16))
        try:
            return bytes.fromhex(re.sub("[%=]", "", s)).decode("utf-8")
        except UnicodeDecodeError:
            return s

    return _ESCAPE.sub(swap, text)


def rated(text: str) -> tuple[float, bool]:
    """(cost, is it plain, that is without a character or pair of the suspicious kind)."""
    c = classes()[codes_of(text)]
    single, pairs = char_costs()[c], pair_costs()[c[:-1], c[1:]]
    plain = not ((single >= SUSPECT).any() or (pairs >= SUSPECT).any() or _FOREIGN.search(text))
    return float(single.sum() + pairs.sum()), plain


def repair(text: str, hints: Iterable[tuple[str, ...]] = ()) -> tuple[str, tuple[str, ...]]:
    """(cheapest reachable text, chain of operations); the text itself where nothing is clearly cheaper.

    *hints* are chains that repaired other lines of the document; one that
    leads to a plain text at a clear gain is taken without a search.
    """
    start, _ = rated(text)
    base = start - 0.1 * len(text)

    def gains(c: float, out: str) -> bool:
        return start - c >= MIN_GAIN * 0.5 and (c - 0.1 * len(out)) <= MIN_RATIO * base

    for chain in hints:
        state = text
        for op in chain:
            state = apply_operation(state, op)
        if state != text:
            c, plain = rated(state)
            if plain and gains(c, state):
                return state, chain
    queue: list = [(start, 0, text, (), False)]
    seen = {hash(text)}
    best, best_cost, best_chain, made = text, start, (), 0
    while queue:
        c, _, state, chain, plain = heapq.heappop(queue)
        c -= STEP_COST * len(chain)
        if c < best_cost:
            best, best_cost, best_chain = state, c, chain
        if plain and chain:  # nothing left to repair
            best, best_cost, best_chain = state, c, chain
            break
        if len(chain) >= MAX_DEPTH or c > start * 1.5 + 10:
            continue
        for op, out, cost_out, plain_out in neighbours(state, c):
            h = hash(out)
            if h not in seen:
                seen.add(h)
                made += 1
                heapq.heappush(queue, (cost_out + STEP_COST * (len(chain) + 1), made, out, chain + (op,), plain_out))
    return (best, best_chain) if best_chain and gains(best_cost, best) else (text, ())


def apply_operation(text: str, op: str) -> str:
    """One named operation of a chain."""
    if op == "unescape":
        return unescape(text)
    x, y = op.split(">")
    if y != "utf-8":
        return from_single(text, x, y)
    return from_utf8_wide(text, x) if x in WIDE_SETS else from_utf8(text, x)


def quoted(text: str, start: int, end: int) -> bool:
    """Does text[start:end] stand by itself between quotation marks?"""
    a, b = start - 1, end
    while a >= 0 and text[a] in " \xa0 ":
        a -= 1
    while b < len(text) and text[b] in " \xa0 ":
        b += 1
    return a >= 0 and b < len(text) and text[a] in OPENERS and text[b] in CLOSERS


_LOST = re.compile("�+")
# A short quotation: its marks stand at blanks or punctuation outside, and it holds no letter of plain words only.
_SAMPLE = re.compile("(?<![^\\s:：(（,，])[«“„\"「『`][ \xa0\u202f]?([^\\s«»“”„\"「」『』`]{1,12})[ \xa0\u202f]?[»”“\"」』`](?!\\w)")


def repair_line(line: str, hints: Iterable[tuple[str, ...]] = ()) -> tuple[str, int, int, tuple[str, ...]]:
    """(repaired line, garbled passages that are no quotations, lost places, chain).

    Short quoted samples are set aside first, so that they neither count nor
    change; they come back as they were.
    """
    held: list[str] = []

    def aside(m: re.Match) -> str:
        if m.group(1).isascii() and "�" not in m.group(1):
            return m.group()
        held.append(m.group())
        return '"' + chr(0x1) + '"'

    bare = _SAMPLE.sub(aside, line)
    fixed, chain = repair(bare, hints) if not bare.isascii() or _ESCAPE.search(bare) else (bare, ())
    lost = sum(1 for m in _LOST.finditer(bare) if not quoted(bare, *m.span()) and _in_word(bare, *m.span()))
    n = int(bool(chain)) if chain else 0
    for h in held:
        fixed = fixed.replace('"' + chr(0x1) + '"', h, 1)
    return fixed, n, lost, chain


def _in_word(text: str, a: int, b: int) -> bool:
    """Does a lost place touch a letter, or stand for a sign between blanks of a line that lost more?"""
    left, right = text[a - 1 : a], text[b : b + 1]
    return left.isalpha() or right.isalpha() or len(_LOST.findall(text)) > 1


def suspicious_lines(texts: list[str]) -> Iterator[tuple[int, int, int]]:
    """(text, start, end) of the lines that a repair should look at, found for all texts at once."""
    if not texts:
        return
    joined = "\n".join(texts) + "\n"
    codes = codes_of(joined)
    c = classes()[codes]
    hot = char_costs()[c] >= SUSPECT
    hot[:-1] |= pair_costs()[c[:-1], c[1:]] >= SUSPECT
    # Runs that only a wide or single-byte set explains: three foreign letters in a row, or Han.
    foreign = (c == LAT1_L) | (c == LAT1_U)
    hot[2:] |= foreign[2:] & foreign[1:-1] & foreign[:-2]
    han = c == HAN
    hot[1:] |= han[1:] & han[:-1]
    if "&" in joined or "\\" in joined or "%" in joined or "=" in joined:
        for m in _ESCAPE.finditer(joined):
            hot[m.start()] = True
    breaks = np.flatnonzero(codes == 10)
    lines = np.unique(np.searchsorted(breaks, np.flatnonzero(hot)))
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    begin = np.concatenate(([0], np.cumsum(sizes)))
    for i in lines.tolist():
        if i >= len(breaks):
            continue
        end = int(breaks[i])
        start = int(breaks[i - 1]) + 1 if i else 0
        owner = int(np.searchsorted(begin, start, side="right")) - 1
        yield owner, start - int(begin[owner]), end - int(begin[owner])


def _plain_han(line: str) -> bool:
    """A line that was only marked for its Han runs, none of which is UTF-8 read as a wide set."""
    if not rated(line)[1]:
        return False
    for run in re.findall("[\u3400-\u9fff]{2,}", line):
        raw = run.encode("gb18030")
        try:
            raw.decode("utf-8")
            return False
        except UnicodeDecodeError as e:
            if e.start >= 4:
                return False
    return True


def repair_lines(lines: list[str]) -> tuple[list[tuple[str, int, int]], dict[tuple[str, ...], int]]:
    """(repaired, garbled, lost) of a document's suspicious lines, and its chains.

    A second round gives lines too short to tell by themselves the chains that
    repaired others of the same document.
    """
    seen: dict[tuple[str, ...], int] = {}
    done: list[tuple[str, int, int]] = []
    for line in lines:
        if not _ESCAPE.search(line) and _plain_han(line):
            done.append((line, 0, 0))
            continue
        fixed, n, lost, chain = repair_line(line, seen)
        if chain:
            seen[chain] = seen.get(chain, 0) + 1
        done.append((fixed, n, lost))
    if seen:
        for i, line in enumerate(lines):
            if not done[i][1] and not done[i][2]:
                fixed, n, lost, _ = repair_line(line, seen)
                done[i] = (fixed, n, lost)
    return done, seen


def restore(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, garbled, n_lines, n_lost, chain, complete, restored) of every row.

    chain is the operation chain of the most repaired lines; restored is the
    text with its garbled lines put right, NULL where it was NULL.
    """
    schema = T.StructType([T.StructField(id_col, df.schema[id_col].dataType), T.StructField("garbled", T.BooleanType()), T.StructField("n_lines", T.IntegerType()), T.StructField("n_lost", T.IntegerType()), T.StructField("chain", T.StringType()), T.StructField("complete", T.BooleanType()), T.StructField("restored", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, len(b), 256):
                part = b.slice(at, 256)
                texts = part.column(1).to_pylist()
                plain = [t or "" for t in texts]
                todo: dict[int, list[tuple[int, int]]] = {}
                for owner, s, e in suspicious_lines(plain):
                    todo.setdefault(owner, []).append((s, e))
                n, lost, chains, out = [0] * len(texts), [0] * len(texts), [None] * len(texts), list(texts)
                for owner, places in todo.items():
                    text, pieces, last = plain[owner], [], 0
                    done, seen = repair_lines([text[s:e] for s, e in places])
                    for (s, e), (fixed, count, gone) in zip(places, done):
                        n[owner] += count
                        lost[owner] += gone
                        if fixed != text[s:e]:
                            pieces += [text[last:s], fixed]
                            last = e
                    if seen:
                        chains[owner] = ",".join(max(sorted(seen), key=seen.get))
                    if pieces:
                        out[owner] = "".join(pieces) + text[last:]
                garbled = [bool(a or z) for a, z in zip(n, lost)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(garbled), pa.array(n, pa.int32()), pa.array(lost, pa.int32()), pa.array(chains, pa.string()), pa.array([g and not z and "�" not in (t or "") for g, z, t in zip(garbled, lost, out)]), pa.array(out, pa.string())],
                    names=schema.names,
                )

    return df.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)
