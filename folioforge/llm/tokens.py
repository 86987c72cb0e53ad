"""Problem 7: token ids of a whole corpus with a public byte-level tokenizer.

Words are located without a regular expression. Each code point gets a
class symbol; a symbol is a transition function on eight scanner states, and
because composing such functions is associative, a blocked prefix scan yields
the state before every code point of an Arrow batch at once. Boundaries follow
from (state, symbol). The slices are grouped by a vectorised hash so that each
distinct slice of a batch is looked up once in a bounded cache of pair merges.

Defined results: a NULL text has NULL ids, an empty text has an empty list.
Special-token strings inside a text are ordinary text.
"""

from __future__ import annotations

import base64
import os
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Where the public vocabularies lie; a parameter of every function below.
TOKENIZER_DIR = os.environ.get("FOLIOFORGE_TOKENIZERS", "/opt/tokenizers")
#: Characters handed to the scanner at once; bounds the worker's memory.
SCAN_CHARS = 1 << 20
#: Distinct slices that a worker's cache holds before it starts afresh.
CACHE_SLICES = 1 << 20

# Symbols: letter, number, other, blank, other white space, apostrophe that
# opens a one-letter ending, one that opens a two-letter ending, text start.
LETTER, NUMBER, OTHER, BLANK, SPACE, APOS1, APOS2, START = range(8)
# States before a code point: inside letters, numbers, others, after a blank,
# after other white space, two or one letters of an ending left, at a start.
IN_L, IN_N, IN_O, IN_B, IN_S, NEED2, NEED1, FRESH = range(8)

# The White_Space code points of Unicode.
WHITE_SPACE = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# The endings that the tokenizer's pattern splits off.
ENDINGS1, ENDINGS2 = "stmd", ("re", "ve", "ll")


def _transitions() -> np.ndarray:
    """state after (symbol, state before)."""
    t = np.empty((8, 8), np.uint8)
    t[LETTER], t[NUMBER], t[OTHER], t[BLANK], t[SPACE] = IN_L, IN_N, IN_O, IN_B, IN_S
    t[LETTER, NEED2], t[LETTER, NEED1] = NEED1, FRESH
    for symbol, need in ((APOS1, NEED1), (APOS2, NEED2)):
        t[symbol] = need  # an apostrophe at a slice's start opens the ending
        t[symbol, IN_O] = t[symbol, IN_B] = IN_O  # inside other signs, or joined to a blank, it is one of them
    t[START] = FRESH
    return t


TRANSITIONS = _transitions()


@cache
def symbol_table() -> np.ndarray:
    """The class symbol of every code point, apart from apostrophes and starts."""
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.fromiter((kinds.get(unicodedata.category(chr(i))[0], OTHER) for i in range(0x110000)), np.uint8, 0x110000)
    table[WHITE_SPACE] = SPACE
    table[0x20] = BLANK
    return table


def scan_states(symbols: np.ndarray, block: int = 256) -> np.ndarray:
    """The state before each symbol, by a blocked associative scan.

    Every block composes its symbols' transition functions for all eight start
    states side by side; the blocks' functions are chained; then each block
    replays from its known start. Both passes are vectorised across blocks.
    """
    n = len(symbols)
    rows = -(-n // block)
    grid = np.full(rows * block, START, np.uint8)
    grid[:n] = symbols
    grid = np.ascontiguousarray(grid.reshape(rows, block).T)
    flat = TRANSITIONS.ravel()
    whole = np.broadcast_to(np.arange(8, dtype=np.uint8), (rows, 8))
    for column in grid:
        whole = flat[(column[:, None] << 3) | whole]
    state, starts = FRESH, np.empty(rows, np.uint8)
    for i, f in enumerate(whole.tolist()):
        starts[i] = state
        state = f[state]
    out = np.empty_like(grid)
    now = starts
    for i, column in enumerate(grid):
        out[i] = now
        now = flat[(column << 3) | now]
    return out.T.ravel()[:n]


def find_slices(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Start offsets of the pre-tokens of texts laid end to end.

    *codes* holds code points with one unused cell before each text, whose
    offsets *starts* lists; those cells are slices of their own.
    """
    symbols = symbol_table()[codes]
    symbols[starts] = START
    ahead = np.zeros(len(codes) + 3, np.uint32)
    ahead[: len(codes)] = codes
    ahead[starts] = 0
    at = np.flatnonzero(codes == 0x27)
    at = at[symbols[at] != START]
    if len(at):
        one, two = ahead[at + 1], ahead[at + 2]
        short = np.isin(one, [ord(c) for c in ENDINGS1])
        long = np.zeros(len(at), bool)
        for a, b in ENDINGS2:
            long |= (one == ord(a)) & (two == ord(b))
        symbols[at[short]] = APOS1
        symbols[at[long]] = APOS2
    state = scan_states(symbols)
    white = (symbols == BLANK) | (symbols == SPACE)
    solid = ~white & (symbols != START)
    next_solid = np.append(solid[1:], False)
    kind = symbols.copy()
    kind[(symbols == APOS1) | (symbols == APOS2)] = OTHER
    # A solid sign goes on with a slice of its own kind, an ending, or one blank.
    goes_on = solid & ((state == kind) | (state == IN_B) | (((state == NEED1) | (state == NEED2)) & (symbols == LETTER)))
    # White space goes on with white space, but the last sign before a solid one stands apart.
    goes_on |= white & ((state == IN_B) | (state == IN_S)) & ~next_solid
    return np.flatnonzero(~goes_on)


def merge_pairs(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one slice by repeated merging of its lowest-ranked pair."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        best, at = None, -1
        for i in range(len(parts) - 1):
            r = ranks.get(parts[i] + parts[i + 1])
            if r is not None and (best is None or r < best):
                best, at = r, i
        if best is None:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


def load_ranks(name: str, directory: str) -> dict[bytes, int]:
    with open(os.path.join(directory, f"{name}.tiktoken"), "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


class Encoder:
    """Scanner, merge cache and vocabulary of one worker."""

    def __init__(self, name: str, directory: str):
        self.ranks = load_ranks(name, directory)
        self.known: dict[bytes, list[int]] = {}
        try:
            import tiktoken

            core = tiktoken.Encoding(name, pat_str=r"[\s\S]+", mergeable_ranks=self.ranks, special_tokens={})
            self.merge = lambda piece: core.encode_ordinary(piece.decode())  # the pattern makes any piece one slice
        except ImportError:
            self.merge = lambda piece: merge_pairs(piece, self.ranks)

    def ids_of(self, piece: bytes) -> list[int]:
        got = self.known.get(piece)
        if got is None:
            rank = self.ranks.get(piece)
            got = [rank] if rank is not None else self.merge(piece)
            if len(self.known) >= CACHE_SLICES:
                self.known.clear()
            self.known[piece] = got
        return got

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids, ids per text, slice offsets (in characters), slices per text, ids per slice."""
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        joined = "\n" + "\n".join(texts)
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        starts = np.zeros(len(texts), np.int64)
        np.cumsum(sizes[:-1] + 1, out=starts[1:])
        begin = find_slices(codes, starts)
        end = np.append(begin[1:], len(codes))
        mark = np.zeros(len(codes), bool)
        mark[starts] = True
        keep = ~mark[begin]
        begin, end = begin[keep], end[keep]
        owner = np.searchsorted(starts, begin, side="right") - 1
        first, inverse = unique_slices(joined, codes, begin, end, ~mark)
        found = [self.ids_of(joined[a:b].encode("utf-8", "replace")) for a, b in zip(begin[first].tolist(), end[first].tolist())]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        pool = np.fromiter((i for f in found for i in f), np.int32, int(lengths.sum()))
        pool_at = np.concatenate(([0], np.cumsum(lengths)))[:-1]
        per_slice = lengths[inverse] if len(found) else np.zeros(0, np.int64)
        total = int(per_slice.sum())
        out_at = np.cumsum(per_slice) - per_slice
        index = np.arange(total) + np.repeat((pool_at[inverse] if len(found) else out_at) - out_at, per_slice)
        per_text = np.bincount(owner, weights=per_slice, minlength=len(texts)).astype(np.int64)
        slices = np.bincount(owner, minlength=len(texts))
        return pool[index], per_text, begin - starts[owner] - 1, slices, per_slice


def unique_slices(joined: str, codes: np.ndarray, begin: np.ndarray, end: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, inverse) of the different slices. Slices cover the cells of *inside*, in order.

    Slices are told apart by their keys, and every sign is compared with the one
    in its key's first slice, so two slices of one key are found, not mixed up.
    """
    _, first, inverse = np.unique(slice_keys(codes, begin, end), return_index=True, return_inverse=True)
    size = end - begin
    if len(begin):
        at = np.flatnonzero(inside)
        model = at + np.repeat(begin[first][inverse] - begin, size)
        if not (np.array_equal(size[first][inverse], size) and np.array_equal(codes[at], codes[model])):
            _, first, inverse = np.unique(np.array([joined[a:b] for a, b in zip(begin.tolist(), end.tolist())], object), return_index=True, return_inverse=True)
    return first, inverse


def slice_keys(codes: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit key of each slice from two rolling hashes, without a loop."""
    keys = []
    with np.errstate(over="ignore"):
        for base in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F):
            power = _powers(base, len(codes) + 1)
            inverse = _powers(pow(base, -1, 1 << 64), len(codes) + 1)
            total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((codes.astype(np.uint64) + np.uint64(0x51ED270B)) * power[:-1])))
            keys.append((total[end] - total[begin]) * inverse[begin])
        a, b = keys
        b = (b << np.uint64(31)) | (b >> np.uint64(33))
        return (a ^ b) * np.uint64(0x9FB21C651E98DF25) + (end - begin).astype(np.uint64)


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    held = _POWERS.get(base)
    if held is None or len(held) < n:
        size = 1 << max(n - 1, 1).bit_length()
        held = np.full(size, base, np.uint64)
        held[0] = 1
        with np.errstate(over="ignore"):
            held = np.multiply.accumulate(held)
        _POWERS[base] = held
    return held[:n]


@cache
def encoder(name: str, directory: str) -> Encoder:
    return Encoder(name, directory)


def text_runs(texts: list[str], limit: int = SCAN_CHARS) -> Iterator[list[str]]:
    """Runs of texts of about *limit* characters; a longer text is a run of its own."""
    run, held = [], 0
    for t in texts:
        if run and held + len(t) > limit:
            yield run
            run, held = [], 0
        run.append(t)
        held += len(t) + 1
    if run:
        yield run


def encode(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str = "byte_bpe_50k",
    directory: str = TOKENIZER_DIR,
    offsets: bool = False,
) -> DataFrame:
    """(id, ids) of every row; with *offsets* also where each slice starts and how many ids it has.

    One narrow pass without a shuffle: rows are encoded in the partition that
    reads them. NULL text -> NULL, '' -> []. Rows that share an id stay apart.
    """
    fields = [T.StructField(id_col, df.schema[id_col].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))]
    if offsets:
        fields += [T.StructField(c, T.ArrayType(T.IntegerType())) for c in ("slice_start", "slice_ids")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, directory)
        for batch in batches:
            at = 0
            texts = batch.column(1).to_pylist()
            for part in text_runs([t or "" for t in texts]):
                flat, per_text, begin, slices, per_slice = enc.encode(part)
                null = pa.array([t is None for t in texts[at : at + len(part)]])

                def lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
                    ends = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
                    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.astype(np.int32)), mask=null)

                columns = [batch.column(0).slice(at, len(part)), lists(flat, per_text)]
                if offsets:
                    columns += [lists(begin, slices), lists(per_slice, slices)]
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])
                at += len(part)

    return df.select(F.col(id_col), F.col(text_col)).mapInArrow(run, T.StructType(fields))


def decode(df: DataFrame, id_col: str = "doc_id", tokenizer: str = "byte_bpe_50k", directory: str = TOKENIZER_DIR) -> DataFrame:
    """(id, text) from (id, ids); the inverse of :func:`encode`. NULL ids -> NULL."""
    schema = T.StructType([T.StructField(id_col, df.schema[id_col].dataType), T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = {i: p for p, i in encoder(tokenizer, directory).ranks.items()}
        for batch in batches:
            texts = [None if ids is None else b"".join(piece[i] for i in ids).decode("utf-8", "replace") for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=schema.names)

    return df.select(id_col, "ids").mapInArrow(run, schema)
