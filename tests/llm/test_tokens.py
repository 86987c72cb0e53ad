"""Ids against the public library, brute force on odd texts, and exact round trips."""

import random

import numpy as np
import pytest

from folioforge.llm import tokens

tiktoken = pytest.importorskip("tiktoken")
PATTERN = r"'(?:s|t|re|ve|m|ll|d)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@pytest.fixture(scope="module")
def own():
    return tokens.Encoder("byte_bpe_50k", tokens.TOKENIZER_DIR)


@pytest.fixture(scope="module")
def public(own):
    return tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=own.ranks, special_tokens={})


def ids(enc, texts):
    flat, per_text, *_ = enc.encode(texts)
    ends = np.cumsum(per_text)
    return [flat[a:b].tolist() for a, b in zip(ends - per_text, ends)]


def test_random_texts(own, public):
    rnd = random.Random(11)
    signs = ["'", "'s", "'re", "'l", " ", "  ", "\n", "\t", "a", "Z", "é", "漢", "1", "½", "_", "-", "\xa0", "\x1c", "👩‍💻", "ve", "\r\n", "　"]
    texts = ["".join(rnd.choice(signs) for _ in range(rnd.randint(0, 16))) for _ in range(5000)]
    texts += ["", " ", "a" * 5000, " " * 3000, "'" * 999, "<|endoftext|>"]
    assert ids(own, texts) == [public.encode_ordinary(t) for t in texts]


def test_pure_merges_agree(own):
    for piece in (b"hello", " größer".encode(), b"zzzzqqqq", "漢字".encode(), b"0123456789"):
        assert tokens.merge_pairs(piece, own.ranks) == own.ids_of(piece)


def test_scan_is_independent_of_the_block(own):
    symbols = np.random.default_rng(1).integers(0, 8, 4099).astype(np.uint8)
    assert (tokens.scan_states(symbols, 16) == tokens.scan_states(symbols, 512)).all()


def test_null_empty_repeated_and_extra_columns(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, "Hello world", "x"), (3, "Hello world", "y"), (4, "w " * 70000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(3)
    got = tokens.encode(df, offsets=True).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 5 and by[1].ids is None and by[2].ids == []
    assert by[3].ids == [15496, 995] and by[3].slice_start == [0, 5] and by[3].slice_ids == [1, 1]
    back = {r.doc_id: r.text for r in tokens.decode(tokens.encode(df)).collect()}
    assert back == {1: None, 2: "", 3: "Hello world", 4: "w " * 70000}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert tokens.encode(df).collect() == []
