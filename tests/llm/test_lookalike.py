"""Ordinary forms case by case, and classes over records."""

import unicodedata

import numpy as np
import pytest

from folioforge.llm import lookalike

SAME = [
    ("ｆｕｌｌ width １２", "full width 12"), ("café".replace("é", "é"), "café"), ("no​space", "nospace"), ("a b　c", "a b c"), ("Тһе ѕсаn", "The scan"), ("cοlumn", "column"),
    ("Кacсовaя книга", "Кассовая книга"), ("so­ft", "soft"), (unicodedata.normalize("NFD", "Bảng lồng nhau"), "Bảng lồng nhau"), ("图 １３：第三列", "图 13：第三列"), ("oﬃce", "office"),
]
STAY = ["½ x²", "α = 0.05 (Δ = 3 mm)", "№ 7, журнал in the margin", "the 👩‍💻 emoji ❤️", "图表说明：参考文本，第三列。", "می‌خواهم", "Выборка BM-7280", "\\frac{α}{2}", "(ж/д накладная)", "", "a\tb\nc"]
RECORD = "tbl string, rec_id long, content map<string,string>"


def forms(spark, texts):
    """Each text's form where the texts are all there is."""
    rows = [("t", i, {"m": t}) for i, t in enumerate(texts)]
    changed = {r.rec_id: r.canonical for r in lookalike.canonical(spark.createDataFrame(rows, RECORD)).collect()}
    return [changed.get(i, t) for i, t in enumerate(texts)]


def test_forms(spark):
    assert forms(spark, [odd for odd, _ in SAME]) == [plain for _, plain in SAME]


def test_ordinary_text_stays(spark):
    assert forms(spark, STAY) == STAY


def test_words_against_a_plain_loop():
    texts = [a for a, _ in SAME if lookalike.mapped(a) == a] + [t for t in STAY if t and lookalike.mapped(t) == t]
    words = lookalike.Words(texts)
    found = [[] for _ in texts]
    for i, o in enumerate(words.owner.tolist()):
        found[o].append(words.word(i))
    for t, got in zip(texts, found):
        want, run = [], ""
        for ch in t + " ":
            if ch.isalpha() and ord(ch) < 0x3100:
                run += ch
            elif run:
                want, run = [*want, run], ""
        assert got == want
    assert np.array_equal(words.pure, [len({lookalike.script(c) for c in words.word(i)} - {""}) < 2 and not set(words.word(i)) & (lookalike.NOT_RUSSIAN | {"ɡ"}) for i in range(len(words.owner))])


def test_classes_of_all_words_decide(spark):
    rows = [("t", i, {"m": "сор и мусор лежат рядом"}) for i in range(5)] + [("t", i, {"m": "the cop and the car"}) for i in range(10, 13)]
    rows += [("t", 20, {"m": "the сор and the car"}), ("t", 21, {"m": "Касcовая книга"}), ("t", 22, {"m": "Кассовая книга"}), ("t", 23, {"m": "the Тһе scan"})]
    rows += [("t", 30, {"m": "ТНЕ"}), ("t", 31, {"m": "ТНЕ"}), *[("t", 40 + i, {"m": f"THE scan of page {i}"}) for i in range(4)]]  # nothing but look-alikes: the class over all values
    got = {r.rec_id: r.canonical for r in lookalike.canonical(spark.createDataFrame(rows, RECORD).repartition(4)).collect()}
    assert got == {20: "the cop and the car", 21: "Кассовая книга", 23: "the The scan", 30: "THE", 31: "THE"}


def test_open_words_follow_their_class(spark):
    rows = [("t", i, {"m": "a note on paper"}) for i in range(5)] + [("t", 10, {"m": "only а note on this"}), ("t", 11, {"m": "văn bản (рус. «штамп») của trang"}), ("t", 12, {"m": "(рус. «штамп») nữa"})]
    got = {r.rec_id: r.canonical for r in lookalike.canonical(spark.createDataFrame(rows, RECORD)).collect()}
    assert got == {10: "only a note on this"}


def test_prepositions_between_russian_words(spark):
    rows = [("t", i, {"m": "очередь сравнивается с общей меткой"}) for i in range(3)] + [("t", 9, {"m": "очередь сравнивается c общей меткой"}), ("t", 10, {"m": "c. Отсканированная страница"}), ("t", 11, {"m": "квотой ячейки XC-5 в третий раз"})]
    got = {r.rec_id: r.canonical for r in lookalike.canonical(spark.createDataFrame(rows, RECORD)).collect()}
    assert got == {9: "очередь сравнивается с общей меткой"}


def test_records(spark):
    rows = [("t", 1, {"m": "Th​e scan", "p": "The scan", "q": None}), ("t", 2, None), ("t", 3, {}), ("t", 4, {"m": "The scan"}), ("t", 5, {"m": "ｘ" * 50000}), ("t", 1, {"m": "Th​e scan"})]
    df = spark.createDataFrame(rows, RECORD).repartition(3)
    got = lookalike.canonical(df).collect()
    assert {(r.rec_id, r.canonical[:8]) for r in got} == {(1, "The scan"), (5, "xxxxxxxx")}
    assert lookalike.canonical(spark.createDataFrame([], RECORD)).collect() == []


def test_collation_tells_accents_apart(spark):
    df = spark.createDataFrame([("é",), ("é",), ("e",), ("E",)], "t string")
    assert df.select(lookalike.collated(df.t).alias("k")).distinct().count() == 3
