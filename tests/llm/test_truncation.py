"""Slots and counts against brute force, held-out accuracy on made values, and odd rows."""

import random
from collections import Counter
from datetime import datetime

import numpy as np

from folioforge.llm import truncation
from folioforge.llm.language import UNKNOWN, fit_languages

ELEMENT = "element_id long, label string, content map<string,string>, loaded_at timestamp, tbl string, source string"
VERDICT = "verdict_id long, element_id long, judge_model string, corrected string"
T0 = datetime(2025, 1, 1)


def test_slots_tell_contexts_apart():
    texts = ["abcdef", "xbcdef", "abcdef", "Äbcdef", "(abcdef"]
    laid = truncation.Laid(texts, np.zeros(5, np.int64))
    short, whole = laid.slots(1, laid.last), laid.whole()
    assert short[0] == short[1] == short[2] == short[3] != short[4]
    assert whole[0] == whole[2] == whole[3] != whole[1]


def test_everywhere_counts_each_character_once():
    texts = ["abcabc", "xabc", ""]
    texts = [t for t in texts if t]
    laid = truncation.Laid(texts, np.zeros(2, np.int64))
    assert len(laid.everywhere(0)) == sum(map(len, texts))
    n = Counter(laid.everywhere(0).tolist())
    assert n[int(laid.slots(0, laid.last)[0])] == 3  # "bc" in one state, three times


def test_no_two_contexts_share_a_key():
    rnd = random.Random(2)
    texts = ["".join(rnd.choice("abcdefghijklmnop") for _ in range(12)) for _ in range(60000)]
    laid = truncation.Laid(texts, np.zeros(len(texts), np.int64))
    for k, n in enumerate(truncation.ORDERS):
        assert len(set(laid.slots(k, laid.last).tolist())) == len({t[-n:] for t in texts})
    assert len(set(laid.whole().tolist())) == len(set(texts))


def test_counts_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(truncation, "FILTER_BITS", (18, 18))  # small, so that contexts which end no value pass the bitmap
    rnd = random.Random(3)
    texts = sorted({"".join(rnd.choice("abcdefghijklmnop ") for _ in range(rnd.randint(14, 60))).strip() + "q" for _ in range(6000)})
    rows = [(i, "text", {"m": t}, T0, None, None) for i, t in enumerate(texts)]
    contexts = truncation.final_contexts(truncation.page_values(spark.createDataFrame(rows, ELEMENT).repartition(3)), fit_languages(None))
    counts = truncation.count_contexts(contexts).collect()
    laid = truncation.Laid(texts, np.zeros(len(texts), np.int64))
    for k, n in enumerate(truncation.ORDERS):
        ends, everywhere = Counter(t[-n:] for t in texts), Counter()
        for t in texts:
            everywhere.update(x for j in range(1, len(t) + 1) if (x := t[max(j - n, 0) : j]) in ends)
        got = {r.key: (r.n_end, r.n_all) for r in counts if r.o == k}
        assert got == {key: (ends[t[-n:]], everywhere[t[-n:]]) for key, t in zip(laid.slots(k, laid.last).tolist(), texts)}


def made(n=1200, seed=4):
    rnd = random.Random(seed)
    subjects, verbs, things = ["The parser", "This annotation batch", "The second reviewer", "A nested table", "The intake team"], ["repeats", "covers", "misreads", "contradicts"], ["the numbered list", "a torn corner", "the survey map", "the footnotes", "an empty region"]
    rows, cut = [], set()
    for i in range(n):
        t = " ".join(f"{rnd.choice(subjects)} {rnd.choice(verbs)} {rnd.choice(things)} on page {rnd.randint(1, 99)}." for _ in range(rnd.randint(1, 3)))
        if i % 12 == 0:
            cut.add(i)
            t = t[: rnd.randint(14, len(t) - 6)].rstrip(". ")
        rows.append((i, "text", {"m": t}, T0, None, None))
    return rows, cut


def test_held_out_cuts(spark):
    rows, cut = made()
    df = truncation.detect(spark.createDataFrame(rows, ELEMENT).repartition(3), spark.createDataFrame([], VERDICT))
    found = {r.rec_id for r in df.filter("cut").collect()}
    assert len(found & cut) / len(cut) > 0.9 and len(found - cut) < 0.02 * len(rows)


def test_copies_are_no_evidence_for_their_own_end(spark):
    rows, _ = made()
    cut = "The second reviewer contradicts the footno"
    once = truncation.detect(spark.createDataFrame([*rows, (5000, "text", {"m": cut}, T0, None, None)], ELEMENT), spark.createDataFrame([], VERDICT))
    many = truncation.detect(spark.createDataFrame([*rows, *[(5000 + i, "text", {"m": cut}, T0, None, None) for i in range(600)]], ELEMENT).repartition(5), spark.createDataFrame([], VERDICT))
    one = [r.logodds for r in once.filter("rec_id >= 5000").collect()]
    all_copies = [(r.logodds, r.cut) for r in many.filter("rec_id >= 5000").collect()]
    assert len(all_copies) == 600 and all(c and abs(x - one[0]) < 1e-9 for x, c in all_copies)


def counted(text, others):
    plain = truncation.spelt_plainly([text, *others])
    return truncation.local_counts(plain[0], plain[1:])


def test_other_readings_are_counted():
    assert counted("The table lists the survey m", ["The table lists the survey map."]) == [0, 1, 0, 1]
    assert counted("A title - the survey map", ["Q title - the survey map"]) == [1, 1, 1, 1]
    assert counted("A title", ["something else"]) == [0, 0, 0, 0]
    assert counted("a map", ["a map", "a map of the a map"]) == [1, 2, 1, 2]  # short values compare from their beginning


def test_other_spellings_are_counted_alike():
    assert counted("Moi o gộp", ["Mỗi ô gộp"]) == [1, 1, 1, 1]
    assert counted("Thứ​ tự đọc", ["THU TU ĐOC"]) == [1, 1, 1, 1]
    assert counted("The tаble lists the survey m", ["The table lists the survey map."]) == [0, 1, 0, 1]


def test_whole_readings_are_counted_beside_verdicts(spark):
    rows = [(1, "text", {"m": "The second reviewer repeats the survey map of the north." + " And more." * 40}, T0, None, None), (2, "text", {"m": "x"}, T0, None, None)]
    verdicts = [(1, 1, "j", "The second reviewer repeats the survey m"), (2, 2, "j", "The second reviewer repeats the survey m")]
    got = {r.rec_id: (r.local_end12, r.local_all12) for r in truncation.detect(spark.createDataFrame(rows, ELEMENT), spark.createDataFrame(verdicts, VERDICT)).filter("tbl = 'judge_verdict'").collect()}
    assert got == {1: (0, 1), 2: (0, 0)}  # far from the reading's end, and the element's own readings only


def test_element_counts_adapt_the_estimate(spark):
    rows, _ = made()
    title = "The second reviewer contradicts"
    same = (5000, "text", {"m": title, "p": title + "", "q": "The  second reviewer contradicts"}, T0, None, None)
    cut = (5001, "text", {"m": title, "p": title + " the footnotes on page 7.", "q": title + " the footnotes on page 7."}, T0, None, None)
    got = truncation.detect(spark.createDataFrame([*rows, same, cut], ELEMENT), spark.createDataFrame([], VERDICT)).filter("rec_id >= 5000 and source = 'm'").collect()
    assert {r.rec_id: r.cut for r in got} == {5000: False, 5001: True} and abs(got[0].general - got[1].general) < 1e-9


def test_valley_lies_between_the_humps():
    width = (truncation.HIGH - truncation.LOW) / truncation.BINS
    middle = truncation.LOW + (np.arange(truncation.BINS) + 0.5) * width
    two = 1000 * np.exp(-((middle - 1) ** 2)) + 100 * np.exp(-((middle + 7) ** 2))
    assert -6 < truncation.valley(two, width) < -1
    assert truncation.valley(np.zeros(truncation.BINS), width) == truncation.DEFAULT_THRESHOLD
    three = 1000 * np.exp(-(((middle - 7) / 0.3) ** 2)) + 300 * np.exp(-((middle - 1) ** 2)) + 100 * np.exp(-((middle + 7) ** 2)) + 1
    assert -6 < truncation.valley(three, width) <= 0  # not the empty stretch between two kinds of finished values


def test_languages_are_learned(spark):
    words = {"en": "the table of the page with margins", "vi": "bảng của trang này với chữ đậm", "ru": "таблица этой страницы с полями"}
    rows = [(i, " ".join(random.Random(i).sample(words[lang].split(), 5)), tag) for i, (lang, tag) in enumerate([("en", "EN"), ("vi", "vi-VN"), ("ru", "ru")] * 40)] + [(900, None, "en"), (901, "x", None), (902, "x", "")]
    model = fit_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.names == ["en", "ru", "vi"]
    texts = list(words.values())
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    assert model.of(codes, np.cumsum([0, *map(len, texts[:-1])])) == ["en", "vi", "ru"]
    empty = fit_languages(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert empty.of(codes, np.array([0])) == [UNKNOWN]


def test_odd_rows(spark):
    rows = [(1, None, {"m": None, "p": "", "q": "   "}, None, "x", "y"), (2, "text", None, T0, None, None), (None, "text", {"m": "x"}, T0, None, None), (3, "table", {"m": "| a | b |\n| c | d |"}, T0, None, None), (4, "text", {"m": "​́"}, T0, None, None), (5, "other", {"m": "y" * 70000}, T0, None, None), (3, "table", {"m": "| a | b |\n| c | d |"}, T0, None, None)]
    verdicts = [(1, 3, "j", "| a |"), (2, None, None, "text."), (None, 3, "j", "x"), (3, 3, "j", None), (4, 99, "j", " ")]
    got = truncation.detect(spark.createDataFrame(rows, ELEMENT), spark.createDataFrame(verdicts, VERDICT)).collect()
    assert {(r.tbl, r.rec_id) for r in got} == {("page_element", 3), ("page_element", 5), ("judge_verdict", 1), ("judge_verdict", 2)}
    assert truncation.detect(spark.createDataFrame([], ELEMENT), spark.createDataFrame([], VERDICT)).collect() == []


def test_field_limit_is_seen(spark):
    rows = [("t", "m", 100 + i % 60, 1) for i in range(300)] + [("t", "m", 240, 1)] * 40
    df = spark.createDataFrame(rows, "tbl string, source string, n_chars int, x int")
    assert [(r.source, r.n_chars) for r in truncation.field_limits(df).collect()] == [("m", 240)]
