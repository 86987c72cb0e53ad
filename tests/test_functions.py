"""Column functions case by case, and against brute force in plain Python."""

import math
import random

import pytest
from pyspark.sql import functions as F

from folioforge.functions import box, sequence, text, vector


def lev(a, b):
    prev = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        cur = [i]
        for j, y in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[-1] + 1, prev[j - 1] + (x != y)))
        prev = cur
    return prev[-1]


def one(spark, expr, schema, *rows):
    return [r[0] for r in spark.createDataFrame(list(rows), schema).select(expr).collect()]


def test_edit_similarity_against_brute_force(spark):
    rnd = random.Random(1)
    rows = [("".join(rnd.choice("abé漢 ") for _ in range(rnd.randint(0, 9))), "".join(rnd.choice("abé漢 ") for _ in range(rnd.randint(0, 9)))) for _ in range(200)] + [("", ""), ("a", "")]
    got = one(spark, text.edit_similarity(F.col("a"), F.col("b")), "a string, b string", *rows)
    for (a, b), g in zip(rows, got):
        assert abs(g - (1.0 if not a and not b else 1 - lev(a, b) / max(len(a), len(b)))) < 1e-12


def test_threshold_mode_agrees(spark):
    rnd = random.Random(2)
    rows = [("".join(rnd.choice("ab") for _ in range(rnd.randint(0, 12))), "".join(rnd.choice("ab") for _ in range(rnd.randint(0, 12)))) for _ in range(200)]
    a, b = F.col("a"), F.col("b")
    assert all(one(spark, text.at_least_similar(a, b, 0.7) == (text.edit_similarity(a, b) >= 0.7), "a string, b string", *rows))


def test_norm_text(spark):
    assert one(spark, text.norm_text(F.col("a")), "a string", (None,), ("",), (" a \n b ",), ("ｆｕｌｌ ﬁ",), ("é",)) == ["", "", "a b", "full fi", "é"]


def test_token_similarity_against_brute_force(spark):
    rnd = random.Random(3)
    words = ["\\frac", "x", "1", "<tr>", "c1x1", "漢"]
    rows = [([rnd.choice(words) for _ in range(rnd.randint(0, 7))], [rnd.choice(words) for _ in range(rnd.randint(0, 7))]) for _ in range(150)] + [([], [])]
    got = one(spark, sequence.token_similarity(F.col("a"), F.col("b")), "a array<string>, b array<string>", *rows)
    for (a, b), g in zip(rows, got):
        assert abs(g - (1.0 if not a and not b else 1 - lev(a, b) / max(len(a), len(b)))) < 1e-12


def test_latex(spark):
    got = one(spark, sequence.latex_tokens(F.col("a")), "a string", ("\\dfrac{12}{x} \\left( y \\right)",), ("a \\, b",), (None,))
    assert got == [["\\frac", "1", "2", "x", "(", "y", ")"], ["a", "\\", ",", "b"], []]
    assert one(spark, sequence.formula_similarity(F.col("a"), F.col("b")), "a string, b string", ("\\tfrac{1}{2}", "\\frac 1 2"), ("", None)) == [1.0, 1.0]


def test_tables(spark):
    a = "<table><tr><td>a</td><td colspan='2'>b c</td></tr><tr><td>1</td>"
    rows = one(spark, sequence.table_rows("a"), "a string", (a,), ("",), (None,), ("no table",))
    assert [[(c.rs, c.cs, c.txt) for c in r] for r in rows[0]] == [[(1, 1, "a"), (1, 2, "b c")], [(1, 1, "1")]] and rows[1] == rows[2] == []
    df = spark.createDataFrame([(a, a), (a, "<table><tr><td>a</td></tr></table>"), ("", "")], "a string, b string")
    got = [r[0] for r in df.select(sequence.table_rows("a").alias("x"), sequence.table_rows("b").alias("y")).select(sequence.table_similarity(F.col("x"), F.col("y"))).collect()]
    assert got[0] == 1.0 and got[2] == 1.0 and abs(got[1] - (0.5 * (1 - 3 / 5) + 0.5 / 3)) < 1e-9


def test_extraction(spark):
    md = "x $$a+b$$ y \\[c\\] $$ $$\n| h | k |\n|---|---|\n| 1 | 2 |\ntext\n| alone |\n<TABLE><tr></tr></TABLE>"
    assert one(spark, text.formulas(F.col("a")), "a string", (md,), (None,), ("",)) == [["a+b", "c"], [], []]
    assert one(spark, text.pipe_tables(F.col("a")), "a string", (md,), (None,))[0] == ["<table><tr><td>h</td><td>k</td></tr><tr><td>1</td><td>2</td></tr></table>"]
    assert one(spark, F.size(text.html_tables(F.col("a"))), "a string", (md,)) == [1]
    assert one(spark, text.strip_math_delims(F.col("a")), "a string", ("$$ x $$",), ("\\[y\\]",), ("\\( $z$ \\)",), ("w",)) == ["x", "y", "$z$", "w"]


def test_labels(spark):
    got = one(spark, text.canon_label(F.col("a")), "a string", ("Section-Header",), (" list__item",), ("isolate_formula",), ("odd",), (None,), ("Table Body",))
    assert got == ["title", "list", "formula", "text", "text", "table"]


def test_replies(spark):
    got = one(spark, text.verdict(F.col("a")), "a string", ('ok {"has_error": true, "confidence": 0.5, "corrected": " ", "note": "n"} end',), ('{"confidence": 1}',), ("none",), ('{"has_error": false}',), (None,))
    assert got[0].has_error and got[0].corrected is None and got[0].confidence == 0.5 and got[1] is None and got[2] is None and got[4] is None
    assert got[3].has_error is False and got[3].confidence == 0.0
    blocks = one(spark, text.reply_blocks(F.col("a")), "a string", ('x [{"type": "Equation", "content": "a", "bbox": [1, 2, 3, 4]}, {"label": "text", "text": ""}]',), ("[]",), ("broken",))
    assert [(b.label, b.content) for b in blocks[0]] == [("formula", "a"), ("text", "")] and blocks[1] == [] and blocks[2] is None
    assert [(r.path, r.page) for r in one(spark, text.page_ref(F.col("a")), "a string", ("f.pdf#7",), ("a.png",), ("a#b#x",))] == [("f.pdf", 7), ("a.png", 0), ("a#b", None)]


def test_boxes(spark):
    rows = [([0.5, 0.5, 0.1, 0.1],), ([0.0, 0.0, 0.0001, 1.0],), ([0.1, None, 0.2, 0.3],), (None,), ([1.0, 2.0],), ([0.0, 0.0, float("nan"), 1.0],)]
    got = one(spark, box.absolute_box(F.col("b"), F.lit(1000), F.lit(2000), "norm1"), "b array<double>", *rows)
    assert got[0] == [100.0, 200.0, 500.0, 1000.0] and got[1:] == [None] * 5
    got = one(spark, box.absolute_box(F.col("b"), F.lit(1000), F.lit(2000), "abs"), "b array<double>", ([-5.0, 10.0, 5000.0, 20.0],))
    assert got == [[0.0, 10.0, 1000.0, 20.0]]


def greedy(a, b):
    pairs = []
    for i, (la, x) in enumerate(a):
        for j, (lb, y) in enumerate(b):
            w, h = max(min(x[2], y[2]) - max(x[0], y[0]), 0), max(min(x[3], y[3]) - max(x[1], y[1]), 0)
            u = (x[2] - x[0]) * (x[3] - x[1]) + (y[2] - y[0]) * (y[3] - y[1]) - w * h
            if la == lb and w * h / max(u, 1e-6) >= 0.5:
                pairs.append((w * h / max(u, 1e-6), i, j))
    ua, ub = set(), set()
    for _, i, j in sorted(pairs, reverse=True):
        if i not in ua and j not in ub:
            ua.add(i)
            ub.add(j)
    return 1.0 if not a and not b else 0.0 if not a or not b else 2 * len(ua) / (len(a) + len(b))


def test_layout_f1_against_brute_force(spark):
    rnd = random.Random(4)

    def page():
        out = []
        for _ in range(rnd.randint(0, 5)):
            x, y = rnd.randint(0, 6), rnd.randint(0, 6)
            out.append((rnd.choice("ab"), [float(x), float(y), float(x + rnd.randint(2, 5)), float(y + rnd.randint(2, 5))]))
        return out

    rows = [(page(), page()) for _ in range(120)]
    got = one(spark, box.layout_f1(F.col("a"), F.col("b")), "a array<struct<label:string,box:array<double>>>, b array<struct<label:string,box:array<double>>>", *rows)
    assert all(abs(g - greedy(a, b)) < 1e-9 for (a, b), g in zip(rows, got))


def test_vectors(spark):
    got = one(spark, vector.unit(F.col("v")), "v array<double>", ([3.0, 4.0],), ([0.0, 0.0],))
    assert got == [[0.6, 0.8], [0.0, 0.0]]
    assert one(spark, vector.combine([(F.col("v"), 1.0), (F.col("v"), 0.0), (F.col("v"), 2.0)]), "v array<double>", ([3.0, 4.0],)) == [[0.6, 0.8, 1.2, 1.6]]
    with pytest.raises(ValueError):
        vector.combine([(F.col("v"), 0.0)])
    h = one(spark, vector.entropy([F.col("a"), F.col("b"), F.col("c")]), "a int, b int, c int", (1, 1, 0), (0, 0, 0))
    assert abs(h[0] - math.log(2)) < 1e-12 and h[1] == 0.0


def test_traps(spark):
    assert one(spark, text.squash(F.col("a")), "a string", ("a\xa0\u2007 b\u3000",)) == ["a b"]  # blanks of all kinds
    assert one(spark, sequence.positional_similarity(F.col("a"), F.col("b"), text.edit_similarity), "a array<string>, b array<string>", (["x", "y", "z"], ["y", "z"]), ([], [])) == [0.0, 1.0]  # one missing shifts all
    small = one(spark, box.absolute_box(F.col("b"), F.lit(1000), F.lit(1000), "auto"), "b array<double>", ([0.0, 0.0, 1.2, 1.2], ), ([0.0, 0.0, 900.0, 900.0],))
    assert small[0] == [0.0, 0.0, 1000.0, 1000.0] and small[1] == [0.0, 0.0, 900.0, 900.0]  # auto misreads small boxes
    assert one(spark, box.area(F.col("b")), "b array<double>", (None,)) == [None]
    assert one(spark, text.is_empty_result(F.col("t"), F.col("b")), "t string, b array<int>", (None, None), ("\n", []), ("x", None), ("", [1])) == [True, True, False, False]
