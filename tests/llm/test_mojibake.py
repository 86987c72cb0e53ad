"""Round trips through wrong decodings, quotations, and odd texts."""

import pytest

from folioforge.llm import mojibake

VI = "Bảng lồng nhau được so sánh với phán quyết trước đó từ khi huấn luyện lại."
FR = "La pièce jointe répète l'étiquette retenue, même très abîmée, à l'œil nu."
RU = "Сложная очередь сравнивается с общей меткой в третий раз."
ZH = "嵌套表格与编号列表在夜班期间被合并。"


@pytest.mark.parametrize("text", [VI, FR, RU, ZH])
@pytest.mark.parametrize("codec", ["latin-1", "cp437", "mac_roman"])
def test_utf8_round_trip(text, codec):
    wrong = text.encode("utf-8").decode(codec)
    fixed, n, lost, _ = mojibake.repair_line(wrong)
    assert fixed == text and n == 1 and lost == 0


def test_double_and_single_byte():
    assert mojibake.repair_line(FR.encode().decode("latin-1").encode().decode("latin-1"))[0] == FR
    assert mojibake.repair_line(RU.encode("koi8-r").decode("cp1251"))[0] == RU
    assert mojibake.repair_line(RU.encode("cp1251").decode("latin-1"))[0] == RU


@pytest.mark.parametrize("text", [VI, FR, RU, ZH, "plain", "39 °C ±8.0 “quoted” ½", "✔ ✘ → §", "🙂👍 ok", 'The log shows "Ã©" for "é".', "пример: «Ñ\x8f» (нужно «я»)"])
def test_sound_text_stays(text):
    fixed, n, lost, _ = mojibake.repair_line(text)
    assert fixed == text and not n and not lost


def test_rows(spark):
    long = (FR + " ") * 3000
    rows = [(1, None, "a"), (2, "", "b"), (3, FR, None), (4, f"{RU}\n{FR.encode().decode('latin-1')}", None), (5, "une r�gion num�ris�e", None), (6, long, "x"), (4, f"{RU}\n{FR.encode().decode('latin-1')}", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, chain string").repartition(3)
    got = mojibake.restore(df).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 7
    assert [by[k].garbled for k in range(1, 7)] == [False, False, False, True, True, False]
    assert by[1].restored is None and by[2].restored == "" and by[4].restored == f"{RU}\n{FR}" and by[4].complete
    assert by[5].n_lost >= 2 and not by[5].complete and by[6].restored == long
    assert mojibake.restore(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_lines_are_found_whatever_the_batch():
    texts = ["", "a\nb", "x\nÃ©tÃ©\ny", "Ã©"]
    assert [(o, texts[o][s:e]) for o, s, e in mojibake.suspicious_lines(texts)] == [(2, "Ã©tÃ©"), (3, "Ã©")]
