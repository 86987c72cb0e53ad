"""Text columns: normal form, edit similarity, extraction from markdown and model replies.

Everything but the compatibility normalisation is a Catalyst expression. NULL
means unknown and '' asserted empty; only :func:`norm_text` turns NULL into ''.
"""

from __future__ import annotations

import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import LABEL_ALIASES


def _nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFKC", t))


def squash(c: Column) -> Column:
    """Runs of white space of any kind as one blank, none at the ends; NULL as ''."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), "(?U)\\s+", " "))


def norm_text(c: Column, compatibility: bool = True) -> Column:
    """Compatibility-composed text with squashed white space. ASCII needs no *compatibility* step."""
    return squash(F.pandas_udf(_nfkc, "string")(c) if compatibility else c)


def edit_similarity(a: Column, b: Column) -> Column:
    """1 - edit distance / longer length; 1 where both are empty."""
    n = F.greatest(F.length(a), F.length(b))
    return F.when(n == 0, F.lit(1.0)).otherwise(1 - F.levenshtein(a, b) / n)


def at_least_similar(a: Column, b: Column, tau: float) -> Column:
    """edit_similarity(a, b) >= tau, giving up as soon as it cannot be."""
    n = F.greatest(F.length(a), F.length(b))
    most = F.floor((1 - tau) * n + 1e-9).cast("int")
    return F.when(n == 0, F.lit(True)).otherwise(F.levenshtein(a, b) <= most)


def preview(c: Column, n: int = 220) -> Column:
    """The first *n* characters without blanks at the ends."""
    return F.left(F.trim(c), F.lit(n))


def strip_math_delims(c: Column) -> Column:
    """A formula without the dollar signs or brackets around it."""
    return F.trim(F.regexp_replace(F.trim(c), "^(\\$\\$|\\$|\\\\\\[|\\\\\\()+\\s*|\\s*(\\$\\$|\\$|\\\\\\]|\\\\\\))+$", ""))


def formulas(c: Column) -> Column:
    """Display formulas of a markdown text, in order, without delimiters; NULL -> []."""
    hits = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit("(?s)(\\$\\$.+?\\$\\$|\\\\\\[.+?\\\\\\])"), F.lit(1))
    inner = F.transform(hits, lambda h: F.trim(F.substring(h, F.lit(3), F.length(h) - 4)))
    return F.filter(inner, lambda h: h != "")


def html_tables(c: Column) -> Column:
    """HTML tables of a markdown text, in order; NULL -> []."""
    return F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit("(?is)(<table\\b.*?</table>)"), F.lit(1))


def pipe_tables(c: Column) -> Column:
    """Pipe tables of a markdown text as HTML, in order: blocks of lines in bars with two rows or more.

    One fold over the lines: the state holds finished tables and the open block;
    separator rows are dropped.
    """
    lines = F.transform(F.split(F.coalesce(c, F.lit("")), "\\r\\n|\\r|\\n"), lambda x: F.trim(x))
    lines = F.concat(lines, F.array(F.lit("")))  # an end marker closes the last block
    empty = F.array().cast("array<string>")
    start = F.struct(empty.alias("done"), empty.alias("block"))

    def cells(row: Column) -> Column:
        bare = F.regexp_replace(row, "^\\|+|\\|+$", "")
        return F.concat(F.lit("<tr>"), F.array_join(F.transform(F.split(bare, "\\|"), lambda x: F.concat(F.lit("<td>"), F.trim(x), F.lit("</td>"))), ""), F.lit("</tr>"))

    def close(acc: Column) -> Column:
        rows = F.filter(acc["block"], lambda r: ~r.rlike("^\\|[\\s:\\-|]+\\|$"))
        table = F.concat(F.lit("<table>"), F.array_join(F.transform(rows, cells), ""), F.lit("</table>"))
        return F.when(F.size(rows) >= 2, F.concat(acc["done"], F.array(table))).otherwise(acc["done"])

    def step(acc: Column, line: Column) -> Column:
        inside = line.startswith("|") & line.endswith("|") & (line != "")
        return F.when(inside, F.struct(acc["done"].alias("done"), F.concat(acc["block"], F.array(line)).alias("block"))).otherwise(F.struct(close(acc).alias("done"), empty.alias("block")))

    return F.aggregate(lines, start, step, lambda acc: acc["done"])


def canon_label(c: Column) -> Column:
    """A provider's block label as one of text, title, list, caption, formula, table; unknown -> text."""
    key = F.regexp_replace(F.lower(F.trim(c)), "[\\s_\\-]+", " ")
    return reduce(lambda acc, kv: acc.when(key.isin(kv[1]), kv[0]), LABEL_ALIASES.items(), F.when(F.lit(False), "")).otherwise("text")


def verdict(c: Column) -> Column:
    """STRUCT<has_error, confidence, corrected, note> of a judge's reply; NULL where it holds no verdict.

    The widest {...} is parsed; has_error must be there; a blank correction is
    none; confidence defaults to 0.
    """
    raw = F.regexp_extract(c, "(?s)\\{.*\\}", 0)
    parsed = F.from_json(raw, "has_error boolean, confidence double, corrected string, note string")
    fixed = F.when(parsed["corrected"].rlike("(?U)\\S"), parsed["corrected"])
    return F.when(parsed["has_error"].isNotNull(), F.struct(parsed["has_error"].alias("has_error"), F.coalesce(parsed["confidence"], F.lit(0.0)).alias("confidence"), fixed.alias("corrected"), F.coalesce(parsed["note"], F.lit("")).alias("note")))


def reply_blocks(c: Column) -> Column:
    """Blocks of a model's reply: NULL where it cannot be read, [] for a blank page.

    Labels, contents and boxes go by several names.
    """
    raw = F.regexp_extract(c, "(?s)\\[.*\\]", 0)
    kinds = "array<struct<type:string,label:string,category:string,content:string,text:string,bbox:array<double>,box:array<double>>>"
    parsed = F.from_json(F.when(raw != "", raw), kinds)
    return F.transform(parsed, lambda b: F.struct(canon_label(F.coalesce(b["type"], b["label"], b["category"])).alias("label"), F.coalesce(b["content"], b["text"]).alias("content"), F.coalesce(b["bbox"], b["box"]).alias("box")))


def page_ref(c: Column) -> Column:
    """STRUCT<path, page> of "file#page"; page 0 without a mark, NULL where it is no number."""
    mark = F.instr(c, "#") > 0
    last = F.split_part(c, F.lit("#"), F.lit(-1))
    return F.struct(F.regexp_replace(c, "#[^#]*$", "").alias("path"), F.when(~mark, F.lit(0)).otherwise(F.try_to_number(last, F.lit("999999999")).cast("int")).alias("page"))


def is_empty_result(text: Column, *lists: Column) -> Column:
    """A page result without text, and with nothing in any of *lists* (blocks, formulas, tables); NULL lists hold nothing."""
    empty = ~F.coalesce(text, F.lit("")).rlike("(?U)\\S")
    return reduce(lambda acc, x: acc & (F.coalesce(F.size(x), F.lit(0)) <= 0), lists, empty)


def markdown_result(c: Column) -> Column:
    """STRUCT<text, formulas, tables> of a reply without blocks: formulas and HTML tables are cut out of the text; NULL stays NULL.

    Pipe tables are among the tables, as HTML, and stay in the text.
    """
    bare = F.regexp_replace(F.regexp_replace(c, "(?is)<table\\b.*?</table>", " "), "(?s)\\$\\$.+?\\$\\$|\\\\\\[.+?\\\\\\]", " ")
    return F.when(c.isNotNull(), F.struct(F.regexp_replace(bare, "(?U)^\\s+|\\s+$", "").alias("text"), formulas(c).alias("formulas"), F.concat(html_tables(c), pipe_tables(c)).alias("tables")))
