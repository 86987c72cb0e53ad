"""Edit similarity of token sequences, and the LaTeX and table tokens it is used on."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import edit_similarity, squash

# Commands and signs that leave no trace in a formula's tokens, and commands of one meaning.
LATEX_SILENT = r"\\(?:left|right|,|;|!|quad|qquad|displaystyle|limits)\b|\s+|{|}"
LATEX_SAME = [("\\dfrac", "\\frac"), ("\\tfrac", "\\frac"), ("\\ast", "*")]


#: Distinct tokens that a pair of sequences may hold: the code points beyond the basic plane.
MAX_TOKENS = 0x100000
#: Spans that a cell may name at most.
MAX_SPAN = 2**31 - 1


def token_similarity(a: Column, b: Column) -> Column:
    """1 - edit distance / longer length of two token arrays; 1 where both are empty.

    Each distinct token of the pair becomes one code point beyond the basic
    plane, so the built-in edit distance of strings does the work inside the JVM.
    A pair with more than MAX_TOKENS distinct tokens, for which there is no code
    point left, is an error rather than a wrong number.
    """
    distinct = F.array_distinct(F.concat(a, b))
    distinct = F.when(F.size(distinct) > MAX_TOKENS, F.raise_error(F.lit(f"more than {MAX_TOKENS} distinct tokens"))).otherwise(distinct)
    index = F.map_from_arrays(distinct, F.transform(distinct, lambda _, i: F.decode(F.unhex(F.lpad(F.hex(F.lit(0x10000) + i), 8, "0")), "UTF-32")))

    def coded(x: Column, m: Column) -> Column:
        return F.array_join(F.transform(x, lambda t: F.element_at(m, t)), "")

    # A lambda over a one-element array binds the map once.
    return F.element_at(F.transform(F.array(index), lambda m: edit_similarity(coded(a, m), coded(b, m))), 1)


def latex_tokens(c: Column) -> Column:
    """Commands, single digits and single signs of a formula; NULL -> []."""
    s = F.coalesce(c, F.lit(""))
    for k, v in LATEX_SAME:
        s = F.replace(s, F.lit(k), F.lit(v))
    # (?U): blanks, digits and word ends are those of all alphabets.
    s = F.regexp_replace(s, "(?U)" + LATEX_SILENT.replace("{", "\\{").replace("}", "\\}"), " ")
    return F.regexp_extract_all(s, F.lit("(?U)(\\\\[a-zA-Z]+|\\d|[^\\s])"), F.lit(1))


def formula_similarity(a: Column, b: Column) -> Column:
    return token_similarity(latex_tokens(a), latex_tokens(b))


class _Grid(HTMLParser):
    """Rows of (rowspan, colspan, text) of a table; what follows an unclosed tag still counts."""

    def __init__(self) -> None:
        super().__init__()
        self.rows: list[list[dict]] = []
        self.cell: dict | None = None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "tr":
            self.rows.append([])
            self.cell = None
        elif tag in ("td", "th"):
            if not self.rows:
                self.rows.append([])
            spans = {k: min(int(v), MAX_SPAN) for k, v in attrs if k in ("rowspan", "colspan") and v and v.isdecimal() and len(v) < 1000}
            self.cell = {"rs": spans.get("rowspan", 1), "cs": spans.get("colspan", 1), "txt": ""}
            self.rows[-1].append(self.cell)

    def handle_endtag(self, tag: str) -> None:
        if tag in ("td", "th", "tr", "table"):
            self.cell = None

    def handle_data(self, data: str) -> None:
        if self.cell is not None:
            self.cell["txt"] += data


def _parse(html: str | None) -> list[list[dict]]:
    grid = _Grid()
    try:
        grid.feed(html or "")
    except (AssertionError, ValueError):  # what the parser gives up on ends the table there
        pass
    rows = [[{**c, "txt": " ".join(unicodedata.normalize("NFKC", c["txt"]).split())} for c in r] for r in grid.rows]
    return [r for r in rows if r]


def _parse_all(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in it:
        yield s.map(_parse)


def table_rows(html: Column | str) -> Column:
    """Rows of an HTML table by the standard library's parser; '' and NULL -> []. A span that is no decimal number counts as 1."""
    return F.pandas_udf(_parse_all, "array<array<struct<rs:int,cs:int,txt:string>>>")(html)


def structure_tokens(rows: Column) -> Column:
    """<tr> per row and c{rowspan}x{colspan} per cell."""
    return F.flatten(F.transform(rows, lambda r: F.concat(F.array(F.lit("<tr>")), F.transform(r, lambda c: F.concat(F.lit("c"), c["rs"].cast("string"), F.lit("x"), c["cs"].cast("string"))))))


def table_similarity(a: Column, b: Column) -> Column:
    """Half structure, half mean similarity of the cells in order; structure alone where there are no cells.

    *a* and *b* are parsed rows.
    """
    shape = token_similarity(structure_tokens(a), structure_tokens(b))
    ca, cb = F.transform(F.flatten(a), lambda c: c["txt"]), F.transform(F.flatten(b), lambda c: c["txt"])
    return 0.5 * shape + 0.5 * positional_similarity(ca, cb, edit_similarity, shape)


def positional_similarity(a: Column, b: Column, similarity, if_empty: Column | float = 1.0) -> Column:
    """Mean of similarity(a[i], b[i]) over the longer length; *if_empty* where both are empty."""
    n = F.greatest(F.size(a), F.size(b))
    m = F.least(F.size(a), F.size(b))
    both = F.zip_with(F.slice(a, F.lit(1), m), F.slice(b, F.lit(1), m), similarity)
    total = F.aggregate(both, F.lit(0.0), lambda acc, x: acc + x)
    empty = if_empty if isinstance(if_empty, Column) else F.lit(if_empty)
    return F.when(n == 0, empty).otherwise(total / n)


def text_similarity(a: Column, b: Column) -> Column:
    """Edit similarity after squashing white space."""
    return edit_similarity(squash(a), squash(b))
