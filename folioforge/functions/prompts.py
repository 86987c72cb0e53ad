"""What models are asked, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What a judge should look at, what a label is called, and what a first draft must be, by subtask; others are text.
LOOK_AT = {
    "text": "tone and vowel marks, reading order, lines left out",
    "formula": "indices, fractions, operators and fences",
    "table": "numbers of rows and columns, merged cells, numbers",
}
FORMAT = {"text": "text", "formula": "LaTeX formula", "table": "HTML table"}
DRAFT = {
    "text": "Write down the text of the image with its line breaks and nothing else.",
    "formula": "Write the formula of the image as LaTeX without dollar signs and nothing else.",
    "table": "Write the table of the image as HTML with its merged cells and nothing else.",
}


def _of(table: dict[str, str], subtask: Column) -> Column:
    out = F.when(F.lit(False), "")
    for k, v in table.items():
        out = out.when(subtask == k, v)
    return out.otherwise(table["text"])


def judge_prompt(content: Column, subtask: Column, rendered: Column) -> Column:
    """The question to a judge about a label, shown beside its drawing where it was *rendered*; NULL content stays NULL."""
    shown = F.when(rendered, "The first image is the original, the second one the label as drawn.").otherwise("The image is the original.")
    return F.concat(shown, F.lit(" Label ("), _of(FORMAT, subtask), F.lit("):\n"), content, F.lit("\nLook at "), _of(LOOK_AT, subtask), F.lit(". Answer as JSON with has_error, confidence, corrected, note."))


def draft_prompt(subtask: Column) -> Column:
    """The request for a first draft; what cannot be read is marked, not guessed."""
    return F.concat(_of(DRAFT, subtask), F.lit(" Mark what you cannot read as [?]."))


def blocks_prompt() -> Column:
    """The request for a page's blocks in reading order."""
    return F.lit("List the blocks of the page in reading order as JSON: type, bbox in thousandths of the page, content.")
