"""Fixed values of the domain: names, thresholds and defaults that results depend on."""

from __future__ import annotations

TIERS = ["easy", "medium", "hard", "invalid"]
SUBTASKS = ["layout", "text", "formula", "table"]
#: Agreement from which two readings of a subtask count as equal.
TAU = {"text": 0.92, "table": 0.95, "formula": 0.95, "layout": 0.85}
#: Training value of an easy, medium and hard sample.
GAINS = {"layout": (0.15, 1.0, 0.6), "text": (0.1, 1.0, 0.5), "formula": (0.1, 0.8, 1.0), "table": (0.1, 0.8, 1.0)}
#: Probe: sizes, square-root factor, junk share, prior strength, entropy bonus.
PROBE = {"n_min": 64, "n_max": 512, "beta": 0.35, "invalid_drop": 0.5, "prior": 20.0, "entropy_bonus": 0.35}
#: Sampler: size exponent, floor per cell, share of a cell that may be taken, rounds of filling.
SAMPLER = {"alpha": 0.4, "floor": 8, "cap_ratio": 0.6, "rounds": 50, "outer_rounds": 12}
#: Clustering: split factor, largest share, smallest cluster, depth, tail percentile, duplicate cosine.
CLUSTER = {"k_coarse": 512, "split": 16, "max_share": 0.005, "min_size": 200, "depth": 3, "tail_pct": 99.5, "dedup_cosine": 0.98, "flatten_rounds": 5}
#: Scan quality: blur, least side, ink range, contrast, skew.
SCAN = {"blur": 40.0, "side": 500, "ink_min": 0.004, "ink_max": 0.60, "contrast": 25.0, "skew": 12.0}
#: Spellings of block labels other than the canonical ones.
LABEL_ALIASES = {
    "text": ["text", "paragraph", "plain text", "body", "figure", "picture", "image", "chart", "page header", "header", "page footer", "footer", "footnote", "code", "algorithm", "form", "key value region", "key value", "document index", "abstract", "reference", "seal", "stamp", "checkbox selected", "checkbox unselected"],
    "title": ["title", "doc title", "heading", "section header", "sub title"],
    "list": ["list", "list item", "listitem"],
    "caption": ["caption", "figure caption", "table caption", "figcaption", "image caption"],
    "formula": ["formula", "equation", "isolate formula", "interline equation", "display formula", "math"],
    "table": ["table", "table body", "tablebody"],
}
LABEL_SUBTASK = {"title": "text", "list": "text", "caption": "text", "text": "text", "formula": "formula", "table": "table"}
