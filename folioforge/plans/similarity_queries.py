"""Queries on texts, formulas, tables and boxes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions import box, sequence, text
from folioforge.operators import elements as el
from folioforge.sources.tables import table

from .inputs import CHEAP, SQL_ELEMENTS, TARGET, elements, sql_similarity, sql_squash


def _readings(spark: SparkSession, d: str, etype: str) -> DataFrame:
    """(element_id, m, p) of the elements that target and cheap parser both read."""
    e = elements(spark, d, "etype", "content").filter(F.col("etype") == etype)
    return e.select("element_id", F.try_element_at("content", F.lit(TARGET)).alias("m"), F.try_element_at("content", F.lit(CHEAP)).alias("p")).filter("m is not null and p is not null")


def text_similarity(spark: SparkSession, d: str) -> DataFrame:
    """Edit similarity of two parsers' readings of text elements, after squashing white space."""
    return _readings(spark, d, "text").select("element_id", F.round(sequence.text_similarity(F.col("m"), F.col("p")), 6).alias("sim"))


def text_similarity_compat(spark: SparkSession, d: str) -> DataFrame:
    """The same after compatibility composition, which no SQL engine has."""
    r = _readings(spark, d, "text").select("element_id", text.norm_text(F.col("m")).alias("m"), text.norm_text(F.col("p")).alias("p"))
    return r.select("element_id", F.round(text.edit_similarity(F.col("m"), F.col("p")), 6).alias("sim"))


def formula_similarity(spark: SparkSession, d: str) -> DataFrame:
    return _readings(spark, d, "formula").select("element_id", F.round(sequence.formula_similarity(F.col("m"), F.col("p")), 6).alias("sim"))


def table_similarity(spark: SparkSession, d: str) -> DataFrame:
    r = _readings(spark, d, "table").select("element_id", sequence.table_rows("m").alias("m"), sequence.table_rows("p").alias("p"))
    return r.select("element_id", F.round(sequence.table_similarity(F.col("m"), F.col("p")), 6).alias("sim"), F.size("m").alias("n_rows"))


def formula_extract(spark: SparkSession, d: str) -> DataFrame:
    """Display formulas of every document."""
    docs = table(spark, d, "documents").select("doc_id", F.posexplode(text.formulas(F.col("text"))).alias("pos", "formula"))
    return docs.withColumn("formula", text.strip_math_delims(F.col("formula")))


def table_extract(spark: SparkSession, d: str) -> DataFrame:
    """HTML tables of every document, and pipe tables as HTML after them."""
    t = table(spark, d, "documents").select("doc_id", text.html_tables(F.col("text")).alias("h"), text.pipe_tables(F.col("text")).alias("p"))
    return t.select("doc_id", F.size("h").alias("n_html"), F.size("p").alias("n_pipe"), F.concat("h", "p").alias("tables"))


def html_table_counts(spark: SparkSession, d: str) -> DataFrame:
    """Per source: documents with HTML tables, tables and rows."""
    t = table(spark, d, "documents").select("source", text.html_tables(F.col("text")).alias("h"))
    rows = F.size(F.regexp_extract_all(F.array_join("h", ""), F.lit("(?i)(<tr\\b)"), F.lit(1)))
    return t.groupBy("source").agg(F.sum((F.size("h") > 0).cast("long")).alias("n_docs"), F.sum(F.size("h").cast("long")).alias("n_tables"), F.sum(rows.cast("long")).alias("n_rows"))


def label_canon(spark: SparkSession, d: str) -> DataFrame:
    """Canonical labels of spellings made from the elements' labels, with counts."""
    e = table(spark, d, "page_element").select(F.col("label"), F.element_at(F.array(F.col("label"), F.upper("label"), F.concat(F.lit(" "), "label"), F.concat("label", F.lit("_body")), F.lit("section-header")), (F.pmod("element_id", F.lit(5)) + 1).cast("int")).alias("raw"))
    return e.groupBy(text.canon_label(F.col("raw")).alias("canon"), F.col("label")).agg(F.count("*").alias("n"))


def box_normalize(spark: SparkSession, d: str) -> DataFrame:
    """Elements' boxes as pixels of a page of 1700 x 2400, from coordinates in thousandths."""
    e = elements(spark, d, "box").select("element_id", box.absolute_box(F.transform("box", lambda v: v.cast("double") / 2), F.lit(1700), F.lit(2400), "norm1000").alias("b"))
    return e.select("element_id", *[F.round(F.col("b")[i], 4).alias(n) for i, n in enumerate(("x1", "y1", "x2", "y2"))])


def verdict_parse(spark: SparkSession, d: str) -> DataFrame:
    """Judges' verdicts written as replies and parsed again."""
    v = table(spark, d, "judge_verdict").select("verdict_id", "judged_at", F.concat(F.lit("Reply: "), F.to_json(F.struct("has_error", "confidence", "corrected", "note")), F.lit(" .")).alias("raw")).distinct()
    p = v.select("verdict_id", text.verdict(F.col("raw")).alias("v"))
    return p.groupBy(F.col("v.has_error").alias("has_error"), F.col("v.corrected").isNotNull().alias("has_fix")).agg(F.count("*").alias("n"), F.round(F.avg("v.confidence"), 6).alias("mean_confidence"))


def page_refs(spark: SparkSession, d: str) -> DataFrame:
    """Page references split into file and page number."""
    e = table(spark, d, "page_element").select("element_id", F.concat("source", F.lit(".pdf#"), F.coalesce("page_id", F.lit("x"))).alias("ref")).distinct()
    r = text.page_ref(F.col("ref"))
    return e.select(r["path"].alias("path"), r["page"].alias("page")).groupBy("path").agg(F.count("*").alias("n"), F.count("page").alias("n_numbered"), F.max("page").alias("last_page"))


def _boxes(spark: SparkSession, d: str) -> DataFrame:
    e = elements(spark, d, "page_id", "eid", "label", "box").filter("page_id is not null and page_id <> '0' and size(box) = 4")
    return e.select("element_id", "page_id", "eid", "label", F.transform("box", lambda v: v.cast("double")).alias("box"))


def layout_f1(spark: SparkSession, d: str) -> DataFrame:
    """Per page the F1 of its boxes against a shifted copy of them."""
    b = _boxes(spark, d).select("page_id", "eid", "label", "box", F.transform("box", lambda v: v + 40).alias("moved"))
    page = b.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("eid", "label", "box"))).alias("a"), F.array_sort(F.collect_list(F.struct("eid", "label", F.col("moved").alias("box")))).alias("b"))
    return page.select("page_id", F.round(box.layout_f1(F.col("a"), F.col("b")), 6).alias("f1"))


def best_iou_match(spark: SparkSession, d: str) -> DataFrame:
    """Records' boxes matched to the elements of their page and label."""
    e = _boxes(spark, d)
    anchors = e.select("page_id", "label", F.col("element_id").alias("anchor_id"), F.transform("box", lambda v: v + 25).alias("box"))
    blocks = e.select("page_id", "label", F.col("eid").alias("pos"), "box", F.col("element_id").alias("content"))
    return el.best_match(anchors, blocks, ["page_id", "label"]).select("anchor_id", F.round("iou", 6).alias("iou"), F.col("content").alias("matched"))


def wrapper_filter(spark: SparkSession, d: str) -> DataFrame:
    """Boxes left per label after text frames around other boxes are dropped."""
    return el.drop_wrappers(_boxes(spark, d), "page_id", "element_id", "text", inside=0.6, least=1, share=0.3).groupBy("label").agg(F.count("*").alias("n"))


def layout_prior(spark: SparkSession, d: str) -> DataFrame:
    """24 layout numbers of every page; tables and formulas as their own kinds."""
    b = _boxes(spark, d)
    pages = b.select("page_id").distinct().withColumn("width", F.lit(1700.0)).withColumn("height", F.lit(2400.0))
    v = el.layout_vector(b, pages, "page_id", ["text", "title", "list", "caption", "table"], image="formula", table="table")
    names = ["text_share", "image_share", "white", "aspect", "density"]
    return v.select("page_id", *[F.round(F.col("vector")[i], 6).alias(n) for i, n in enumerate(names)], F.array_position(F.slice("vector", 7, 6), F.lit(1.0)).alias("n_cols"), *[F.round(F.col("vector")[12 + i], 6).alias(n) for i, n in enumerate(("image_part", "table_part", "plain_part"))])


def running_ordinals(spark: SparkSession, d: str) -> DataFrame:
    """The number of each block among those of its label on its page."""
    return el.running_ordinal(_boxes(spark, d), "page_id", "eid", "label").select("element_id", F.col("nth").cast("long").alias("nth"))


QUERIES = {f.__name__: f for f in (text_similarity, text_similarity_compat, formula_similarity, table_similarity, formula_extract, table_extract, html_table_counts, label_canon, box_normalize, verdict_parse, page_refs, layout_f1, best_iou_match, wrapper_filter, layout_prior, running_ordinals)}

_BOXES = f"""{SQL_ELEMENTS}, boxes AS (
  SELECT element_id, page_id, eid, label, list_transform(box, lambda v: v::DOUBLE) AS box FROM elements WHERE page_id IS NOT NULL AND page_id <> '0' AND len(box) = 4
)"""
_IOU = "({i} / greatest((({a}[3] - {a}[1]) * ({a}[4] - {a}[2]) + ({b}[3] - {b}[1]) * ({b}[4] - {b}[2]) - {i}), 1e-6::DOUBLE))"
_INTER = "(greatest(least({a}[3], {b}[3]) - greatest({a}[1], {b}[1]), 0::DOUBLE) * greatest(least({a}[4], {b}[4]) - greatest({a}[2], {b}[2]), 0::DOUBLE))"


def _iou(a: str, b: str) -> str:
    return _IOU.format(a=a, b=b, i=_INTER.format(a=a, b=b))


def _tokens(c: str) -> str:
    """SQL of a formula's tokens. DuckDB's word ends are ASCII, so the sign after a command is matched and put back;
    a sign that begins the next command is matched in the second pass."""
    word = "\\p{L}\\p{M}\\p{Nd}\\p{Pc}\\x{200C}\\x{200D}"
    s = f"replace(replace(replace({c}, '\\dfrac', '\\frac'), '\\tfrac', '\\frac'), '\\ast', '*')"
    for _ in range(2):
        s = f"regexp_replace({s}, '\\\\(?:left|right|quad|qquad|displaystyle|limits)([^{word}]|$)', ' \\1', 'g')"
    s = f"regexp_replace({s}, '\\\\[,;!]([{word}])', ' \\1', 'g')"
    blanks = "\\s\\x{0B}\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}"
    return f"regexp_extract_all(regexp_replace({s}, '[{blanks}]+|\\{{|\\}}', ' ', 'g'), '\\\\[a-zA-Z]+|[^{blanks}]')"


ORACLES = {
    "text_similarity": f"""WITH {SQL_ELEMENTS}, r AS (
  SELECT element_id, {sql_squash(f"content['{TARGET}']")} AS m, {sql_squash(f"content['{CHEAP}']")} AS p
  FROM elements WHERE etype = 'text' AND content['{TARGET}'] IS NOT NULL AND content['{CHEAP}'] IS NOT NULL
) SELECT element_id, round({sql_similarity("m", "p")}, 6) AS sim FROM r""",
    "formula_similarity": f"""WITH {SQL_ELEMENTS}, r AS (
  SELECT element_id, {_tokens(f"content['{TARGET}']")} AS a, {_tokens(f"content['{CHEAP}']")} AS b
  FROM elements WHERE etype = 'formula' AND content['{TARGET}'] IS NOT NULL AND content['{CHEAP}'] IS NOT NULL
), d AS (SELECT *, list_distinct(list_concat(a, b)) AS ds FROM r), c AS (
  SELECT element_id, greatest(len(a), len(b)) AS n, array_to_string(list_transform(a, lambda t: chr(list_position(ds, t)::INT)), '') AS x, array_to_string(list_transform(b, lambda t: chr(list_position(ds, t)::INT)), '') AS y FROM d)
SELECT element_id, round(CASE WHEN n = 0 THEN 1.0::DOUBLE ELSE 1 - levenshtein(x, y)::DOUBLE / n END, 6) AS sim FROM c""",
    "formula_extract": """WITH f AS (
  SELECT doc_id, list_filter(list_transform(regexp_extract_all(coalesce(text, ''), '(?s)(\\$\\$.+?\\$\\$|\\\\\\[.+?\\\\\\])', 1), lambda h: trim(substr(h, 3, length(h) - 4), ' ')), lambda h: h <> '') AS fs FROM documents)
SELECT doc_id, CAST(i - 1 AS INT) AS pos, trim(regexp_replace(trim(fs[i], ' '), '^(\\$\\$|\\$|\\\\\\[|\\\\\\()+\\s*|\\s*(\\$\\$|\\$|\\\\\\]|\\\\\\))+$', '', 'g'), ' ') AS formula
FROM (SELECT doc_id, fs, unnest(range(1, len(fs) + 1)) AS i FROM f)""",
    "table_extract": """WITH pl AS (
  SELECT doc_id, i, trim(ls[i], ' ') AS l FROM (SELECT doc_id, regexp_split_to_array(coalesce(text, ''), '\\r\\n|\\r|\\n') AS ls FROM documents), range(1, 200000) r(i) WHERE i <= len(ls)
), pi AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS island FROM pl WHERE starts_with(l, '|') AND ends_with(l, '|')
), pt AS (
  SELECT doc_id, island, '<table>' || string_agg('<tr>' || array_to_string(list_transform(string_split(regexp_replace(l, '^\\|+|\\|+$', '', 'g'), '|'), lambda x: '<td>' || trim(x, ' ') || '</td>'), '') || '</tr>', '' ORDER BY i) || '</table>' AS t
  FROM pi WHERE NOT regexp_matches(l, '^\\|[\\s:\\-|]+\\|$') GROUP BY doc_id, island HAVING count(*) >= 2
), pn AS (SELECT doc_id, list(t ORDER BY island) AS p FROM pt GROUP BY doc_id
), h AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '(?is)<table\\b.*?</table>') AS h FROM documents)
SELECT doc_id, CAST(len(h) AS INT) AS n_html, CAST(coalesce(len(p), 0) AS INT) AS n_pipe, list_concat(h, coalesce(p, [])) AS tables FROM h LEFT JOIN pn USING (doc_id)""",
    "layout_f1": f"""WITH {_BOXES}, pg AS (
  SELECT page_id, list(struct_pack(label := label, box := box) ORDER BY eid, label, box) AS a FROM boxes GROUP BY page_id
), pr AS (
  SELECT page_id, i, j, {_iou("a[i].box", "list_transform(a[j].box, lambda v: v + 40)")} AS v FROM pg, range(1, 400) x(i), range(1, 400) y(j) WHERE i <= len(a) AND j <= len(a) AND a[i].label = a[j].label
), ps AS (SELECT page_id, list(struct_pack(ua := []::BIGINT[], ub := []::BIGINT[], i := i, j := j) ORDER BY v DESC, i DESC, j DESC) AS ps FROM pr WHERE v >= 0.5::DOUBLE GROUP BY page_id
), gr AS (
  SELECT page_id, len(list_reduce(list_prepend(struct_pack(ua := []::BIGINT[], ub := []::BIGINT[], i := 0::BIGINT, j := 0::BIGINT), ps), lambda acc, x: CASE WHEN list_contains(acc.ua, x.i) OR list_contains(acc.ub, x.j) THEN acc
    ELSE struct_pack(ua := list_append(acc.ua, x.i), ub := list_append(acc.ub, x.j), i := x.i, j := x.j) END).ua) AS m FROM ps)
SELECT page_id, round(coalesce(m, 0)::DOUBLE / len(a), 6) AS f1 FROM pg LEFT JOIN gr USING (page_id)""",
    "html_table_counts": """WITH t AS (
  SELECT source, regexp_extract_all(coalesce(text, ''), '(?is)(<table\\b.*?</table>)', 1) AS h FROM documents)
SELECT source, CAST(sum(CASE WHEN len(h) > 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_docs, CAST(sum(len(h)) AS BIGINT) AS n_tables,
       CAST(sum(len(regexp_extract_all(array_to_string(h, ''), '(?i)(<tr\\b)', 1))) AS BIGINT) AS n_rows
FROM t GROUP BY source""",
    "label_canon": """WITH e AS (
  SELECT label, CASE element_id % 5 WHEN 0 THEN label WHEN 1 THEN upper(label) WHEN 2 THEN ' ' || label WHEN 3 THEN label || '_body' ELSE 'section-header' END AS raw FROM page_element
), k AS (SELECT label, regexp_replace(lower(trim(raw)), '[\\s_\\-]+', ' ', 'g') AS k FROM e)
SELECT CASE WHEN k = 'section header' OR k = 'title' THEN 'title' WHEN k = 'list' THEN 'list' WHEN k = 'caption' THEN 'caption' WHEN k = 'formula' THEN 'formula'
            WHEN k IN ('table', 'table body') THEN 'table' ELSE 'text' END AS canon, label, count(*) AS n
FROM k GROUP BY ALL""",
    "box_normalize": f"""WITH {SQL_ELEMENTS}, c AS (
  SELECT element_id, CASE WHEN len(box) = 4 THEN [box[1]::DOUBLE / 2 / 1000 * 1700, box[2]::DOUBLE / 2 / 1000 * 2400, box[3]::DOUBLE / 2 / 1000 * 1700, box[4]::DOUBLE / 2 / 1000 * 2400] END AS b FROM elements
), o AS (
  SELECT element_id, greatest(least(b[1], b[3]), 0) AS x1, greatest(least(b[2], b[4]), 0) AS y1, least(greatest(b[1], b[3]), 1700) AS x2, least(greatest(b[2], b[4]), 2400) AS y2, b IS NOT NULL AS ok FROM c
)
SELECT element_id, CASE WHEN ok AND x2 - x1 >= 1 AND y2 - y1 >= 1 THEN round(x1, 4) END AS x1, CASE WHEN ok AND x2 - x1 >= 1 AND y2 - y1 >= 1 THEN round(y1, 4) END AS y1,
       CASE WHEN ok AND x2 - x1 >= 1 AND y2 - y1 >= 1 THEN round(x2, 4) END AS x2, CASE WHEN ok AND x2 - x1 >= 1 AND y2 - y1 >= 1 THEN round(y2, 4) END AS y2 FROM o""",
    "verdict_parse": f"""WITH v AS (SELECT DISTINCT verdict_id, judged_at, has_error, confidence, corrected, note FROM judge_verdict)
SELECT has_error, {sql_squash("corrected")} <> '' AND has_error IS NOT NULL AS has_fix, count(*) AS n,
       round(avg(CASE WHEN has_error IS NOT NULL THEN coalesce(confidence, 0) END), 6) AS mean_confidence
FROM v GROUP BY ALL""",
    "page_refs": """WITH e AS (SELECT DISTINCT element_id, source, page_id FROM page_element WHERE source IS NOT NULL)
SELECT source || '.pdf' AS path, count(*) AS n, count(try_cast(page_id AS INT)) AS n_numbered, max(try_cast(page_id AS INT)) AS last_page FROM e GROUP BY source""",
    "best_iou_match": f"""WITH {_BOXES}, p AS (
  SELECT a.element_id AS anchor_id, b.eid AS pos, b.element_id AS matched, {_iou("list_transform(a.box, lambda v: v + 25)", "b.box")} AS iou
  FROM boxes a JOIN boxes b ON a.page_id = b.page_id AND a.label = b.label
), w AS (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY iou DESC, pos) AS rn FROM p WHERE iou >= 0.5)
SELECT a.element_id AS anchor_id, round(w.iou, 6) AS iou, w.matched FROM boxes a LEFT JOIN w ON w.anchor_id = a.element_id AND w.rn = 1""",
    "wrapper_filter": f"""WITH {_BOXES}, a AS (
  SELECT *, greatest(box[3] - box[1], 0) * greatest(box[4] - box[2], 0) AS area FROM boxes
), f AS (
  SELECT p.element_id FROM a p JOIN a c ON p.page_id = c.page_id AND p.element_id <> c.element_id
  WHERE p.label = 'text' AND c.area > 0 AND c.area < p.area AND {_INTER.format(a="p.box", b="c.box")} >= 0.6::DOUBLE * c.area
  GROUP BY p.element_id, p.area HAVING count(*) >= 1 AND sum(c.area) >= 0.3::DOUBLE * p.area
)
SELECT label, count(*) AS n FROM a WHERE element_id NOT IN (SELECT element_id FROM f) GROUP BY label""",
    "layout_prior": f"""WITH {_BOXES}, a AS (
  SELECT *, greatest(box[3] - box[1], 0) * greatest(box[4] - box[2], 0) AS area, (box[1] + box[3]) / 2 AS x, label <> 'formula' AS is_text FROM boxes
), g AS (SELECT page_id, x - lag(x) OVER (PARTITION BY page_id ORDER BY x) > 0.04::DOUBLE * 1700 AS wide FROM a WHERE is_text
), c AS (SELECT page_id, least(coalesce(sum(wide::INT), 0) + 1, 6) AS n_cols FROM g GROUP BY page_id
), p AS (
  SELECT page_id, count(*) FILTER (is_text) AS nt, count(*) FILTER (NOT is_text) AS ni, count(*) FILTER (label = 'table') AS nb,
         coalesce(sum(area) FILTER (is_text), 0) AS ta, coalesce(sum(area) FILTER (NOT is_text), 0) AS ia FROM a GROUP BY page_id
)
SELECT p.page_id, round(ta / 4080000, 6) AS text_share, round(ia / 4080000, 6) AS image_share, round(greatest(1 - ta / 4080000 - ia / 4080000, 0), 6) AS white,
       round(1700.0::DOUBLE / 2400, 6) AS aspect, round(nt / 4.08::DOUBLE, 6) AS density, CAST(coalesce(n_cols, 1) AS BIGINT) AS n_cols,
       round(CASE WHEN nt + ni > 0 THEN ni::DOUBLE / (nt + ni) ELSE 0 END, 6) AS image_part, round(nb::DOUBLE / greatest(nt, 1), 6) AS table_part,
       round(CASE WHEN nt > 0 THEN (nt - nb)::DOUBLE / nt ELSE 0 END, 6) AS plain_part
FROM p LEFT JOIN c USING (page_id)""",
    "running_ordinals": f"WITH {_BOXES} SELECT element_id, row_number() OVER (PARTITION BY page_id, label ORDER BY eid) - 1 AS nth FROM boxes",
}
