"""Queries on tiers derived from readings, checks before and after the models, and what goes to people."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions import box, prompts, text
from folioforge.operators import allocation, consistency, evaluation, quality, refine
from folioforge.operators import elements as el
from folioforge.session import materialize
from folioforge.sources.tables import table

from .flow_queries import JUDGEABLE, _refine_sql, _script
from .inputs import CHEAP, EXPENSIVE, SQL_ELEMENTS, SQL_PAGES, SQL_TIER, TARGET, _SPACES, elements, pages, sql_similarity, sql_squash, tier_name
from .similarity_queries import _iou, _tokens

MODELS = {"m": TARGET, "p": CHEAP, "q": EXPENSIVE}


def _own(spark: SparkSession, d: str) -> DataFrame:
    """(element_id, etype, m, p, q): the readings stored with every element."""
    e = elements(spark, d, "etype", "content")
    return e.select("element_id", "etype", *[F.try_element_at("content", F.lit(m)).alias(k) for k, m in MODELS.items()])


def _matched(spark: SparkSession, d: str) -> DataFrame:
    """The same by place: what each parser read where the element lies on its page; elements of lost pages keep their own readings."""
    e = elements(spark, d, "page_id", "eid", "label", "etype", "box", "content").withColumn("box", F.transform("box", lambda v: v.cast("double")))
    placed = F.coalesce(F.col("page_id") != "0", F.lit(False)) & F.coalesce(F.size("box") == 4, F.lit(False)) & F.col("label").isNotNull()
    on_page = e.filter(placed)
    blocks = on_page.select("page_id", "label", F.col("eid").alias("pos"), "box", F.explode("content").alias("source", "content")).filter("content is not null")
    named = {m: k for k, m in MODELS.items()}
    blocks = blocks.filter(F.col("source").isin(list(named))).replace(named, subset=["source"]).withColumnRenamed("source", "model")
    found = el.readings_by_box(on_page.select("page_id", "label", F.col("element_id").alias("anchor_id"), "box"), blocks, ["page_id", "label"], list(MODELS))
    got = on_page.select("element_id", "etype").join(found.withColumnRenamed("anchor_id", "element_id"), "element_id")
    lost = e.filter(~placed).select("element_id", "etype", *[F.try_element_at("content", F.lit(m)).alias(k) for k, m in MODELS.items()])
    return got.unionByName(lost)


def pair_similarities(spark: SparkSession, d: str) -> DataFrame:
    """Similarities of the three parsers' stored readings, by subtask."""
    t = consistency.pair_similarities(_own(spark, d), "etype", "m", "p", "q", compatibility=False)
    return t.select("element_id", *[F.round(c, 6).alias(c) for c in ("s_mp", "s_mq", "s_pq")])


def element_tiers(spark: SparkSession, d: str) -> DataFrame:
    """Tiers from what the parsers read at each element's place."""
    t = consistency.element_tiers(_matched(spark, d), "etype", "m", "p", "q", compatibility=False)
    return t.select("element_id", "etype", *[F.round(c, 6).alias(c) for c in ("s_mp", "s_mq", "s_pq")], "derived")


def validity_gate(spark: SparkSession, d: str) -> DataFrame:
    """Tiers after a gate: elements without any readable content are invalid before a model is asked."""
    own = _own(spark, d)
    readable = F.exists(F.array("m", "p", "q"), lambda x: F.coalesce(x.rlike("(?U)\\S"), F.lit(False)))
    t = consistency.gated(own, readable, lambda x: consistency.element_tiers(x, "etype", "m", "p", "q", compatibility=False))
    return t.groupBy("etype", "derived").agg(F.count("*").alias("n"))


def label_sets(spark: SparkSession, d: str) -> DataFrame:
    """Labels of the elements that no record's subtask has, and the other way round."""
    a = table(spark, d, "page_element").select(F.col("label").alias("name"))
    b = table(spark, d, "sft_record").select(F.col("subtask").alias("name"))
    return el.label_difference(a, b, "name")


def tier_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Records whose page has a tier, and those whose page is not known: a look-up must find its key."""
    r = table(spark, d, "sft_record").select("record_id", F.expr("try_cast(page_id as bigint)").alias("page_id"))
    known = pages(spark, d).select("page_id")
    found, missing = r.join(known, "page_id", "left_semi"), r.join(known, "page_id", "left_anti")
    return found.agg(F.count("*").alias("n")).withColumn("side", F.lit("found")).unionByName(missing.agg(F.count("*").alias("n")).withColumn("side", F.lit("missing")))


def without_junk(spark: SparkSession, d: str) -> DataFrame:
    """Pages outside the clusters of which more than half is invalid."""
    p = pages(spark, d).filter("subtask is not null")
    junk = p.groupBy("subtask", "cid").agg(F.avg((F.col("tier") == "invalid").cast("double")).alias("bad")).filter("bad > 0.5")
    return p.join(junk, ["subtask", "cid"], "left_anti").groupBy("subtask", "tier").agg(F.count("*").alias("n"))


def sample_quality(spark: SparkSession, d: str) -> DataFrame:
    """How varied and how useful the pages of each subtask are."""
    p = pages(spark, d).filter("subtask is not null")
    gain = F.when(F.lit(False), F.lit(0.0))
    for s in ("layout", "text", "formula", "table"):
        gain = gain.when(F.col("subtask") == s, allocation.gain_of(F.col("tier"), s))
    return evaluation.sample_quality(p.withColumn("gain", F.coalesce(gain, F.lit(0.0))), ["subtask"], "cid", "tier", "gain")


def qa_clean_share(spark: SparkSession, d: str) -> DataFrame:
    """Share of labels without an issue, per subtask; a reading that the judges found wrong is a rejected draft."""
    r = table(spark, d, "sft_record").filter("subtask <> 'layout'")
    bad = table(spark, d, "judge_verdict").filter("has_error and element_id is not null").select("element_id").distinct()
    e = elements(spark, d, "content").join(bad, "element_id", "left_semi").select("element_id", F.try_element_at("content", F.lit(TARGET)).alias("rejected"))
    area = F.when(F.size("box") == 4, box.area(F.transform("box", lambda v: v.cast("double"))))
    checked = r.join(e, "element_id", "left").select("subtask", quality.label_issues(F.col("content"), F.col("subtask"), area, F.col("rejected")).alias("issues"))
    return quality.clean_share(checked, ["subtask"])


def agreement_by_subtask(spark: SparkSession, d: str) -> DataFrame:
    """Mean agreement of an element's answers, per subtask."""
    a = table(spark, d, "annotation").select("element_id", tier_name(F.col("tier")).alias("tier"))
    per = quality.item_agreement(a, "element_id", "tier")
    return per.join(elements(spark, d, "etype"), "element_id").groupBy("etype").agg(F.count("*").alias("n_items"), F.sum("n_pairs").alias("n_pairs"), F.round(F.avg("agree"), 6).alias("agree"))


def worst_annotator_pairs(spark: SparkSession, d: str) -> DataFrame:
    """The ten pairs of annotators that agree least."""
    a = table(spark, d, "annotation").select("element_id", "annotator_id", tier_name(F.col("tier")).alias("tier"))
    return quality.worst_pairs(quality.annotator_pairs(a, "element_id", "annotator_id", "tier"))


def render_checks(spark: SparkSession, d: str) -> DataFrame:
    """Why the target parser's formulas and tables could not be drawn."""
    t = _own(spark, d).filter("m is not null").select(F.col("etype").alias("subtask"), F.coalesce(refine.render_error(F.col("m"), F.col("etype")), F.lit("fine")).alias("reason"))
    return t.groupBy("subtask", "reason").agg(F.count("*").alias("n"))


def _rendered(spark: SparkSession, d: str) -> DataFrame:
    items, verdicts = _script(spark, d)
    # A written table: what filters the outcomes would else be pushed into the rounds' one large expression.
    return materialize(refine.refine(items, verdicts, "element_id", JUDGEABLE, render=refine.render_error), "refine-outcomes")


def judge_refine_rendered(spark: SparkSession, d: str) -> DataFrame:
    """The judge's loop with a label that must be drawn before each round."""
    return _rendered(spark, d).select("element_id", "subtask", "outcome", F.md5("content").alias("content_md5"), "rounds", "confidence")


def judge_reasons(spark: SparkSession, d: str) -> DataFrame:
    """How often items leave the loop in which way."""
    return refine.reasons(_rendered(spark, d))


def refined_records(spark: SparkSession, d: str) -> DataFrame:
    """Training records of the refined items."""
    r = refine.to_sft(_rendered(spark, d), "element_id", "script")
    return r.select("element_id", "subtask", "tier", "label_source", F.md5("content").alias("content_md5"))


def expert_queue(spark: SparkSession, d: str) -> DataFrame:
    """Items that people must finish, with the draft that they get."""
    q = refine.to_experts(_rendered(spark, d), "element_id")
    return q.select("element_id", "subtask", "reason", F.md5("draft").alias("draft_md5"), "confidence")


def unparsed_verdicts(spark: SparkSession, d: str) -> DataFrame:
    """Verdicts from replies of which every seventh is cut: those count as errors without confidence."""
    v = table(spark, d, "judge_verdict").filter("verdict_id is not null").groupBy("verdict_id").agg(F.max(F.struct("received_at", "has_error", "confidence")).alias("r")).select("verdict_id", "r.*")
    whole = F.to_json(F.struct("has_error", "confidence"))
    raw = v.select("verdict_id", F.when(F.pmod("verdict_id", F.lit(7)) == 0, F.left(whole, F.length(whole) - 1)).otherwise(whole).alias("raw"))
    p = raw.select(refine.unparsed_as_error(text.verdict(F.col("raw"))).alias("v"))
    return p.groupBy(F.col("v.has_error").alias("has_error"), (F.col("v.confidence") == 0).alias("no_confidence")).agg(F.count("*").alias("n"))


def markdown_results(spark: SparkSession, d: str) -> DataFrame:
    """Every document as a reply without blocks: its text without formulas and tables, and what was found."""
    r = table(spark, d, "documents").filter("text is not null").select("doc_id", text.markdown_result(F.col("text")).alias("r"))
    return r.select("doc_id", F.md5("r.text").alias("text_md5"), F.size("r.formulas").alias("n_formulas"), F.size("r.tables").alias("n_tables"), text.is_empty_result(F.col("r.text"), F.col("r.formulas"), F.col("r.tables")).alias("is_empty"))


def judge_prompts(spark: SparkSession, d: str) -> DataFrame:
    """The questions to the judge about the target parser's readings."""
    t = _own(spark, d).filter("m is not null")
    return t.select("element_id", F.md5(prompts.judge_prompt(F.col("m"), F.col("etype"), F.col("etype").isin("formula", "table"))).alias("prompt_md5"), F.md5(prompts.draft_prompt(F.col("etype"))).alias("draft_md5"))


def feature_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Which features tell the labels best: the first three quarters of the embedding, the rest, or both."""
    e = table(spark, d, "embeddings").select("vec_id", "label", "embedding", F.slice("embedding", 1, 48).alias("front"), F.slice("embedding", 49, 16).alias("rest"))
    k = e.select("label").distinct().count()
    return evaluation.evaluate_candidates(e, "vec_id", "label", {"both": "embedding", "front": "front", "rest": "rest"}, k)


QUERIES = {f.__name__: f for f in (pair_similarities, element_tiers, validity_gate, label_sets, tier_lookup, without_junk, sample_quality, qa_clean_share, agreement_by_subtask, worst_annotator_pairs, render_checks, judge_refine_rendered, judge_reasons, refined_records, expert_queue, unparsed_verdicts, markdown_results, judge_prompts, feature_candidates)}

_WIDE = "".join(chr(i) for i in range(0xFF01, 0xFF5F) if chr(i) != "\uff07")
_NARROW = "".join(chr(i - 0xFEE0) for i in range(0xFF01, 0xFF5F) if chr(i) != "\uff07")


def _table_parts(c: str) -> str:
    """SQL of the opening tags of rows and cells with what follows them. A row begins before a first cell without one; empty rows are none."""
    parts = f"regexp_extract_all({c}, '(?i)<(?:tr|td|th)(?:\\s[^<>]*)?>[^<]*')"
    full = f"(CASE WHEN len({parts}) > 0 AND NOT regexp_matches({parts}[1], '(?i)^<tr') THEN list_prepend('<tr>', {parts}) ELSE {parts} END)"
    return f"list_filter({full}, lambda x, i: NOT regexp_matches(x, '(?i)^<tr') OR (i < len({full}) AND NOT regexp_matches({full}[i + 1], '(?i)^<tr')))"


def sql_table_sims(source: str, name: str) -> str:
    """CTEs that end in *name* (k, sim, n_rows) of the tables a and b of *source* (k, a, b), both known."""
    span = lambda kind: f"coalesce(nullif(regexp_extract(x, '(?i){kind}=\"(\\d+)\"', 1), '')::INT, 1)"
    shape = lambda c: f"array_to_string(list_transform({c}, lambda x: CASE WHEN regexp_matches(x, '(?i)^<tr') THEN 'A' ELSE chr(100 + ({span('rowspan')} - 1) * 8 + {span('colspan')}) END), '')"
    plain = f"trim(regexp_replace(nfc_normalize(translate(regexp_replace(x, '^<[^>]*>', ''), '{_WIDE}', '{_NARROW.replace(chr(39), chr(39) * 2)}')), '{_SPACES}', ' ', 'g'))"
    cells = lambda c: f"list_transform(list_filter({c}, lambda x: NOT regexp_matches(x, '(?i)^<tr')), lambda x: {plain})"
    return f"""{name}_p AS (SELECT k, {_table_parts("a")} AS pa, {_table_parts("b")} AS pb FROM {source}
), {name}_s AS (SELECT k, {shape("pa")} AS sa, {shape("pb")} AS sb, {cells("pa")} AS ca, {cells("pb")} AS cb FROM {name}_p
), {name}_u AS (SELECT k, ca[i] AS x, cb[i] AS y FROM {name}_s, range(1, 2000) r(i) WHERE i <= least(len(ca), len(cb))
), {name}_c AS (SELECT k, sum({sql_similarity("x", "y")}) AS total FROM {name}_u GROUP BY k
), {name}_h AS (SELECT *, CASE WHEN greatest(length(sa), length(sb)) = 0 THEN 1.0::DOUBLE ELSE 1 - levenshtein(sa, sb)::DOUBLE / greatest(length(sa), length(sb)) END AS shape, greatest(len(ca), len(cb)) AS n FROM {name}_s
), {name} AS (SELECT h.k, 0.5::DOUBLE * shape + 0.5::DOUBLE * (CASE WHEN n = 0 THEN shape ELSE coalesce(total, 0) / n END) AS sim, CAST(length(replace(regexp_replace(sa, '[^A]', '', 'g'), ' ', '')) AS INT) AS n_rows
  FROM {name}_h h LEFT JOIN {name}_c c ON c.k = h.k)"""


def sql_pair_sims(source: str) -> str:
    """CTEs from *source* (element_id, etype, m, p, q) to sims (element_id, s_mp, s_mq, s_pq)."""
    coded = lambda c: f"array_to_string(list_transform({c}, lambda t: chr(list_position(ds, t)::INT)), '')"
    return f"""pr AS (
  SELECT element_id, etype, 'mp' AS pair, m AS a, p AS b FROM {source} UNION ALL SELECT element_id, etype, 'mq', m, q FROM {source} UNION ALL SELECT element_id, etype, 'pq', p, q FROM {source}
), kn AS (SELECT *, element_id || pair AS k FROM pr WHERE a IS NOT NULL AND b IS NOT NULL
), ft AS (SELECT k, {_tokens("a")} AS a, {_tokens("b")} AS b FROM kn WHERE etype = 'formula'
), fd AS (SELECT *, list_distinct(list_concat(a, b)) AS ds FROM ft
), fs AS (SELECT k, CASE WHEN greatest(len(a), len(b)) = 0 THEN 1.0::DOUBLE ELSE 1 - levenshtein({coded("a")}, {coded("b")})::DOUBLE / greatest(len(a), len(b)) END AS sim FROM fd
), xt AS (SELECT k, {sql_squash("a")} AS a, {sql_squash("b")} AS b FROM kn WHERE etype IS NULL OR etype NOT IN ('formula', 'table')
), xs AS (SELECT k, {sql_similarity("a", "b")} AS sim FROM xt
), tb AS (SELECT k, a, b FROM kn WHERE etype = 'table'
), {sql_table_sims("tb", "ts")}, al AS (
  SELECT k, sim FROM fs UNION ALL SELECT k, sim FROM xs UNION ALL SELECT k, sim FROM ts
), sims AS (SELECT element_id, max(sim) FILTER (pair = 'mp') AS s_mp, max(sim) FILTER (pair = 'mq') AS s_mq, max(sim) FILTER (pair = 'pq') AS s_pq FROM pr LEFT JOIN al ON al.k = pr.element_id || pr.pair GROUP BY element_id)"""


_OWN = f"{SQL_ELEMENTS}, own AS (SELECT element_id, etype, content['{TARGET}'] AS m, content['{CHEAP}'] AS p, content['{EXPENSIVE}'] AS q FROM elements)"
_PLACED = "coalesce(page_id <> '0', false) AND coalesce(len(box) = 4, false) AND label IS NOT NULL"
_MATCHED = f"""{_OWN}, bx AS (SELECT element_id, page_id, eid, label, list_transform(box, lambda v: v::DOUBLE) AS box FROM elements WHERE {_PLACED}
), bl AS (SELECT bx.*, u.model, u.content FROM bx JOIN (SELECT element_id, 'm' AS model, m AS content FROM own UNION ALL SELECT element_id, 'p', p FROM own UNION ALL SELECT element_id, 'q', q FROM own) u USING (element_id) WHERE u.content IS NOT NULL
), pb AS (SELECT a.element_id, b.model, b.content, b.eid AS pos, {_iou("a.box", "b.box")} AS iou FROM bx a JOIN bl b ON a.page_id = b.page_id AND a.label = b.label
), wb AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY element_id, model ORDER BY iou DESC, pos) AS rb FROM pb WHERE iou >= 0.5::DOUBLE) WHERE rb = 1
), matched AS (
  SELECT e.element_id, e.etype, max(w.content) FILTER (model = 'm') AS m, max(w.content) FILTER (model = 'p') AS p, max(w.content) FILTER (model = 'q') AS q
  FROM elements e JOIN bx USING (element_id) LEFT JOIN wb w ON w.element_id = e.element_id GROUP BY e.element_id, e.etype
  UNION ALL SELECT o.* FROM own o JOIN elements e USING (element_id) WHERE NOT ({_PLACED}))"""
_TAU = "(CASE etype WHEN 'text' THEN 0.92::DOUBLE WHEN 'table' THEN 0.95::DOUBLE WHEN 'formula' THEN 0.95::DOUBLE WHEN 'layout' THEN 0.85::DOUBLE ELSE 0.92::DOUBLE END)"


def _tiers(source: str) -> str:
    blank = lambda c: f"{sql_squash(c)} = ''"
    return f"""{sql_pair_sims(source)}, tiers AS (
  SELECT x.element_id, x.etype, x.m IS NULL OR x.p IS NULL OR ({blank("x.m")} AND {blank("x.p")}) AS nothing, s_mp, s_mq, s_pq FROM {source} x JOIN sims USING (element_id)
), derived AS (SELECT element_id, etype, CASE WHEN NOT nothing THEN s_mp END AS s_mp, CASE WHEN NOT nothing THEN s_mq END AS s_mq, CASE WHEN NOT nothing THEN s_pq END AS s_pq,
  CASE WHEN nothing THEN 'hard' WHEN s_mq IS NULL THEN (CASE WHEN s_mp >= {_TAU} THEN 'easy' ELSE 'hard' END) WHEN s_mp >= {_TAU} OR s_mq >= {_TAU} THEN 'easy' WHEN s_pq >= {_TAU} THEN 'medium' ELSE 'hard' END AS derived FROM tiers)"""


_BARE = "regexp_replace({0}, '\\\\[{{}}]', '', 'g')"
_times = "len(regexp_extract_all({0}, '{1}'))"


def sql_render_error(c: str, subtask: str) -> str:
    bare = _BARE.format(c)
    n = lambda p: f"len(regexp_extract_all({c}, '{p}'))"
    return f"""(CASE WHEN {subtask} = 'formula' THEN (CASE WHEN len(regexp_extract_all({bare}, '\\{{')) <> len(regexp_extract_all({bare}, '\\}}')) THEN 'braces'
  WHEN {n("\\\\begin\\{")} <> {n("\\\\end\\{")} THEN 'environments' WHEN {n("\\\\left[^a-zA-Z]")} <> {n("\\\\right[^a-zA-Z]")} THEN 'fences' END)
  WHEN {subtask} = 'table' AND NOT regexp_matches({c}, '(?is)<tr\\b.*<t[dh]\\b') AND NOT regexp_matches({c}, '(?m)^\\s*\\|.*\\|\\s*$') THEN 'no_cells' END)"""


_LOOP = _refine_sql(render=sql_render_error)
_PIPES = """pl AS (SELECT doc_id, i, trim(ls[i]) AS l FROM (SELECT doc_id, regexp_split_to_array(text, '\\r\\n|\\r|\\n') AS ls FROM documents WHERE text IS NOT NULL), range(1, 200000) r(i) WHERE i <= len(ls)
), pi AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS island FROM pl WHERE starts_with(l, '|') AND ends_with(l, '|')
), pt AS (SELECT doc_id, island, count(*) FILTER (NOT regexp_matches(l, '^\\|[\\s:\\-|]+\\|$')) AS n FROM pi GROUP BY doc_id, island
), pn AS (SELECT doc_id, count(*) FILTER (n >= 2) AS n_pipe FROM pt GROUP BY doc_id)"""


def _case(table_: dict[str, str]) -> str:
    return "CASE etype " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table_.items()) + f" ELSE '{table_['text']}' END"


ORACLES = {
    "table_similarity": f"""WITH {_OWN}, src AS (SELECT element_id AS k, m AS a, p AS b FROM own WHERE etype = 'table' AND m IS NOT NULL AND p IS NOT NULL), {sql_table_sims("src", "ts")}
SELECT k AS element_id, round(sim, 6) AS sim, n_rows FROM ts""",
    "pair_similarities": f"WITH {_OWN}, {sql_pair_sims('own')} SELECT element_id, round(s_mp, 6) AS s_mp, round(s_mq, 6) AS s_mq, round(s_pq, 6) AS s_pq FROM sims",
    "element_tiers": f"WITH {_MATCHED}, {_tiers('matched')} SELECT element_id, etype, round(s_mp, 6) AS s_mp, round(s_mq, 6) AS s_mq, round(s_pq, 6) AS s_pq, derived FROM derived",
    "validity_gate": f"""WITH {_OWN}, good AS (SELECT * FROM own WHERE {sql_squash("m")} <> '' OR {sql_squash("p")} <> '' OR {sql_squash("q")} <> ''), {_tiers("good")}
SELECT etype, derived, count(*) AS n FROM (SELECT etype, derived FROM derived UNION ALL SELECT etype, 'invalid' FROM own WHERE element_id NOT IN (SELECT element_id FROM good)) GROUP BY ALL""",
    "label_sets": """WITH a AS (SELECT DISTINCT label AS name FROM page_element), b AS (SELECT DISTINCT subtask AS name FROM sft_record)
SELECT name, 'left' AS side FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT name, 'right' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""",
    "tier_lookup": f"""WITH {SQL_PAGES}, r AS (SELECT try_cast(page_id AS BIGINT) IN (SELECT page_id FROM pages) AS known FROM sft_record)
SELECT count(*) FILTER (coalesce(known, false)) AS n, 'found' AS side FROM r UNION ALL SELECT count(*) FILTER (NOT coalesce(known, false)), 'missing' FROM r""",
    "without_junk": f"""WITH {SQL_PAGES}, j AS (SELECT subtask, cid FROM pages WHERE subtask IS NOT NULL GROUP BY ALL HAVING avg((tier = 'invalid')::INT) > 0.5::DOUBLE)
SELECT p.subtask, p.tier, count(*) AS n FROM pages p ANTI JOIN j ON p.subtask = j.subtask AND p.cid = j.cid WHERE p.subtask IS NOT NULL GROUP BY ALL""",
    "sample_quality": f"""WITH {SQL_PAGES}, g AS (SELECT subtask, cid, tier, CASE WHEN tier = 'easy' THEN CASE subtask WHEN 'layout' THEN 0.15::DOUBLE ELSE 0.1::DOUBLE END WHEN tier = 'medium' THEN CASE WHEN subtask IN ('layout', 'text') THEN 1.0::DOUBLE ELSE 0.8::DOUBLE END
    WHEN tier = 'hard' THEN CASE subtask WHEN 'layout' THEN 0.6::DOUBLE WHEN 'text' THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END ELSE 0 END * (subtask IN ('layout', 'text', 'formula', 'table'))::INT AS gain FROM pages WHERE subtask IS NOT NULL
), c AS (SELECT subtask, cid, count(*) AS n, count(*) FILTER (tier = 'invalid') AS bad, sum(gain) AS gain FROM g GROUP BY ALL
), p AS (SELECT *, n::DOUBLE / sum(n) OVER (PARTITION BY subtask) AS p, percent_rank() OVER (PARTITION BY subtask ORDER BY n, cid) AS r FROM c)
SELECT subtask, CAST(sum(n) AS BIGINT) AS n_rows, round(exp(-sum(p * ln(p))), 6) AS effective, round(max(p), 6) AS head_share, round(sum(CASE WHEN r < 0.5::DOUBLE THEN p ELSE 0 END), 6) AS tail_share,
  round(sum(bad)::DOUBLE / sum(n), 6) AS waste, round(sum(gain) / sum(n), 6) AS signal FROM p GROUP BY subtask""",
    "qa_clean_share": f"""WITH {SQL_ELEMENTS}, rej AS (SELECT element_id, content['{TARGET}'] AS rejected FROM elements WHERE element_id IN (SELECT element_id FROM judge_verdict WHERE has_error)
), r AS (SELECT subtask, s.content, {sql_squash("s.content")} AS c, {sql_squash("rejected")} AS bad, length(rejected) AS nb, CASE WHEN len(box) = 4 THEN greatest(box[3]::DOUBLE - box[1], 0) * greatest(box[4]::DOUBLE - box[2], 0) END AS area
  FROM sft_record s LEFT JOIN rej USING (element_id) WHERE subtask <> 'layout'
), i AS (SELECT subtask, c <> '' AND NOT coalesce(subtask = 'table' AND NOT regexp_matches(content, '(?is)<t[dh]\\b'), false) AND NOT coalesce(nb > 0 AND bad = c, false)
  AND NOT coalesce(area > 0 AND length(c) / (area / 1000) > 12, false) AND NOT coalesce(contains(content, '[?]'), false) AS clean FROM r)
SELECT subtask, count(*) AS n, CAST(count(*) FILTER (clean) AS BIGINT) AS n_clean, round(avg(clean::INT::DOUBLE), 6) AS clean_share FROM i GROUP BY subtask""",
    "agreement_by_subtask": f"""WITH {SQL_ELEMENTS}, a AS (SELECT element_id, {SQL_TIER.format("tier")} AS t FROM annotation), k AS (
  SELECT element_id, t, count(*) AS k FROM a WHERE element_id IS NOT NULL AND t IS NOT NULL GROUP BY ALL), m AS (
  SELECT element_id, sum(k) AS m, sum(k * (k - 1) / 2) AS same FROM k GROUP BY element_id HAVING sum(k) > 1)
SELECT etype, count(*) AS n_items, CAST(sum(m * (m - 1) / 2) AS BIGINT) AS n_pairs, round(avg(same::DOUBLE / (m * (m - 1) / 2)), 6) AS agree FROM m JOIN elements USING (element_id) GROUP BY etype""",
    "worst_annotator_pairs": f"""WITH a AS (SELECT DISTINCT element_id, annotator_id, {SQL_TIER.format("tier")} AS tier FROM annotation), b AS (SELECT * FROM a WHERE element_id IS NOT NULL AND annotator_id IS NOT NULL AND tier IS NOT NULL)
SELECT x.annotator_id AS annotator_a, y.annotator_id AS annotator_b, count(*) AS n, round(avg((x.tier = y.tier)::INT::DOUBLE), 6) AS agree
FROM b x JOIN b y ON x.element_id = y.element_id AND x.annotator_id < y.annotator_id GROUP BY ALL ORDER BY agree, annotator_a, annotator_b LIMIT 10""",
    "render_checks": f"WITH {_OWN} SELECT etype AS subtask, coalesce({sql_render_error('m', 'etype')}, 'fine') AS reason, count(*) AS n FROM own WHERE m IS NOT NULL GROUP BY ALL",
    "judge_refine_rendered": f"WITH {_LOOP} SELECT element_id, subtask, outcome, md5(txt) AS content_md5, n AS rounds, conf AS confidence FROM done",
    "judge_reasons": f"WITH {_LOOP} SELECT subtask, outcome, count(*) AS n FROM done GROUP BY ALL",
    "refined_records": f"WITH {_LOOP} SELECT element_id, subtask, 'hard' AS tier, 'judge-refine:script' AS label_source, md5(txt) AS content_md5 FROM done WHERE outcome = 'refined'",
    "expert_queue": f"WITH {_LOOP} SELECT element_id, subtask, outcome AS reason, md5(txt) AS draft_md5, conf AS confidence FROM done WHERE outcome <> 'refined'",
    "unparsed_verdicts": """WITH v AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY verdict_id ORDER BY received_at DESC) AS rn FROM judge_verdict WHERE verdict_id IS NOT NULL) WHERE rn = 1)
SELECT CASE WHEN verdict_id % 7 = 0 OR has_error IS NULL THEN true ELSE has_error END AS has_error, (CASE WHEN verdict_id % 7 = 0 OR has_error IS NULL THEN 0 ELSE coalesce(confidence, 0) END) = 0 AS no_confidence, count(*) AS n FROM v GROUP BY ALL""",
    "markdown_results": f"""WITH {_PIPES}, t AS (
  SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(text, '(?is)<table\\b.*?</table>', ' ', 'g'), '(?s)\\$\\$.+?\\$\\$|\\\\\\[.+?\\\\\\]', ' ', 'g'), '^{_SPACES}|{_SPACES}$', '', 'g') AS bare,
    len(list_filter(list_transform(regexp_extract_all(text, '(?s)(\\$\\$.+?\\$\\$|\\\\\\[.+?\\\\\\])', 1), lambda h: trim(substr(h, 3, length(h) - 4), ' ')), lambda h: h <> '')) AS nf,
    len(regexp_extract_all(text, '(?is)<table\\b.*?</table>')) AS nh FROM documents WHERE text IS NOT NULL)
SELECT doc_id, md5(bare) AS text_md5, CAST(nf AS INT) AS n_formulas, CAST(nh + coalesce(n_pipe, 0) AS INT) AS n_tables, bare = '' AND nf = 0 AND nh + coalesce(n_pipe, 0) = 0 AS is_empty FROM t LEFT JOIN pn USING (doc_id)""",
    "judge_prompts": f"""WITH {_OWN} SELECT element_id, md5(CASE WHEN etype IN ('formula', 'table') THEN 'The first image is the original, the second one the label as drawn.' ELSE 'The image is the original.' END || ' Label (' || {_case(prompts.FORMAT)} || '):' || chr(10) || m || chr(10) || 'Look at ' || {_case(prompts.LOOK_AT)} || '. Answer as JSON with has_error, confidence, corrected, note.') AS prompt_md5,
  md5({_case(prompts.DRAFT)} || ' Mark what you cannot read as [?].') AS draft_md5 FROM own WHERE m IS NOT NULL""",
}
