"""Queries on queues, the judge loop, label checks, call logs and event windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions import box
from folioforge.operators import calls, consistency, quality, refine, sampling
from folioforge.sources.tables import table
from folioforge.streaming import health

from .inputs import SQL_ELEMENTS, SQL_TIER, elements, sql_similarity, sql_squash, tier_name
from .tier_queries import _sims

JUDGEABLE = ["text", "formula", "table"]


def _weakness(spark: SparkSession, d: str) -> DataFrame:
    w = consistency.weakness(_sims(spark, d), "etype", F.col("s_mp"), F.col("s_mq"))
    return w.select(F.col("etype").alias("subtask"), F.round("weakness", 6).alias("weakness"))


def _hard(spark: SparkSession, d: str) -> DataFrame:
    return elements(spark, d, "tier", "etype").filter("tier = 'hard'").select("element_id", F.col("etype").alias("subtask"))


def judge_selection(spark: SparkSession, d: str) -> DataFrame:
    """Quotas of the hard elements' subtasks for 200 judgements, and the drawn elements."""
    hard = _hard(spark, d)
    q = sampling.queue_quotas(hard, _weakness(spark, d), "subtask", 200, 20)
    return sampling.draw(hard, q.select("subtask", "quota"), ["subtask"], "element_id").select("subtask", "element_id", F.col("rank").cast("long").alias("rank"))


def expert_priority(spark: SparkSession, d: str) -> DataFrame:
    """The 100 verdicts that people should see first."""
    v = table(spark, d, "judge_verdict").groupBy("verdict_id").agg(F.max(F.struct("received_at", "element_id", "has_error", "confidence")).alias("r")).select("verdict_id", "r.*")
    items = v.join(elements(spark, d, "etype").select("element_id", F.col("etype").alias("subtask")), "element_id").filter("has_error").withColumn("located", F.col("has_error"))
    return sampling.priority(items, _weakness(spark, d), "subtask", "verdict_id", budget=100).select("verdict_id", "subtask", "confidence")


def stage_split(spark: SparkSession, d: str) -> DataFrame:
    """Records by training stage."""
    r = table(spark, d, "sft_record").groupBy("record_id").agg(F.min("subtask").alias("subtask"))
    s = sampling.split_stages(r, _weakness(spark, d), "subtask", "record_id", ["formula", "table"])
    return s.groupBy("subtask", "stage").agg(F.count("*").alias("n"), F.sum("record_id").alias("ids"))


def double_annotation(spark: SparkSession, d: str) -> DataFrame:
    """Five in a hundred elements for a second annotator."""
    return sampling.first_share(table(spark, d, "page_element").select("element_id").distinct(), "element_id", 0.05).select("element_id")


def _script(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Every judged element with its draft, and the judge's rounds as the script."""
    v = table(spark, d, "judge_verdict").filter("element_id is not null and round_no is not null").groupBy("element_id", "round_no").agg(F.max(F.struct("received_at", "verdict_id", "has_error", "confidence", "corrected")).alias("r"))
    v = v.select("element_id", F.col("round_no").alias("round"), "r.has_error", "r.confidence", "r.corrected")
    e = elements(spark, d, "etype", "content").join(v.select("element_id").distinct(), "element_id", "left_semi")
    items = e.select("element_id", F.col("etype").alias("subtask"), F.coalesce(F.try_element_at("content", F.lit("qwen3-vl-8b")), F.try_element_at("content", F.lit("mistral-ocr-4"))).alias("draft"))
    return items, v


def _rounds(spark: SparkSession, d: str) -> DataFrame:
    """Refinement of every judged element by the script."""
    return refine.refine(*_script(spark, d), "element_id", JUDGEABLE)


def judge_refine_loop(spark: SparkSession, d: str) -> DataFrame:
    return _rounds(spark, d).select("element_id", "subtask", "outcome", F.md5("content").alias("content_md5"), "rounds", "confidence")


def judge_summary(spark: SparkSession, d: str) -> DataFrame:
    return refine.summary(_rounds(spark, d))


def annotation_qa(spark: SparkSession, d: str) -> DataFrame:
    """Issues of the records' labels, by code."""
    r = table(spark, d, "sft_record").filter("subtask <> 'layout'")
    b = F.when(F.size("box") == 4, box.area(F.transform("box", lambda v: v.cast("double"))))
    checked = r.select(quality.label_issues(F.col("content"), F.col("subtask"), b, F.lit(None).cast("string")).alias("issues"))
    return quality.issue_counts(checked)


def inter_annotator(spark: SparkSession, d: str) -> DataFrame:
    """Agreement of every two annotators on the elements both labelled."""
    a = table(spark, d, "annotation").select("element_id", "annotator_id", tier_name(F.col("tier")).alias("tier"))
    return quality.annotator_pairs(a, "element_id", "annotator_id", "tier")


def scan_qa_flags(spark: SparkSession, d: str) -> DataFrame:
    """Reasons to drop scans, on line items' numbers as stand-ins for measures."""
    x = table(spark, d, "lineitem").select(quality.scan_reasons(F.col("l_quantity") * 2, F.col("l_discount") * 7, F.col("l_tax") * 1000, F.col("l_quantity") * 50, F.col("l_extendedprice")).alias("reasons"))
    return x.groupBy(F.array_join("reasons", "+").alias("reasons")).agg(F.count("*").alias("n"))


def scan_calibration(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "lineitem").select((F.col("l_quantity") * 2).alias("blur"), (F.col("l_tax") * 1000).alias("contrast"), (F.col("l_returnflag") == "N").alias("readable"))
    return quality.scan_thresholds(x, ["blur", "contrast"], "readable")


def client_stats(spark: SparkSession, d: str) -> DataFrame:
    """Calls per user, error events as failures."""
    return calls.call_stats(table(spark, d, "events"), "user_id", F.col("event_type") == "error", "value")


def failure_streaks(spark: SparkSession, d: str) -> DataFrame:
    return calls.failure_streaks(table(spark, d, "events"), "user_id", ["ts", "event_id"], F.col("event_type") == "error")


def cache_misses(spark: SparkSession, d: str) -> DataFrame:
    """Texts that a cache of the even documents lacks, by content key."""
    docs = table(spark, d, "documents").select("doc_id", calls.cache_key(F.lit("v1"), F.col("text")).alias("key"))
    return calls.cache_misses(docs.select("key"), docs.filter("doc_id % 2 = 0").select("key"))


def tumbling_health(spark: SparkSession, d: str) -> DataFrame:
    """Events and errors per hour and type; an extension."""
    return health.tumbling_health(table(spark, d, "events"), "ts", "event_type", F.col("event_type") == "error")


def session_calls(spark: SparkSession, d: str) -> DataFrame:
    """Sessions of every user with gaps of at most 30 minutes; an extension."""
    return health.sessions(table(spark, d, "events"), "ts", "user_id")


QUERIES = {f.__name__: f for f in (judge_selection, expert_priority, stage_split, double_annotation, judge_refine_loop, judge_summary, annotation_qa, inter_annotator, scan_qa_flags, scan_calibration, client_stats, failure_streaks, cache_misses, tumbling_health, session_calls)}

_WEAK = f"""{SQL_ELEMENTS}, weak AS (
  SELECT etype AS subtask, round(1 - avg(list_avg(list_filter([sims['M-P'], sims['M-Q']], lambda x: x IS NOT NULL))), 6) AS weakness FROM elements GROUP BY etype)"""



def _refine_sql(rounds: int = 3, render=None) -> str:
    """The loop unrolled: one step of tables per round; *render* gives SQL of a label's drawing error."""
    per = ", ".join(f"any_value(has_error) FILTER (round_no = {r}) AS h{r}, any_value(confidence) FILTER (round_no = {r}) AS c{r}, any_value(corrected) FILTER (round_no = {r}) AS f{r}" for r in range(1, rounds + 1))
    steps = [f"""{SQL_ELEMENTS}, vv AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY element_id, round_no ORDER BY received_at DESC, verdict_id DESC) AS rv FROM judge_verdict WHERE element_id IS NOT NULL AND round_no IS NOT NULL) WHERE rv = 1
), pv AS (SELECT element_id, {per} FROM vv GROUP BY element_id), t0 AS (
  SELECT e.element_id, etype AS subtask, coalesce(content['qwen3-vl-8b'], content['mistral-ocr-4']) AS txt, pv.* EXCLUDE (element_id), 0 AS n, CAST(NULL AS DOUBLE) AS conf,
         CASE WHEN coalesce(content['qwen3-vl-8b'], content['mistral-ocr-4'], '') = '' THEN 'no_draft' WHEN etype NOT IN ('text', 'formula', 'table') OR etype IS NULL THEN 'no_judge_path' END AS outcome,
         [coalesce(content['qwen3-vl-8b'], content['mistral-ocr-4'])] AS seen FROM elements e JOIN pv USING (element_id)
)"""]
    for r in range(1, rounds + 1):
        drawn = f"{render('txt', 'subtask')} IS NOT NULL" if render else "false"
        steps.append(f"""a{r} AS (SELECT *, outcome IS NULL AS was_live, {drawn} AS undrawn, outcome IS NULL AND NOT ({drawn}) AS live, CASE WHEN {sql_squash(f"f{r}")} <> '' THEN f{r} END AS fx, {sql_squash("txt")} AS sa, {sql_squash(f"f{r}")} AS sb FROM t{r - 1}), t{r} AS (
  SELECT * EXCLUDE (live, was_live, undrawn, fx, sa, sb) REPLACE (
    CASE WHEN NOT was_live THEN outcome WHEN undrawn THEN 'render_failed' WHEN h{r} IS NULL THEN 'no_verdict' WHEN NOT h{r} THEN 'refined' WHEN fx IS NULL THEN 'no_fix'
         WHEN {sql_similarity("sa", "sb")} >= 0.995::DOUBLE THEN 'stuck' WHEN list_contains(seen, fx) THEN 'oscillating' END AS outcome,
    CASE WHEN live AND h{r} AND fx IS NOT NULL THEN fx ELSE txt END AS txt, CASE WHEN live AND h{r} AND fx IS NOT NULL THEN list_append(seen, fx) ELSE seen END AS seen,
    CASE WHEN live AND h{r} IS NOT NULL THEN {r} ELSE n END AS n, CASE WHEN live AND h{r} IS NOT NULL THEN coalesce(c{r}, 0) ELSE conf END AS conf) FROM a{r})""")
    return ", ".join(steps) + f", done AS (SELECT element_id, subtask, coalesce(outcome, 'max_rounds') AS outcome, txt, n, conf FROM t{rounds})"


ORACLES = {
    "judge_refine_loop": f"WITH {_refine_sql()} SELECT element_id, subtask, outcome, md5(txt) AS content_md5, n AS rounds, conf AS confidence FROM done",
    "judge_summary": f"""WITH {_refine_sql()}
SELECT subtask, count(*) AS n, round(avg((outcome = 'refined')::INT::DOUBLE), 6) AS resolve_rate, round(avg(CASE WHEN n > 0 THEN n END), 6) AS mean_rounds FROM done GROUP BY subtask""",
    "judge_selection": f"""WITH {_WEAK}, hard AS (SELECT element_id, etype AS subtask FROM elements WHERE tier = 'hard'), s AS (
  SELECT h.subtask, count(*) AS n, greatest(coalesce(any_value(weakness), 0), 1e-6::DOUBLE) AS score FROM hard h LEFT JOIN weak USING (subtask) GROUP BY h.subtask
), b AS (SELECT *, least(n, greatest(least(20, 200 // count(*) OVER ()), CAST(floor(200 * score / sum(score) OVER ()) AS BIGINT))) AS base, sum(n) OVER () AS total FROM s
), l AS (SELECT *, greatest(200 - sum(base) OVER (), 0) AS rest, coalesce(sum(n - base) OVER (ORDER BY score DESC, subtask ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead FROM b
), q AS (SELECT subtask, CASE WHEN total <= 200 THEN n ELSE base + greatest(least(n - base, rest - ahead), 0) END AS quota FROM l
), r AS (SELECT subtask, element_id, row_number() OVER (PARTITION BY subtask ORDER BY md5('7:' || element_id), element_id) AS rank FROM hard)
SELECT r.subtask, element_id, rank FROM r JOIN q USING (subtask) WHERE rank <= quota""",
    "expert_priority": f"""WITH {_WEAK}, v AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY verdict_id ORDER BY received_at DESC) AS rn FROM judge_verdict) WHERE rn = 1 AND has_error
)
SELECT verdict_id, e.etype AS subtask, confidence FROM v JOIN elements e ON e.element_id = v.element_id LEFT JOIN weak w ON w.subtask = e.etype
ORDER BY CASE WHEN confidence >= 0.7::DOUBLE THEN 0 ELSE 1 END, coalesce(weakness, 0) DESC, coalesce(confidence, 0) DESC, verdict_id LIMIT 100""",
    "stage_split": f"""WITH {_WEAK}, rec AS (SELECT record_id, min(subtask) AS subtask FROM sft_record GROUP BY record_id), s AS (
  SELECT rec.subtask, count(*) AS n, any_value(weakness) AS weakness FROM rec LEFT JOIN weak USING (subtask) GROUP BY rec.subtask
), c AS (SELECT CAST(floor(sum(n) * 0.3::DOUBLE) AS BIGINT) AS cap FROM s), o AS (
  SELECT subtask, n, coalesce(sum(n) OVER (ORDER BY coalesce(weakness, 0) DESC, subtask ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead FROM s WHERE subtask IN ('formula', 'table')
), q AS (SELECT subtask, greatest(least(n, cap - ahead), 0) AS quota FROM o, c), r AS (
  SELECT *, row_number() OVER (PARTITION BY subtask ORDER BY md5('7:' || record_id), record_id) AS rank FROM rec)
SELECT r.subtask, CASE WHEN rank <= coalesce(quota, 0) THEN 'reinforce' ELSE 'finetune' END AS stage, count(*) AS n, CAST(sum(record_id) AS BIGINT) AS ids FROM r LEFT JOIN q USING (subtask) GROUP BY ALL""",
    "double_annotation": f"""WITH {SQL_ELEMENTS}, k AS (SELECT greatest(1, CAST(round_even(count(*) * 0.05::DOUBLE, 0) AS BIGINT)) AS k FROM elements), r AS (
  SELECT element_id, row_number() OVER (ORDER BY md5('7:' || element_id), element_id) AS rn FROM elements)
SELECT element_id FROM r, k WHERE rn <= k""",
    "annotation_qa": """WITH r AS (
  SELECT content, subtask, trim(regexp_replace(coalesce(content, ''), '[\\s\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]+', ' ', 'g')) AS s,
         CASE WHEN len(box) = 4 THEN greatest(box[3]::DOUBLE - box[1], 0) * greatest(box[4]::DOUBLE - box[2], 0) END AS area
  FROM sft_record WHERE subtask <> 'layout'
), i AS (
  SELECT unnest(CASE WHEN s = '' THEN ['blank'] ELSE list_filter([
    CASE WHEN subtask = 'table' AND NOT regexp_matches(content, '(?is)<t[dh]\\b') THEN 'broken_table' END,
    CASE WHEN area > 0 AND length(s) / (area / 1000) > 12 THEN 'too_long' END, CASE WHEN contains(content, '[?]') THEN 'unread' END], lambda x: x IS NOT NULL) END) AS code FROM r)
SELECT code, count(*) AS n FROM i GROUP BY code""",
    "inter_annotator": f"""WITH a AS (SELECT DISTINCT element_id, annotator_id, {SQL_TIER.format("tier")} AS tier FROM annotation), b AS (SELECT * FROM a WHERE element_id IS NOT NULL AND annotator_id IS NOT NULL AND tier IS NOT NULL)
SELECT x.annotator_id AS annotator_a, y.annotator_id AS annotator_b, count(*) AS n, round(avg((x.tier = y.tier)::INT::DOUBLE), 6) AS agree
FROM b x JOIN b y ON x.element_id = y.element_id AND x.annotator_id < y.annotator_id GROUP BY ALL""",
    "scan_qa_flags": """SELECT array_to_string(list_filter([
  CASE WHEN least(l_quantity * 50, l_extendedprice) < 500 THEN 'small' END, CASE WHEN l_quantity * 2 < 40 THEN 'blurred' END,
  CASE WHEN l_discount * 7 < 0.004::DOUBLE THEN 'blank' WHEN l_discount * 7 > 0.6::DOUBLE THEN 'black' END, CASE WHEN l_tax * 1000 < 25 THEN 'flat' END], lambda x: x IS NOT NULL), '+') AS reasons, count(*) AS n
FROM lineitem GROUP BY 1""",
    "scan_calibration": "SELECT round(quantile_cont(l_quantity * 2, 0.01::DOUBLE), 6) AS min_blur, round(quantile_cont(l_tax * 1000, 0.01::DOUBLE), 6) AS min_contrast FROM lineitem WHERE l_returnflag = 'N'",
    "client_stats": """SELECT user_id, count(*) AS n_calls, count(*) FILTER (event_type = 'error') AS n_failed, round(avg((event_type = 'error')::INT::DOUBLE), 6) AS failed_share,
  round(avg(value) FILTER (event_type <> 'error'), 6) AS mean_latency FROM events GROUP BY user_id""",
    "failure_streaks": """WITH e AS (SELECT user_id, ts, event_id, event_type = 'error' AS f FROM events), i AS (
  SELECT *, sum(CASE WHEN f THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island FROM e)
SELECT user_id, min(ts) AS first_at, count(*) AS n FROM i WHERE f GROUP BY user_id, island HAVING count(*) >= 2""",
    "cache_misses": """WITH k AS (SELECT doc_id, sha256('=v1' || chr(31) || coalesce('=' || text, '~')) AS key FROM documents)
SELECT DISTINCT key FROM k WHERE key NOT IN (SELECT key FROM k WHERE doc_id % 2 = 0)""",
    "tumbling_health": "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n, CAST(count(*) FILTER (event_type = 'error') AS BIGINT) AS n_failed FROM events GROUP BY ALL",
    "session_calls": """WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w >= INTERVAL 30 MINUTE OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (
  SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS n FROM s GROUP BY user_id, k""",
}
