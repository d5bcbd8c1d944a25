"""Roll-up of answers and the feedback loop over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from formspark.operators import feedback as fb
from formspark.operators import rollup
from formspark.plans import jobs
from formspark.plans.queries.intake import run_at
from formspark.plans.queries.texts import CATEGORY_SQL, NUMBER_SQL, PAGE_SQL
from formspark.plans.registry import query
from formspark.session import scratch_dir
from formspark.sources.layouts import FEEDBACK, FILE_QUALITY, conform, struct_of
from formspark.sources.writers import KeyedTable, replace_by_folder

_NUMBERED = f"SELECT *, {NUMBER_SQL} AS qnum, coalesce(review_note, '') AS note FROM fx_responses"
_ISSUES = f"""
  SELECT *, 'Q' || qnum || ': ' || {CATEGORY_SQL} AS issue,
    'Question ' || qnum || ' (' || coalesce('page ' || CAST({PAGE_SQL} AS VARCHAR), 'page unknown') || '): ' || note AS area,
    CASE WHEN qnum IN ('H1','H2','H3','H4','H5','H6') THEN 0 WHEN regexp_full_match(qnum, '[0-9]+') THEN 1 ELSE 2 END AS tier,
    CASE WHEN qnum IN ('H1','H2','H3','H4','H5','H6') THEN CAST(substr(qnum, 2) AS INT) WHEN regexp_full_match(qnum, '[0-9]+') THEN CAST(qnum AS INT) ELSE 0 END AS place
  FROM ({_NUMBERED}) r"""
_CATEGORIES = f"""
  SELECT folder_name, file_name, needs_review AS flagged, qnum, tier, place, page, category, count(*) AS n, min(note) AS low, max(note) AS high, min(report_date) AS report_date
  FROM (SELECT i.*, substr(issue, length(qnum) + 4) AS category, CAST({PAGE_SQL} AS VARCHAR) AS page FROM ({_ISSUES}) i) i GROUP BY ALL"""
_TIMES = "CASE WHEN {n} > 1 THEN ' (x' || CAST({n} AS VARCHAR) || ')' ELSE '' END"
_QUALITY = f"""
  SELECT q.*, coalesce(a.unreadable_areas, '') AS unreadable_areas FROM (
    SELECT folder_name, file_name, min(report_date) AS report_date, CAST(sum(n) AS BIGINT) AS total_question_count, CAST(coalesce(sum(n) FILTER (flagged), 0) AS BIGINT) AS flagged_question_count,
      coalesce(string_agg('Q' || qnum || ': ' || category || {_TIMES.format(n="n")}, '; ' ORDER BY tier, place, qnum, page, category) FILTER (flagged), '') AS issues
    FROM ({_CATEGORIES}) c GROUP BY folder_name, file_name) q
  LEFT JOIN (
    SELECT folder_name, file_name, string_agg('Question ' || qnum || ' (' || coalesce('page ' || page, 'page unknown') || '): ' || CASE WHEN low = high THEN low ELSE 'several notes' END || {_TIMES.format(n="n")}, '; ' ORDER BY tier, place, qnum, page) AS unreadable_areas
    FROM (SELECT folder_name, file_name, qnum, tier, place, page, CAST(sum(n) AS BIGINT) AS n, min(low) AS low, max(high) AS high FROM ({_CATEGORIES}) c WHERE flagged GROUP BY ALL) p
    GROUP BY folder_name, file_name) a ON q.folder_name IS NOT DISTINCT FROM a.folder_name AND q.file_name IS NOT DISTINCT FROM a.file_name"""


def quality_of(v):
    return rollup.file_quality(v["fx_responses"], run_at())


@query("FQ-02", f"""
SELECT folder_name, file_name, report_date, DATE '2025-12-01' AS refreshed_date, flagged_question_count > 0 AS needs_review, flagged_question_count, total_question_count,
  CASE WHEN flagged_question_count > 0 THEN CAST(flagged_question_count AS VARCHAR) || ' of ' || CAST(total_question_count AS VARCHAR) || ' question(s) flagged for review in ' || file_name || ': ' || issues || '.'
       ELSE 'No issues detected in ' || file_name || ' - all ' || CAST(total_question_count AS VARCHAR) || ' question(s) passed review.' END AS issue_summary,
  issues, unreadable_areas FROM ({_QUALITY}) q""", dates="report_date refreshed_date")
def file_quality_rollup(v):
    return quality_of(v).select(
        "folder_name", "file_name", "report_date", "refreshed_date", "needs_review", "flagged_question_count",
        "total_question_count", "issue_summary", F.array_join("issues", "; ").alias("issues"),
        F.array_join("unreadable_areas", "; ").alias("unreadable_areas"))


@query("FQ-02", f"SELECT folder_name, file_name, issue, area FROM ({_ISSUES}) i WHERE needs_review")
def file_issue_rows(v):
    return rollup.file_issues(v["fx_responses"]).select("folder_name", "file_name", "issue", "area")


@query("FQ-01 FN-20", f"SELECT DISTINCT survey_question, qnum AS question_number FROM ({_NUMBERED}) r")
def file_question_lookup(v):
    return rollup.question_lookup(v["fx_responses"])


@query("FQ-03", f"""
SELECT count(*) AS files, CAST(sum(total_question_count) AS BIGINT) AS answers, CAST(count_if(flagged_question_count > 0) AS BIGINT) AS flagged_files FROM ({_QUALITY}) q""")
def file_quality_totals(v):
    return rollup.quality_totals(v["fx_responses"])


@query("FQ-04 SNK-03 SNK-06", f"""
WITH q AS ({_QUALITY}), new AS (SELECT folder_name, file_name, flagged_question_count, total_question_count, DATE '2025-12-01' AS refreshed_date FROM q WHERE flagged_question_count > 0)
SELECT folder_name, file_name, CAST(0 AS BIGINT) AS flagged_question_count, CAST(1 AS BIGINT) AS total_question_count, DATE '2025-11-01' AS refreshed_date FROM q
WHERE folder_name IS NULL OR folder_name NOT IN (SELECT folder_name FROM new WHERE folder_name IS NOT NULL)
UNION ALL SELECT * FROM new""", dates="refreshed_date")
def file_quality_refresh(v):
    shown = ["folder_name", "file_name", "flagged_question_count", "total_question_count", "refreshed_date"]
    stored = conform(v["fx_responses"].select("folder_name", "file_name").distinct().withColumns({
        "flagged_question_count": F.lit(0), "total_question_count": F.lit(1),
        "refreshed_date": F.lit("2025-11-01")}), FILE_QUALITY)
    fresh = conform(quality_of(v).filter("needs_review"), FILE_QUALITY)
    return replace_by_folder(stored, fresh).select(*shown)


def synced(v):
    known = fb.sync_feedback(v["fx_responses"].filter("survey_answer = 'Yes'"), None)
    return fb.sync_feedback(v["fx_responses"], known.withColumn(
        "updated_with_feedback", F.when(F.col("question_number") == "2", F.lit(False))))


_SYNCED = """
  SELECT folder_name, file_name, question_number, survey_answer, needs_review,
    CASE WHEN survey_answer = 'Yes' AND question_number = '2' THEN FALSE END AS updated_with_feedback FROM fx_responses"""


@query("FB-01", f"SELECT * FROM ({_SYNCED}) s")
def feedback_sync(v):
    return synced(v).select("folder_name", "file_name", "question_number", "survey_answer", "needs_review",
                            "updated_with_feedback")


@query("FB-02", f"SELECT folder_name, file_name, question_number FROM ({_SYNCED}) s WHERE needs_review AND updated_with_feedback IS NULL")
def feedback_pending(v):
    return fb.pending_feedback(synced(v)).select("folder_name", "file_name", "question_number")


@query("FB-03", f"""
SELECT s.folder_name, s.file_name, s.question_number, CASE WHEN hit THEN f.correct_answer ELSE s.survey_answer END AS survey_answer,
  CASE WHEN hit THEN f.correct_answer END AS correct_answer, CASE WHEN hit THEN TRUE ELSE s.updated_with_feedback END AS updated_with_feedback,
  CASE WHEN hit THEN 'export_1.csv' END AS ingested_from, coalesce(hit, FALSE) AS applied_now
FROM (SELECT s.*, f.correct_answer, f.correct_answer <> '' AND s.updated_with_feedback IS NULL AS hit FROM ({_SYNCED}) s
  LEFT JOIN fx_feedback f ON f.folder_name = s.folder_name AND f.file_name = s.file_name AND f.question_number = s.question_number) s
LEFT JOIN fx_feedback f ON f.folder_name = s.folder_name AND f.file_name = s.file_name AND f.question_number = s.question_number""")
def feedback_merge(v):
    return fb.merge_feedback(synced(v), v["fx_feedback"], F.lit("export_1.csv"), run_at()).select(
        "folder_name", "file_name", "question_number", "survey_answer", "correct_answer", "updated_with_feedback",
        "ingested_from", "applied_now")


@query("FB-03", """
SELECT folder_name, file_name, correct_answer AS question_number, count(*) AS rows FROM fx_feedback WHERE correct_answer IS NOT NULL
GROUP BY ALL HAVING count(*) > 1""")
def feedback_duplicates(v):
    doubled = v["fx_feedback"].withColumn("question_number", F.col("correct_answer"))
    return fb.sheet_duplicates(doubled)


@query("FB-04 SRC-03 SRC-04 FB-01 FB-03", """
SELECT r.folder_name, r.file_name, r.question_number, CASE WHEN f.correct_answer <> '' THEN f.correct_answer ELSE r.survey_answer END AS survey_answer, coalesce(f.correct_answer <> '', FALSE) AS applied_now
FROM fx_responses r LEFT JOIN fx_feedback f ON f.folder_name = r.folder_name AND f.file_name = r.file_name AND f.question_number = r.question_number""")
def feedback_ingest_latest(v):
    return jobs.ingest_latest(v.spark, _exported(v), "review_", v["fx_responses"], None, run_at()).select(
        "folder_name", "file_name", "question_number", "survey_answer", "applied_now")


def _exported(v):
    """The sheet as the newest export of a folder, and a listing that names it."""
    base = scratch_dir(v.spark, "exports")
    newest = f"{base}/review_20251130_101500.csv"
    v["fx_feedback"].write.option("header", "true").csv(newest)
    listing = v["fx_exports"].select(F.concat(F.lit(f"{base}/"), F.substring_index("object_name", "/", -1)).alias("object_name"))
    return listing.unionByName(v["region"].select(F.lit(newest).alias("object_name")))


@query("FB-04 FB-01 FB-03 SNK-02", """
WITH a AS (SELECT r.folder_name, r.file_name, r.question_number, CASE WHEN f.correct_answer <> '' THEN f.correct_answer ELSE r.survey_answer END AS survey_answer, coalesce(f.correct_answer <> '', FALSE) AS taken
FROM fx_responses r LEFT JOIN fx_feedback f ON f.folder_name = r.folder_name AND f.file_name = r.file_name AND f.question_number = r.question_number)
SELECT folder_name, file_name, question_number, survey_answer, taken, (SELECT count(*) FILTER (taken) FROM a) AS first_applied, CAST(0 AS BIGINT) AS then_applied FROM a""")
def feedback_load_twice(v):
    """The newest export written into the feedback table, and loaded again: the second time nothing is left to apply."""
    v.keep("fx_responses")
    table = KeyedTable(v.spark, scratch_dir(v.spark, "feedback"), fb.KEY, struct_of(FEEDBACK), buckets=8)
    listing = _exported(v)
    first, then = (jobs.load_feedback(table, listing, "review_", v["fx_responses"], run_at()) for _run in range(2))
    return table.read().select("folder_name", "file_name", "question_number", "survey_answer",
                               F.coalesce("updated_with_feedback", F.lit(False)).alias("taken"),
                               F.lit(first).cast("bigint").alias("first_applied"), F.lit(then).cast("bigint").alias("then_applied"))


@query("FB-05", """
SELECT correction_id, file_name, question, root_cause, row_number() OVER (PARTITION BY question, root_cause ORDER BY logged_at, correction_id) > 1 AS recurrence
FROM fx_corrections QUALIFY root_cause = 'error' ORDER BY logged_at DESC, correction_id DESC LIMIT 100""")
def feedback_corrections(v):
    return fb.list_corrections(v["fx_corrections"], root_cause="error", limit=100).drop("logged_at")
