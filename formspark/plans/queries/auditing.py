"""Manifest checks over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from formspark.operators import audit as aud
from formspark.operators import manifest as man
from formspark.plans.queries.intake import BUCKET, ISSUE_SQL, MARK_SQL, PAGES, PREFIX, run_at, UNITS_SQL
from formspark.plans import jobs
from formspark.plans.registry import query
from formspark.session import scratch_dir
from formspark.sources import writers

_SHOWN = ("source_gcs_uri", "source_page_range", "issues")
_QCAT = "'''' || output_category || ''''"
_PLACE_SQL = f"""CASE WHEN destination_gcs_uri IS NULL THEN []
  ELSE list_filter([
    CASE WHEN sub <> '' AND NOT starts_with(rel, sub) THEN 'output_category=' || {_QCAT} || ' but destination path doesn''t start with ''' || sub || ''': ''' || rel || '''' END,
    CASE WHEN sub = '' AND starts_with(rel, 'Declined/') THEN 'output_category=' || {_QCAT} || ' but destination path starts with ''Declined/'': ''' || rel || '''' END,
    CASE WHEN sub = '' AND starts_with(rel, 'Rejected/') THEN 'output_category=' || {_QCAT} || ' but destination path starts with ''Rejected/'': ''' || rel || '''' END,
    CASE WHEN NOT starts_with(below, destination_folder || '/') THEN 'destination_folder=''' || destination_folder || ''' doesn''t match destination_gcs_uri''s source-name folder segment: ''' || below || '''' END
  ], lambda x: x IS NOT NULL) END"""
_PATHS_SQL = """
  SELECT *, CASE WHEN sub <> '' AND starts_with(rel, sub) THEN substr(rel, len(sub) + 1) ELSE rel END AS below FROM (
    SELECT *, substr(destination_gcs_uri, 19) AS rel,
      CASE output_category WHEN 'declined' THEN 'Declined/' WHEN 'rejected' THEN 'Rejected/' ELSE '' END AS sub FROM fx_audited)"""
_GONE = "'destination file does not exist in GCS: ' || destination_gcs_uri"


@query("AUD-01", f"""
SELECT source_gcs_uri, source_page_range, array_to_string({_PLACE_SQL}, ' | ') AS issues FROM ({_PATHS_SQL}) p WHERE len({_PLACE_SQL}) > 0""")
def audit_placement(v):
    return writers.issue_rows(aud.check_placement(v["fx_audited"], BUCKET, PREFIX)).select(*_SHOWN)


@query("AUD-02", f"""
SELECT source_gcs_uri, source_page_range, {_GONE} AS issues FROM fx_audited
WHERE destination_gcs_uri IS NOT NULL AND destination_gcs_uri NOT IN (SELECT uri FROM fx_listing)""")
def audit_destination(v):
    return writers.issue_rows(aud.check_destination(v["fx_audited"], v["fx_listing"], BUCKET)).select(*_SHOWN)


_RANGE = "regexp_full_match(a.source_page_range, '\\d+-\\d+')"
_JUDGED_SQL = f"""
  SELECT *, CASE WHEN mark IS NOT NULL THEN 'declined' WHEN issue IS NOT NULL THEN 'rejected' ELSE 'normal' END AS expected FROM (
    SELECT a.*, s.page_count, coalesce(language_verdict = 'ENGLISH', FALSE) AS ok, {ISSUE_SQL} AS issue, {MARK_SQL} AS mark,
      {_RANGE} AS readable, CASE WHEN {_RANGE} THEN CAST(split_part(a.source_page_range, '-', 1) AS INT) END AS p0,
      CASE WHEN {_RANGE} THEN CAST(split_part(a.source_page_range, '-', 2) AS INT) END AS p1
    FROM fx_audited a LEFT JOIN fx_source s ON s.source_gcs_uri = a.source_gcs_uri
    LEFT JOIN fx_unit_verdict v ON v.source_gcs_uri = a.source_gcs_uri
      AND v.unit_index = CASE WHEN {_RANGE} THEN floor((CAST(split_part(a.source_page_range, '-', 1) AS INT) - 1) / 2) + 1 END)"""
_CATEGORY_SQL = """CASE WHEN NOT readable THEN ['unparseable source_page_range: ''' || source_page_range || '''']
  WHEN p0 < 1 OR p1 > page_count OR p0 > p1 THEN ['source_page_range ''' || source_page_range || ''' out of bounds for a ' || CAST(page_count AS VARCHAR) || '-page source']
  ELSE list_filter([
    CASE WHEN expected <> output_category THEN 're-check says output_category should be ''' || expected || ''' (content_issue=' ||
      CASE WHEN issue IS NULL THEN 'None' WHEN contains(issue, '''') THEN '"' || issue || '"' ELSE '''' || issue || '''' END || ', decline_marking=' || coalesce('''' || mark || '''', 'None') ||
      ', language_note=' || CASE WHEN ok THEN 'None' ELSE '''the survey appears to be written in a language other than English''' END || '), but manifest has ''' || output_category || '''' END,
    CASE WHEN coalesce(rejected, FALSE) <> (expected = 'rejected') THEN 're-check says rejected should be ' || CASE WHEN expected = 'rejected' THEN 'True' ELSE 'False' END || ' but manifest has ' || CASE WHEN rejected THEN 'True' ELSE 'False' END END,
    CASE WHEN coalesce(needs_review, FALSE) <> (expected = 'declined' OR (expected = 'normal' AND NOT ok)) THEN 're-check says needs_review should be ' ||
      CASE WHEN expected = 'declined' OR (expected = 'normal' AND NOT ok) THEN 'True' ELSE 'False' END || ' but manifest has ' || CASE WHEN needs_review THEN 'True' ELSE 'False' END END
  ], lambda x: x IS NOT NULL) END"""


@query("AUD-03", f"""
SELECT source_gcs_uri, source_page_range, array_to_string({_CATEGORY_SQL}, ' | ') AS issues FROM ({_JUDGED_SQL}) j
WHERE page_count % 2 = 0 AND len({_CATEGORY_SQL}) > 0""")
def audit_category(v):
    return writers.issue_rows(
        aud.check_category(v["fx_audited"], v["fx_unit_verdict"], v["fx_source"], PAGES)).select(*_SHOWN)


_MISSING_SQL = f"""
  SELECT u.source_gcs_uri, u.source_page_range, 'no manifest row at all for page range ' || u.source_page_range || ' of this source PDF' AS issues
  FROM ({UNITS_SQL}) u JOIN (SELECT DISTINCT source_gcs_uri FROM {{rows}}) m ON m.source_gcs_uri = u.source_gcs_uri
  WHERE NOT EXISTS (SELECT 1 FROM {{rows}} a WHERE a.source_gcs_uri = u.source_gcs_uri AND a.source_page_range = u.source_page_range)"""
_MALFORMED_SQL = """
  SELECT s.source_gcs_uri, NULL AS source_page_range, 'source PDF has ' || CAST(s.page_count AS VARCHAR) || ' page(s), not a multiple of 2 - cannot verify completeness by page range' AS issues
  FROM fx_source s JOIN (SELECT source_gcs_uri, count(*) AS n, max(CASE WHEN rejected THEN rejected_reason END) AS reason FROM {rows} GROUP BY source_gcs_uri) m
    ON m.source_gcs_uri = s.source_gcs_uri
  WHERE s.page_count % 2 = 1 AND NOT (n = 1 AND coalesce(contains(reason, CAST(s.page_count AS VARCHAR) || ' page(s)') AND contains(reason, 'not a multiple of'), FALSE))"""


@query("AUD-04", _MISSING_SQL.format(rows="fx_audited"))
def audit_missing_units(v):
    return writers.issue_rows(aud.missing_units(v["fx_source"], v["fx_audited"], PAGES)).select(*_SHOWN)


def _broken_rejections(v):
    """Planted defects: some whole-source rows lose their rejection, others get a second row."""
    rows = v["fx_audited"]
    whole = rows.filter(F.col("destination_gcs_uri").isNull() & (F.col("output_category") == "rejected"))
    return rows.withColumn("source_gcs_uri", F.regexp_replace("source_gcs_uri", "^file:", "")).unionByName(
        whole.filter(F.contains("source_gcs_uri", F.lit("Nov 1"))))


_BROKEN = """(SELECT regexp_replace(source_gcs_uri, '^file:', '') AS source_gcs_uri, rejected, rejected_reason FROM fx_audited UNION ALL
  SELECT source_gcs_uri, rejected, rejected_reason FROM fx_audited WHERE destination_gcs_uri IS NULL AND output_category = 'rejected' AND contains(source_gcs_uri, 'Nov 1'))"""


@query("AUD-05", _MALFORMED_SQL.format(rows=_BROKEN))
def audit_malformed(v):
    return writers.issue_rows(aud.check_malformed(v["fx_source"], _broken_rejections(v), PAGES)).select(*_SHOWN)


_SOURCE_SQL = """
  SELECT a.*, CASE WHEN NOT starts_with(a.source_gcs_uri, 'gs://bucket/') THEN 'unrecognized source_gcs_uri: ''' || a.source_gcs_uri || ''''
    WHEN a.source_gcs_uri NOT IN (SELECT uri FROM fx_listing) THEN 'source PDF no longer exists in GCS: ' || a.source_gcs_uri
    WHEN e.error IS NOT NULL THEN 'failed to open source PDF: ' || e.error END AS source_problem
  FROM fx_audited a LEFT JOIN fx_open_errors e ON e.source_gcs_uri = a.source_gcs_uri"""


@query("AUD-06", f"SELECT source_gcs_uri, source_page_range, source_problem AS issues FROM ({_SOURCE_SQL}) s WHERE source_problem IS NOT NULL")
def audit_sources(v):
    return writers.issue_rows(
        aud.check_source(v["fx_audited"], v["fx_listing"], v["fx_open_errors"], BUCKET)).select(*_SHOWN)


_ALL_SQL = _PATHS_SQL.replace("FROM fx_audited", f"FROM ({_JUDGED_SQL.replace('FROM fx_audited a', 'FROM (' + _SOURCE_SQL + ') a')}) j")


ALL_ISSUES_SQL = f"""
WITH sp AS ({_SOURCE_SQL}), sound AS (SELECT * FROM sp WHERE source_problem IS NULL),
every AS (SELECT source_gcs_uri, source_page_range, CASE WHEN source_problem IS NOT NULL THEN source_problem
    ELSE array_to_string(list_concat(list_concat({_PLACE_SQL},
      CASE WHEN destination_gcs_uri IS NOT NULL AND destination_gcs_uri NOT IN (SELECT uri FROM fx_listing) THEN [{_GONE}] ELSE [] END),
      CASE WHEN page_count % 2 = 0 THEN {_CATEGORY_SQL} ELSE [] END), ' | ') END AS issues FROM ({_ALL_SQL}) q)
SELECT source_gcs_uri, source_page_range, issues FROM every WHERE issues <> ''
UNION ALL {_MISSING_SQL.format(rows='sound')} UNION ALL {_MALFORMED_SQL.format(rows='sound')}"""


@query("AUD-07 SNK-08", ALL_ISSUES_SQL)
def audit_everything(v):
    rows = v["fx_audited"]
    found = aud.audit(rows, v["fx_source"], v["fx_listing"], v["fx_unit_verdict"], BUCKET, PREFIX, PAGES,
                      v["fx_open_errors"])
    return writers.issue_rows(found).select(*_SHOWN)


_ISSUES = "source_gcs_uri string, source_page_range string, issues string"


@query("AUD-07 SNK-08 AUD-08", ALL_ISSUES_SQL)
def audit_changes(v):
    """Issues after two runs: before the first a share of the verdicts and files was missing, which the second sees."""
    v.keep("fx_source", "fx_manifest", "fx_unit_verdict")
    base = scratch_dir(v.spark, "audit")
    issues = writers.KeyedTable(v.spark, f"{base}/issues", ["source_gcs_uri"], StructType.fromDDL(_ISSUES), buckets=16)
    audited = writers.KeyedTable(v.spark, f"{base}/audited", ["source_gcs_uri"], StructType.fromDDL("source_gcs_uri string, digest string"), buckets=16)
    some = F.crc32(F.col("source_gcs_uri").cast("binary")) % 4 > 0
    for verdicts, listing in ((v["fx_unit_verdict"].filter(some), v["fx_listing"].filter(F.crc32(F.col("uri").cast("binary")) % 9 > 0)),
                              (v["fx_unit_verdict"], v["fx_listing"])):
        jobs.audit_changes(issues, audited, v["fx_audited"], v["fx_source"], listing, verdicts, BUCKET, PREFIX, PAGES, v["fx_open_errors"])
    return issues.read()


@query("AUD-08", """
SELECT DISTINCT source_gcs_uri FROM fx_audited WHERE source_gcs_uri NOT IN (SELECT source_gcs_uri FROM fx_source WHERE lang = 'en')""")
def audit_pending(v):
    return aud.pending_sources(v["fx_audited"], v["fx_source"].filter("lang = 'en'"))


@query("AUD-09", """
SELECT source_gcs_uri, source_page_range, CASE WHEN NOT starts_with(source_gcs_uri, 'gs://bucket/') THEN 'source_gcs_uri not under expected bucket'
  WHEN source_gcs_uri NOT IN (SELECT uri FROM fx_listing) THEN 'source PDF no longer exists' END AS skip_reason FROM fx_audited""")
def audit_reprocess_units(v):
    return aud.reprocess_units(v["fx_audited"].select(*man.KEY), v["fx_listing"], BUCKET)


@query("AUD-10", f"""
WITH w AS (SELECT DISTINCT u.source_gcs_uri, u.source_page_range, u.unit_index, u.destination_folder, u.output_name FROM ({UNITS_SQL}) u
    JOIN fx_audited a ON a.source_gcs_uri = u.source_gcs_uri AND a.source_page_range = u.source_page_range
    WHERE a.needs_review AND u.source_gcs_uri IN (SELECT uri FROM fx_listing)),
f AS (SELECT w.*, {ISSUE_SQL} AS issue, {MARK_SQL} AS mark FROM w LEFT JOIN fx_unit_verdict v ON v.source_gcs_uri = w.source_gcs_uri AND v.unit_index = w.unit_index),
n AS (SELECT source_gcs_uri, source_page_range, CASE WHEN mark IS NOT NULL THEN 'declined' WHEN issue IS NOT NULL THEN 'rejected' ELSE 'normal' END AS output_category, destination_folder, output_name FROM f)
SELECT source_gcs_uri, source_page_range, output_category, destination_gcs_uri FROM fx_audited a
WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.source_gcs_uri = a.source_gcs_uri AND n.source_page_range = a.source_page_range)
UNION ALL SELECT source_gcs_uri, source_page_range, output_category,
  'gs://bucket/split/' || CASE output_category WHEN 'declined' THEN 'Declined/' WHEN 'rejected' THEN 'Rejected/' ELSE '' END || destination_folder || '/' || output_name FROM n""")
def audit_apply_reprocess(v):
    rows = v["fx_audited"]
    flags = rows.filter("needs_review").select(*man.KEY)
    replaced, _old = aud.apply_reprocess(flags, v["fx_source"], v["fx_unit_verdict"], v["fx_listing"], rows,
                                         BUCKET, PREFIX, PAGES, run_at())
    return replaced.select("source_gcs_uri", "source_page_range", "output_category", "destination_gcs_uri")
