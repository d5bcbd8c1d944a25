"""Column functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from formspark import functions as fx
from formspark.plans.registry import query

# Source addresses in the shapes they come in, from documents and pages.
_ADDRESSES = """
    SELECT CASE doc_id % 6
             WHEN 0 THEN replace(source_gcs_uri, ' ', '%20')
             WHEN 1 THEN 'https://storage.googleapis.com/' || substr(source_gcs_uri, 6)
             WHEN 2 THEN 'https://storage.cloud.google.com/bucket/raw/a+b%2Bc/' || lang || '%zz.pdf'
             WHEN 3 THEN 'gs://' || lang
             WHEN 4 THEN 'gs://bucket/raw/' || lang || '/sub/x%C3%A9.pdf'
             ELSE source_gcs_uri END AS uri
    FROM fx_source UNION ALL SELECT url AS uri FROM pages
"""
_FOLDERS = """
    SELECT CASE o_custkey % 9
             WHEN 0 THEN 'Nov ' || CAST(o_orderkey % 40 AS STRING) || ' 2025'
             WHEN 1 THEN 'November ' || CAST(o_orderkey % 32 AS STRING) || ', 2024'
             WHEN 2 THEN substr(CAST(o_orderdate AS STRING), 1, 10)
             WHEN 3 THEN '2025_' || CAST(o_orderkey % 14 AS STRING) || '_30'
             WHEN 4 THEN ' Feb' || CAST(o_orderkey % 31 AS STRING) || ' '
             WHEN 5 THEN 'batch_' || CAST(o_orderkey AS STRING)
             WHEN 6 THEN 'Sept 3rd 2025'
             WHEN 7 THEN '20251110'
             ELSE 'Sept' || 'ember ' || CAST(o_orderkey % 29 AS STRING) || ' 2023' END AS folder,
           CASE o_custkey % 4 WHEN 0 THEN 'Dec' || CAST(o_orderkey % 40 AS STRING) || '_1.pdf'
             WHEN 1 THEN 'may7.pdf' WHEN 2 THEN 'Xyz3_2.pdf'
             ELSE 'Jan' || CAST(o_orderkey % 10 AS STRING) || 'x.pdf' END AS file_name,
           CASE o_custkey % 3 WHEN 0 THEN substr(CAST(o_orderdate AS STRING), 1, 10)
             WHEN 1 THEN '2025-02-30' ELSE 'n/a' END AS iso
    FROM orders
"""
_MONTHS = (
    "MAP {'jan':1,'feb':2,'mar':3,'apr':4,'may':5,'jun':6,'jul':7,'aug':8,'sep':9,'oct':10,'nov':11,'dec':12,"
    "'january':1,'february':2,'march':3,'april':4,'june':6,'july':7,'august':8,'september':9,'october':10,"
    "'november':11,'december':12}"
)
_CHOICES_SQL = """list_filter(list_transform(CASE WHEN contains({c}, '|') THEN string_split({c}, '|')
  WHEN contains({c}, ' / ') THEN string_split({c}, ' / ') ELSE CAST([] AS VARCHAR[]) END, lambda x: trim(x)), lambda x: x <> '')"""


@query("FN-11 FN-12 FN-13 FN-14 FN-15", f"""
SELECT form_id, number, array_to_string({_CHOICES_SQL.format(c='choices')}, ' | ') AS joined,
       CAST(len({_CHOICES_SQL.format(c='choices')}) AS INT) AS n_choices,
       contains(choices, '|') OR contains(choices, ' / ') AS is_list,
       lower(trim(coalesce(model_overrules, ''))) IN ('y', 'yes', 'true', '1') AS overrules,
       coalesce(trim(ocr_authoritative), '') AS authoritative
FROM fx_questions""")
def fn_choice_cells(v):
    choices = fx.split_choices(F.col("choices"))
    return v["fx_questions"].select(
        "form_id", "number",
        fx.join_choices(choices).alias("joined"),
        F.size(choices).alias("n_choices"),
        fx.is_choice_list(F.col("choices")).alias("is_list"),
        fx.is_yes(F.col("model_overrules")).alias("overrules"),
        fx.clean(F.col("ocr_authoritative")).alias("authoritative"),
    )


@query("FN-03 FN-04", f"""
WITH a AS ({_ADDRESSES}),
b AS (SELECT uri, CASE WHEN starts_with(uri, 'gs://') THEN substr(uri, 6)
        WHEN regexp_matches(uri, '^https?://(storage\\.googleapis\\.com|storage\\.cloud\\.google\\.com)/')
        THEN regexp_replace(uri, '^https?://[^/]*/', '') END AS rest FROM a),
c AS (SELECT uri, url_decode(rest) AS rest FROM b),
d AS (SELECT uri, CASE WHEN contains(rest, '/') AND split_part(rest, '/', 1) <> '' THEN split_part(rest, '/', 1) END AS bucket,
        CASE WHEN contains(rest, '/') THEN substr(rest, strpos(rest, '/') + 1) END AS obj FROM c)
SELECT uri, CASE WHEN bucket IS NOT NULL AND obj <> '' THEN bucket END AS bucket,
       CASE WHEN bucket IS NOT NULL AND obj <> '' THEN obj END AS object,
       NOT (bucket IS NOT NULL AND coalesce(obj, '') <> '') AS bad,
       CASE WHEN bucket IS NOT NULL AND obj <> '' THEN
         CASE WHEN starts_with(obj, 'raw/') THEN CASE WHEN contains(substr(obj, 5), '/') THEN split_part(substr(obj, 5), '/', 1) END
              WHEN contains(obj, '/') THEN split_part(obj, '/', 1) END END AS folder
FROM d""")
def fn_object_addresses(v):
    v["fx_source"].createOrReplaceTempView("fx_source")
    v["pages"].createOrReplaceTempView("pages")
    parsed = fx.parse_uri(F.col("uri"))
    return v.spark.sql(_ADDRESSES).select(
        "uri", parsed["bucket"].alias("bucket"), parsed["object"].alias("object"),
        parsed["error"].isNotNull().alias("bad"),
        fx.relative_folder(F.col("uri"), F.lit("gs://bucket/raw/")).alias("folder"),
    )


@query("FN-05 FN-06 FN-07 FN-08 RCN-17", f"""
WITH f AS ({_FOLDERS}),
x AS (SELECT *, trim(folder) AS t,
   regexp_extract(trim(folder), '(\\d{{4}})[-_/]?(\\d{{1,2}})[-_/](\\d{{1,2}})\\b', ['y', 'm', 'd']) AS i,
   regexp_extract(trim(folder), '([A-Za-z]{{3,9}})\\.?\\s*[_ ]?(\\d{{1,2}})(?:(?:st|nd|rd|th)?)[,_ ]*\\s*(\\d{{4}})?', ['m', 'd', 'y']) AS w,
   regexp_extract(trim(folder), '^([A-Za-z]{{3,}})\\s+(\\d{{1,2}})\\s+(\\d{{4}})$', ['m', 'd', 'y']) AS s,
   regexp_extract(trim(file_name), '^([A-Za-z]{{3}})(\\d{{1,2}})[_\\W]', ['m', 'd']) AS n FROM f)
SELECT folder, file_name, iso,
  TRY_CAST(s.y || '-' || CAST({_MONTHS}[lower(substr(s.m, 1, 3))] AS VARCHAR) || '-' || s.d AS DATE) AS strict_date,
  coalesce(TRY_CAST(i.y || '-' || i.m || '-' || i.d AS DATE),
    TRY_CAST(CASE WHEN w.y = '' THEN '2025' ELSE w.y END || '-' || CAST({_MONTHS}[lower(w.m)] AS VARCHAR) || '-' || w.d AS DATE),
    DATE '2025-12-01') AS best_date,
  CASE WHEN {_MONTHS}[lower(n.m)] IS NOT NULL AND TRY_CAST(n.d AS INT) BETWEEN 1 AND 31 THEN {_MONTHS}[lower(n.m)] * 100 + TRY_CAST(n.d AS INT) END AS month_day,
  TRY_CAST(iso AS DATE) AS iso_date
FROM x""", dates="strict_date best_date iso_date")
def fn_name_dates(v):
    v["orders"].createOrReplaceTempView("orders")
    md = fx.file_name_month_day(F.col("file_name"))
    return v.spark.sql(_FOLDERS).select(
        "folder", "file_name", "iso",
        fx.strict_folder_date(F.col("folder")).alias("strict_date"),
        fx.folder_date(F.col("folder"), F.lit("2025-12-01").cast("date")).alias("best_date"),
        (md["month"] * 100 + md["day"]).alias("month_day"),
        fx.iso_date(F.col("iso")).alias("iso_date"),
    )


@query("FN-01 FN-02 FN-09 FN-10", """
SELECT doc_id, array_to_string(list_transform(regexp_extract_all(lower(source_gcs_uri), '[^0-9]*[0-9]+|[^0-9]+'),
         lambda c: regexp_extract(c, '^([^0-9]*)', 1) || '#' || CASE WHEN regexp_extract(c, '([0-9]+)$', 1) = '' THEN ''
           ELSE CAST(len(regexp_replace(regexp_extract(c, '([0-9]+)$', 1), '^0+', '')) AS VARCHAR) || ':' ||
                regexp_replace(regexp_extract(c, '([0-9]+)$', 1), '^0+', '') END), '~') AS natural,
       'raw/' || lang || '/' AS prefix,
       'Batch ' || CAST(doc_id AS VARCHAR) AS stem,
       'Batch ' || CAST(doc_id AS VARCHAR) || '_p' || CAST(page_count AS VARCHAR) || '.pdf' AS unit,
       '2025_Batch ' || CAST(doc_id AS VARCHAR) || '_p' || CAST(page_count + 1 AS VARCHAR) || '.pdf' AS legacy_unit,
       ['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec'][doc_id % 12 + 1] || CAST(page_count AS VARCHAR) || '_' || lang AS batch,
       'split/' || CASE lang WHEN 'de' THEN 'Declined/' WHEN 'fr' THEN 'Rejected/' ELSE '' END || 'f/n.pdf' AS destination
FROM fx_source""")
def fn_unit_paths(v):
    name = fx.stem(fx.base_name(F.col("source_gcs_uri")))
    category = F.when(F.col("lang") == "de", "declined").when(F.col("lang") == "fr", "rejected").otherwise("normal")
    shown = F.transform(
        fx.natural_key(F.col("source_gcs_uri")),
        lambda e: F.concat(e["text"], F.lit("#"), F.coalesce(
            F.concat(e["digit_count"].cast("string"), F.lit(":"), e["digits"]), F.lit(""))),
    )
    return v["fx_source"].select(
        "doc_id", F.array_join(shown, "~").alias("natural"),
        fx.norm_prefix(F.concat(F.lit("raw/"), F.col("lang"))).alias("prefix"),
        name.alias("stem"), fx.unit_name(name, F.col("page_count")).alias("unit"),
        fx.legacy_unit_name(F.lit(2025), name, F.col("page_count")).alias("legacy_unit"),
        fx.batch_folder((F.col("doc_id") % 12 + 1).cast("int"), F.col("page_count"), F.col("lang")).alias("batch"),
        fx.destination_path(F.lit("split"), category, F.lit("f"), F.lit("n.pdf")).alias("destination"),
    )


@query("FN-17 FN-18 FN-19", """
SELECT source_gcs_uri, unit_index, coalesce(language_verdict = 'ENGLISH', FALSE) AS language_ok,
  CASE split_part(regexp_replace(upper(trim(content_verdict)), '\\s+', ' ', 'g'), ' ', 1)
    WHEN 'UNREADABLE' THEN 'Gemini could not read the page content' WHEN 'BLANK' THEN 'The PDF is empty - there''s no data to process' END AS issue,
  CASE split_part(regexp_replace(upper(trim(content_verdict)), '\\s+', ' ', 'g'), ' ', 2)
    WHEN 'DECLINED_WORD' THEN 'WORD' WHEN 'DECLINED_SCRIBBLE' THEN 'SCRIBBLE' END AS marking
FROM fx_unit_verdict""")
def fn_verdict_tokens(v):
    content = fx.content_verdict(F.col("content_verdict"))
    return v["fx_unit_verdict"].select(
        "source_gcs_uri", "unit_index", fx.language_ok(F.col("language_verdict")).alias("language_ok"),
        content["content_issue"].alias("issue"), content["decline_marking"].alias("marking"),
    )


@query("FN-19", """
SELECT source_gcs_uri, source_page_range,
  CASE WHEN regexp_full_match(source_page_range, '\\d+-\\d+') THEN CAST(split_part(source_page_range, '-', 1) AS INT) END AS first_page,
  CASE WHEN regexp_full_match(source_page_range, '\\d+-\\d+') THEN CAST(split_part(source_page_range, '-', 2) AS INT) END AS last_page,
  NOT regexp_full_match(source_page_range, '\\d+-\\d+') AS bad
FROM fx_audited""")
def fn_page_range(v):
    pages = fx.page_range(F.col("source_page_range"))
    return v["fx_audited"].select(
        "source_gcs_uri", "source_page_range", pages["start"].alias("first_page"),
        pages["end"].alias("last_page"), pages["bad"].alias("bad"),
    )


NUMBER_SQL = """CASE
  WHEN contains({t}, '. ') AND regexp_full_match(trim(split_part({t}, '. ', 1)), '[0-9]+|[Hh][0-9]+') THEN upper(trim(split_part({t}, '. ', 1)))
  WHEN contains({t}, ') ') AND regexp_full_match(trim(split_part({t}, ') ', 1)), '[0-9]+|[Hh][0-9]+') THEN upper(trim(split_part({t}, ') ', 1)))
  WHEN contains({t}, '.') AND regexp_full_match(trim(split_part({t}, '.', 1)), '[0-9]+|[Hh][0-9]+') THEN upper(trim(split_part({t}, '.', 1)))
  ELSE '?' END""".format(t="trim(survey_question)")
PAGE_SQL = """CASE WHEN qnum IN ('H1','H2','H3','H4','H5','H6') THEN 1 WHEN TRY_CAST(qnum AS INT) BETWEEN 1 AND 23 THEN 1
  WHEN TRY_CAST(qnum AS INT) BETWEEN 24 AND 35 THEN 2 END"""
CATEGORY_SQL = """CASE
  WHEN contains(lower(note), 'cloud vision') THEN 'independent OCR cross-check disagreement (Vision couldn''t confirm the model''s written-text answer)'
  WHEN contains(lower(note), 'no box confidently marked') THEN 'model answered but scan appears blank here'
  WHEN contains(lower(note), 'auto-corrected to the pixel reading') THEN 'model/pixel disagreement (auto-corrected to the pixel reading)'
  WHEN contains(lower(note), 'reconciled to') OR (contains(lower(note), 'claimed') AND contains(lower(note), 'missed')) OR contains(lower(note), 'pixel found') THEN 'multi-select pixel reconciliation'
  WHEN contains(lower(note), 'self-reported confidence') THEN 'low model confidence'
  WHEN regexp_matches(lower(note), 'does not match choice at|is not a number|is out of range|no mark_position|no answer text|mark position\\(s\\)') THEN 'model self-inconsistent (answer vs. mark position)'
  WHEN contains(lower(note), 'should be a 6-digit number') OR contains(lower(note), 'should be a date in mm/dd/yyyy format') THEN 'answer doesn''t match this field''s expected format (H1/H6)'
  WHEN contains(lower(note), 'model''s own account of the scan') AND NOT contains(note, ';') THEN 'model-reported scan-quality issue'
  ELSE 'flagged for review' END"""


@query("FN-20 FN-21 FN-22 FN-25 FN-26", f"""
WITH r AS (SELECT *, {NUMBER_SQL} AS qnum, coalesce(review_note, '') AS note FROM fx_responses)
SELECT folder_name, file_name, survey_question, qnum, {PAGE_SQL} AS page, {CATEGORY_SQL} AS category,
  CASE WHEN qnum IN ('H1','H2','H3','H4','H5','H6') THEN 0 WHEN regexp_full_match(qnum, '[0-9]+') THEN 1 ELSE 2 END AS tier,
  CASE WHEN qnum IN ('H1','H2','H3','H4','H5','H6') THEN CAST(substr(qnum, 2) AS INT) WHEN regexp_full_match(qnum, '[0-9]+') THEN CAST(qnum AS INT) ELSE 0 END AS place,
  qnum || '. ' || survey_question AS whole
FROM r""")
def fn_question_and_note(v):
    rows = v["fx_responses"].withColumn("qnum", fx.question_number(F.col("survey_question")))
    rank = fx.question_rank(F.col("qnum"))
    return rows.select(
        "folder_name", "file_name", "survey_question", "qnum",
        fx.question_page(F.col("qnum")).alias("page"),
        fx.review_category(F.col("review_note")).alias("category"),
        rank["tier"].alias("tier"), rank["n"].cast("int").alias("place"),
        fx.full_text(F.col("qnum"), F.col("survey_question")).alias("whole"),
    )


@query("FN-23", """
SELECT doc_id, lower(trim(regexp_replace(text, '[\\s\\x{00a0}\\x{0085}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}\\x0b\\x1c-\\x1f]+', ' ', 'g'))) AS norm
FROM documents""")
def fn_norm_text(v):
    return v["documents"].select("doc_id", fx.norm_text(F.col("text")).alias("norm"))


_TRANSCRIBED = """
    SELECT form_id, number, number || CASE WHEN multi_select = 'Y' THEN '. ' ELSE ') ' END || question_text || ' :' AS raw_text,
           CASE WHEN choices LIKE '%|%' THEN replace(choices, '|', ': |') ELSE choices || ': ' END AS raw_choices
    FROM fx_questions
"""


@query("FN-24", f"""
WITH t AS ({_TRANSCRIBED}), p AS (SELECT *, {_CHOICES_SQL.format(c='raw_choices')} AS parts FROM t)
SELECT form_id, number,
  trim(regexp_replace(trim(regexp_replace(trim(raw_text), '\\s*:\\s*$', '')), '^' || number || '\\s*[.)]?\\s*', '')) AS question_text,
  CASE WHEN len(parts) > 0 THEN array_to_string(list_filter(list_transform(parts, lambda x: trim(regexp_replace(x, '\\s*:\\s*$', ''))), lambda x: x <> ''), ' | ')
       ELSE trim(regexp_replace(trim(raw_choices), '\\s*:\\s*$', '')) END AS choices
FROM p""")
def fn_clean_transcribed(v):
    v["fx_questions"].createOrReplaceTempView("fx_questions")
    cleaned = fx.clean_transcribed(F.col("number"), F.col("raw_text"), F.col("raw_choices"))
    return v.spark.sql(_TRANSCRIBED).select(
        "form_id", "number", cleaned["question_text"].alias("question_text"), cleaned["choices"].alias("choices")
    )


@query("FN-27 FN-28", f"""
SELECT form_id, number,
  CASE WHEN len({_CHOICES_SQL.format(c='choices')}) = 0 THEN 'open-text' WHEN contains(lower(question_text), 'mark all') THEN 'multi-select' ELSE 'single-choice' END AS answer_type,
  CASE WHEN multi_select = 'Y' THEN 'Multiple Choice (pick several)' WHEN ocr_check = 'Token' THEN 'Written Answer - Short Code or Number'
       WHEN ocr_check = 'freeform' THEN 'Written Answer - Longer Text' WHEN NOT (contains(choices, '|') OR contains(choices, ' / ')) THEN 'Written Answer - Not Checked by Cloud Vision'
       ELSE 'Single Choice (pick one)' END AS question_type
FROM fx_questions""")
def fn_question_types(v):
    return v["fx_questions"].select(
        "form_id", "number",
        fx.answer_type(F.col("question_text"), F.col("choices")).alias("answer_type"),
        fx.question_type(fx.is_yes(F.col("multi_select")), F.lower("ocr_check"), F.col("choices")).alias("question_type"),
    )


_ANSWERS = """
    SELECT event_id, CASE event_id % 7 WHEN 0 THEN CAST(event_id AS STRING) WHEN 1 THEN substr('00' || CAST(event_id % 97 AS STRING), -6)
             WHEN 2 THEN CAST(event_id % 13 AS STRING) || '/' || CAST(event_id % 28 + 10 AS STRING) || '/2025' WHEN 3 THEN '11/0' || CAST(event_id % 9 + 1 AS STRING) || '/202' || CAST(event_id % 10 AS STRING)
             WHEN 4 THEN CAST(event_id % 50 AS STRING) || '.5' WHEN 5 THEN ' ' ELSE 'n/a' END AS answer,
           CASE event_id % 5 WHEN 0 THEN 'digits' WHEN 1 THEN 'Integer' WHEN 2 THEN 'decimal' WHEN 3 THEN 'date' ELSE NULL END AS fmt,
           CAST(event_id % 3 + 4 AS INT) AS digits, CAST(event_id % 30 AS DOUBLE) AS low, CAST(40 + event_id % 900 AS DOUBLE) AS high
    FROM events
"""


@query("FN-29", f"""
WITH a AS ({_ANSWERS}), b AS (SELECT *, trim(answer) AS t, lower(coalesce(fmt, '')) AS k,
  CASE WHEN regexp_full_match(trim(answer), '\\d\\d/\\d\\d/\\d\\d\\d\\d') THEN TRY_CAST(substr(trim(answer), 7, 4) || '-' || substr(trim(answer), 1, 2) || '-' || substr(trim(answer), 4, 2) AS DATE) END AS d FROM a)
SELECT event_id, answer, reason IS NULL AS ok, reason FROM (
  SELECT *, CASE WHEN t = '' OR k = '' THEN NULL
    WHEN k = 'digits' AND NOT (regexp_full_match(t, '[0-9]+') AND len(t) = digits) THEN 'should be a ' || CAST(digits AS VARCHAR) || '-digit number'
    WHEN k = 'integer' AND NOT regexp_full_match(t, '[+-]?[0-9]+') THEN 'should be a whole number'
    WHEN k = 'decimal' AND NOT regexp_full_match(t, '[+-]?([0-9]+(\\.[0-9]*)?|\\.[0-9]+)') THEN 'should be a number'
    WHEN k = 'date' AND d IS NULL THEN 'should be a date in MM/DD/YYYY format'
    WHEN k = 'date' AND year(d) <> 2025 THEN 'year should be 2025'
    WHEN k <> 'date' AND TRY_CAST(t AS DOUBLE) < low THEN 'is below the minimum'
    WHEN k <> 'date' AND TRY_CAST(t AS DOUBLE) > high THEN 'is above the maximum' END AS reason FROM b)""")
def fn_format_check(v):
    v["events"].createOrReplaceTempView("events")
    checked = fx.format_ok(F.col("answer"), F.col("fmt"), F.col("digits"), F.lit(None).cast("string"),
                           F.lit(2025), F.col("low"), F.col("high"))
    return v.spark.sql(_ANSWERS).select(
        "event_id", "answer", checked["ok"].alias("ok"), checked["reason"].alias("reason")
    )


@query("FN-30", """
SELECT conv_id, turn, coalesce(regexp_matches(error, '429|RESOURCE_EXHAUSTED|403|PERMISSION_DENIED'), FALSE) AS retryable FROM fx_call_log""")
def fn_retryable_errors(v):
    return v["fx_call_log"].select("conv_id", "turn", fx.is_retryable(F.col("error")).alias("retryable"))
