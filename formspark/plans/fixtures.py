"""Domain-shaped views over the driver tables, in SQL both engines accept.

The views give the whole tables a new shape: none of them drops rows to stay
small. Modulo conditions only plant defects (a missing unit, a moved file).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from formspark.sources.writers import stored

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# Embeddings, one row per position.
VEC_DUCKDB = """
SELECT vec_id, i - 1 AS pos, CAST(embedding[i] AS DOUBLE) AS val
FROM (SELECT vec_id, embedding, unnest(range(1, 65)) AS i FROM embeddings)
"""

# Form set-up parameters and the value each supplier's form gives it.
_SETUP = {
    "FORM_SETUP_STATUS": "CASE s_suppkey % 5 WHEN 0 THEN 'DRAFT' WHEN 1 THEN 'approved' ELSE ' APPROVED ' END",
    "FORM_NAME": "s_name",
    "PAGES_PER_SURVEY": "CASE WHEN s_suppkey % 7 = 0 THEN '0' ELSE CAST(s_nationkey % 4 + 1 AS STRING) END",
    "FORM_DETECTION_MODE": "CASE s_suppkey % 3 WHEN 0 THEN 'Hybrid' WHEN 1 THEN 'model_only' "
                           "ELSE CASE WHEN s_acctbal < 0 THEN 'auto' ELSE '' END END",
    "FORM_INK_THRESHOLD": "'18' || CAST(s_nationkey % 10 AS STRING) || '.0'",
    "GRID_COLUMN_CENTERS_JSON": "'[100.5, 200, ' || CAST(300 + s_nationkey AS STRING) || ']'",
    "BASELINE_MARKS_JSON": "'{\"0\": [[180, 220], [2380, 220], [180, 3110], [2380, 3110]]}'",
}
# Every unit of a source, whatever its number of pages.
UNITS_DUCKDB = """
SELECT source_gcs_uri, doc_id, unnest(range(1, (page_count + 1) // 2 + 1)) AS i FROM fx_source
"""
# Views with a form per engine.
DUCKDB_FORM = {"fx_vec": VEC_DUCKDB, "fx_unit": UNITS_DUCKDB}

VIEWS: dict[str, str] = {
    "fx_vec": """
SELECT vec_id, pos, CAST(col AS DOUBLE) AS val FROM (SELECT vec_id, posexplode(embedding) FROM embeddings)
""",
    "fx_responses": """
SELECT CASE WHEN g.l_orderkey % 50 = 0 THEN NULL
            ELSE substr('JanFebMarAprMayJunJulAugSepOctNovDec', (month(o.o_orderdate) - 1) * 3 + 1, 3)
                 || ' ' || CAST(day(o.o_orderdate) % 3 + 1 AS STRING) || ' ' || CAST(year(o.o_orderdate) AS STRING) END AS folder_name,
       'scan' || CAST(g.l_orderkey % 40 AS STRING) || '_p' || CAST(g.l_orderkey AS STRING) || '.pdf' AS file_name,
       CASE WHEN g.l_orderkey % 7 = 0 THEN NULL ELSE CAST(o.o_orderdate AS DATE) END AS report_date,
       q.question_number,
       CASE WHEN g.l_linenumber = 7 THEN 'Unnumbered remark'
            ELSE q.question_number || q.sep || 'item text' END AS survey_question,
       CASE WHEN g.pk % 11 = 0 THEN NULL WHEN g.pk % 2 = 0 THEN 'Yes' ELSE 'No' END AS survey_answer,
       CASE WHEN g.pk % 13 = 0 THEN NULL ELSE g.rf = 'R' END AS needs_review,
       CASE g.pk % 10 WHEN 0 THEN NULL
            WHEN 1 THEN 'Cloud Vision could not confirm; possible hallucination'
            WHEN 2 THEN 'no box confidently marked'
            WHEN 3 THEN 'auto-corrected to the pixel reading'
            WHEN 4 THEN 'model claimed A; detector missed A'
            WHEN 5 THEN 'self-reported confidence 0.5 below 0.7'
            WHEN 6 THEN 'answer does not match choice at 2'
            WHEN 7 THEN 'value should be a 6-digit number'
            WHEN 8 THEN 'model''s own account of the scan: smudge'
            ELSE 'other' END AS review_note,
       g.disc * 10 AS model_confidence
FROM (SELECT l_orderkey, l_linenumber, min(l_partkey) AS pk, min(l_discount) AS disc, max(l_returnflag) AS rf
      FROM lineitem GROUP BY l_orderkey, l_linenumber) g
JOIN orders o ON o.o_orderkey = g.l_orderkey
JOIN (VALUES (1,'H1','. '),(2,'1',') '),(3,'2','.'),(4,'19','. '),(5,'24',') '),(6,'H6','. '),(7,'?','')) AS q(ln, question_number, sep)
  ON q.ln = g.l_linenumber
""",
    "fx_feedback": """
SELECT folder_name, file_name, question_number,
       CASE WHEN review_note IS NULL THEN NULL WHEN review_note = 'other' THEN ''
            WHEN survey_answer = 'Yes' THEN 'No' ELSE 'N/A' END AS correct_answer
FROM fx_responses WHERE needs_review AND folder_name IS NOT NULL
""",
    "fx_source": """
SELECT 'gs://bucket/raw/' || CASE WHEN doc_id % 9 = 0 THEN '' ELSE 'Nov ' || CAST(doc_id % 28 + 1 AS STRING) || ' 2025/' END
         || 'Batch ' || CAST(doc_id AS STRING) || CASE WHEN doc_id % 5 = 0 THEN '.PDF' ELSE '.pdf' END AS source_gcs_uri,
       doc_id,
       CAST(2 * (1 + floor(n_chars / 1000)) + CASE WHEN doc_id % 17 = 0 THEN 1 ELSE 0 END AS INT) AS page_count,
       lang
FROM documents
""",
    "fx_unit": """
SELECT source_gcs_uri, doc_id, explode(sequence(1, CAST(floor((page_count + 1) / 2) AS INT))) AS i FROM fx_source
""",
    "fx_verdict": """
SELECT d.doc_id,
       CASE WHEN d.lang = 'en' THEN 'ENGLISH' WHEN d.doc_id % 10 = 0 THEN 'maybe?' ELSE 'NON_ENGLISH' END AS language_verdict,
       CASE WHEN l.doc_id IS NULL THEN NULL
            ELSE CASE WHEN l.quality = 1 THEN 'OK' WHEN d.doc_id % 2 = 0 THEN 'BLANK' ELSE 'UNREADABLE' END || ' '
                 || CASE WHEN l.toxic = 0 THEN 'NOT_DECLINED' WHEN d.doc_id % 2 = 0 THEN 'DECLINED_WORD' ELSE 'DECLINED_SCRIBBLE' END
       END AS content_verdict
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
""",
    "fx_manifest": """
SELECT s.source_gcs_uri, s.doc_id, k.i AS unit_index,
       CAST(2 * k.i - 1 AS STRING) || '-' || CAST(2 * k.i AS STRING) AS source_page_range,
       'Batch ' || CAST(s.doc_id AS STRING) AS destination_folder,
       CASE WHEN s.doc_id % 23 = 0 THEN NULL
            ELSE 'gs://bucket/split/' || CASE WHEN s.doc_id % 8 = 0 THEN 'Declined/' WHEN s.doc_id % 12 = 1 THEN 'Rejected/' ELSE '' END
                 || CASE WHEN s.doc_id % 31 = 0 THEN 'Other' ELSE 'Batch ' || CAST(s.doc_id AS STRING) END
                 || '/Batch ' || CAST(s.doc_id AS STRING) || '_p' || CAST(k.i AS STRING) || '.pdf' END AS destination_gcs_uri,
       CASE WHEN s.doc_id % 8 = 0 THEN 'declined' WHEN s.doc_id % 12 = 5 THEN 'rejected' ELSE 'normal' END AS output_category
FROM fx_source s
JOIN fx_unit k ON k.doc_id = s.doc_id AND k.source_gcs_uri = s.source_gcs_uri AND k.i <= floor(s.page_count / 2)
WHERE s.page_count % 2 = 0 AND NOT (s.doc_id % 11 = 0 AND k.i = 2)
""",
    "fx_listing": """
SELECT destination_gcs_uri AS uri FROM fx_manifest WHERE destination_gcs_uri IS NOT NULL AND doc_id % 19 <> 0
UNION ALL
SELECT source_gcs_uri AS uri FROM fx_source WHERE doc_id % 29 <> 0
""",
    "fx_box_ink": """
SELECT 'scan' || CAST(vec_id AS STRING) || '_p1.pdf' AS file_name, pos AS box,
       CAST(floor(pos / 4) AS INT) AS question, pos % 4 AS choice, abs(val) AS ratio, abs(val) > 0.004 AS confirmed
FROM fx_vec
""",
    "fx_marks": """
SELECT v.vec_id AS page_id, m.corner, CAST(m.ax AS DOUBLE) AS ax, CAST(m.ay AS DOUBLE) AS ay,
       m.ax * (1 + p.e0 / 100) - m.ay * p.e1 / 100 + 40 * p.e2 + 12 * v.val AS bx,
       m.ay * (1 + p.e0 / 100) + m.ax * p.e1 / 100 + 40 * p.e3 - 12 * v.val AS b_y
FROM fx_vec v
JOIN (VALUES (10,'TL',180.0,220.0),(11,'TR',2380.0,220.0),(12,'BL',180.0,3110.0),(13,'BR',2380.0,3110.0)) AS m(pos, corner, ax, ay) ON m.pos = v.pos
JOIN (SELECT vec_id, max(CASE WHEN pos = 0 THEN val END) AS e0, max(CASE WHEN pos = 1 THEN val END) AS e1,
             max(CASE WHEN pos = 2 THEN val END) AS e2, max(CASE WHEN pos = 3 THEN val END) AS e3
      FROM fx_vec GROUP BY vec_id) p ON p.vec_id = v.vec_id
WHERE NOT (v.vec_id % 20 = 0 AND m.corner = 'BR')
""",
    "fx_profile_log": """
SELECT 'scan' || CAST(user_id AS STRING) || '_p1.pdf' AS file_name, ts AS profiled_at, event_id,
       CASE event_type WHEN 'error' THEN NULL WHEN 'click' THEN 'tight' ELSE 'clear' END AS ink_quality,
       value / 1000 AS ink_mark_lo, (value - 100) / 600 AS rotation_deg_p1, value / 40 AS fit_residual_p1,
       event_type <> 'signup' AS marks_found_p1
FROM events
""",
    "fx_call_log": """
SELECT conv_id, turn, role AS model,
       CASE WHEN turn % 5 = 4 THEN NULL ELSE length(text) END AS prompt_tokens,
       CASE WHEN turn % 7 = 6 THEN NULL ELSE length(text) % 97 END AS output_tokens,
       CASE conv_id % 4 WHEN 0 THEN '429 RESOURCE_EXHAUSTED' WHEN 1 THEN '403 PERMISSION_DENIED' WHEN 2 THEN 'deadline' ELSE NULL END AS error
FROM conversations
""",
    "fx_unit_verdict": """
SELECT s.source_gcs_uri, s.doc_id, k.i AS unit_index, v.language_verdict,
       CASE WHEN k.i > 1 AND (s.doc_id + k.i) % 6 = 0 THEN 'ok declined_word'
            WHEN k.i > 1 AND (s.doc_id + k.i) % 7 = 0 THEN ' BLANK  NOT_DECLINED' ELSE v.content_verdict END AS content_verdict
FROM fx_source s JOIN fx_verdict v ON v.doc_id = s.doc_id
JOIN fx_unit k ON k.doc_id = s.doc_id AND k.source_gcs_uri = s.source_gcs_uri
WHERE NOT (s.doc_id % 13 = 0 AND k.i = 2)
""",
    "fx_audited": """
SELECT substr(source_gcs_uri, 6) AS source_file, source_gcs_uri, destination_folder, destination_gcs_uri,
       CASE WHEN doc_id % 37 = 3 THEN 'page ' || source_page_range WHEN doc_id % 41 = 5 THEN '0-2' ELSE source_page_range END AS source_page_range,
       output_category, output_category = 'rejected' AS rejected,
       CASE WHEN output_category = 'rejected' THEN 'blank page' END AS rejected_reason,
       CASE WHEN doc_id % 10 = 7 THEN NULL ELSE output_category = 'declined' AND doc_id % 3 <> 0 END AS needs_review,
       CASE WHEN output_category = 'declined' THEN 'declined marking' END AS needs_review_reason,
       CAST('2025-11-30 08:00:00' AS TIMESTAMP) AS moved_at
FROM fx_manifest
UNION ALL
SELECT substr(source_gcs_uri, 6), CASE WHEN doc_id % 34 = 17 THEN source_gcs_uri ELSE 'file:' || source_gcs_uri END, 'Batch ' || CAST(doc_id AS STRING), NULL,
       '1-' || CAST(page_count AS STRING), 'rejected', doc_id % 51 <> 17,
       'scan has ' || CAST(page_count AS STRING) || ' page(s), which is not a multiple of 2 pages per survey',
       FALSE, NULL, CAST('2025-11-30 08:00:00' AS TIMESTAMP)
FROM fx_source WHERE page_count % 2 = 1
""",
    "fx_open_errors": """
SELECT source_gcs_uri, 'damaged trailer in ' || lang AS error FROM fx_source WHERE lang = 'es' AND page_count > 8
""",
    "fx_split_listing": """
SELECT 'gs://bucket/split/' || CASE WHEN (s.doc_id + k.i) % 8 = 0 THEN 'Declined/' WHEN (s.doc_id + k.i) % 12 = 1 THEN 'Rejected/' ELSE '' END
         || 'Batch ' || CAST(s.doc_id AS STRING) || '/Batch ' || CAST(s.doc_id AS STRING) || '_p' || CAST(k.i AS STRING) || '.pdf' AS uri
FROM fx_source s
JOIN fx_unit k ON k.doc_id = s.doc_id AND k.source_gcs_uri = s.source_gcs_uri AND k.i <= floor(s.page_count / 2)
WHERE NOT (s.lang = 'fr' AND k.i = 1)
UNION ALL
SELECT 'gs://bucket/split/Rejected/Batch ' || CAST(doc_id AS STRING) || '/Batch ' || CAST(doc_id AS STRING) || '_p1.pdf' AS uri
FROM fx_source WHERE lang = 'de'
""",
    "fx_new_rows": """
SELECT source_gcs_uri, source_page_range, destination_folder, 'normal' AS output_category,
       CASE WHEN unit_index > 4 THEN destination_gcs_uri
            ELSE replace(destination_gcs_uri, 'split/Declined/', 'split/') END AS destination_gcs_uri
FROM fx_manifest WHERE output_category <> 'rejected'
""",
    "fx_exports": """
SELECT 'feedback/' || o_orderpriority || '/review_' || replace(substr(CAST(o_orderdate AS STRING), 1, 10), '-', '')
         || '_' || substr('00000' || CAST(o_custkey AS STRING), -6) || CASE WHEN o_orderstatus = 'O' THEN '.csv.tmp' ELSE '.csv' END AS object_name
FROM orders
""",
    "fx_questions": """
SELECT 'form' || CAST(CAST(floor(p_partkey / 40) AS BIGINT) AS STRING) AS form_id,
       CASE WHEN p_partkey % 40 < 6 THEN 'H' || CAST(p_partkey % 40 + 1 AS STRING) ELSE CAST(p_partkey % 40 - 5 AS STRING) END AS number,
       p_brand AS group_key,
       p_name || CASE WHEN p_size % 5 = 0 THEN ' (mark ALL that apply)' ELSE '' END AS question_text,
       CASE p_size % 4 WHEN 0 THEN 'Yes | No' WHEN 1 THEN 'OP/IOP / Detox/WM / Other' WHEN 2 THEN 'A|B | |C' ELSE 'written ' || p_name END AS choices,
       CASE p_size % 7 WHEN 0 THEN 'single choice (pick one)' WHEN 1 THEN 'Multiple Choice (pick several)'
            WHEN 2 THEN ' Written Answer - Short Code or Number ' WHEN 3 THEN 'Written Answer - Longer Text'
            WHEN 4 THEN 'Written Answer - Not Checked by Cloud Vision' ELSE '' END AS question_type,
       CASE WHEN p_size % 2 = 0 THEN 'Y' ELSE 'no' END AS multi_select,
       CASE p_size % 3 WHEN 0 THEN 'Token' WHEN 1 THEN 'freeform' ELSE '' END AS ocr_check,
       CASE WHEN p_size % 3 = 0 THEN ' YES ' ELSE '' END AS model_overrules,
       CASE WHEN p_size % 11 = 0 THEN '1' ELSE 'N' END AS blank_exempt,
       CASE WHEN p_size % 13 = 0 THEN 'true' ELSE NULL END AS ocr_authoritative,
       CASE WHEN p_size = 50 THEN '3' WHEN p_size % 9 = 0 THEN '' ELSE CAST(p_size % 2 + 1 AS STRING) || '.0' END AS page_1based,
       CASE WHEN p_partkey % 80 < 40 THEN CAST(p_size % 2 + 1 AS STRING) WHEN p_size % 27 = 0 THEN '' ELSE CAST(p_size % 2 AS STRING) END AS legacy_page,
       CASE p_size % 6 WHEN 0 THEN 'digits' WHEN 1 THEN 'Integer' WHEN 2 THEN 'decimal' WHEN 3 THEN 'date' WHEN 4 THEN CASE WHEN p_size % 10 = 4 THEN 'roman' ELSE '' END ELSE '' END AS expected_format,
       CASE WHEN p_size % 5 = 0 THEN CAST(p_size % 7 AS STRING) ELSE '' END AS expected_digits,
       CASE WHEN p_size % 4 = 0 THEN CAST(p_size AS STRING) ELSE '' END AS minimum,
       CASE WHEN p_size % 8 = 0 THEN CAST(60 - p_size AS STRING) || '.5' ELSE '' END AS maximum,
       CASE WHEN p_size % 4 = 3 THEN 'Name:' ELSE '' END AS anchor,
       CASE p_size % 3 WHEN 0 THEN 'Right' WHEN 1 THEN 'below' ELSE 'up' END AS direction
FROM part
""",
    "fx_overrides": """
SELECT 'form' || CAST(CAST(floor(p_partkey / 40) AS BIGINT) AS STRING) AS form_id,
       CASE WHEN p_type = 'ECONOMY' THEN 'X' ELSE '' END || CASE WHEN p_partkey % 40 < 6 THEN 'H' || CAST(p_partkey % 40 + 1 AS STRING) ELSE CAST(p_partkey % 40 - 5 AS STRING) END AS number,
       CASE WHEN p_size % 3 = 0 THEN NULL ELSE 'new ' || p_name END AS question_text,
       CASE WHEN p_size % 4 = 0 THEN NULL ELSE 'Yes | No | N/A' END AS choices
FROM part WHERE p_brand < 'Brand#3'
""",
    "fx_form_setup": "UNION ALL".join(f"""
SELECT 'form' || CAST(s_suppkey AS STRING) AS form_id, ' {parameter} ' AS parameter, {value} AS value FROM supplier
""" for parameter, value in _SETUP.items()),
    "fx_controls": """
SELECT 'form' || CAST(CAST(floor(p.p_partkey / 40) AS BIGINT) AS STRING) AS form_id,
       CASE WHEN p.p_partkey % 40 < 6 THEN 'H' || CAST(p.p_partkey % 40 + 1 AS STRING) ELSE CAST(p.p_partkey % 40 - 5 AS STRING) END AS question,
       CASE WHEN p.p_size = 49 THEN CAST(l.k % 2 + 1 AS STRING) WHEN p.p_size = 48 THEN '5' ELSE CAST(p.p_size % 2 + 1 AS STRING) END AS page,
       CASE WHEN p.p_size % 10 = 8 THEN 'circle' WHEN p.p_size = 30 THEN 'slider' ELSE 'Checkbox' END AS control_type,
       CASE WHEN p.p_size = 20 THEN l.label || '!' ELSE l.label END AS label,
       CAST(100 * l.k AS DOUBLE) AS x0, CAST(100 * l.k + CASE WHEN p.p_size = 40 THEN 0 ELSE 30 END AS DOUBLE) AS x1,
       CAST(p.p_partkey % 40 * 50 AS DOUBLE) AS y0, CAST(p.p_partkey % 40 * 50 + 28 AS DOUBLE) AS y1,
       CASE WHEN p.p_size % 16 = 0 THEN CAST(l.k % 2 + 1 AS STRING) ELSE '' END AS layout,
       CASE WHEN p.p_retailprice > 1700 THEN 'PENDING' WHEN p.p_retailprice > 1300 THEN ' approved' ELSE 'APPROVED' END AS approval
FROM part p
JOIN (VALUES (0,1,'Yes'),(0,2,'No'),(1,1,'OP/IOP'),(1,2,'Detox/WM'),(1,3,'Other'),(2,1,'A'),(2,2,'B'),(2,3,'C')) AS l(kind, k, label)
  ON l.kind = p.p_size % 4
""",
    "fx_review": """
SELECT 'form' || CAST(CAST(floor(p_partkey / 8) AS BIGINT) AS STRING) AS form_id, p_name AS item,
       CASE WHEN p_size % 6 = 0 THEN ' reference' WHEN p_size = 50 THEN 'PENDING' ELSE 'Approved ' END AS status
FROM part
""",
    "fx_components": """
SELECT page_id, CAST(floor(bx) - 36 AS DOUBLE) AS x, CAST(floor(b_y) - 37 AS DOUBLE) AS y, CAST(72 AS DOUBLE) AS w, CAST(74 AS DOUBLE) AS h,
       CAST(5000 AS DOUBLE) AS area, CAST(2560 AS DOUBLE) AS page_w, CAST(3330 AS DOUBLE) AS page_h
FROM fx_marks
UNION ALL
SELECT vec_id, CAST(pos * 35 AS DOUBLE), CAST(pos * 45 AS DOUBLE), CAST(floor(abs(val) * 180) AS DOUBLE), CAST(floor(abs(val) * 170) AS DOUBLE),
       CAST(floor(abs(val) * 180) AS DOUBLE) * CAST(floor(abs(val) * 170) AS DOUBLE) * CAST(0.6 + (pos % 4) * 0.1 AS DOUBLE), CAST(2560 AS DOUBLE), CAST(3330 AS DOUBLE)
FROM fx_vec
""",
    "fx_expected_box": """
SELECT DISTINCT l_orderkey AS page_id, l_linenumber AS box, CAST(300 + 200 * l_linenumber AS DOUBLE) AS x0, CAST(330 + 200 * l_linenumber AS DOUBLE) AS x1,
       CAST(500 AS DOUBLE) AS y0, CAST(530 AS DOUBLE) AS y1
FROM lineitem
""",
    "fx_candidates": """
SELECT l_orderkey AS page_id, CAST(300 + 200 * l_linenumber + l_partkey % 25 - 12 AS DOUBLE) AS x0,
       CAST(300 + 200 * l_linenumber + l_partkey % 25 - 12 + 14 + l_suppkey % 36 AS DOUBLE) AS x1,
       CAST(500 + l_partkey % 17 - 8 AS DOUBLE) AS y0, CAST(500 + l_partkey % 17 + 10 + CAST(l_quantity AS INT) % 30 AS DOUBLE) AS y1,
       0.5 + l_discount * 5 AS ink_top, CAST(0.9 AS DOUBLE) AS ink_bottom, 0.55 + l_tax * 5 AS ink_left, CAST(0.8 AS DOUBLE) AS ink_right
FROM lineitem
""",
    "fx_rects": """
SELECT l_suppkey AS page_id, CAST(l_orderkey % 2400 AS DOUBLE) AS x0, CAST(l_orderkey % 2400 + 24 + CAST(l_quantity AS INT) % 30 AS DOUBLE) AS x1,
       CAST(l_linenumber * 300 + l_partkey % 37 AS DOUBLE) AS y0, CAST(l_linenumber * 300 + l_partkey % 37 + 24 + CAST(l_quantity AS INT) % 28 AS DOUBLE) AS y1,
       CAST(500 + CAST(l_quantity AS INT) * 20 AS DOUBLE) AS area
FROM lineitem
""",
    "fx_page_controls": """
SELECT l_orderkey AS page_id, CAST(floor((l_linenumber + 6) / 7) AS INT) AS page, CASE WHEN l_returnflag = 'N' AND l_linenumber > 4 THEN 'circle' ELSE 'checkbox' END AS control_type,
       CAST(300 * l_linenumber + l_partkey % 61 - 30 AS DOUBLE) AS x0, CAST(300 * l_linenumber + l_partkey % 61 + CAST(l_quantity AS INT) % 20 AS DOUBLE) AS x1,
       CAST(400 * (1 + l_linenumber % 2) + l_suppkey % 41 - 20 AS DOUBLE) AS y0, CAST(400 * (1 + l_linenumber % 2) + l_suppkey % 41 + 10 AS DOUBLE) AS y1
FROM lineitem
""",
    "fx_sides": """
SELECT vec_id AS page_id, CAST(floor(pos / 4) AS INT) AS box, pos % 4 AS side, least(abs(val) * 8, 1.0) AS coverage, val < 0.2 AS inside FROM fx_vec
""",
    "fx_strips": """
SELECT vec_id AS page_id, CASE WHEN pos < 32 THEN 'left' ELSE 'right' END AS side, pos % 32 AS y, CASE WHEN abs(val) < 0.15 THEN 0.0 ELSE abs(val) / 4 END AS ink FROM fx_vec
""",
    "fx_line_sums": """
SELECT vec_id AS page_id, CAST(100 + pos * 70 + floor(abs(val) * 150) AS INT) AS y, CAST(CASE WHEN val > -0.2 THEN 2000 ELSE 900 END AS DOUBLE) AS line_sum, CAST(2560 AS DOUBLE) AS page_w FROM fx_vec
UNION ALL
SELECT vec_id, CAST(101 + pos * 70 + floor(abs(val) * 150) AS INT), CAST(1900 AS DOUBLE), CAST(2560 AS DOUBLE) FROM fx_vec WHERE val > 0
""",
    "fx_cells": """
SELECT vec_id AS page_id, CAST(floor(pos / 11) + 1 AS INT) AS grid_row, CASE WHEN pos % 11 < 6 THEN 'box' ELSE 'gap' END AS kind, pos % 11 AS idx, abs(val) AS density FROM fx_vec
""",
    "fx_questions_seen": """
SELECT file_name, CAST(question AS STRING) AS question, CAST(question AS STRING) || '#' || CAST(question % 2 AS STRING) AS question_key, question % 2 AS candidate,
       question % 3 AS page_idx, 'yesno_box' AS kind, CAST(sum(CASE WHEN confirmed THEN 1 ELSE 0 END) AS BIGINT) AS boxes_confirmed, count(*) AS boxes_total
FROM fx_box_ink GROUP BY file_name, question
UNION ALL
SELECT file_name, CAST(question AS STRING), CAST(question AS STRING) || '#' || CAST(1 - question % 2 AS STRING), 1 - question % 2,
       question % 3, 'yesno_box', CAST(sum(CASE WHEN ratio > 0.05 THEN 1 ELSE 0 END) AS BIGINT), count(*)
FROM fx_box_ink GROUP BY file_name, question
""",
    "fx_quality_in": """
SELECT file_name, event_id, profiled_at, ink_quality, ink_mark_lo, rotation_deg_p1, fit_residual_p1, marks_found_p1,
       CAST(event_id % 100 AS DOUBLE) / 99 AS border_rate, CAST(event_id % 31 AS DOUBLE) / 30 AS border_cov_min, CAST(event_id % 17 AS DOUBLE) / 400 AS shadow_coverage,
       event_id % 13 AS shadow_bands, event_id % 4 AS overflow_kind
FROM fx_profile_log
""",
    "fx_readings": """
SELECT g.l_orderkey AS doc, 'scan' || CAST(g.l_orderkey AS STRING) || '_p1.pdf' AS file_name, CAST(g.l_linenumber AS STRING) AS question_number,
       CASE g.pk % 6 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'Agree' WHEN 3 THEN 'Neutral' WHEN 4 THEN 'Disagree' ELSE 'Maybe' END AS model_answer,
       CASE g.sk % 5 WHEN 0 THEN '1' WHEN 1 THEN '2' WHEN 2 THEN '3' WHEN 3 THEN 'x' ELSE NULL END AS mark_position,
       'Agree | Neutral | Disagree' AS choices,
       CASE g.ok % 5 WHEN 0 THEN NULL WHEN 1 THEN 'Agree' WHEN 2 THEN 'Neutral' WHEN 3 THEN 'Disagree' ELSE '' END AS pixel_answer,
       g.ok % 5 <> 0 AS pixel_ran, g.disc * 4 AS pixel_margin, g.tax > 0.06 AS second_mark, g.qty / 50 AS model_confidence,
       g.qty > 25 AS model_overrules, g.qty > 45 AS blank_exempt,
       CASE g.pk % 4 WHEN 0 THEN NULL WHEN 1 THEN 'agree' WHEN 2 THEN 'A gree' ELSE 'neutral disagree' END AS ocr_text,
       g.pk % 3 <> 0 AS ocr_ran, g.sk % 3 = 0 AS ocr_authoritative, g.sk % 2 = 0 AS grid_question, g.disc > 0.03 AS grid_row_found,
       CASE WHEN g.sk % 2 = 0 THEN 'grid' WHEN g.pk % 7 = 0 THEN 'circle' ELSE 'box' END AS control, g.pk % 9 <> 0 AS calibration_validated, g.ok % 17 = 3 AS cross_out,
       CASE WHEN g.pk % 5 = 0 THEN 'digits' END AS answer_format, 6 AS format_digits, g.sk % 4 = 1 AS comment_question,
       CASE WHEN g.ok % 11 = 0 THEN CASE g.pk % 3 WHEN 0 THEN 'A,B' WHEN 1 THEN 'A' ELSE '' END END AS model_choices,
       CASE g.sk % 3 WHEN 0 THEN 'A,B' WHEN 1 THEN 'A,C' ELSE NULL END AS pixel_choices
FROM (SELECT l_orderkey, l_linenumber, min(l_partkey) AS pk, min(l_suppkey) AS sk, min(l_orderkey) AS ok, min(l_discount) AS disc, max(l_tax) AS tax, max(l_quantity) AS qty
      FROM lineitem GROUP BY l_orderkey, l_linenumber) g
""",
    "fx_ocr": """
SELECT conv_id, turn, text AS model_text, CASE turn % 3 WHEN 0 THEN text WHEN 1 THEN lower(replace(text, 'e', 'c')) ELSE NULL END AS ocr_text FROM conversations
""",
    "fx_corrections": """
SELECT event_id AS correction_id, ts AS logged_at, 'scan' || CAST(user_id AS STRING) || '_p1.pdf' AS file_name,
       CAST(event_id % 35 + 1 AS STRING) AS question, event_type AS root_cause FROM events
""",
    "fx_pages": """
SELECT 'scan' || CAST(vec_id AS STRING) || '_p1.pdf' AS file_name, vec_id AS page_id, CAST(pos + 1 AS INT) AS page, CASE WHEN val > 0.1 THEN 'A4' ELSE 'Letter' END AS paper,
       val > -0.15 AS marks_found, CASE WHEN val > -0.15 THEN floor(abs(val) * 6000) / 100 END AS fit_residual, 1 + floor(val * 1000) / 100000 AS scale,
       CASE WHEN val > -0.15 THEN floor(val * 4000) / 1000 END AS rotation_deg, floor(val * 400) / 10 AS offset_dx, floor(val * 300) / 10 AS offset_dy, floor(230 + val * 50) AS paper_level
FROM fx_vec
""",
    "fx_measured": """
SELECT event_id, file_name, CASE WHEN marks_found_p1 THEN floor(abs(rotation_deg_p1) * 1000) / 1000 END AS tilt_deg, floor(fit_residual_p1 * 100) / 100 AS fit_residual_max,
       marks_found_p1 AS marks_found_all_pages, ink_quality, floor(ink_mark_lo * 40000) / 10000 AS ink_mark_lo, floor(ink_mark_lo * 4000) / 10000 AS ink_gap, floor(ink_mark_lo * 20000) / 10000 AS ink_threshold,
       CASE WHEN event_id % 50 > 40 THEN NULL WHEN event_id % 4 > 0 THEN CAST(1 AS DOUBLE) ELSE floor(border_rate * 10000) / 10000 END AS border_rate,
       CASE WHEN event_id % 3 = 0 THEN NULL WHEN event_id % 5 > 0 THEN 0.9 + border_cov_min / 20 ELSE border_cov_min END AS border_cov_min,
       floor(shadow_coverage * 10000) / 10000 AS shadow_coverage, shadow_bands, CASE WHEN event_id % 7 < 5 THEN '' WHEN overflow_kind = 0 THEN NULL WHEN overflow_kind = 1 THEN '3' ELSE '3,17' END AS overflow_text,
       CASE WHEN event_id % 6 = 5 THEN 'self-measured' ELSE 'pdf_calibration_profile' END AS calibration_source
FROM fx_quality_in
""",
    "fx_judgements": """
SELECT event_id, CASE event_id % 8 WHEN 0 THEN 'clear' WHEN 1 THEN 'questionable' WHEN 2 THEN 'unreadable' WHEN 3 THEN '' ELSE 'clear' END AS handwriting_readable,
       CASE WHEN event_id % 3 = 0 THEN 'row ' || CAST(user_id AS STRING) ELSE '' END AS handwriting_notes, CASE WHEN event_id % 11 = 0 THEN 'yes' ELSE 'no' END AS tears_or_damage,
       CASE WHEN event_id % 2 = 0 THEN NULL ELSE 'corner' END AS damage_notes, CASE WHEN event_id % 13 = 5 THEN 'Timeout: 30s' ELSE NULL END AS vision_error
FROM events WHERE event_type <> 'purchase'
""",
}

_loaded: dict[tuple[str, str, str], DataFrame] = {}


def _needs(sql: str, names) -> list[str]:
    words = set(re.findall(r"\w+", sql))
    return [name for name in names if name in words]


class Views:
    """Driver tables and fixture views of one data folder as frames."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self.kept = spark, folder, {}

    def keep(self, *names: str) -> None:
        """Write these views out, for a query that draws on them several times; views built on them read the copies."""
        for name in names:
            self.kept[name] = stored(self[name])

    def table(self, name: str) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.folder, name)
        if key not in _loaded:
            _loaded[key] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return _loaded[key]

    def __getitem__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.table(name)
        if name in self.kept:
            return self.kept[name]
        sql = VIEWS[name]
        for part in _needs(sql, TABLES):
            self.table(part).createOrReplaceTempView(part)
        for part in _needs(sql, VIEWS):
            if part != name:
                self[part].createOrReplaceTempView(part)
        return self.spark.sql(sql)


def oracle(body: str) -> str:
    """Stand-alone DuckDB text: the fixture views a query uses, then its body."""
    order: list[str] = []

    def visit(sql: str, seen: str | None = None) -> None:
        for part in _needs(sql, VIEWS):
            if part == seen or part in order:
                continue
            visit(DUCKDB_FORM.get(part, VIEWS[part]), part)
            order.append(part)

    visit(body)
    if not order:
        return body.strip()
    ctes = ", ".join(f"{name} AS ({DUCKDB_FORM.get(name, VIEWS[name]).strip()})" for name in order)
    body = body.strip()
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {ctes}, {body[15:]}"
    if body.upper().startswith("WITH "):
        return f"WITH {ctes}, {body[5:]}"
    return f"WITH {ctes} {body}"
