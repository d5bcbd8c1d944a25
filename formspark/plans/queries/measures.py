"""Page geometry over whole measurement tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from formspark.operators import geometry as geo
from formspark.plans.registry import query

_OK = "w BETWEEN 46 AND 102 AND h BETWEEN 46 AND 102 AND abs(w - h) <= 28 AND area >= 0.75 * w * h"
_CORNERS_SQL = f"""
  SELECT page_id, CASE WHEN y + h / 2 < page_h / 2 THEN 'T' ELSE 'B' END || CASE WHEN x + w / 2 < page_w / 2 THEN 'L' ELSE 'R' END AS corner,
    x + w / 2 AS cx, y + h / 2 AS cy FROM fx_components WHERE {_OK}"""
_FOUND_SQL = f"""
  SELECT page_id FROM (SELECT page_id, corner, count(*) AS n FROM ({_CORNERS_SQL}) c GROUP BY ALL) q
  GROUP BY page_id HAVING count(*) = 4 AND max(n) = 1"""


@query("GEO-01", f"""
SELECT p.page_id, f.page_id IS NOT NULL AS marks_found, max(CASE WHEN f.page_id IS NOT NULL AND corner = 'TL' THEN cx END) AS x_TL,
  max(CASE WHEN f.page_id IS NOT NULL AND corner = 'BR' THEN cy END) AS y_BR
FROM (SELECT DISTINCT page_id FROM fx_components) p LEFT JOIN ({_FOUND_SQL}) f ON f.page_id = p.page_id
LEFT JOIN ({_CORNERS_SQL}) c ON c.page_id = p.page_id GROUP BY p.page_id, f.page_id""")
def geometry_registration_marks(v):
    return geo.registration_marks(v["fx_components"]).select("page_id", "marks_found", "x_TL", "y_BR")


_FIT_SQL = """
  SELECT page_id, (covar_pop(ax, bx) + covar_pop(ay, b_y)) / (var_pop(ax) + var_pop(ay)) AS re, (covar_pop(ax, b_y) - covar_pop(ay, bx)) / (var_pop(ax) + var_pop(ay)) AS im,
    avg(ax) AS cax, avg(ay) AS cay, avg(bx) AS cbx, avg(b_y) AS cby, max(CASE WHEN corner = 'TL' THEN bx - ax END) AS dx, max(CASE WHEN corner = 'TL' THEN b_y - ay END) AS dy
  FROM fx_marks GROUP BY page_id HAVING count(*) = 4"""


@query("GEO-02", f"""
SELECT page_id, round(sqrt(re * re + im * im), 5) AS scale, round(degrees(atan2(im, re)), 3) + 0.0 AS rotation_deg, round(dx, 1) + 0.0 AS offset_dx, round(dy, 1) + 0.0 AS offset_dy
FROM ({_FIT_SQL}) f""")
def geometry_similarity_fit(v):
    return geo.fit_similarity(v["fx_marks"]).select(
        "page_id", "scale", *[(F.col(c) + 0.0).alias(c) for c in ("rotation_deg", "offset_dx", "offset_dy")])


@query("GEO-04", f"""
SELECT m.page_id, round(max(greatest(abs(re * (ax - cax) - im * (ay - cay) + cbx - bx), abs(re * (ay - cay) + im * (ax - cax) + cby - b_y))), 2) AS fit_residual
FROM fx_marks m JOIN ({_FIT_SQL}) f ON f.page_id = m.page_id GROUP BY m.page_id""")
def geometry_fit_residual(v):
    return geo.fit_residual(geo.fit_similarity(v["fx_marks"])).select("page_id", "fit_residual")


# A small template: corners of a few boxes, and one question's baseline correction.
_POINTS = "(0,'19','a',400.0,900.0),(0,'19','b',600.0,900.0),(1,'31','a',500.0,1200.0),(1,'31','b',700.0,1200.0),(2,'34','a',450.0,300.0)"


@query("GEO-03", f"""
SELECT f.page_id, p.question, p.label, round(re * (x - cax) - im * (y + CASE p.question WHEN '31' THEN 23 WHEN '34' THEN 16 ELSE 0 END - cay) + cbx, 3) AS px,
  round(re * (y + CASE p.question WHEN '31' THEN 23 WHEN '34' THEN 16 ELSE 0 END - cay) + im * (x - cax) + cby, 3) AS py
FROM ({_FIT_SQL}) f JOIN (VALUES {_POINTS}) AS p(page_idx, question, label, x, y) ON p.page_idx = f.page_id % 3""")
def geometry_projected_points(v):
    points = v.spark.sql(
        "SELECT page_idx, question, label, CAST(x AS DOUBLE) AS x, CAST(y AS DOUBLE) AS y "
        f"FROM VALUES {_POINTS} AS p(page_idx, question, label, x, y)")
    fits = geo.fit_similarity(v["fx_marks"]).withColumn("page_idx", (F.col("page_id") % 3).cast("int"))
    corrections = v.spark.sql("SELECT * FROM VALUES ('31', 0D, 23D), ('34', 0D, 16D) AS c(question, dx, dy)")
    return geo.project(points, fits, corrections).select(
        "page_id", "question", "label", F.round("px", 3).alias("px"), F.round("py", 3).alias("py"))


@query("GEO-05", """
WITH h AS (SELECT e.page_id, e.box, c.x0, c.x1, c.y0, c.y1, row_number() OVER (PARTITION BY e.page_id, e.box
    ORDER BY abs((c.x1 - c.x0) - (e.x1 - e.x0)) + abs((c.y1 - c.y0) - (e.y1 - e.y0)), c.x0, c.x1, c.y0, c.y1) AS rn
  FROM fx_expected_box e JOIN fx_candidates c ON c.page_id = e.page_id AND c.x0 > e.x0 - 8 AND c.x1 < e.x1 + 7 AND c.y0 > e.y0 - 8 AND c.y1 < e.y1 + 7
  WHERE c.x1 - c.x0 BETWEEN 18 AND 55 AND c.y1 - c.y0 BETWEEN 18 AND 55 AND least(ink_top, ink_bottom, ink_left, ink_right) >= 0.6)
SELECT e.page_id, e.box, h.x0 IS NOT NULL AS confirmed, h.x0 AS found_x0, h.x1 AS found_x1, h.y0 AS found_y0, h.y1 AS found_y1
FROM fx_expected_box e LEFT JOIN h ON h.page_id = e.page_id AND h.box = e.box AND h.rn = 1""")
def geometry_confirmed_boxes(v):
    return geo.confirm_boxes(v["fx_expected_box"], v["fx_candidates"])


# Rectangles that clash with an earlier one are taken in order, page by page; the others stay.
@query("GEO-06", """
WITH RECURSIVE c AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY area DESC, y0, x0, x1, y1) AS i FROM fx_rects),
e AS (SELECT b.page_id, b.i, list(a.i) AS before FROM c a JOIN c b ON a.page_id = b.page_id AND a.i < b.i
  AND abs(a.x0 + a.x1 - b.x0 - b.x1) < 20 AND abs(a.y0 + a.y1 - b.y0 - b.y1) < 20 GROUP BY b.page_id, b.i),
n AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY i) AS k FROM e),
w AS (SELECT DISTINCT page_id, CAST(0 AS BIGINT) AS k, CAST([] AS BIGINT[]) AS gone FROM n
  UNION ALL SELECT w.page_id, n.k, CASE WHEN len(list_filter(before, lambda x: NOT list_contains(gone, x))) > 0 THEN list_append(gone, n.i) ELSE gone END
  FROM w JOIN n ON n.page_id = w.page_id AND n.k = w.k + 1),
d AS (SELECT page_id, unnest(max_by(gone, k)) AS i FROM w GROUP BY page_id)
SELECT page_id, x0, x1, y0, y1, area FROM c WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.page_id = c.page_id AND d.i = c.i)""")
def geometry_collapsed_rects(v):
    return geo.collapse_nested(v["fx_rects"])


_CHAIN = """
  SELECT *, sum(starts) OVER (PARTITION BY page_id ORDER BY c) AS chain FROM (
    SELECT *, CASE WHEN c - lag(c) OVER (PARTITION BY page_id ORDER BY c) > {gap} THEN 1 ELSE 0 END AS starts FROM (
      SELECT *, {value} AS c FROM {table}) q) q"""


@query("GEO-07", f"""
SELECT page_id, round(avg(c), 2) AS center, count(*) AS members FROM ({_CHAIN.format(gap=3, value='(x0 + x1) / 2', table='fx_rects')}) q GROUP BY page_id, chain""")
def geometry_column_clusters(v):
    centred = v["fx_rects"].withColumn("cx", (F.col("x0") + F.col("x1")) / 2)
    return geo.cluster_1d(centred, ["page_id"], "cx", 3.0).select("page_id", "center", "members")


@query("GEO-08", f"""
SELECT page_id, count(*) AS count, max(x1) - min(x0) AS x_span, max(y1) - min(y0) AS y_span, round(avg((x0 + x1) / 2), 3) AS x_center, round(avg(c), 3) AS y_center
FROM ({_CHAIN.format(gap=12, value='(y0 + y1) / 2', table='fx_rects')}) q GROUP BY page_id, chain""")
def geometry_control_rows(v):
    return geo.control_rows(v["fx_rects"], ["page_id"], 12.0).select(
        "page_id", "count", "x_span", "y_span", F.round("x_center", 3).alias("x_center"),
        F.round("y_center", 3).alias("y_center"))


# Template of labelled controls: question, control type, page, layout, label, order, centre.
_TARGETS = (
    "('20','checkbox',1,'1','Yes',0,300.0,800.0),('20','checkbox',1,'1','No',1,600.0,400.0),"
    "('20','checkbox',1,'2','Yes',0,900.0,800.0),('20','checkbox',1,'2','No',1,1200.0,400.0),"
    "('21','checkbox',1,'1','Yes',0,300.0,790.0),('21','checkbox',1,'1','No',1,340.0,800.0),"
    "('H3','circle',1,'1','Day',0,1500.0,800.0),('H3','circle',1,'1','Night',1,1800.0,400.0)"
)
_TARGET_ROWS = f"""SELECT question, control_type, page, layout, label, k AS target_index, CAST(x AS DOUBLE) - 10 AS x0, CAST(x AS DOUBLE) + 10 AS x1,
  CAST(y AS DOUBLE) - 10 AS y0, CAST(y AS DOUBLE) + 10 AS y1 FROM (VALUES {_TARGETS}) AS t(question, control_type, page, layout, label, k, x, y)"""


def _controls(v):
    targets = v.spark.sql(_TARGET_ROWS)
    detected = v["fx_page_controls"].withColumnRenamed("page_id", "doc")
    return targets, detected


@query("GEO-09", f"""
WITH t AS ({_TARGET_ROWS}), n AS (SELECT question, control_type, page, layout, count(*) AS size FROM t GROUP BY ALL),
d AS (SELECT page_id AS doc, control_type, x0, x1, y0, y1, row_number() OVER (PARTITION BY page_id, control_type, x0, x1, y0, y1) AS copy FROM fx_page_controls),
p AS (SELECT d.doc, t.question, t.layout, t.label, d.x0, d.x1, d.y0, d.y1, d.copy, n.size,
   sqrt(((t.x0 + t.x1) / 2 - (d.x0 + d.x1) / 2) * ((t.x0 + t.x1) / 2 - (d.x0 + d.x1) / 2) + ((t.y0 + t.y1) / 2 - (d.y0 + d.y1) / 2) * ((t.y0 + t.y1) / 2 - (d.y0 + d.y1) / 2)) AS delta
   FROM t JOIN n USING (question, control_type, page, layout) JOIN d ON d.control_type = t.control_type)
SELECT doc, question, layout, label, round(delta, 3) AS delta FROM (
  SELECT *, row_number() OVER (PARTITION BY doc, question, layout, label ORDER BY delta, y0, x0, x1, y1, copy) AS rn FROM p WHERE delta <= 80 AND copy <= size) q WHERE rn <= size""")
def geometry_control_pairs(v):
    targets, detected = _controls(v)
    return geo._nearest_pairs(targets, detected, 80.0).select(
        "doc", "question", "layout", "label", F.round("delta", 3).alias("delta"))


# Layouts of the template hold two targets: the nearest pair is taken, then the nearest that shares nothing with it.
_MATCHED = f"""t AS ({_TARGET_ROWS}),
d AS (SELECT page_id AS doc, control_type, x0, x1, y0, y1, row_number() OVER (PARTITION BY page_id, control_type, x0, x1, y0, y1) AS copy FROM fx_page_controls),
p AS (SELECT d.doc, t.question, t.layout, t.label, t.target_index, d.x0, d.x1, d.y0, d.y1, d.copy,
   sqrt(((t.x0 + t.x1) / 2 - (d.x0 + d.x1) / 2) * ((t.x0 + t.x1) / 2 - (d.x0 + d.x1) / 2) + ((t.y0 + t.y1) / 2 - (d.y0 + d.y1) / 2) * ((t.y0 + t.y1) / 2 - (d.y0 + d.y1) / 2)) AS delta
   FROM t JOIN d ON d.control_type = t.control_type),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc, question, layout ORDER BY delta, target_index, y0, x0, x1, y1, copy) AS rn FROM p WHERE delta <= 80) q WHERE rn = 1),
g AS (SELECT * FROM (SELECT p.*, row_number() OVER (PARTITION BY p.doc, p.question, p.layout ORDER BY p.delta, p.target_index, p.y0, p.x0, p.x1, p.y1, p.copy) AS rn
   FROM p JOIN f ON f.doc = p.doc AND f.question = p.question AND f.layout = p.layout WHERE p.delta <= 80 AND p.target_index <> f.target_index
   AND NOT (p.x0 = f.x0 AND p.x1 = f.x1 AND p.y0 = f.y0 AND p.y1 = f.y1 AND p.copy = f.copy)) q WHERE rn = 1)"""


@query("GEO-09", f"""
WITH {_MATCHED} SELECT doc, question, layout, label, x0, y0, round(delta, 3) AS delta FROM (SELECT * FROM f UNION ALL SELECT * FROM g) q""")
def geometry_matched_controls(v):
    targets, detected = _controls(v)
    return geo.match_controls(targets, detected).select(
        "doc", "question", "layout", "label", "x0", "y0", F.round("delta", 3).alias("delta"))


@query("GEO-09 GEO-10 GEO-11", f"""
WITH {_MATCHED},
m AS (SELECT doc, question, layout, delta FROM f UNION ALL SELECT doc, question, layout, delta FROM g),
y AS (SELECT question, layout, count(*) AS size FROM t GROUP BY ALL), s AS (SELECT doc, count(*) AS n FROM d GROUP BY doc),
z AS (SELECT s.doc, y.question, y.layout, y.size, count(m.delta) AS matches, coalesce(sum(m.delta), 0) AS total FROM s CROSS JOIN y
  LEFT JOIN m ON m.doc = s.doc AND m.question = y.question AND m.layout = y.layout GROUP BY ALL),
b AS (SELECT *, row_number() OVER (PARTITION BY doc, question ORDER BY matches DESC, total, layout DESC) AS rn, count(*) OVER (PARTITION BY doc, question) AS layouts FROM z),
k AS (SELECT m.doc, round(avg(delta), 2) AS mean, round(max(delta), 2) AS most FROM m JOIN b ON b.rn = 1 AND b.doc = m.doc AND b.question = m.question AND b.layout = m.layout GROUP BY m.doc),
c AS (SELECT doc, CAST(sum(size) AS BIGINT) AS expected, CAST(sum(matches) AS BIGINT) AS matched, CAST(sum(layouts) AS BIGINT) AS layouts FROM b WHERE rn = 1 GROUP BY doc)
SELECT s.doc, s.n AS detected_controls, c.expected AS expected_controls, c.layouts AS available_layout_candidates, c.matched AS matched_controls,
  k.mean AS mean_center_delta_px, k.most AS max_center_delta_px, c.expected - c.matched AS unmatched_expected_controls, s.n - c.matched AS unmatched_detected_controls
FROM s JOIN c ON c.doc = s.doc LEFT JOIN k ON k.doc = s.doc""")
def geometry_match_report(v):
    targets, detected = _controls(v)
    matches = geo.match_controls(targets, detected)
    return geo.match_metrics(geo.choose_layout(matches, targets, detected), matches, detected)


_LAYOUTS = "('A','F',3,1),('A','O',3,1),('N','F',2,1),('N','O',4,1),('R','F',5,1),('R','O',5,1),('Z','O',1,2)"


def _layout_choice(v):
    matches = v["lineitem"].select(
        F.col("l_orderkey").alias("doc"), F.col("l_returnflag").alias("question"), F.lit("checkbox").alias("control_type"),
        F.floor((F.col("l_linenumber") + 6) / 7).cast("int").alias("page"), F.col("l_linestatus").alias("layout"), F.col("l_quantity").alias("delta"))
    targets = v.spark.sql(
        f"SELECT question, 'checkbox' AS control_type, page, layout, explode(sequence(1, n)) AS i "
        f"FROM VALUES {_LAYOUTS} AS t(question, layout, n, page)")
    detected = v["fx_page_controls"].select(F.col("page_id").alias("doc"), "page")
    return matches, targets, detected


_CHOSEN = f"""
  SELECT * FROM (SELECT d.doc, t.question, t.layout, t.n AS layout_size, count(l_orderkey) AS matches, coalesce(sum(l_quantity), 0) AS total,
      row_number() OVER (PARTITION BY d.doc, t.question ORDER BY count(l_orderkey) DESC, coalesce(sum(l_quantity), 0), t.layout DESC) AS rn
    FROM (SELECT DISTINCT l_orderkey AS doc FROM lineitem) d JOIN (VALUES {_LAYOUTS}) AS t(question, layout, n, page) ON t.page = 1
    LEFT JOIN lineitem l ON l.l_orderkey = d.doc AND l.l_returnflag = t.question AND l.l_linestatus = t.layout
    GROUP BY d.doc, t.question, t.layout, t.n) q WHERE rn = 1"""


@query("GEO-10", f"SELECT doc, question, layout, matches, layout_size, total AS total_delta FROM ({_CHOSEN}) q")
def geometry_chosen_layout(v):
    return geo.choose_layout(*_layout_choice(v)).select(
        "doc", "question", "layout", "matches", "layout_size", (F.col("total_delta") + 0.0).alias("total_delta"))


@query("GEO-11", f"""
WITH c AS ({_CHOSEN}), k AS (SELECT l.l_orderkey AS doc, l_quantity AS delta FROM lineitem l JOIN c ON c.doc = l.l_orderkey AND c.question = l.l_returnflag AND c.layout = l.l_linestatus)
SELECT s.doc, CAST(sum(c.layout_size) AS BIGINT) AS expected_controls, CAST(sum(c.matches) AS BIGINT) AS matched_controls, s.n AS detected_controls, CAST(sum(c.layout_size) - sum(c.matches) AS BIGINT) AS unmatched_expected_controls,
  CAST(s.n - sum(c.matches) AS BIGINT) AS unmatched_detected_controls, k.m AS mean_center_delta_px, k.x AS max_center_delta_px
FROM (SELECT l_orderkey AS doc, count(*) AS n FROM lineitem GROUP BY 1) s JOIN c ON c.doc = s.doc
LEFT JOIN (SELECT doc, round(avg(delta), 2) AS m, round(max(delta), 2) AS x FROM k GROUP BY doc) k ON k.doc = s.doc GROUP BY s.doc, s.n, k.m, k.x""")
def geometry_match_metrics(v):
    matches, targets, detected = _layout_choice(v)
    chosen = geo.choose_layout(matches, targets, detected)
    return geo.match_metrics(chosen, matches, detected).drop("available_layout_candidates")


# Templates of three forms: question, place in the form, answer type, labels.
_TEMPLATE = (
    "(0,'H3',0,'single-choice',['Day','Night']),(0,'1',1,'single-choice',['Yes','No']),(0,'2',2,'single-choice',['Agree','Neutral','Disagree']),"
    "(0,'3',3,'multi-select',['Never','Seldom','Often','Always']),(1,'H3',0,'single-choice',['Day','Night','Both']),(1,'1',1,'open-ended',['Yes','No']),"
    "(1,'2',2,'single-choice',['Yes','No']),(1,'3',3,'multi-select',['A','B','C','D']),(2,'1',1,'single-choice',['Yes','No','H3']),(2,'2',2,'multi-select',[])"
)
_MAP_WORDS = """SELECT l_orderkey % 3 AS form_id, l_orderkey AS doc, CAST(floor((l_linenumber + 6) / 7) AS INT) AS page,
  CASE WHEN l_returnflag = 'A' THEN ' Yes' WHEN l_linestatus = 'F' THEN 'seldom' ELSE 'h3' END AS text FROM lineitem"""


def _mapping(v):
    controls = v["fx_page_controls"].withColumnRenamed("page_id", "doc").withColumn("form_id", F.col("doc") % 3)
    template = v.spark.sql("SELECT CAST(form_id AS BIGINT) AS form_id, question, place, answer_type, CAST(labels AS ARRAY<STRING>) AS labels FROM VALUES "
                           f"{_TEMPLATE.replace('[', 'array(').replace(']', ')')} AS t(form_id, question, place, answer_type, labels)")
    v["lineitem"].createOrReplaceTempView("lineitem")
    return geo.map_controls(controls, v.spark.sql(_MAP_WORDS), template), controls, template


# Rows are chains of controls; a document's rows of a kind then go one by one, the questions gone in a list.
_MAPPED = f"""
t AS (SELECT form_id, question, place, answer_type, CAST(labels AS VARCHAR[]) AS labels, CASE WHEN question = 'H3' THEN 'h3_circle' ELSE 'yesno_box' END AS kind
  FROM (VALUES {_TEMPLATE}) AS t(form_id, question, place, answer_type, labels) WHERE len(labels) > 0 OR question = 'H3'),
ctl AS (SELECT page_id AS doc, page_id % 3 AS form_id, page, control_type, x0, x1, y0, y1, (y0 + y1) / 2 AS cy, CASE WHEN control_type = 'circle' THEN 18 ELSE 12 END AS gap FROM fx_page_controls),
brk AS (SELECT *, CASE WHEN cy - lag(cy) OVER (PARTITION BY doc, page, control_type ORDER BY cy) > gap THEN 1 ELSE 0 END AS starts FROM ctl),
chn AS (SELECT *, sum(starts) OVER (PARTITION BY doc, page, control_type ORDER BY cy) AS chain FROM brk),
rws AS (SELECT form_id, doc, page, control_type, chain, count(*) AS n, avg(cy) AS y, CASE WHEN control_type = 'circle' THEN 'h3_circle' ELSE 'yesno_box' END AS kind FROM chn GROUP BY ALL
  HAVING count(*) >= 2 AND max(x1) - min(x0) >= CASE WHEN control_type = 'circle' THEN 180 ELSE 600 END AND max(y1) > min(y0)),
wds AS (SELECT form_id, doc, page, lower(trim(text)) AS word FROM ({_MAP_WORDS}) q),
trm AS (SELECT form_id, question, unnest(list_concat([lower(question)], list_transform(labels, lambda l: lower(l)), CASE WHEN question = 'H3' THEN ['h3', 'setting'] ELSE [] END)) AS word FROM t),
hit AS (SELECT doc, page, question, count(*) AS hits FROM wds JOIN trm USING (form_id, word) GROUP BY ALL), has AS (SELECT DISTINCT doc, page FROM wds),
ofr AS (SELECT rws.*, question, place, abs(len(labels) - n) AS diff, CASE WHEN len(labels) = n THEN 0.8 ELSE 0.65 END AS s0, coalesce(hits, 0) AS h, has.doc IS NOT NULL AS said
  FROM rws JOIN t USING (form_id, kind) LEFT JOIN hit USING (doc, page, question) LEFT JOIN has USING (doc, page) WHERE abs(len(labels) - n) <= 1 AND (kind = 'h3_circle' OR answer_type IN ('single-choice', 'multi-select'))),
scr AS (SELECT *, CASE WHEN said THEN least(0.97, s1 + 0.05) ELSE s1 END AS score FROM (SELECT *, CASE WHEN h > 0 THEN least(0.96, s0 + 0.12 * least(h, 3)) ELSE s0 END AS s1 FROM ofr) q),
lin AS (SELECT form_id, doc, kind, page, control_type, chain, n, list({{'q': question, 's': score}} ORDER BY diff, place) AS cand, row_number() OVER (PARTITION BY doc, kind ORDER BY page, y) AS k
  FROM scr GROUP BY form_id, doc, kind, page, control_type, chain, n, y),
wlk AS (SELECT doc, kind, CAST(0 AS BIGINT) AS k, CAST([] AS VARCHAR[]) AS gone, CAST(NULL AS STRUCT(q VARCHAR, s DECIMAL(5, 2))) AS best FROM lin WHERE k = 1
  UNION ALL SELECT doc, kind, k, CASE WHEN b.s >= 0.75 THEN list_append(gone, b.q) ELSE gone END, b FROM (
    SELECT l.doc, l.kind, l.k, w.gone, list_filter(l.cand, lambda c: NOT list_contains(w.gone, c.q))[1] AS b FROM wlk w JOIN lin l ON l.doc = w.doc AND l.kind = w.kind AND l.k = w.k + 1) q),
trd AS (SELECT l.form_id, l.doc, best.q AS question, l.page, l.kind, l.control_type, l.chain, l.n, round(CAST(best.s AS DOUBLE), 3) AS confidence, best.s >= 0.75 AS resolved
  FROM wlk JOIN lin l ON l.doc = wlk.doc AND l.kind = wlk.kind AND l.k = wlk.k WHERE wlk.k > 0 AND best IS NOT NULL)"""


@query("GEO-12", f"""
WITH RECURSIVE {_MAPPED},
lft AS (SELECT d.form_id, d.doc, t.question FROM (SELECT DISTINCT form_id, doc FROM wds UNION SELECT DISTINCT form_id, doc FROM ctl) d JOIN t ON t.form_id = d.form_id
  WHERE NOT EXISTS (SELECT 1 FROM trd WHERE trd.resolved AND trd.doc = d.doc AND trd.question = t.question)),
al AS (SELECT form_id, doc, question, page, kind, n, confidence, resolved FROM trd UNION ALL SELECT form_id, doc, question, NULL, NULL, NULL, 0, false FROM lft)
SELECT al.form_id, doc, al.question, page, al.kind, n AS controls, CAST(len(labels) AS INTEGER) AS expected, confidence, resolved,
  CASE WHEN resolved THEN NULL WHEN page IS NULL THEN 'no high-confidence geometry match was found for this survey control' ELSE 'count/order matched but layout confidence stayed below threshold' END AS reason
FROM al JOIN t ON t.form_id = al.form_id AND t.question = al.question""")
def geometry_mapped_controls(v):
    return _mapping(v)[0].drop("chain", "control_type", "y_low", "y_high")


@query("GEO-12", f"""
WITH RECURSIVE {_MAPPED},
mem AS (SELECT trd.form_id, trd.doc, trd.question, trd.page, trd.kind, x0, x1, y0, y1, confidence,
  row_number() OVER (PARTITION BY trd.doc, trd.page, trd.control_type, trd.chain ORDER BY x0, y0, x1, y1) AS i
  FROM trd JOIN chn ON chn.doc = trd.doc AND chn.page = trd.page AND chn.control_type = trd.control_type AND chn.chain = trd.chain WHERE resolved)
SELECT mem.form_id, doc, mem.question, CAST(i - 1 AS INTEGER) AS label_index, labels[i] AS label, page, mem.kind, x0, x1, y0, y1, confidence
FROM mem JOIN t ON t.form_id = mem.form_id AND t.question = mem.question WHERE i <= len(labels)""")
def geometry_mapped_labels(v):
    return geo.mapped_labels(*_mapping(v))


@query("GEO-13", """
SELECT file_name, question, candidate, boxes_confirmed, row_number() OVER (PARTITION BY file_name, question ORDER BY boxes_confirmed DESC, boxes_confirmed / greatest(boxes_total, 1) DESC, candidate) = 1 AS active_layout
FROM fx_questions_seen""")
def geometry_active_layout(v):
    return geo.active_layout(v["fx_questions_seen"]).select(
        "file_name", "question", "candidate", "boxes_confirmed", "active_layout")


@query("GEO-14", """
SELECT page_id, box, round(CASE WHEN bool_and(inside) THEN avg(coverage) ELSE 0 END, 6) AS coverage FROM fx_sides GROUP BY page_id, box""")
def geometry_border_coverage(v):
    return geo.border_coverage(v["fx_sides"]).withColumn("coverage", F.round("coverage", 6))


@query("GEO-15", """
WITH b AS (SELECT *, ntile(20) OVER (PARTITION BY page_id, side ORDER BY y) AS band FROM fx_strips),
s AS (SELECT page_id, side, sum(s) / sum(n) AS coverage, CAST(count_if(s / n > 0.01) AS BIGINT) AS bands FROM (SELECT page_id, side, band, sum(ink) AS s, count(*) AS n FROM b GROUP BY ALL) q GROUP BY page_id, side)
SELECT page_id, round(CASE WHEN r > l THEN r ELSE l END, 6) AS shadow_coverage, CASE WHEN greatest(l, r) <= 0 THEN 0 WHEN r > l THEN rb ELSE lb END AS shadow_bands FROM (
  SELECT page_id, max(CASE WHEN side = 'left' THEN coverage END) AS l, max(CASE WHEN side = 'right' THEN coverage END) AS r,
    max(CASE WHEN side = 'left' THEN bands END) AS lb, max(CASE WHEN side = 'right' THEN bands END) AS rb FROM s GROUP BY page_id) q""")
def geometry_margin_shadow(v):
    return geo.margin_shadow(v["fx_strips"]).withColumn("shadow_coverage", F.round("shadow_coverage", 6))


@query("GEO-16", f"""
WITH c AS ({_CHAIN.format(gap=3, value='y', table='(SELECT page_id, y FROM fx_line_sums WHERE line_sum > page_w * 0.5) s')}),
l AS (SELECT page_id, CAST(floor(avg(y)) AS INT) AS center FROM c GROUP BY page_id, chain),
b AS (SELECT *, CASE WHEN center - lag(center) OVER (PARTITION BY page_id ORDER BY center) BETWEEN 45 AND 145 THEN 0 ELSE 1 END AS breaks FROM l),
r AS (SELECT *, sum(breaks) OVER (PARTITION BY page_id ORDER BY center ROWS UNBOUNDED PRECEDING) AS run FROM b),
n AS (SELECT page_id, run, count(*) AS length, row_number() OVER (PARTITION BY page_id ORDER BY count(*) DESC, run) AS rn FROM r GROUP BY page_id, run)
SELECT page_id, string_agg(CAST(center AS VARCHAR), ',' ORDER BY center) AS rows FROM (
  SELECT r.*, row_number() OVER (PARTITION BY r.page_id ORDER BY center) AS i FROM r JOIN n ON n.page_id = r.page_id AND n.run = r.run AND n.rn = 1 WHERE n.length >= 19) q
WHERE i <= 19 GROUP BY page_id""")
def geometry_grid_rows(v):
    return geo.grid_rows(v["fx_line_sums"]).select("page_id", F.array_join("rows", ",").alias("rows"))


@query("GEO-17", """
SELECT page_id, coalesce(string_agg(CAST(grid_row AS VARCHAR), ',' ORDER BY grid_row) FILTER (over_), '') AS rows FROM (
  SELECT page_id, grid_row, greatest(0, max(CASE WHEN kind = 'gap' THEN density END) - min(CASE WHEN kind = 'box' THEN density END)) >= 0.03 AS over_ FROM fx_cells GROUP BY page_id, grid_row) q
GROUP BY page_id""")
def geometry_overflow_rows(v):
    return geo.overflow_rows(v["fx_cells"]).select("page_id", F.array_join("overflow_rows", ",").alias("rows"))


def _drafts(v):
    pages = v["fx_vec"].join(v["embeddings"].select("vec_id", "label"), "vec_id").select(
        F.col("label").alias("form_id"), F.col("vec_id").alias("file_name"), (F.col("pos") + 1).alias("page"),
        F.floor(F.abs("val") * 1000).cast("double").alias("ink_threshold"),
        F.when(F.col("val") > 0, F.concat_ws(",", F.col("vec_id"), F.col("pos"))).alias("marks"))
    rects = v["fx_rects"].join(v["supplier"], F.col("page_id") == F.col("s_suppkey")).select(
        (F.col("s_nationkey") % 10).alias("form_id"), "x0", "x1", "y0", "y1")
    return pages, rects


_DRAFT_PAGES = """SELECT label AS form_id, v.vec_id AS file_name, pos + 1 AS page, floor(abs(val) * 1000) AS ink_threshold,
  CASE WHEN val > 0 THEN CAST(v.vec_id AS VARCHAR) || ',' || CAST(pos AS VARCHAR) END AS marks FROM fx_vec v JOIN embeddings e ON e.vec_id = v.vec_id"""
_DRAFT_RECTS = "SELECT s_nationkey % 10 AS form_id, x0, x1, y0, y1 FROM fx_rects JOIN supplier ON s_suppkey = page_id"


@query("GEO-18", f"""
SELECT p.form_id, first_file, ink_threshold, size AS box_expected_size FROM
  (SELECT form_id, min(file_name) AS first_file, round(median(ink_threshold), 2) AS ink_threshold FROM ({_DRAFT_PAGES}) p GROUP BY form_id) p
LEFT JOIN (SELECT form_id, round(median(side), 2) AS size FROM (SELECT form_id, x1 - x0 AS side FROM ({_DRAFT_RECTS}) r UNION ALL SELECT form_id, y1 - y0 FROM ({_DRAFT_RECTS}) r) q GROUP BY form_id) r
  ON r.form_id = p.form_id""")
def geometry_draft_profile(v):
    return geo.draft_profile(*_drafts(v))


@query("GEO-18", f"""
WITH p AS ({_DRAFT_PAGES}) SELECT form_id, file_name, page, marks FROM p WHERE marks IS NOT NULL AND file_name = (SELECT min(file_name) FROM p q WHERE q.form_id = p.form_id)""")
def geometry_draft_baseline(v):
    return geo.draft_baseline(_drafts(v)[0])


@query("GEO-18 GEO-07", f"""
SELECT page_id AS form_id, round(avg(c), 2) AS center FROM ({_CHAIN.format(gap=12, value='(x0 + x1) / 2', table=f'(SELECT form_id AS page_id, x0, x1 FROM ({_DRAFT_RECTS}) r) d')}) q GROUP BY page_id, chain""")
def geometry_draft_columns(v):
    return geo.draft_columns(_drafts(v)[1]).select("form_id", "center")
