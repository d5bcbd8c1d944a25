"""Sources, sinks, jobs and streams on real folders."""

from __future__ import annotations

import datetime as dt
import json
import os

import pytest
from conftest import SMALL
from pyspark.sql import functions as F
from pyspark.sql import types as T

from formspark.operators import audit as aud
from formspark.operators import feedback as fb
from formspark.operators import manifest as man
from formspark.operators import rollup
from formspark.plans import jobs
from formspark.plans.fixtures import Views
from formspark.session import scratch_dir
from formspark.sources import layouts, readers, writers
from formspark.streaming import intake as stream



def now():
    return F.lit("2025-12-01 09:30:00").cast("timestamp")


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def test_listing_reads_names_not_content(spark, tmp_path):
    for name in ("a.pdf", "sub/b.PDF", "sub/c.txt"):
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_bytes(b"%PDF")
    listed = readers.list_documents(spark, str(tmp_path))
    assert {r.object_name for r in listed.collect()} == {"a.pdf", "b.PDF"}
    assert "content" not in listed.columns
    loose = readers.select_sources(listed, f"file:{tmp_path}", loose_only=True)
    assert [r.object_name for r in loose.collect()] == ["a.pdf"]
    assert readers.select_sources(listed, f"file:{tmp_path}", only_file="b.PDF").count() == 1


def test_prefix_ends_at_a_folder(spark):
    names = spark.createDataFrame([("gs://b/scans/x.pdf",), ("gs://b/scans_old/y.pdf",), ("gs://b/scans/z.txt",)], "uri string")
    assert [r.uri for r in readers.documents_in(names, "gs://b/scans").collect()] == ["gs://b/scans/x.pdf"]
    assert readers.documents_in(names, "gs://b/scans/x.pdf").count() == 1


def test_small_files(spark, tmp_path):
    (tmp_path / "done").write_text("gs://b/a.pdf\n\n  \ngs://b/b.pdf\ngs://b/a.pdf\n")
    assert readers.read_done_log(spark, str(tmp_path / "done")).count() == 2
    (tmp_path / "again.csv").write_text("source_gcs_uri,source_page_range\ngs://b/a.pdf,1-2\n,3-4\ngs://b/c.pdf,\n")
    assert rows_of(readers.read_reprocess_list(spark, str(tmp_path / "again.csv"))) == [("gs://b/a.pdf", "1-2")]
    (tmp_path / "o.json").write_text(json.dumps({"1": {"question_text": "t"}, "H1": {"choices": "", "question_type": "x"}}))
    got = {r.number: (r.question_text, r.choices, r.has_text, r.has_choices) for r in readers.read_overrides(spark, str(tmp_path / "o.json")).collect()}
    assert got == {"1": ("t", None, True, False), "H1": (None, "", False, True)}
    (tmp_path / "sheet.csv").write_text("file_name,extra,folder_name,question_number,correct_answer\nf.pdf,x, d ,1, N/A \nf.pdf,x,d,2,\n")
    assert rows_of(readers.read_feedback(spark, str(tmp_path / "sheet.csv"))) == [
        ("d", "f.pdf", "1", "N/A"), ("d", "f.pdf", "2", None)]


def test_bad_geometry_json_has_no_questions(spark):
    frame = spark.createDataFrame([("a", "{oops"), ("b", None), ("c", '{"27#1": {"page_idx": 1, "rects": {"Yes": [1,2,3,4]}}}')],
                                  "file_name string, question_rects_json string")
    got = readers.unpack_question_rects(frame).collect()
    assert [(r.file_name, r.question, r.page_idx, r.boxes_total) for r in got] == [("c", "27", 1, 0)]


def test_append_is_partitioned_and_repeatable(spark, folder):
    frame = spark.createDataFrame([(1, "2025-11-01"), (2, "2025-11-02"), (3, "2025-11-02")], "a int, d string").withColumn("d", F.to_date("d"))
    for _again in range(2):
        assert tuple(writers.append_partitioned(frame, folder + "/log", "d", "one").first()) == (3, 2)
    writers.append_partitioned(frame, folder + "/log", "d", "two")
    log = writers.read_log(spark, folder + "/log", frame.schema)
    assert log.count() == 6 and {r[0] for r in log.select("load_id").distinct().collect()} == {"one", "two"}
    with pytest.raises(writers.NothingToLoad):
        writers.append_partitioned(frame.filter("a > 9"), folder + "/log", "d", "three")


def test_replace_by_key_treats_null_keys_as_equal(spark, folder):
    schema = "source_gcs_uri string, source_page_range string, v int"
    old = spark.createDataFrame([("a", "1-2", 0), ("a", None, 0), ("b", "1-2", 0), (None, None, 0)], schema)
    new = spark.createDataFrame([("a", None, 1), (None, None, 1), ("c", "1-2", 1)], schema)
    want = [("a", "1-2", 0), ("a", None, 1), ("b", "1-2", 0), ("c", "1-2", 1), (None, None, 1)]
    assert rows_of(writers.replace_by_key(old, new, man.KEY)) == sorted(want, key=repr)
    table = writers.KeyedTable(spark, folder + "/t", man.KEY, old.schema, buckets=4)
    assert table.is_empty()
    table.replace(old)
    for _again in range(2):
        table.replace(new)
        assert rows_of(table.read().select(*old.columns)) == sorted(want, key=repr)


def test_a_failed_rewrite_leaves_the_table(spark, folder):
    rows = spark.createDataFrame([(i, "old") for i in range(50)], "k int, v string")
    table = writers.KeyedTable(spark, folder + "/t", ["k"], rows.schema, buckets=4)
    table.append(rows)
    new = rows.limit(30).select("k", F.lit("new").alias("v"))

    def fails(old, fresh):
        merged = writers.replace_by_key(old, fresh, ["k"])
        return merged.withColumn("v", F.when(F.col("k") == 7, F.raise_error("broken off")).otherwise(F.col("v")))

    def folders():
        return sorted(name for name in os.listdir(folder + "/t") if not name.startswith((".", "_SUCCESS")))

    with pytest.raises(Exception, match="broken off"):
        table._rewrite(new, fails)
    assert rows_of(table.read()) == rows_of(rows)
    before = folders()
    assert table.replace(new) > 0
    assert table.read().filter("v = 'new'").count() == 30 and table.read().count() == 50
    assert folders() == before == [f"key_bucket={i}" for i in range(4)]
    table.append(rows.limit(1))
    assert table.read().count() == 51
    with pytest.raises(ValueError, match="declares no"):
        table.append(rows.withColumn("w", F.lit(1)))
    assert table.read().count() == 51


def test_a_failed_reload_leaves_the_load(spark, folder):
    frame = spark.createDataFrame([(i, dt.date(2025, 1, 1 + i % 3)) for i in range(30)], "a int, d date")
    writers.append_partitioned(frame, folder + "/log", "d", "one")
    broken = frame.withColumn("a", F.when(F.col("a") == 29, F.raise_error("broken off")).otherwise(F.col("a")))
    with pytest.raises(Exception, match="broken off"):
        writers.append_partitioned(broken, folder + "/log", "d", "one")
    assert writers.read_log(spark, folder + "/log", frame.schema).count() == 30
    # A shorter run of the load takes the place of the whole of it, dates that it lacks included.
    assert tuple(writers.append_partitioned(frame.filter("d = '2025-01-02'"), folder + "/log", "d", "one").first()) == (10, 1)
    assert writers.read_log(spark, folder + "/log", frame.schema).count() == 10
    assert os.listdir(folder + "/log") == ["load_id=one"]


def test_scratch_needs_a_shared_folder(spark, monkeypatch):
    class Cluster:
        master = "spark://host:7077"

    class Session:
        conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: default)})
        sparkContext = Cluster

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(Session, "x")


def test_replace_by_folder_leaves_nameless_rows(spark):
    old = spark.createDataFrame([("x", 0), ("y", 0), (None, 0), ("", 0)], "folder_name string, v int")
    new = spark.createDataFrame([("x", 1), (None, 1)], "folder_name string, v int")
    assert rows_of(writers.replace_by_folder(old, new)) == sorted([("x", 1), ("y", 0), (None, 0), ("", 0), (None, 1)], key=repr)
    assert writers.replace_by_folder(old, new, replace=False).count() == 6


def test_conform_turns_bad_values_to_null(spark):
    raw = spark.createDataFrame([("x", "2025-02-30", "7", ["a"], "maybe"), ("y", "2025-02-03", "7.5", None, "true")],
                                "file_name string, report_date string, flagged_question_count string, issues array<string>, needs_review string")
    got = layouts.conform(raw, layouts.FILE_QUALITY)
    assert got.columns == [n for n, _k, _c in layouts.FILE_QUALITY]
    assert [tuple(r) for r in got.select("report_date", "flagged_question_count", "issues", "unreadable_areas", "needs_review").collect()] == [
        (None, 7, ["a"], [], None), (dt.date(2025, 2, 3), None, [], [], True)]
    wider = layouts.evolve(raw, layouts.FILE_QUALITY)
    assert set(raw.columns) <= set(wider.columns) and dict(wider.dtypes)["report_date"] == "string"


def test_feedback_twice_is_feedback_once(spark):
    v = Views(spark, SMALL)
    synced = fb.sync_feedback(v["fx_responses"], None)
    assert fb.sync_feedback(v["fx_responses"], synced).count() == synced.count()
    once = fb.merge_feedback(synced, v["fx_feedback"], F.lit("one.csv"), now())
    twice = fb.merge_feedback(once.drop("applied_now"), v["fx_feedback"].withColumn("correct_answer", F.lit("late")), F.lit("two.csv"), now())
    first = once.filter("applied_now").count()
    assert first > 0
    late = twice.filter("applied_now")
    assert late.join(once.filter("applied_now"), fb.KEY, "left_semi").count() == 0
    assert once.filter("updated_with_feedback = false AND applied_now").count() == 0
    doubled = v["fx_feedback"].unionByName(v["fx_feedback"])
    with pytest.raises(fb.DuplicateFeedback):
        fb.merge_feedback(synced, doubled, F.lit("x"), now())


def test_feedback_guards(spark):
    schema = "folder_name string, file_name string, question_number string, survey_answer string, needs_review boolean"
    base = fb.sync_feedback(spark.createDataFrame([("d", "f", q, "old", True) for q in "1234"] + [(None, "f", "1", "old", True)], schema), None)
    base = base.withColumn("updated_with_feedback", F.when(F.col("question_number") == "2", F.lit(False)))
    sheet = spark.createDataFrame([("d", "f", "1", "N/A"), ("d", "f", "2", "x"), ("d", "f", "3", ""), (None, "f", "1", "x")],
                                  "folder_name string, file_name string, question_number string, correct_answer string")
    got = fb.merge_feedback(base, sheet, F.lit("s.csv"), now())
    assert rows_of(got.filter("applied_now").select("question_number", "survey_answer", "ingested_from")) == [("1", "N/A", "s.csv")]
    assert fb.pending_feedback(got).count() == 3


def test_missing_export_is_an_error(spark):
    v = Views(spark, SMALL)
    with pytest.raises(jobs.MissingExport):
        jobs.ingest_latest(spark, v["fx_exports"], "other_", v["fx_responses"], None, now())


def test_units_found_and_missing_make_the_whole(spark):
    v = Views(spark, SMALL)
    sources = v["fx_source"].select("source_gcs_uri", "page_count")
    manifest = v["fx_manifest"].withColumn("source_file", F.lit("f")).withColumn("rejected", F.lit(False)).withColumn(
        "rejected_reason", F.lit(None).cast("string"))
    missing = aud.missing_units(sources, manifest, 2).select(*man.KEY)
    expected = man.expand_units(sources, 2).join(manifest.select("source_gcs_uri").distinct(), "source_gcs_uri", "left_semi")
    assert rows_of(missing.unionByName(manifest.select(*man.KEY))) == rows_of(expected.select(*man.KEY))


def test_exact_unit_and_first_units(spark):
    source = spark.createDataFrame([("gs://b/s.pdf", 10), ("gs://b/bad.pdf", 7), ("gs://b/empty.pdf", 0)], "source_gcs_uri string, page_count int")
    assert rows_of(man.expand_units(source, 2, only_range=(3, 4)).select("output_name")) == [("s_p2.pdf",)]
    assert man.expand_units(source, 2, only_range=(2, 3)).count() == 0
    assert man.expand_units(source, 2, max_units=3).count() == 3
    assert man.expand_units(source, 2).count() == 5


def test_copies_of_a_unit_keep_one(spark):
    unit = ("gs://b/s.pdf", 1, "s_p1.pdf", "normal", None, "note")
    units = spark.createDataFrame([unit] * 4 + [("gs://b/s.pdf", 3, "s_p1.pdf", "normal", None, None)],
                                  "source_gcs_uri string, page_start int, output_name string, output_category string, rejected_reason string, needs_review_reason string")
    got = man.flag_duplicate_names(units).collect()
    assert sum(r.has_destination for r in got) == 1 and len(got) == 5
    assert all(r.output_category == "rejected" for r in got if not r.has_destination)


def _answers(spark, rows):
    return spark.createDataFrame(rows, "folder_name string, file_name string, report_date date, survey_question string, survey_answer string, "
                                       "needs_review boolean, review_note string")


def test_heavy_file_is_one_row(spark, folder):
    """One file holds a third of all answers, with two notes: one row, as long as its form; stored and read again alike."""
    hot = [("d", "hot.pdf", dt.date(2025, 1, 1), f"{i % 3 + 1}. q", "a", i % 4 != 0, "answer does not match choice" if i % 3 else "") for i in range(1200)]
    rest = [("d", f"f{i}.pdf", None, "1. q", "a", i % 2 == 0, None) for i in range(2400)]
    frame = _answers(spark, hot + rest)
    whole = rollup.file_quality(frame, now())
    assert whole.count() == 2401
    row = whole.filter("file_name = 'hot.pdf'").first()
    assert (row.flagged_question_count, row.total_question_count) == (900, 1200)
    assert len(row.issues) == 3 and all(x.endswith(" (x300)") for x in [*row.issues, *row.unreadable_areas])
    assert rollup.file_issues(frame).filter("file_name = 'hot.pdf'").count() == 900
    assert tuple(rollup.quality_totals(frame).first()) == (2401, 3600, 1201)
    table = writers.KeyedTable(spark, folder + "/fq", ["folder_name", "file_name"], layouts.struct_of(layouts.FILE_QUALITY), buckets=4, by_folder=True)
    jobs.refresh_file_quality(table, frame, now())
    stored = table.read()
    assert stored.count() == 2401 and stored.filter("file_name = 'hot.pdf'").first().issues == row.issues


def test_one_question_with_several_notes(spark):
    rows = [("d", "f.pdf", None, "2. q", "a", True, n) for n in ("first", "second")] + [("d", "f.pdf", None, "7. q", "a", True, "alone")]
    row = rollup.file_quality(_answers(spark, rows), now()).first()
    assert len(row.unreadable_areas) == 2
    assert row.unreadable_areas[0].endswith("): several notes (x2)") and row.unreadable_areas[1].endswith("): alone")


def test_roll_up_meets_the_answers_twice(spark):
    """Two exchanges, by question and by file; the texts are made from rows, not by walking a file's list for each question."""
    rows = [("d", "f.pdf", None, q, "a", True, n) for q, n in [
        ("10. q", "self-reported confidence low"), ("2) q", "no answer text"), ("2) q", "something"), ("2) q", "no answer text"), ("2) q", None),
        ("h1. q", "seen by Cloud Vision"), ("no number", "self-reported confidence low")]]
    frame = _answers(spark, [*rows, ("d", "f.pdf", dt.date(2025, 2, 1), "2) q", "a", False, "no answer text"), ("d", "f.pdf", None, "30. q", "a", None, "x"),
                             (None, "f.pdf", None, "30. q", "a", True, "x"), (None, None, None, None, None, None, None)])
    rolled = rollup.file_quality(frame, now())
    assert rolled._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2
    found = {(r.folder_name, r.file_name): r for r in rolled.collect()}
    low, own, other = "low model confidence", "model self-inconsistent (answer vs. mark position)", "flagged for review"
    vision = "independent OCR cross-check disagreement (Vision couldn't confirm the model's written-text answer)"
    row = found["d", "f.pdf"]
    assert row.issues == [f"QH1: {vision}", f"Q2: {other} (x2)", f"Q2: {own} (x2)", f"Q10: {low}", f"Q?: {low}"]
    assert row.unreadable_areas == ["Question H1 (page 1): seen by Cloud Vision", "Question 2 (page 1): several notes (x4)",
                                    "Question 10 (page 1): self-reported confidence low", "Question ? (page unknown): self-reported confidence low"]
    assert (row.flagged_question_count, row.total_question_count, row.report_date) == (7, 9, dt.date(2025, 2, 1))
    assert row.issue_summary == f"7 of 9 question(s) flagged for review in f.pdf: {'; '.join(row.issues)}."
    assert found[None, "f.pdf"].unreadable_areas == ["Question 30 (page 2): x"] and found[None, "f.pdf"].issues == [f"Q30: {other}"]
    clean = found[None, None]
    assert (clean.issues, clean.unreadable_areas, clean.needs_review, clean.total_question_count) == ([], [], False, 1)


def test_sources_without_pages_are_rejected(spark):
    sources = spark.createDataFrame([("gs://b/zero.pdf", 0), ("gs://b/null.pdf", None), ("gs://b/odd.pdf", 3), ("gs://b/ok.pdf", 4)],
                                    "source_gcs_uri string, page_count int")
    verdicts = spark.createDataFrame([], "source_gcs_uri string, unit_index int, language_verdict string, content_verdict string")
    bad = {r.source_gcs_uri: r for r in man.malformed_sources(sources, verdicts, 2).collect()}
    assert set(bad) == {"gs://b/zero.pdf", "gs://b/null.pdf", "gs://b/odd.pdf"}
    assert bad["gs://b/null.pdf"].rejected_reason.startswith("null.pdf has an unknown number of page(s)")
    assert bad["gs://b/zero.pdf"].source_page_range is None and bad["gs://b/odd.pdf"].source_page_range == "1-3"


def test_no_unit_is_lost_in_silence(spark):
    rows = spark.createDataFrame([("gs://b/a.pdf", "1-2", True, True)],
                                 "source_gcs_uri string, source_page_range string, rejected boolean, needs_review boolean")
    assert man.all_or_error(rows, rows.limit(0)).count() == 1
    with pytest.raises(Exception, match="both rejected and for review: gs://b/a.pdf"):
        man.all_or_error(rows, rows).collect()
    taken = []
    assert man.settled(rows.limit(0), rows, taken.append).count() == 0 and taken[0].count() == 1


def test_an_empty_rerun_leaves_the_log(spark, folder):
    frame = spark.createDataFrame([(1, dt.date(2025, 1, 1))], "a int, d date")
    writers.append_partitioned(frame, folder + "/log", "d", "one")
    with pytest.raises(writers.NothingToLoad):
        writers.append_partitioned(frame.limit(0), folder + "/log", "d", "one")
    assert writers.read_log(spark, folder + "/log", frame.schema).count() == 1


def test_refresh_replaces_its_folders(spark, folder):
    v = Views(spark, SMALL)
    table = writers.KeyedTable(spark, folder + "/fq", ["folder_name", "file_name"], layouts.struct_of(layouts.FILE_QUALITY), buckets=8, by_folder=True)
    rows = jobs.refresh_file_quality(table, v["fx_responses"].filter("folder_name IS NOT NULL"), now())
    n = rows.count()
    names = [r[0] for r in v["fx_responses"].select("folder_name").filter("folder_name IS NOT NULL").distinct().limit(3).collect()]
    jobs.refresh_file_quality(table, v["fx_responses"], now(), folders=names)
    assert table.read().count() == n
    jobs.refresh_file_quality(table, v["fx_responses"], now(), folders=names, dry_run=True)
    assert table.read().count() == n
    jobs.refresh_file_quality(table, v["fx_responses"], now(), folders=names, replace=False)
    assert table.read().count() > n


def test_stream_takes_new_files_once(spark, folder):
    v = Views(spark, SMALL)
    table = writers.KeyedTable(spark, folder + "/manifest", man.KEY, layouts.struct_of(layouts.MANIFEST), buckets=4)
    sources = v["fx_source"].select("source_gcs_uri", "page_count")

    def take():
        files = stream.new_inventory(spark, folder + "/landing", sources.schema)
        q = stream.stream_intake(files, lambda: v["fx_unit_verdict"], table, folder + "/cp", "bucket", "split/", 2, now())
        q.awaitTermination()
        return q.lastProgress["numInputRows"] if q.lastProgress else 0

    sources.filter("source_gcs_uri LIKE '%Nov%'").coalesce(1).write.mode("append").parquet(folder + "/landing")
    take()
    first = table.read().count()
    assert first > 0 and take() == 0 and table.read().count() == first
    sources.filter("source_gcs_uri NOT LIKE '%Nov%'").coalesce(1).write.mode("append").parquet(folder + "/landing")
    take()
    total = table.read()
    assert total.count() == total.select(*man.KEY).distinct().count() > first


def test_stream_judges_a_source_once(spark, folder):
    """Twice in one file, again in a later one, and again after a batch that broke off midway."""
    v = Views(spark, SMALL)
    table = writers.KeyedTable(spark, folder + "/manifest", man.KEY, layouts.struct_of(layouts.MANIFEST), buckets=4)
    judged = []
    good = v["fx_unit_verdict"]

    def take(verdicts):
        files = stream.new_inventory(spark, folder + "/landing", "source_gcs_uri string, page_count int")
        stream.stream_intake(files, verdicts, table, folder + "/cp", "bucket", "split/", 2, now(),
                             lambda rows: judged.append(rows.count())).awaitTermination()

    def broken():
        raise RuntimeError("no verdicts today")

    first = v["fx_source"].filter("page_count % 2 = 0").select("source_gcs_uri", F.col("page_count").cast("int")).orderBy("source_gcs_uri").limit(20)
    first.unionByName(first).coalesce(1).write.parquet(folder + "/landing")
    with pytest.raises(Exception, match="no verdicts today"):
        take(broken)
    assert table.is_empty()
    take(lambda: good)
    rows = rows_of(table.read().select(*man.KEY, "output_category"))
    assert len(rows) == first.agg(F.sum(F.col("page_count") / 2)).first()[0]
    # Were a source judged again, it would now be for review.
    first.coalesce(1).write.mode("append").parquet(folder + "/landing")
    take(lambda: good.limit(0))
    assert rows_of(table.read().select(*man.KEY, "output_category")) == rows
    more = first.limit(1).select(F.lit("gs://bucket/raw/new.pdf").alias("source_gcs_uri"), F.lit(4).alias("page_count"))
    more.unionByName(first).coalesce(1).write.mode("append").parquet(folder + "/landing")
    take(lambda: good.limit(0))
    assert len(rows_of(table.read().select(*man.KEY))) == len(rows) + 2


def test_audit_then_reprocess(spark):
    v = Views(spark, SMALL)
    rows = v["fx_audited"]
    flags = rows.filter("needs_review").select(*man.KEY)
    replaced, old = aud.apply_reprocess(flags, v["fx_source"], v["fx_unit_verdict"], v["fx_listing"], rows, "bucket", "split/", 2, now())
    assert replaced.count() == rows.count()
    assert set(old.columns) == {*man.KEY, "old_uri", "new_uri"}


def test_pending_sources_cut_before_resume(spark):
    manifest = spark.createDataFrame([("c",), ("a",), (None,), ("b",), ("a",)], "source_gcs_uri string")
    done = spark.createDataFrame([("a",)], "source_gcs_uri string")
    assert [r[0] for r in aud.pending_sources(manifest, done).collect()] == ["b", "c", None]
    assert [r[0] for r in aud.pending_sources(manifest, done, limit=2).collect()] == ["b"]


def test_done_log_and_issues_files(spark, folder):
    v = Views(spark, SMALL)
    found = aud.check_destination(readers.manifest_projection(v["fx_audited"]), v["fx_listing"], "bucket")
    writers.write_issues(found, folder + "/issues")
    assert spark.read.option("header", "true").csv(folder + "/issues").count() == found.count()
    writers.append_done_log(v["fx_audited"], folder + "/done")
    done = readers.read_done_log(spark, folder + "/done")
    assert aud.pending_sources(v["fx_audited"], done).count() == 0


def test_a_third_of_the_log_on_one_file(spark):
    from formspark.operators.quality import latest_profile

    log = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("file_name"),
        F.timestamp_seconds("id").alias("profiled_at"), F.col("id").alias("event_id"))
    newest = latest_profile(log, tie="event_id")
    assert newest.count() == 20_001
    assert newest.filter("file_name = 'hot'").first().event_id == 29_997


def test_every_review_rule_fires(spark):
    from formspark.operators import reconcile as rcn

    out = rcn.reconcile(Views(spark, SMALL)["fx_readings"]).filter("review_note IS NOT NULL").collect()
    assert all(r.needs_review for r in out if "auto-corrected" not in r.review_note)
    for phrase in ("does not match choice", "auto-corrected", "kept the model's", "reconciled to", "the model missed", "Cloud Vision read",
                   "blank comment filled", "below 0.7", "genuine skip", "second mark", "cross-out", "6-digit number", "could not be located"):
        assert any(phrase in r.review_note for r in out), phrase


def test_an_unproven_calibration_flags_what_it_corrects(spark):
    from formspark.operators import reconcile as rcn

    rows = [("a", "Agree", "Neutral", 0.1, "grid", True), ("b", "Agree", "Neutral", 0.1, "box", True), ("c", "Agree", "Neutral", 0.2, "box", False)]
    frame = spark.createDataFrame(rows, "q string, model_answer string, pixel_answer string, pixel_margin double, control string, calibration_validated boolean") \
        .withColumns({"pixel_ran": F.lit(True), "model_overrules": F.lit(False)})
    got = {r.q: (r.answer, r.pixel_flag) for r in rcn.pixel_vs_model(frame).collect()}
    assert got == {"a": ("Neutral", False), "b": ("Agree", False), "c": ("Neutral", True)}


def test_new_documents_are_taken_once(spark, folder):
    """Files that appear below a root, streamed twice: each once, others not at all."""
    import os

    root = folder + "/in/batch"
    os.makedirs(root)

    def take():
        files = stream.new_documents(spark, folder + "/in").select("uri", "length")
        q = files.writeStream.format("parquet").option("path", folder + "/out").option("checkpointLocation", folder + "/cp") \
            .trigger(availableNow=True).start()
        q.awaitTermination()
        return sorted(os.path.basename(r.uri) for r in spark.read.schema("uri string, length long").parquet(folder + "/out").collect())

    for name in ("a.pdf", "b.PDF", "c.txt"):
        with open(f"{root}/{name}", "wb") as out:
            out.write(b"%PDF")
    assert take() == ["a.pdf", "b.PDF"]
    with open(f"{root}/d.pdf", "wb") as out:
        out.write(b"%PDF more")
    assert take() == ["a.pdf", "b.PDF", "d.pdf"]
    assert take() == ["a.pdf", "b.PDF", "d.pdf"]


def test_equal_times_give_one_newest_row(spark):
    """However the rows are dealt, and with a map among the columns."""
    from formspark.operators import quality, reconcile

    rows = [(f"f{i % 7}", "gs://b/" + str(i % 3), dt.datetime(2025, 1, 1 + i % 2), i, {"k": i % 5}) for i in range(210)]
    log = spark.createDataFrame(rows, "file_name string, gcs_uri string, profiled_at timestamp, n int, extra map<string,int>")
    dealt = [log.repartition(1), log.repartition(7, "n"), log.orderBy(F.desc("n")).coalesce(3)]
    assert len({str(rows_of(quality.latest_profile(d))) for d in dealt}) == 1
    assert {r.profiled_at.day for r in quality.latest_profile(log).collect()} == {2}
    assert [r.n for r in quality.latest_profile(log, tie="n").orderBy("file_name").collect()] == [
        max(n for f, _u, t, n, _e in rows if f == f"f{k}" and t.day == 2) for k in range(7)]
    files = spark.createDataFrame([(f"gs://b/{i}", f"f{i}") for i in range(7)], "gcs_uri string, file_name string")
    assert len({str(rows_of(reconcile.tiered_lookup(files, d))) for d in dealt}) == 1


def test_rules_that_cannot_be_meant(spark):
    from formspark.operators import reconcile

    rules = spark.createDataFrame(
        [("1", "digits", 6, None, None, None), ("2", "roman", None, None, None, None), ("3", "digits", 0, None, None, None),
         ("4", "integer", None, None, 5.0, 4.0), ("5", "date", None, "DD.MM", None, None), ("6", None, None, None, None, None)],
        "question_number string, answer_format string, format_digits int, date_format string, minimum double, maximum double")
    got = {r.question_number: r.reason for r in reconcile.constraint_violations(rules).collect()}
    assert set(got) == {"2", "3", "4", "5"} and "roman" in got["2"]


def test_rules_of_a_form_hold_for_its_answers_only(spark):
    from formspark.operators import reconcile

    rules = spark.createDataFrame([("a", "1", "digits", 2), ("b", "1", "integer", None)],
                                  "form_id string, question_number string, answer_format string, format_digits int")
    rows = spark.createDataFrame([("a", "1", "123"), ("b", "1", "123"), ("b", "1", "x"), ("a", "2", "x"), ("c", "1", "x")],
                                 "form_id string, question_number string, answer string")
    got = [(r.form_id, r.answer, r.note) for r in reconcile.with_rules(rows, rules).select("*", reconcile.format_note().alias("note")).collect()]
    assert sorted(got, key=str) == sorted([("a", "123", "should be a 2-digit number"), ("b", "123", None), ("b", "x", "should be a whole number"),
                                  ("a", "x", None), ("c", "x", None)], key=str)


def test_audit_reads_what_changed(spark, folder):
    v = Views(spark, SMALL)
    manifest, sources, listing, verdicts = v["fx_audited"], v["fx_source"], v["fx_listing"], v["fx_unit_verdict"]
    shape = T.StructType.fromDDL("source_gcs_uri string, source_page_range string, issues string")
    issues = writers.KeyedTable(spark, folder + "/issues", ["source_gcs_uri"], shape, buckets=4)
    audited = writers.KeyedTable(spark, folder + "/audited", ["source_gcs_uri"], T.StructType.fromDDL("source_gcs_uri string, digest string"), buckets=4)
    shown = ("source_gcs_uri", "source_page_range", "issues")

    def run(manifest=manifest, listing=listing, verdicts=verdicts, limit=None):
        n = jobs.audit_changes(issues, audited, manifest, sources, listing, verdicts, "bucket", "split/", 2, limit=limit)
        whole = writers.issue_rows(aud.audit(manifest, sources, listing, verdicts, "bucket", "split/", 2)).select(*shown)
        return n, rows_of(issues.read().select(*shown)) == rows_of(whole)

    total = manifest.select("source_gcs_uri").distinct().count()
    assert run(limit=3) == (3, False)
    assert run() == (total - 3, True)
    assert run(manifest=manifest.repartition(5)) == (0, True)
    several = manifest.groupBy("source_gcs_uri").count().filter("count > 2")
    there = verdicts.join(several, "source_gcs_uri").join(listing, F.col("source_gcs_uri") == F.col("uri"))
    one, other = (r[0] for r in there.select("source_gcs_uri").distinct().orderBy("source_gcs_uri").limit(2).collect())
    changed = verdicts.withColumn("content_verdict", F.when(F.col("source_gcs_uri") == one, "BLANK").otherwise(F.col("content_verdict")))
    assert run(verdicts=changed) == (1, True)
    lost = listing.filter(F.col("uri") != other)
    assert run(verdicts=changed, listing=lost) == (1, True)
    # A source that is well again loses its issues; one that is gone from the manifest keeps its last ones.
    fewer = manifest.filter(~F.col("source_gcs_uri").eqNullSafe(F.lit(one)) | (F.col("source_page_range") == "1-2"))
    assert run(manifest=fewer, verdicts=changed, listing=lost) == (1, True)

    class Broken(writers.KeyedTable):
        def replace(self, *rows):
            raise OSError("no room")

    state = rows_of(audited.read())
    held, issues = issues, Broken(spark, folder + "/issues", ["source_gcs_uri"], shape, buckets=4)
    with pytest.raises(OSError, match="no room"):
        run()
    issues = held
    assert rows_of(audited.read()) == state
    assert run()[1]


def test_keys_go_without_new_rows(spark, folder):
    rows = spark.createDataFrame([(k, i) for k in ("a", "b", "c", None) for i in range(3)], "k string, i int")
    table = writers.KeyedTable(spark, folder + "/t", ["k"], rows.schema, buckets=64)
    table.append(rows)
    table.replace(rows.filter("k = 'a' AND i = 0"), rows.filter("k IS NULL OR k IN ('a', 'b')").select("k"))
    assert rows_of(table.read()) == sorted([("a", 0), ("c", 0), ("c", 1), ("c", 2)], key=repr)
    table.replace(rows.limit(0), rows.select("k"))
    assert table.is_empty() and [f for f in os.listdir(folder + "/t") if f.startswith("key")] == []


def test_a_sheet_loaded_again_rewrites_nothing(spark, folder):
    """Rows under one key, some answered, stay whole when another is answered; null keys are known again."""
    table = writers.KeyedTable(spark, folder + "/fb", fb.KEY, layouts.struct_of(layouts.FEEDBACK), buckets=4)
    rows = [("d", "f", "1", "a"), ("d", "f", "2", "b"), ("d", "g", "1", "c"), (None, "f", "1", "e"), ("d", None, None, "g")]
    responses = spark.createDataFrame(rows, "folder_name string, file_name string, question_number string, survey_answer string")

    def load(name, *given):
        spark.createDataFrame(given, "folder_name string, file_name string, question_number string, correct_answer string") \
            .coalesce(1).write.option("header", "true").csv(f"{folder}/in/{name}")
        listing = spark.createDataFrame([(f"{folder}/in/{name}",)], "object_name string")
        return jobs.load_feedback(table, listing, "review_", responses, now())

    def files():
        return sorted(str(f) for f in os.walk(folder + "/fb"))

    def answers():
        return rows_of(table.read().select(*fb.KEY, "survey_answer", "updated_with_feedback"))

    assert load("review_20250101_000000.csv", ("d", "f", "1", "A")) == 1
    want = [("d", "f", "1", "A", True), ("d", "f", "2", "b", None), ("d", "g", "1", "c", None), (None, "f", "1", "e", None), ("d", None, None, "g", None)]
    assert answers() == sorted(want, key=repr)
    before = files()
    assert load("review_20250102_000000.csv", ("d", "f", "1", "A")) == 0 and files() == before
    # A second row of an answered key, and a new answer.
    table.append(table.read().filter("survey_answer = 'A'").withColumns(
        {"survey_answer": F.lit("z"), "updated_with_feedback": F.lit(None).cast("boolean")}))
    responses = responses.unionByName(spark.createDataFrame([("d", "h", None, "n")], responses.schema))
    assert load("review_20250103_000000.csv", ("d", "f", "1", "B"), ("d", "g", "1", "C")) == 2
    want = [("d", "f", "1", "A", True), ("d", "f", "1", "B", True), ("d", "f", "2", "b", None), ("d", "g", "1", "C", True),
            (None, "f", "1", "e", None), ("d", None, None, "g", None), ("d", "h", None, "n", None)]
    assert answers() == sorted(want, key=repr)


def test_a_first_load_is_written_once(spark, folder, monkeypatch):
    copies, saved = [], writers.saved
    monkeypatch.setattr(writers, "saved", lambda df: copies.append(1) or saved(df))
    rows = spark.createDataFrame([(i, "old") for i in range(50)], "k int, v string")
    table = writers.KeyedTable(spark, folder + "/t", ["k"], rows.schema, buckets=4)
    assert table.replace(rows) == 4 and copies == []
    assert table.replace(rows.filter("k < 9").withColumn("v", F.lit("new"))) > 0 and copies == [1]
    assert table.read().filter("v = 'new'").count() == 9 and table.read().count() == 50


def test_an_audit_reads_its_rows_from_a_copy(spark, folder, monkeypatch):
    """The rows of the sources due are picked out once, not for each check."""
    v, plans, audit = Views(spark, SMALL), [], aud.audit
    monkeypatch.setattr(aud, "audit", lambda rows, *more: plans.append(
        rows._jdf.queryExecution().optimizedPlan().toString()) or audit(rows.limit(0), *more))
    table = [writers.KeyedTable(spark, f"{folder}/{name}", ["source_gcs_uri"], T.StructType.fromDDL(f"source_gcs_uri string, {rest}"), buckets=2)
             for name, rest in (("issues", "source_page_range string, issues string"), ("audited", "digest string"))]
    jobs.audit_changes(*table, v["fx_audited"], v["fx_source"], v["fx_listing"], v["fx_unit_verdict"], "bucket", "split/", 2)
    assert len(plans) == 1 and "Join" not in plans[0]


def test_a_batch_goes_through_the_state_once(spark, folder):
    v = Views(spark, SMALL)
    table = writers.KeyedTable(spark, folder + "/manifest", man.KEY, layouts.struct_of(layouts.MANIFEST), buckets=4)
    sources = v["fx_source"].select("source_gcs_uri", "page_count")
    sources.coalesce(1).write.parquet(folder + "/landing")
    q = stream.stream_intake(stream.new_inventory(spark, folder + "/landing", sources.schema), lambda: v["fx_unit_verdict"], table,
                             folder + "/cp", "bucket", "split/", 2, now())
    q.awaitTermination()
    assert sum(p["numInputRows"] for p in q.recentProgress) == sources.count()
