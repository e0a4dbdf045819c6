"""Text files, the table store and the batch jobs that write them."""

from __future__ import annotations

import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from vellumflow import vocabulary as V
from vellumflow.operators.governance import key_violations
from vellumflow.plans import extract, projection, summarize, upload
from vellumflow.schemas import EXTRACTED_DOCUMENTS, JOB_EVENTS
from vellumflow.sources import files
from vellumflow.sources.store import TableStore, named_table, rows_to_frame

NOW = at("2024-01-02 12:00:00")


def folder_of(tmp_path, **texts):
    for name, body in texts.items():
        (tmp_path / f"{name}.txt").write_bytes(body.encode())
    return str(tmp_path)


def test_read_whole_files(spark, tmp_path):
    where = folder_of(tmp_path, a="one\r\n\r\ntwo\n", b="\n", c="'quoted' ünï")
    got = files.read_documents(spark, where).select(F.element_at(F.split("document_path", "/"), -1).alias("f"), "extracted_text")
    assert rows(got, "f", "extracted_text") == [("a.txt", "one\n\ntwo\n"), ("b.txt", "\n"), ("c.txt", "'quoted' ünï")]


def test_list_and_get(spark, tmp_path):
    where = folder_of(tmp_path, p1_a="x", p1_b="yy", p2_a="zzz")
    (tmp_path / "other.csv").write_text("no")
    assert [(r.file_name, r.size) for r in files.list_summaries(spark, where).collect()] == [
        ("p2_a.txt", 3), ("p1_b.txt", 2), ("p1_a.txt", 1)
    ]
    assert files.list_summaries(spark, where, "p1").count() == 2
    wanted = spark.createDataFrame([("p1_a.txt",), ("missing.txt",)], "file_name string")
    got = files.get_summaries(files.read_documents(spark, where), wanted)
    assert rows(got, "file_name", "status", "content") == [("missing.txt", "failed", None), ("p1_a.txt", "success", "x")]


def test_rendered_files_round_trip(spark, tmp_path):
    su = spark.createDataFrame(
        [("1", 11, 12, "line one\nline two"), ("2", 21, 22, None)],
        "patient_id string, extraction_run_id long, summarization_run_id long, summary_text string",
    )
    rendered = upload.render_summaries(su, NOW)
    where = files.write_text_files(rendered, str(tmp_path / "out"))
    assert [r.file_name for r in files.list_summaries(spark, where).collect()] == [
        "oncology_summary_2_20240102_120000.txt", "oncology_summary_1_20240102_120000.txt"
    ]
    got = files.get_summaries(files.read_documents(spark, where), rendered.filter("patient_id = '1'")).first().content
    rule = "=" * 80
    assert got.split("\n") == [
        rule, "ONCOLOGY SUMMARY - Patient 1", rule, "Generated: 2024-01-02T12:00:00", "Extraction Run ID: 11",
        "Summarization Run ID: 12", rule, "", "line one", "line two",
    ]


def test_event_table_prunes_by_day(spark, tmp_path, make_log):
    store = TableStore(spark, str(tmp_path))
    store.append("job_events", make_log(("1", "JobStarted", 1, "extraction_agent", "u", "2024-01-01 00:00:00")))
    store.append("job_events", make_log(("2", "JobStarted", 2, "extraction_agent", "u", "2024-01-02 00:00:00")))
    assert store.read("job_events").schema.simpleString() == JOB_EVENTS.simpleString()
    assert rows(store.read("job_events"), "event_id") == [("1",), ("2",)]
    assert sorted(p.name for p in (tmp_path / "job_events").glob("event_date=*")) == ["event_date=2024-01-01", "event_date=2024-01-02"]
    store.register("job_events")
    assert named_table(spark, "job_events").count() == 2


def test_rows_get_the_declared_types(spark):
    df = rows_to_frame(spark, [{"extraction_id": "a", "extraction_run_id": 1, "document_path": "/p", "page_count": 2}], "extracted_documents")
    assert df.schema == EXTRACTED_DOCUMENTS and df.first().page_count == 2


def test_run_extract_stores_text_and_events(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    folder_of(source, run_1="a\n\nb", run_2="it's", run_3="x")
    (source / "run_4.bad").write_text("no")
    store = TableStore(spark, str(tmp_path / "tables"))
    run = F.regexp_extract("document_path", r"run_([0-9]+)", 1).cast("long")
    batch = extract.run_extract(spark, store, str(source), run, F.lit("user"), NOW, suffix=".txt", prefix="file:")
    assert rows(batch.rejected, "reason") == [(V.BAD_SUFFIX,)]
    assert rows(store.read("extracted_documents"), "extraction_id", "page_count", "extracted_text") == [
        ("extract_1", 2, "a\n\nb"), ("extract_2", 1, "it's"), ("extract_3", 1, "x")
    ]
    log = store.read("job_events")
    assert rows(log, "run_id", "event_type", "status", "triggered_by") == [
        (i, "ExtractionJobCompleted", "SUCCESS", "user") for i in (1, 2, 3)
    ]
    pages = log.select("run_id", F.get_json_object("details", "$.pages_extracted").alias("n"))
    assert rows(pages, "run_id", "n") == [(1, "2"), (2, "1"), (3, "1")]


def test_whole_chain_and_its_repetition(spark, tmp_path):
    """Extract, summarize with a model that fails once, upload; twice."""
    source = tmp_path / "in"
    source.mkdir()
    folder_of(source, run_1="First. Second.", run_2="bad text", run_3="Third.")
    store = TableStore(spark, str(tmp_path / "tables"))
    out = str(tmp_path / "out")
    run = F.regexp_extract("document_path", r"run_([0-9]+)", 1).cast("long")

    def load():
        def model(text):
            if "bad" in text:
                raise ValueError("refused")
            return text.upper()

        return model

    for _ in range(2):
        extract.run_extract(spark, store, str(source), run, F.lit("u"), NOW, suffix=".txt", prefix="file:")
        summarize.run_summarize(spark, store, F.col("extraction_run_id") + 100, F.lit("u"), NOW, load, "upper")
        upload.run_upload(spark, store, out, "https://s", NOW)
    # A later run finds nothing left to publish.
    later = upload.run_upload(spark, store, out, "https://s", at("2024-01-05 12:00:00"))
    assert rows(later, "summarization_run_id", "event_type") == [(102, None)]  # failed, so not ready
    assert rows(store.read("summaries"), "summary_id", "summary_text") == [
        ("summary_101", "FIRST. SECOND."), ("summary_103", "THIRD.")
    ]
    assert rows(store.read("job_events"), "run_id", "event_type", "status") == sorted(
        [(i, "ExtractionJobCompleted", "SUCCESS") for i in (1, 2, 3)]
        + [(101, "SummarizationJobCompleted", "SUCCESS"), (102, "SummarizationJobFailed", "FAILED")]
        + [(103, "SummarizationJobCompleted", "SUCCESS")]
        + [(0, "SharePointUploadCompleted", "COMPLETED")] * 2,
        key=repr,
    )
    assert [r.file_name for r in files.list_summaries(spark, out).collect()] == [
        "oncology_summary_103_20240102_120000.txt", "oncology_summary_101_20240102_120000.txt"
    ]
    state = projection.workflow_state_from_events(store.read("job_events"))
    assert rows(state, "extraction_run_id", "current_stage", "status") == [
        (1, "completed", "completed"), (2, "summarizing", "failed"), (3, "completed", "completed")
    ]


def test_repeating_a_job_repeats_its_event_ids(spark, tmp_path):
    runs = spark.createDataFrame([(1, "u", "/a")], "run_id long, triggered_by string, document_path string")
    store = TableStore(spark, str(tmp_path))
    assert not store.exists("job_events")
    for _ in range(2):
        store.append("job_events", extract.start_events(runs, NOW))
    assert rows(key_violations({"job_events": (store.read("job_events"), "event_id")}), "n") == [(2,)]
    assert store.read("job_events").dropDuplicates(["event_id"]).count() == 1
    store.append_new("job_events", extract.start_events(runs.withColumn("run_id", F.lit(2)), NOW))
    store.append_new("job_events", extract.start_events(runs, NOW))
    assert rows(store.read("job_events"), "run_id") == [(1,), (1,), (2,)]


def documents(spark, *texts):
    full = [(f"extract_{i}", i, f"/source_pdfs/{i}.pdf", t, 1, NOW, "x") for i, t in enumerate(texts, 1)]
    return spark.createDataFrame(full, EXTRACTED_DOCUMENTS)


def test_supplied_model_and_its_errors(spark):
    def load():
        import os

        seen = os.getpid()  # stands for a model loaded once per task

        def model(text):
            if text is None or "bad" in text:
                raise ValueError("cannot read")
            return f"{len(text)} chars" if seen else ""

        return model

    got = summarize.summarize(documents(spark, "hello", "bad one", None, ""), load)
    assert rows(got, "extraction_id", "summary_text", "error") == [
        ("extract_1", "5 chars", None), ("extract_2", None, "cannot read"), ("extract_3", None, "cannot read"), ("extract_4", "0 chars", None)
    ]


def test_summaries_pass_the_gate(spark, make_log):
    log = make_log(
        ("1", "ExtractionJobCompleted", 1, "extraction_agent", "u", "2024-01-01 00:00:00"),
        ("2", "ExtractionJobFailed", 2, "extraction_agent", "u", "2024-01-01 00:00:00"),
        ("3", "ExtractionJobCompleted", 3, "extraction_agent", "u", "2024-01-01 00:00:00"),
        ("4", "ExtractionJobCompleted", 9, "extraction_agent", "u", "2024-01-01 00:00:00"),
    )
    su = summarize.summarize_ready(log, documents(spark, "One. Two.", "x", ""), F.col("extraction_run_id") + 100, NOW)
    assert rows(su, "summary_id", "summary_text") == [("summary_101", "One. Two."), ("summary_103", "")]
    done = summarize.completion_events(su, F.lit("u"), NOW)
    ratios = done.select("run_id", F.get_json_object("details", "$.compression_ratio").alias("c"))
    assert rows(ratios, "run_id", "c") == [(101, "1.0"), (103, None)]


NAMES = ["plain.txt", "my doc.txt", "a:b.txt", "100%.txt", "x=y+z.txt", "ünï.txt"]


def test_names_and_bytes_survive(spark, tmp_path):
    contents = {n: c for n, c in zip(NAMES, ["p", "p\n", "", "two\nlines\n\n", "ü", "\n"])}
    rendered = spark.createDataFrame(list(contents.items()), "file_name string, content string")
    where = files.write_text_files(rendered, str(tmp_path / "out"))
    assert {(r.file_name, r.size) for r in files.list_summaries(spark, where).collect()} == {(n, len(c.encode())) for n, c in contents.items()}
    got = files.get_summaries(files.read_documents(spark, where), rendered)
    assert {(r.file_name, r.status, r.content) for r in got.collect()} == {(n, "success", c) for n, c in contents.items()}
    files.write_text_files(rendered.filter("file_name = 'a:b.txt'").withColumn("content", F.lit("new")), where)
    got = files.get_summaries(files.read_documents(spark, where), rendered)
    assert {r.file_name: r.content for r in got.collect()} == {**contents, "a:b.txt": "new"}


def test_foreign_files_of_zero_bytes_and_odd_names(spark, tmp_path):
    (tmp_path / "empty.txt").write_bytes(b"")
    (tmp_path / "patient one.txt").write_bytes(b"x\n")
    got = {r.document_path.rsplit("/", 1)[1]: r.extracted_text for r in files.read_documents(spark, str(tmp_path)).collect()}
    assert got == {"empty.txt": "", "patient one.txt": "x\n"}
    assert {(r.file_name, r.size) for r in files.list_summaries(spark, str(tmp_path)).collect()} == {("empty.txt", 0), ("patient one.txt", 2)}


def test_appends_keep_one_row_per_key_and_prune_days(spark, tmp_path, make_log):
    store = TableStore(spark, str(tmp_path))
    log = make_log(*[(str(k), "ExtractionJobStarted", k, "extraction_agent", "u", f"2024-01-{k + 1:02d} 10:00:00") for k in range(9)])
    for _ in range(2):
        store.append_new("job_events", log.unionByName(log))
    assert store.read("job_events").count() == 9
    few = store.read("job_events", at("2024-01-03 00:00:00"), at("2024-01-04 23:00:00"))
    assert few.count() == 2
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    prompts = spark.createDataFrame([("p", 1, "a"), ("p", 2, "b"), ("p", 2, "b")], "prompt_id string, version int, content string")
    for _ in range(2):
        store.append_new("prompts", prompts)
    assert store.read("prompts").count() == 2


def test_listing_costs_no_call_and_no_task_per_file(spark, tmp_path, monkeypatch):
    where = {n: files.write_text_files(spark.range(n).select(F.concat(F.lit("d"), "id", F.lit(".txt")).alias("file_name"), F.lit("x").alias("content")), str(tmp_path / str(n))) for n in (40, 240)}
    client, calls = type(spark.sparkContext._gateway._gateway_client), []
    send = client.send_command
    monkeypatch.setattr(client, "send_command", lambda self, command, *a, **b: (calls.append(command[0]), send(self, command, *a, **b))[1])

    def cost(read, n):
        calls.clear()
        read(spark, where[n])
        return len(calls) - calls.count("m")  # without what the garbage collector sends

    for read in (files.read_documents, files.list_summaries):
        cost(read, 40)  # loads classes
        assert cost(read, 240) - cost(read, 40) < 100
    monkeypatch.undo()
    spark.sparkContext.setJobGroup("listing", "listing")
    got = files.read_documents(spark, where[240])
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    listing = [tracker.getStageInfo(s).numTasks for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    assert listing and max(listing) <= files.TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    assert got.rdd.getNumPartitions() <= files.TASKS_PER_CORE * spark.sparkContext.defaultParallelism and got.count() == 240


def tree(folder):
    """Contents by folder, hidden files left out."""
    found = {}
    for p in folder.glob("*/part-*"):
        found.setdefault(str(p.parent.relative_to(folder)), []).append(p.read_bytes())
    return {k: sorted(v) for k, v in found.items()}


def test_sink_lays_files_out_as_sparks_writer(spark, tmp_path):
    signs = "".join(map(chr, [*range(1, 47), *range(48, 300), 0x2603, 0x1F600]))
    named = [(f"n{c}.txt", f"of {c}") for c in signs] + [("twice", "a"), ("twice", "a"), ("", "no name"), (None, "null"), ("none", None), ("end", "x\r\n")]
    rendered = spark.createDataFrame(named, "file_name string, content string").repartition(3)
    files.write_text_files(rendered, str(tmp_path / "own"))
    rendered.withColumnRenamed("content", "value").repartition(4, "file_name").write.partitionBy("file_name").text(str(tmp_path / "spark"))
    assert tree(tmp_path / "own") == tree(tmp_path / "spark")
    assert sorted(p.name for p in (tmp_path / "own").iterdir()) == sorted(p.name for p in (tmp_path / "spark").glob("file_name=*"))


def test_a_failed_job_leaves_no_file_and_an_empty_one_a_folder(spark, tmp_path):
    where = str(tmp_path / "out")
    files.write_text_files(spark.createDataFrame([("a", "old")], "file_name string, content string"), where)
    bad = F.when(F.col("id") == 40, F.raise_error(F.lit("broken")).cast("string")).otherwise("new")
    with pytest.raises(Exception, match="broken"):
        files.write_text_files(spark.range(80).select(F.when(F.col("id") == 0, "a").otherwise(F.col("id").cast("string")).alias("file_name"), bad.alias("content")), where)
    assert tree(tmp_path / "out") == {"file_name=a": [b"old\n"]} and len(list((tmp_path / "out").iterdir())) == 1
    none = files.write_text_files(spark.createDataFrame([], "file_name string, content string"), str(tmp_path / "none"))
    assert files.read_documents(spark, none).count() == 0


def test_a_hundred_empty_files_among_others(spark, tmp_path):
    for i in range(100):
        (tmp_path / f"e ü%{i}.txt").write_bytes(b"")
    folder_of(tmp_path, full="x")
    (tmp_path / "_hidden.txt").write_bytes(b"")
    got = {r.document_path.rsplit("/", 1)[1]: r.extracted_text for r in files.read_documents(spark, str(tmp_path)).collect()}
    assert got == {**{f"e ü%{i}.txt": "" for i in range(100)}, "full.txt": "x"}
    assert files.list_summaries(spark, str(tmp_path)).where("size = 0 AND modified_at > '2020-01-01'").count() == 100
