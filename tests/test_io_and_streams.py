"""Sources, sinks and streams."""

import json
import os

import pytest
from pyspark.sql import functions as F

from lakeloom import schemas
from lakeloom.session import table, written
from lakeloom.sources import readers, sinks
from lakeloom.streaming import flows


def test_links_reject_bad_rows(spark):
    good, bad = readers.links(spark.createDataFrame([(1.0, "http://a"), (1.5, "http://b"), (None, "c"), (3.0, " ")], "id double, url string"))
    assert [tuple(r) for r in good.collect()] == [(1, "http://a")]
    assert sorted(r.reason for r in bad.collect()) == ["id is no integer", "id is null", "url is empty"]
    assert readers.links(spark.createDataFrame([(True, "u")], "doc_id boolean, url string"))[1].first().reason == "id is a boolean"


def test_candidate_ids(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"doc_ids": [3, 1, 3]}')
    (tmp_path / "a.txt").write_text("5\nx\n 6 \n")
    assert sorted(r[0] for r in readers.candidate_ids(spark, str(tmp_path / "a.json")).collect()) == [1, 3]
    assert sorted(r[0] for r in readers.candidate_ids(spark, str(tmp_path / "a.txt")).collect()) == [5, 6]


def test_corpus_round_trip(spark, sf, tmp_path):
    rows = spark.createDataFrame(table(spark, sf, "corpus").rdd, schemas.CORPUS_SCHEMA)
    sinks.write_corpus(rows, str(tmp_path / "c"), 50)
    back = readers.corpus(spark, str(tmp_path / "c"), str(tmp_path / "missing"), only_success=False)
    assert back.count() == rows.count() and len(list((tmp_path / "c").glob("*.parquet"))) > 1
    assert readers.corpus(spark, str(tmp_path / "none")).count() == 0
    assert readers.searchable(readers.corpus(spark, str(tmp_path / "c"))).count() > 0
    with pytest.raises(ValueError):
        sinks.write_corpus(rows.drop("url"), str(tmp_path / "d"))


def test_logs_and_profiles(spark, tmp_path):
    (tmp_path / "t.jsonl").write_text("\n".join([json.dumps({"fetch_key": "a", "attempt": 1})] * 2 + ["broken", json.dumps({"attempt": 2})]))
    good, rejected = readers.timing_log(spark, str(tmp_path / "t.jsonl"))
    assert good.count() == 1 and sorted(r.reason for r in rejected.collect()) == ["no fetch_key", "no record"]
    (tmp_path / "c.jsonl").write_text("\n".join(json.dumps({"fetch_key": "a", "attempt": 1, "status": x}) for x in ("SUCCESS", "FAILED")))
    good, rejected = readers.timing_log(spark, str(tmp_path / "c.jsonl"))
    assert good.count() == 0 and {r.reason for r in rejected.collect()} == {"attempt with different values"}
    (tmp_path / "p.csv").write_text("﻿domain,estimated_work\na,1.5\nb,x\n")
    assert [tuple(r) for r in readers.profile_csv(spark, str(tmp_path / "p.csv"))[0].collect()] == [("a", 1.5)]
    (tmp_path / "s.jsonl").write_text('{"doc_id": 1}\n{"doc_id": 1}\n')
    with pytest.raises(Exception, match="document twice"):
        readers.selection_jsonl(spark, str(tmp_path / "s.jsonl")).collect()


def test_metrics_stream_gives_the_closed_windows_of_the_batch(spark, sf, tmp_path):
    log = table(spark, sf, "timing_log")
    log.orderBy("logged_at").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(log.schema).parquet(str(tmp_path / "in"))
    for _ in range(2):  # a second run on the same checkpoint adds nothing
        flows.write_batches(flows.fetch_metrics(stream, late="3650 days"), str(tmp_path / "none"), str(tmp_path / "cp0")).awaitTermination()
        flows.write_batches(flows.fetch_metrics(stream, late="1 hour"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = {(r.window_start, r.domain, r.n_attempts) for r in spark.read.parquet(str(tmp_path / "out")).drop("batch").collect()}
    want = {(r.window_start, r.domain, r.n_attempts) for r in flows.fetch_metrics(log).collect()}
    assert got and got <= want


def test_retry_state_stream(spark, tmp_path):
    schema = "fetch_key string, attempt int, status string, retryable boolean, at double"
    for n, rows in enumerate(([("a", 1, "FAILED", True, 1000.0), ("b", 1, "SUCCESS", False, 1000.0)], [("a", 2, "SUCCESS", False, 1050.0), ("b", 2, "FAILED", True, 1060.0)])):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / f"in/{n}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/*"))
    q = flows.retry_state(stream).writeStream.outputMode("update").foreachBatch(lambda b, i: b.write.mode("overwrite").parquet(str(tmp_path / f"out/batch={i}"))).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    seen = spark.read.parquet(str(tmp_path / "out"))
    last = {r.fetch_key: r.status for r in seen.groupBy("fetch_key").agg(F.max_by("status", "batch").alias("status")).collect()}
    assert last == {"a": "SUCCESS", "b": "SUCCESS"}


def test_ended_targets_leave_the_state(spark, tmp_path):
    schema = "fetch_key string, attempt int, status string, retryable boolean, at double"
    for n, rows in enumerate(([(f"k{i}", 1, "SUCCESS", False, 1000.0 + i) for i in range(20)], [("open", 1, "FAILED", True, 1e6)], [("late", 1, "SUCCESS", False, 1e6 + 1)])):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / f"in/{n}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/*"))
    q = flows.retry_state(stream, forget=3600.0).writeStream.outputMode("update").format("noop").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    assert q.awaitTermination(120)
    held = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    assert max(held) >= 20 and held[-1] == 2


def test_pipeline_is_taken_up_again(spark, tmp_path):
    spark.range(10).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id long").parquet(str(tmp_path / "in"))
    for _ in range(2):
        flows.pipeline(stream, lambda b: b.withColumn("x", F.col("id") * 2), str(tmp_path / "out"), str(tmp_path / "cp"), per_batch=4).awaitTermination(120)
        assert spark.read.parquet(str(tmp_path / "out")).agg(F.sum("x"), F.count("x")).first()[:] == (90, 10)
        spark.range(0).write.mode("append").parquet(str(tmp_path / "in"))


def test_sinks_write_manifests_and_summaries(spark, sf, tmp_path):
    from lakeloom.operators import cleaning, corpus as merging

    clean = cleaning.curate(table(spark, sf, "corpus"))
    if set(schemas.CURATED_SCHEMA.names) <= set(clean.columns):
        sinks.write_curated(clean, str(tmp_path / "curated"))
        back = spark.read.parquet(str(tmp_path / "curated"))
        assert back.columns == schemas.CURATED_SCHEMA.names and back.count() == clean.filter("curation_status = 'CLEAN'").count() > 0
    made = spark.createDataFrame([(1, "a", 3), (1, "b", 4), (2, "c", 5)], "doc_id long, text string, token_count int")
    sinks.write_chunks(made, str(tmp_path / "chunks"), spark.createDataFrame([(9,)], "doc_id long"))
    facts = json.loads(spark.read.text(str(tmp_path / "chunks/manifest")).first().value)
    assert facts == {"n_chunks": 3, "n_docs": 2, "n_missing": 1, "n_tokens": 12, "version": "v1"}
    assigned = spark.createDataFrame([(i, f"d{i % 3}", i % 2) for i in range(20)], "doc_id long, domain string, worker_id int")
    sinks.write_partitions(assigned, str(tmp_path / "parts"))
    assert sorted(tuple(r) for r in spark.read.option("header", "true").csv(str(tmp_path / "parts/summary")).collect()) == [("0", "10", "3"), ("1", "10", "3")]
    rows = spark.createDataFrame(table(spark, sf, "corpus").rdd, schemas.CORPUS_SCHEMA)
    sinks.write_merged(merging.winners(rows), merging.merge_conflicts(rows), str(tmp_path / "merged"))
    assert spark.read.json(str(tmp_path / "merged/summary")).agg(F.sum("n")).first()[0] == rows.select("doc_id").distinct().count()


def test_broken_files_are_named(spark, tmp_path):
    rows = spark.createDataFrame([], schemas.CORPUS_SCHEMA)
    row = (1, "u", None, "d", None, None, "x", None, None, 200, "SUCCESS", 1, 1)
    spark.createDataFrame([row], schemas.CORPUS_SCHEMA).coalesce(1).write.parquet(str(tmp_path / "c"))
    (tmp_path / "c" / "broken.parquet").write_bytes(b"PAR1 nothing")
    assert rows.count() == 0 and [r.path.split("/")[-1] for r in readers.unread_files(spark, str(tmp_path / "c")).collect()] == ["broken.parquet"]


def test_stages_are_dropped(spark):
    from lakeloom import session

    df = written(spark.range(3).toDF("x"), "gone")
    path = df.inputFiles()[0]
    assert session.drop_stages(spark) >= 1 and not os.path.exists(path.removeprefix("file://"))


def test_written_tables_go_to_the_shared_folder(spark):
    df = written(spark.range(5).toDF("x"), "t")
    assert df.count() == 5 and spark.conf.get("spark.checkpoint.dir") in df.inputFiles()[0]


def test_shards(spark, tmp_path):
    from lakeloom.operators import reports

    spark.range(10).coalesce(1).write.parquet(str(tmp_path / "s"))
    rows = spark.read.parquet(str(tmp_path / "s"))
    name = rows.inputFiles()[0].split("/")[-1]
    for expected, checks in (([(name, 10)], set()), ([(name, 9), ("x", 1)], {"row count differs", "shard is missing"}), ([("x", 1)], {"shard is unknown", "shard is missing"})):
        assert {r["check"] for r in reports.shard_check(rows, spark.createDataFrame(expected, "shard_name string, row_count long")).collect()} == checks


def test_reviews(spark):
    from lakeloom.operators import reports

    flags = ", ".join(f"{c} boolean" for c in reports.REVIEW)
    df = spark.createDataFrame([("d", True, True, True, True, True), ("d", True, False, True, True, True), ("e", None, True, True, True, True)], f"domain string, {flags}")
    got = {r.domain: (r.n_rows, r.n_reviewed, r.n_accepted, r.n_not_complete) for r in reports.review_summary(df).collect()}
    assert got == {None: (3, 2, 1, 1), "d": (2, 2, 1, 1), "e": (1, 0, 0, None)} or got["e"][:3] == (1, 0, 0) and got["d"] == (2, 2, 1, 1)
    assert reports.review_summary(df.withColumn(reports.REVIEW[0], reports.F.lit("true"))).filter("n_reviewed > 0").count() == 0


def test_passages_and_needed_chunks(spark):
    from lakeloom.operators import reports

    c = spark.createDataFrame([(1, i, f"c{i}", "w " * 10) for i in range(9)] + [(2, 0, "d0", "x")], "doc_id long, chunk_index int, chunk_id string, text string")
    wide = {(r.doc_id, r.chunk_index): r.n_words for r in reports.wide_passages(c, 35, 2).collect()}
    assert wide[1, 4] == 40 and wide[1, 0] == 30 and wide[2, 0] == 1
    ids = spark.createDataFrame([("c1",), ("d0",)], "chunk_id string")
    assert sorted(r.chunk_id for r in reports.needed_chunks(c, ids, spark.createDataFrame([(2,)], "doc_id long")).collect()) == ["c1", "d0"]
