"""Views keep all rows and whole texts, anti joins remove something, hot keys are
split, storage faults are raised."""

import os
import tempfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from signalmine import session
from signalmine.operators import joins as jn
from signalmine.operators import similarity as sim
from signalmine.operators import text as tx
from signalmine.operators.matching import keys_found_in
from signalmine.plans import jobs
from signalmine.sources import files as fsrc
from signalmine.sources import sinks
from signalmine.sources.fixtures import AS_OF_EVENTS, Fixtures
from signalmine.streaming import jobs as sj


def test_views_keep_all_rows(spark, sf_small):
    fx = Fixtures(spark, sf_small)
    for view, table in (("learning_items", "documents"), ("learning_items_tagged", "documents"), ("kb_texts", "documents"),
                        ("commits", "orders"), ("findings", "events"), ("phase_runs", "lineitem"), ("code_files", "part")):
        assert getattr(fx, view).count() == fx.table(table).count(), view
    turns = fx.table("conversations")
    text = fx.session_lines.groupBy("session_id").agg(F.sum(F.length("line") + 1).alias("n"))
    whole = turns.groupBy("conv_id").agg(F.sum(F.length("text")).alias("n"))
    short = whole.join(text, whole.conv_id == text.session_id, "left").where(text.n.isNull() | (text.n < whole.n))
    assert short.count() == 0


def test_anti_joins_remove_something(spark, sf_small):
    fx = Fixtures(spark, "/root/testdata/sf0.01")
    known = jn.errors_without_item(fx.error_patterns, fx.learning_items, 5).count()
    assert 0 < known < fx.error_patterns.where("not resolved and occurrence_count >= 5").count()
    files = fx.session_lines.select("file_name").distinct()
    assert 0 < jn.sessions_without_item(files, fx.learning_items).count() < files.count()
    docs = fx.kb_docs
    nn = sim.nearest_documents(docs, docs.where("is_recent"), 5)
    linked = jn.unlinked_neighbours(nn, fx.kb_links, docs).count()
    assert jn.unlinked_neighbours(nn, fx.kb_links, docs, fx.kb_texts).count() < linked < nn.count()


def test_every_kind_of_key_is_found(spark):
    keys = ["err-1-b2", "abcdef", "a", "zz", "x.", ".md", "-abcd", "no", "100%", "(a|b)", "plain key", "\\Q", "é-tude", "tude"]
    texts = ["saw err-1-b23 and xabcdefy", "b zz. x.y.md", "q-abcdz 100% (a|b)", "a plain key \\Q \\E", "é-tudes", None, ""]
    k = spark.createDataFrame([(x,) for x in keys], "k string")
    t = spark.createDataFrame(list(enumerate(texts)), "i long, t string")
    got = set(rows(keys_found_in(t, "t", k, "k", text_id_col="i"), "tid", "key"))
    assert got == {(str(i), x) for i, s in enumerate(texts) if s for x in keys if x in s}


def test_hot_duplicate_key_is_split(spark):
    df = spark.range(20000).select(
        "id", F.lit("error").alias("source"), F.when(F.col("id") % 20 > 0, "hot").otherwise(F.col("id").cast("string")).alias("lesson"),
        F.lit(False).alias("applied"))
    out = jn.duplicate_items(df)
    assert out.count() == 19000 - 1
    keyed = jn.dup_keys(df).withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(16)).cast("int"))
    largest = keyed.groupBy("source", "lesson_key", "salt").count().agg(F.max("count")).first()[0]
    assert largest < 0.1 * 20000


def test_wrong_answers_of_before(spark):
    patterns = spark.createDataFrame([("k.1", "d", 9, False), ("k1", "d", 7, False)],
                                     "pattern_key string, description string, occurrence_count int, resolved boolean")
    none = spark.createDataFrame([], "id long, target_skill string, status string, recurrence_count int, created_at timestamp_ntz")
    assert rows(jn.proposal_candidates(patterns, none), "pattern_key") == [("k.1",)]
    reply = spark.createDataFrame([("FOLDER: \nFILE: a.md\nCONTENT: x",), ("FOLDER: f\nFILE: b.md\nCONTENT: y",)], "reply string")
    assert rows(tx.parse_stub_reply(reply), "folder", "file") == [("f", "b.md")]
    lines = spark.createDataFrame([("a", 1, "no front matter"), ("b", 1, "---"), ("b", 2, "title: T"), ("b", 3, "---")],
                                  "path string, line_no int, line string")
    assert rows(tx.task_front_matter(lines), "path", "title", "verification") == [("a", None, "full"), ("b", "T", "full")]
    phases = spark.createDataFrame([(1, 1, 5.0, 10, True, 8.0), (1, 2, 5.0, 10, False, 8.0), (1, 3, 1.0, 1, True, 8.0)],
                                   "run_id int, phase int, cost_usd double, duration_s int, gate_ok boolean, max_budget_usd double")
    r = jobs.phase_ledger_job(phases).first()
    assert (r.total_cost_usd, r.phases_ok, r.phases_failed, r.status) == (10.0, 1, 0, "SUCCESS")


def test_found_miss_may_share_a_document_id(spark):
    docs = spark.createDataFrame([(7, [1.0, 0.0]), (8, [0.0, 1.0])], "doc_id long, embedding array<double>")
    misses = spark.createDataFrame([(7, "q", False, 0.1), (9, "r", False, 0.1), (10, "s", True, 0.1)],
                                   "id long, query string, resolved boolean, best_score double")
    vectors = spark.createDataFrame([(7, [1.0, 0.1]), (9, [-1.0, -1.0])], "id long, embedding array<double>")
    assert rows(sim.resolve_found_misses(misses, vectors, docs), "id", "resolved", "resolved_by") == [
        (7, True, "rag-filler-found"), (9, False, None), (10, True, None)]


def test_nightly_documents_and_ledger(spark, sf_small):
    fx = Fixtures(spark, sf_small)
    ledger = spark.createDataFrame([(1, "completed")], "id long, status string")
    res = jobs.nightly_review_job(fx.learning_items, fx.error_patterns, fx.skill_proposals, fx.findings, AS_OF_EVENTS, run_id=2,
                                  session_lines=fx.session_lines, misses=fx.rag_misses, commits=fx.commits, ledger=ledger,
                                  duration_s=47, report_path="r.md")
    out = os.path.join(tempfile.mkdtemp(), "docs")
    sinks.write_documents(res.playbooks.unionByName(res.stubs), None, out)
    back = spark.read.parquet(out)
    s = res.summary.first()
    assert back.count() == s.playbooks_created + s.rag_gaps_filled
    stub = back.where("path like 'known-issues/%'").first()
    assert stub.content.startswith("---\ntitle: topic ") and "status: todo" in stub.content and "Dreaming Run #2" in stub.content
    done = {r.id: r for r in res.ledger.collect()}
    assert done[2].status == "completed" and done[2].rag_gaps_filled == s.rag_gaps_filled and done[2].duration_seconds == 47
    assert done[1].status == "completed" and done[1].rag_gaps_filled is None
    assert set(res.context) == {"top_items", "top_errors", "sessions", "miss_counts", "commits"}


def test_drift_job_report(spark):
    apps = spark.createDataFrame([("x", "/r/x", "x.md"), ("y", "/r/y", "y.md")], "app string, repo string, doc string")
    code = spark.createDataFrame([("x", "src/app/api/users/route.ts", "SELECT 1 FROM audit_log"),
                                  ("x", "app/api/orders/route.js", "")], "app string, rel_path string, content string")
    docs = spark.createDataFrame([("x.md", "Orders are here")], "path string, content string")
    out = jobs.drift_job(apps, code, docs)
    assert [(r.app, r.routes, r.tables, r.missing_total) for r in out["totals"].orderBy(F.col("app").desc_nulls_last()).collect()] == [
        ("x", ["users"], ["audit_log"], 2), (None, [], [], 2)]
    lines = [r.line for r in out["lines"].orderBy("part", "section", "line_no").collect()]
    assert "**Missing entries total: 2**" in lines and "- `/api/users/`" in lines and "- y: `y.md` missing" in lines


def test_names_and_bytes_of_files(spark):
    d = tempfile.mkdtemp()
    with open(os.path.join(d, "2024-01-30 my log+1.md"), "w") as f:
        f.write("# x")
    os.makedirs(os.path.join(d, "src"))
    for name, raw in (("bad.ts", b"FROM a_b \xff\xfe end"), ("good.TS", "é".encode()), ("image.png", b"\x00")):
        with open(os.path.join(d, "src", name), "wb") as f:
            f.write(raw)
    got = fsrc.scan_sessions_by_name_date(spark, d, "2024-01-31 00:00:00")
    assert rows(got, "file_name") == [("2024-01-30 my log+1.md",)]
    code = {os.path.basename(r.path): r.content for r in fsrc.scan_code(spark, d).collect()}
    assert set(code) == {"bad.ts", "good.TS"} and code["good.TS"] == "é" and code["bad.ts"].startswith("FROM a_b ")


def test_checkpoint_folder_must_be_named_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return default

    class Spark:
        conf = Conf()
        sparkContext = type("C", (), {"master": "spark://host:7077"})()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Spark())


def test_failing_read_is_no_empty_table(spark):
    d = tempfile.mkdtemp()
    table = os.path.join(d, "t")
    day = datetime(2024, 1, 1)
    batch = spark.createDataFrame([("k", day, 1, day, day)],
                                  "pattern_key string, day timestamp, occurrence_count long, first_seen timestamp_ntz, last_seen timestamp_ntz")
    write = sj.upsert_pattern_counts(table)
    write(batch, 0)
    write(batch.withColumn("pattern_key", F.lit("other")), 1)
    write(batch.withColumn("pattern_key", F.lit("other")), 1)  # a replay
    assert rows(sj.read_pattern_counts(spark, table), "pattern_key") == [("k",), ("other",)]
    for name in os.listdir(os.path.join(table, "v=000000000001")):
        if name.endswith(".parquet"):
            with open(os.path.join(table, "v=000000000001", name), "wb") as f:
                f.write(b"broken")
    with pytest.raises(Exception):
        write(batch, 2)
    for v in range(2, 8):
        sj.upsert_pattern_counts(os.path.join(d, "u"))(batch, v)
    assert sj._versions(spark, os.path.join(d, "u")) == [4, 5, 6, 7]


def test_sliding_windows_equal_batch(spark):
    d = tempfile.mkdtemp()
    ms = spark.createDataFrame([(i, f"q{i % 3}", False, datetime(2024, 1, 1 + i % 20)) for i in range(60)],
                               "id long, query string, resolved boolean, created_at timestamp_ntz")
    ms.write.parquet(f"{d}/in")
    stream = spark.readStream.schema(ms.schema).parquet(f"{d}/in")
    sj.run_available(sj.stream_miss_clusters_sliding(stream), "sliding_t", mode="complete", checkpoint=f"{d}/ckpt")
    got = rows(spark.table("sliding_t"), "window_start", "query", "miss_count")
    assert got == rows(sj.stream_miss_clusters_sliding(ms), "window_start", "query", "miss_count") and got
