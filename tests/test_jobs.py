"""Composite jobs on the small fixture, plus the remaining small operators."""

from datetime import datetime

from pyspark.sql import functions as F

from conftest import rows
from signalmine.operators import joins as jn
from signalmine.operators import text as tx
from signalmine.operators import udfs
from signalmine.operators import updates as up
from signalmine.plans import jobs
from signalmine.sources.fixtures import AS_OF_EVENTS, Fixtures


def test_learning_loop_job_and_idempotence(spark, sf_small):
    fx = Fixtures(spark, sf_small)
    items = fx.learning_items.select("id", "source", "lesson", "applicable_to", "occurrence_count", "applied",
                                     "applied_at", "created_at")
    out = jobs.learning_loop_job(items, fx.rag_misses, fx.error_patterns, fx.session_lines, AS_OF_EVENTS)
    new = out.new_items.cache()
    assert set(new.columns) >= {"source", "lesson", "applicable_to", "occurrence_count"}
    kinds = {r.source for r in new.select("source").distinct().collect()}
    assert kinds <= {"rag_miss", "error", "session"} and "session" in kinds
    # second run over the grown table adds nothing from errors and sessions
    grown = items.unionByName(new.withColumn("id", F.lit(-1).cast("long")), allowMissingColumns=True)
    again = jobs.learning_loop_job(grown, fx.rag_misses, fx.error_patterns, fx.session_lines, AS_OF_EVENTS)
    repeat = again.new_items.filter(F.col("source").isin("error", "session")).join(new.select("lesson"), "lesson")
    assert repeat.count() == 0  # nothing already added comes back (error items are capped at 10 per run)
    sessions_again = again.new_items.filter(F.col("source") == "session").count()
    assert sessions_again == 0


def test_nightly_review_job(spark, sf_small):
    fx = Fixtures(spark, sf_small)
    existing = spark.createDataFrame([("playbooks/slow-page-1.md",)], "path string")
    res = jobs.nightly_review_job(fx.learning_items, fx.error_patterns, fx.skill_proposals, fx.findings,
                                  AS_OF_EVENTS, existing, run_id=7)
    assert res.playbooks.filter(F.col("path") == "playbooks/slow-page-1.md").count() == 0
    pb = res.playbooks.first()
    assert pb is None or "Created by Dreaming Run #7" in pb.content
    s = res.summary.first()
    assert s.playbooks_created == res.playbooks.count() > 0 and s.rag_gaps_filled == res.stubs.count() > 0
    assert s.learnings_applied == res.items.where("changed").count()
    ledger = up.start_run(spark.createDataFrame([], "id long, status string"), 7, AS_OF_EVENTS)
    assert up.record_run(ledger, res.summary, 7, duration_s=47).first().duration_seconds == 47


def test_consolidate_and_other_jobs(spark, sf_small):
    fx = Fixtures(spark, sf_small)
    res = jobs.consolidate_job(fx.learning_items, AS_OF_EVENTS)
    sections = {r.section for r in res.report.collect()}
    assert {"summary", "topic"} <= sections
    assert res.items.count() <= fx.learning_items.count()
    clusters, misses = jobs.gap_filler_job(fx.rag_misses)
    assert misses.count() == fx.rag_misses.count()
    review = jobs.skill_review_job(fx.skill_decisions, fx.error_patterns, fx.skill_metrics, fx.rag_misses,
                                   AS_OF_EVENTS)
    assert review["gate"].count() == 1
    pairs, texts, report = jobs.link_job(fx.kb_docs, fx.kb_links, fx.kb_texts, "2024-01-31")
    assert pairs.count() == report.agg(F.sum("links")).first()[0] > 10
    assert jobs.link_job(fx.kb_docs, fx.kb_links, fx.kb_texts, "2024-01-31", cap=10)[0].count() == 10


def test_small_operators(spark):
    replies = spark.createDataFrame(
        [(1, "FOLDER: architecture\nFILE: RATE.md\nCONTENT:\n# Rate\nbody"), (2, "FILE: x.md\nCONTENT: y")],
        "id long, reply string")
    parsed = tx.parse_stub_reply(replies).collect()
    assert len(parsed) == 1 and parsed[0].folder == "architecture" and parsed[0].content.startswith("# Rate")
    apps = spark.createDataFrame([("a", "/r/a", "/d/a.md"), ("b", "/r/b", "/d/b.md")], "app string, repo string, doc string")
    docs = spark.createDataFrame([("/d/a.md",)], "path string")
    assert rows(jn.missing_documents(apps, docs), "app") == [("b",)]
    files = spark.createDataFrame([("old", datetime(2024, 1, 1)), ("new", datetime(2024, 1, 30))],
                                  "path string, modified_at timestamp_ntz")
    assert rows(up.purge_staging(files, "2024-01-31 00:00:00"), "path") == [("new",)]
    items = spark.createDataFrame([(1, "deploy failed on docker"), (2, "nothing here")], "id long, lesson string")
    assert rows(udfs.classify_items(items), "id", "action") == [(1, "guard"), (2, "skip")]
    custom = udfs.pandas_classifier(lambda s: s.str.contains("docker").map({True: "config", False: "memory"}))
    assert rows(udfs.classify_items(items, custom), "id", "action") == [(1, "config"), (2, "memory")]


def test_remaining_jobs(spark, sf_small):
    fx = Fixtures(spark, sf_small)
    misses = fx.rag_misses.withColumn("resolved_by", F.lit(None).cast("string"))
    clusters = jobs.gap_filler_job(misses)[0].collect()
    assert clusters
    first, second = clusters[0].query_prefix, clusters[1].query_prefix
    replies = spark.createDataFrame([(first, "FOLDER: guides\nFILE: a.md\nCONTENT:\nbody"), (second, "no fields")],
                                    "query_prefix string, reply string")
    res = jobs.gap_stubs_job(misses, replies, AS_OF_EVENTS)
    assert rows(res.stubs, "path") == [("guides/a.md",)]
    stubbed = res.misses.filter("resolved_by = 'rag-filler-stub'").select("query").distinct().collect()
    assert all(r.query.startswith(first) for r in stubbed) and stubbed
    found = spark.createDataFrame([(second,)], "query_prefix string")
    res2 = jobs.gap_stubs_job(misses, replies, AS_OF_EVENTS, found_prefixes=found)
    assert res2.misses.filter("resolved_by = 'rag-filler-found'").count() > 0
    memo = jobs.memo_job(fx.learning_items, fx.rag_misses, fx.session_lines)
    assert memo["counts"].count() == 2 and memo["top_items"].count() <= 15
    applied = jobs.apply_job(fx.learning_items, AS_OF_EVENTS)
    assert applied.classified.count() == fx.learning_items.where("not applied").count() - applied.archived.agg(F.sum("items")).first()[0]
    assert jobs.apply_job(fx.learning_items, AS_OF_EVENTS, k=5).classified.count() == 5
    assert {r.action for r in applied.action_counts.collect()} <= {"guard", "memory", "vault", "config", "skip"}
    lines = spark.createDataFrame([("2024-01-30-a.md", 1, "# A"), ("2023-01-01-b.md", 1, "# B")],
                                  "file_name string, line_no int, line string")
    digest, kept = jobs.weekly_review_job(lines, AS_OF_EVENTS, spark.createDataFrame(
        [(1, "1. do x"), (2, "prose"), (3, "- y")], "line_no long, line string"))
    assert rows(digest) == [("2024-01-30-a.md", "\n\n--- SESSION: 2024-01-30-a.md ---\n# A")] and kept.count() == 2
    ll = spark.createDataFrame([("s", 1, "## 2026-07-01: T"), ("s", 2, "Score: 4"), ("s", 3, "Runs: 3")],
                               "skill string, line_no int, line string")
    cands, alert, lines = jobs.crystallize_job(ll)
    assert alert.first().candidates == 1 and lines.first().line == "- s: T (Score 4, Runs 3)"


def test_night_run_fills_gaps_before_it_learns(spark, sf_small, tmp_path):
    fx = Fixtures(spark, sf_small)
    misses = spark.createDataFrame(
        [(i, "how to scale redis" if i < 4 else "how to fix tls", False, datetime(2024, 1, 30, 20)) for i in range(8)],
        "id long, query string, resolved boolean, created_at timestamp_ntz")
    replies = spark.createDataFrame([("how to scale redis", "FOLDER: architecture\nFILE: REDIS.md\nCONTENT:\n# Redis\nbody")],
                                    "query_prefix string, reply string")
    alone = jobs.learning_loop_job(fx.learning_items, misses, fx.error_patterns, fx.session_lines, "2024-01-31 00:00:00")
    asked = lambda df: {r.lesson.split(": ", 1)[1] for r in df.where("source = 'rag_miss'").collect()}
    assert asked(alone.new_items) == {"how to scale redis", "how to fix tls"}
    run = jobs.night_run(fx.learning_items, fx.error_patterns, fx.skill_proposals, misses, fx.findings, replies, fx.session_lines,
                         "2024-01-31 00:00:00", run_id=7, root=str(tmp_path))
    assert asked(run.loop.new_items) == {"how to fix tls"}  # the other search has its stub by now
    assert run.gaps.stubs.count() == 1 and run.loop.consolidated.report.count() > 0
    closed = {r.id for r in run.review.items.where("changed").select("id").collect()}
    still = {r.id for r in run.loop.consolidated.items.where("applied = false").select("id").collect()}
    assert closed and not closed & still
    written = [p for p in tmp_path.rglob("*.md")]
    assert len(written) == run.documents.select("path").distinct().count() > 1
    assert any(p.name == "REDIS.md" and "# Redis" in p.read_text() for p in written)
