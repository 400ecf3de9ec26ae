"""Streaming equals batch on closed windows; file sources and sinks on temp dirs."""

import json
import os
import tempfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from signalmine.operators import aggregates as agg
from signalmine.operators.drift import drift_report, route_groups, table_refs
from signalmine.sources import files as fsrc
from signalmine.sources import sinks
from signalmine.sources.fixtures import Fixtures
from signalmine.streaming import jobs as sj


def _scratch():
    return tempfile.mkdtemp(prefix="sm-test-")


def test_stream_miss_clusters_equal_batch_closed_windows(spark, sf_small):
    misses = Fixtures(spark, sf_small).rag_misses.withColumn("resolved_by", F.lit(None).cast("string"))
    d = _scratch()
    src = os.path.join(d, "in")
    # one file per day, written in time order, so micro-batches advance the watermark
    (misses.withColumn("day", F.to_date("created_at")).repartition("day")
     .write.partitionBy("day").parquet(src))
    stream = (spark.readStream.schema(misses.schema).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", True).parquet(src))
    q = sj.run_available(sj.stream_miss_clusters(stream, 200, 2), "miss_clusters_t",
                         checkpoint=os.path.join(d, "ckpt"))
    assert q is not None
    got = rows(spark.table("miss_clusters_t"), "window_start", "query_prefix", "miss_count")
    batch = (misses.filter(~F.col("resolved")).withColumn("ws", F.date_trunc("day", "created_at"))
             .groupBy("ws", F.left("query", F.lit(200)).alias("query_prefix")).agg(F.count(F.lit(1)).alias("n"))
             .filter("n >= 2"))
    want = {(r.ws, r.query_prefix, r.n) for r in batch.collect()}
    got_set = {(r[0].replace(tzinfo=None) if hasattr(r[0], "tzinfo") else r[0], r[1], r[2]) for r in got}
    assert got_set and got_set <= want  # emitted (closed) windows equal the batch result


def test_stream_dedup_keeps_one_per_key(spark):
    d = _scratch()
    df = spark.createDataFrame(
        [(1, "s", "same lesson text", "2024-01-01 00:00:00"), (2, "s", "same lesson text", "2024-01-01 01:00:00"),
         (3, "e", "same lesson text", "2024-01-01 02:00:00")],
        "id long, source string, lesson string, ts string").withColumn("created_at", F.to_timestamp("ts"))
    df.drop("ts").write.parquet(os.path.join(d, "in"))
    stream = spark.readStream.schema(df.drop("ts").schema).parquet(os.path.join(d, "in"))
    sj.run_available(sj.stream_dedup_items(stream), "dedup_t", checkpoint=os.path.join(d, "ckpt"))
    keys = rows(spark.table("dedup_t"), "source")
    assert keys == [("e",), ("s",)]


def test_read_texts_lines_and_scans(spark):
    d = _scratch()
    os.makedirs(os.path.join(d, "2026-07"), exist_ok=True)
    for name, body in [("2026-07/2026-07-15-a.md", "# A\n- Fix: x\n"), ("2026-07/2026-07-01-b.md", "# B\n"),
                       ("notes.txt", "skip")]:
        with open(os.path.join(d, name), "w") as fh:
            fh.write(body)
    docs = fsrc.read_texts(spark, d)
    assert docs.count() == 2
    lines = fsrc.to_lines(docs)
    assert rows(lines.filter(F.col("path").endswith("a.md")), "line_no", "line") == [(1, "# A"), (2, "- Fix: x")]
    recent = fsrc.scan_sessions_by_prefix_date(spark, d, "2026-07-16 00:00:00", days=7)
    assert rows(recent, "file_name") == [("2026-07-15-a.md",)]
    by_name = fsrc.scan_sessions_by_name_date(spark, d, "2026-07-16 00:00:00", days=1)
    assert rows(by_name, "file_name") == [("2026-07-15-a.md",)]


def _code_tree():
    d = _scratch()
    files = {
        "repo/src/app/api/members/route.ts": "export const q = `SELECT * FROM user_profiles JOIN created_at`",
        "repo/src/app/api/[id]/route.ts": "x",
        "repo/src/app/api/webhooks/in/route.js": "db.query('INSERT INTO audit_log VALUES (1)')",
        "repo/app/api/health/route.js": "ok",
        "repo/src/lib/db.sql": "select * from lower_case; UPDATE \"notification_preferences\" SET a=1",
        "repo/node_modules/x.ts": "FROM vendor_table",
        "repo/docs/readme.md": "FROM doc_table",
        "repo/src/.hidden/x.ts": "FROM hidden_table",
        "repo/src/app/api/.beta/route.ts": "x",
        "docs/MODEL.md": "# Model\nThe members area and user_profiles table.",
    }
    for p, body in files.items():
        full = os.path.join(d, p)
        os.makedirs(os.path.dirname(full), exist_ok=True)
        with open(full, "w") as fh:
            fh.write(body)
    return d


def test_drift_on_code_tree(spark):
    d = _code_tree()
    cfg = os.path.join(d, "config.json")
    with open(cfg, "w") as fh:
        json.dump({"vault_dir": d, "apps": {"my-app": {"repo": f"{d}/repo", "doc": f"{d}/docs/MODEL.md"},
                                            "admin-panel": {"repo": f"{d}/repo", "doc": f"{d}/docs/ADMIN.md"}}}, fh)
    apps = fsrc.load_app_config(spark, cfg)
    assert fsrc.scan_code(spark, f"{d}/repo").filter(F.col("path").contains("/.")).count() == 0
    code = fsrc.scan_code(spark, f"{d}/repo", skip_hidden=False)
    assert code.filter(F.col("path").contains("node_modules")).count() == 0
    from signalmine.operators.drift import relative_paths
    rel = relative_paths(code, apps.filter("app = 'my-app'"))
    # routes are looked for in hidden folders too, tables are not
    assert rows(route_groups(rel), "route_group") == [(".beta",), ("members",), ("webhooks",)]
    assert rows(table_refs(rel), "name") == [("audit_log",), ("notification_preferences",), ("user_profiles",)]
    docs = fsrc.read_texts(spark, f"{d}/docs").select(F.regexp_replace("path", "^file:", "").alias("path"), "content")
    missing, totals, no_doc = drift_report(apps, relative_paths(code, apps), docs)
    assert rows(missing.filter("app = 'my-app'"), "kind", "term") == [
        ("route", ".beta"), ("route", "webhooks"), ("table", "audit_log"), ("table", "notification_preferences")]
    assert rows(totals.filter("app = 'my-app'"), "missing_total") == [(4,)]
    assert rows(no_doc, "app") == [("admin-panel",)]


def test_sinks_never_overwrite(spark):
    d = _scratch()
    docs = spark.createDataFrame([("a.md", "new a"), ("b.md", "new b")], "path string, content string")
    existing = spark.createDataFrame([("a.md",)], "path string")
    out = os.path.join(d, "docs")
    written = sinks.write_documents(docs, existing, out)
    assert rows(written, "path") == [("b.md",)]
    assert rows(spark.read.parquet(out), "path") == [("b.md",)]
    report = spark.createDataFrame([("summary", "open", 3)], "section string, name string, value long")
    md = sinks.report_markdown(report, "Report").first().markdown
    assert "| summary | open | 3 |" in md


def test_staging_json(spark, sf_small):
    fx = Fixtures(spark, sf_small)
    pc = fx.error_patterns.agg(F.count(F.lit(1)))
    at = spark.createDataFrame([(0,)], "n int")
    doc = sinks.staging_document("2024-01-31", pc, at, 3, {"rag_misses": agg.miss_last_seen(fx.rag_misses)})
    parsed = json.loads(doc.first().json)
    assert parsed["max_auto_per_day"] == 3 and isinstance(parsed["rag_misses"], list)


def test_stream_error_patterns_upsert_equals_batch(spark, sf_small):
    d = _scratch()
    ev = spark.read.parquet(f"{sf_small}/events.parquet").filter("event_type = 'error'")
    errors = ev.select(F.concat(F.lit("err-"), F.col("user_id").cast("string")).alias("pattern_key"),
                       F.col("ts").alias("ts"))
    (errors.withColumn("day", F.to_date("ts")).repartition("day").write.partitionBy("day").parquet(f"{d}/in"))
    stream = (spark.readStream.schema(errors.schema).option("maxFilesPerTrigger", 3)
              .option("recursiveFileLookup", True).parquet(f"{d}/in"))
    table = f"{d}/patterns"
    sj.run_available(sj.stream_error_patterns(stream), "err_t", mode="update",
                     checkpoint=f"{d}/ckpt", foreach_batch=sj.upsert_pattern_counts(table))
    got = rows(sj.read_pattern_counts(spark, table), "pattern_key", "occurrence_count")
    assert 1 <= len(sj._versions(spark, table)) <= 4
    want = rows(errors.groupBy("pattern_key", F.to_date("ts")).agg(F.count(F.lit(1)).alias("n")), "pattern_key", "n")
    assert got == want


def test_stream_late_rows_are_dropped(spark):
    """Spark's guarantee is one-way: rows behind the watermark may still count
    while their window's state is alive, and are dropped once it was emitted."""
    import datetime as dt

    d = _scratch()
    schema = "id long, query string, resolved boolean, created_at timestamp_ntz"
    on_time = [(i, "how to x", False, dt.datetime(2024, 1, 1, 1, i)) for i in range(3)]
    later = [(10 + i, "how to y", False, dt.datetime(2024, 1, 5, 1, i)) for i in range(3)]
    late = [(20 + i, "how to x", False, dt.datetime(2024, 1, 1, 2, i)) for i in range(3)]

    def put(n, batch):
        spark.createDataFrame(batch, schema).coalesce(1).write.parquet(f"{d}/in/b={n}")
        for f in os.listdir(f"{d}/in/b={n}"):  # distinct modification times fix the arrival order
            os.utime(f"{d}/in/b={n}/{f}", (1_700_000_000 + 100 * n, 1_700_000_000 + 100 * n))

    put(0, on_time)
    put(1, later)
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", True).parquet(f"{d}/in"))
    q = (sj.stream_miss_clusters(stream, 200, 2).writeStream.outputMode("append").format("memory")
         .queryName("late_t").option("checkpointLocation", f"{d}/ckpt").start())
    try:
        q.processAllAvailable()  # Jan 5 moves the watermark past Jan 1: that window is emitted
        put(2, late)
        q.processAllAvailable()
        dropped = sum(s.get("numRowsDroppedByWatermark", 0) for p in q.recentProgress for s in p["stateOperators"])
    finally:
        q.stop()
    assert rows(spark.table("late_t"), "query_prefix", "miss_count") == [("how to x", 3)]
    assert dropped >= 1  # counted after the map-side partial aggregate (one row per key)


def test_modified_since_and_skill_learnings(spark):
    d = _scratch()
    for name, body, mtime in [("deploy/learnings.md", "## 2026-07-01: A\nScore: 5\nRuns: 3\n", 1_780_000_000),
                              ("auth/learnings.md", "## 2026-07-02: B\n", 1_700_000_000),
                              ("auth/other.md", "x", 1_780_000_000)]:
        full = os.path.join(d, name)
        os.makedirs(os.path.dirname(full), exist_ok=True)
        with open(full, "w") as fh:
            fh.write(body)
        os.utime(full, (mtime, mtime))
    skills = fsrc.scan_skill_learnings(spark, d)
    assert rows(skills, "skill") == [("auth",), ("deploy",)]
    # mtime 1_780_000_000 is 2026-05-28 20:26 UTC: within two days of the as_of, the other file is not
    fresh = fsrc.scan_files_modified_since(spark, d, "2026-05-29 00:00:00", days=2)
    assert rows(fresh, "file_name") == [("learnings.md",), ("other.md",)]
    from signalmine.plans import jobs
    lines = fsrc.to_lines(skills)
    cands, alert, text = jobs.crystallize_job(lines)
    assert rows(alert) == [(1,)] and rows(text, "line") == [("- deploy: A (Score 5, Runs 3)",)]
    assert rows(cands, "skill", "title") == [("deploy", "A")]


def test_stream_session_items_writer(spark):
    d = _scratch()
    os.makedirs(f"{d}/sessions")
    with open(f"{d}/sessions/2026-07-15-a.md", "w") as fh:
        fh.write("# S\n- Fix: restart the worker after deploy\n")
    items_path = f"{d}/items"
    stream = sj.session_file_stream(spark, f"{d}/sessions")
    sj.run_available(stream, "sess_t", checkpoint=f"{d}/ckpt", foreach_batch=sj.session_items_writer(items_path))
    got = [r.lesson for r in spark.read.parquet(items_path).collect()]
    assert got == ["Session 2026-07-15-a.md: Fix: restart the worker after deploy"]
    # a second file arrives; the first is not itemised again
    with open(f"{d}/sessions/2026-07-16-b.md", "w") as fh:
        fh.write("# T\n- Lesson: pin the base image\n")
    sj.run_available(sj.session_file_stream(spark, f"{d}/sessions"), "sess_t2", checkpoint=f"{d}/ckpt",
                     foreach_batch=sj.session_items_writer(items_path))
    assert len(spark.read.parquet(items_path).collect()) == 2


def test_session_items_batches_are_replayed(spark, monkeypatch):
    d = _scratch()
    batch = lambda *files: spark.createDataFrame(
        [(f"file:/x/{n}", f"# S\n- Fix: {n} needs another look\n") for n in files], "path string, content string")
    lessons = lambda: sorted(r.lesson.split(": ")[0] for r in spark.read.parquet(f"{d}/items").collect())
    write = sj.session_items_writer(f"{d}/items")
    write(batch("a.md", "b.md"), 0)
    write(batch("b.md", "c.md"), 1)
    assert lessons() == ["Session a.md", "Session b.md", "Session c.md"]
    write(batch("b.md", "c.md"), 1)  # a replay of the whole batch
    assert lessons() == ["Session a.md", "Session b.md", "Session c.md"]

    # dies after the items, before the ledger
    from pyspark.sql import DataFrameWriter
    plain = DataFrameWriter.parquet

    def parquet(self, path, *args, **kw):
        if "/_seen/" in path:
            raise OSError("killed")
        return plain(self, path, *args, **kw)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    with pytest.raises(OSError, match="killed"):
        write(batch("d.md"), 2)
    monkeypatch.undo()
    write(batch("d.md"), 2)
    write(batch("d.md", "e.md"), 3)
    assert lessons() == [f"Session {n}.md" for n in "abcde"]
    known = spark.createDataFrame([("session", "Session f.md: seen before")], "source string, lesson string")
    known.write.parquet(f"{d}/known")
    sj.session_items_writer(f"{d}/other", f"{d}/known")(batch("f.md", "g.md"), 0)
    assert [r.lesson.split(": ")[0] for r in spark.read.parquet(f"{d}/other").collect()] == ["Session g.md"]


def test_pattern_lifetimes(spark):
    d = _scratch()
    schema = "pattern_key string, ts timestamp_ntz"
    at = lambda day: datetime(2024, 1, day)
    batches = [[("a", at(5)), ("b", at(6)), ("a", at(7))], [("a", at(1)), (None, at(2))], [("c", None), ("c", at(9))],
               [("b", at(20))]]

    def put(n):
        spark.createDataFrame(batches[n], schema).coalesce(1).write.parquet(f"{d}/in/b={n}")
        for f in os.listdir(f"{d}/in/b={n}"):
            os.utime(f"{d}/in/b={n}/{f}", (1_700_000_000 + 100 * n, 1_700_000_000 + 100 * n))

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option(
            "recursiveFileLookup", True).parquet(f"{d}/in")
        sj.run_available(sj.stream_pattern_lifetimes(stream), "life_t", mode="update", checkpoint=f"{d}/ckpt",
                         foreach_batch=sj.pattern_lifetimes_writer(f"{d}/out", merge_every=2))

    def expected(n):
        whole = spark.createDataFrame([r for b in batches[:n] for r in b], schema)
        return {tuple(r) for r in whole.groupBy("pattern_key").agg(F.count("*"), F.min("ts"), F.max("ts")).collect()}

    assert sj.read_pattern_lifetimes(spark, f"{d}/out").isEmpty()
    put(0)
    put(1)
    run()
    assert {tuple(r) for r in sj.read_pattern_lifetimes(spark, f"{d}/out").collect()} == expected(2)
    changed = {r.pattern_key for f in os.listdir(f"{d}/out") if f == "batch=000000000001"
               for r in spark.read.parquet(f"{d}/out/{f}").collect()}
    assert changed == {"a", None}
    put(2)
    put(3)
    run()  # a restart from the checkpoint: the counts go on
    got = sj.read_pattern_lifetimes(spark, f"{d}/out")
    assert {tuple(r) for r in got.collect()} == expected(4) and got.count() == 4
    # a replay of the last batch, and one that is older than the last merge, change nothing
    last = spark.read.schema(sj.LIFETIMES).parquet(f"{d}/out/batch=000000000003").collect()
    sj.pattern_lifetimes_writer(f"{d}/out", merge_every=2)(spark.createDataFrame(last, sj.LIFETIMES), 3)
    assert {tuple(r) for r in sj.read_pattern_lifetimes(spark, f"{d}/out").collect()} == expected(4)
    assert sorted(os.listdir(f"{d}/out")) == ["batch=000000000002", "batch=000000000003", "merged=000000000001",
                                              "merged=000000000003"]


def test_code_below_hidden_and_underscored_folders(spark):
    d = _scratch()
    names = ["src/app/api/_private/route.ts", "src/app/api/.beta/x/route.ts", "src/a b+c/%41.js", "src/node_modules/x.ts",
             "src/.git/x.ts", "lib/notes.md"] + [f"deep/{i}/{j}/f.sql" for i in range(20) for j in range(20)]
    for name in names:
        os.makedirs(os.path.dirname(f"{d}/{name}"), exist_ok=True)
        with open(f"{d}/{name}", "w") as fh:
            fh.write(name)
    os.symlink(f"{d}/nowhere", f"{d}/lib/gone.ts")
    got = rows(fsrc.scan_code(spark, [d, d + "/"], skip_hidden=False))
    want = sorted((f"{d}/{n}", n) for n in names if "node_modules" not in n and ".git" not in n and not n.endswith(".md"))
    assert got == want
    assert rows(fsrc.scan_code(spark, d)) == [w for w in want if "/." not in w[0]]
    with pytest.raises(Exception):
        fsrc.scan_code(spark, f"{d}/nowhere").collect()
    os.makedirs(f"{d}/empty")
    assert fsrc.scan_code(spark, f"{d}/empty").isEmpty()


def test_append_items_and_write_report(spark):
    d = _scratch()
    items = spark.createDataFrame([("error", "Recurring problem: k - x", "2024-01-31")],
                                  "source string, lesson string, created_date string")
    sinks.append_items(items, f"{d}/items", partition_by="created_date")
    sinks.append_items(items, f"{d}/items", partition_by="created_date")
    assert spark.read.parquet(f"{d}/items").count() == 2
    report = spark.createDataFrame([("summary", "open", 3), ("topic", "auth", 1)], "section string, name string, value long")
    sinks.write_report(report, f"{d}/report")
    assert rows(spark.read.json(f"{d}/report"), "section", "name", "value") == [("summary", "open", 3), ("topic", "auth", 1)]
    sinks.write_staging_json(spark.createDataFrame([('{"a": 1}',)], "json string"), f"{d}/staging")
    assert json.loads(spark.read.text(f"{d}/staging").first().value) == {"a": 1}
