"""Plans and rows of the queries that failed at size in round 3."""

import re
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from test_regressions import AS_OF, NOW, SCHEMA, claims_by_loop, pairs_by_loop, table
from signalmine.operators import joins as jn
from signalmine.operators import knn
from signalmine.operators import text as tx
from signalmine.operators import udfs
from signalmine.plans import jobs


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_phases_broadcast_no_lines(spark):
    lines = spark.range(200).select(F.concat(F.lit("t"), F.col("id").cast("string")).alias("path"), F.posexplode(
        F.array(F.lit("---"), F.lit("## Phase 1: do"), F.lit("step"), F.lit("## Notes"))).alias("line_no", "line"))
    found = tx.task_phases(lines)
    assert "Broadcast" not in plan(found)
    assert rows(found.where("path = 't7'"), "phase", "prompt") == [(1, "## Phase 1: do\nstep")]


@pytest.mark.parametrize("chunk_lines", [1, 3, 100])
def test_sections_over_chunks(spark, chunk_lines):
    text = [None, "a", "# x", "b", "# y", None, "c", "# z", "d"]
    lines = spark.createDataFrame([(f, i, t) for f in ("p", None) for i, t in enumerate(text)]
                                  + [("q", None, "# w"), ("q", 0, "e")], "path string, line_no int, line string")
    got = tx.section_ids(lines, "path", F.col("line").startswith("# "), chunk_lines)
    assert got.columns == ["path", "line_no", "line", "_is_head", "section"]
    want = [0, 0, 1, 1, 2, 2, 2, 3, 3]
    for f in ("p", None):
        assert rows(got.where(F.col("path").eqNullSafe(F.lit(f))), "line_no", "section") == list(enumerate(want))
    assert rows(got.where("path = 'q'"), "line", "section") == [("# w", 1), ("e", 1)]


def test_neighbours_broadcast_no_vectors_and_shuffle_none_per_block(spark):
    vectors = [(i, [float(i % 7), float(i % 11), 1.0]) for i in range(300)]
    docs = spark.createDataFrame(vectors, "doc_id long, embedding array<double>").repartition(4)
    blocks, idx = knn.index(docs, cells=5, block_rows=16)
    packs = knn._packs(docs.where("doc_id % 3 = 0"), idx).withColumn("q_least", F.lit(None).cast("binary"))
    text = plan(knn._compared(knn._routed(packs, idx, 4), blocks, idx, 4, True))
    assert "CartesianProduct" in text and "Exchange" not in text
    found = knn.nearest_documents(docs, docs, 4)
    assert "Broadcast" not in plan(found)
    assert found.count() == 1200


def test_misses_searched_once(spark):
    docs = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "doc_id long, embedding array<double>")
    misses = spark.createDataFrame([(1, "how to a", False), (2, "how to b", False), (3, "how to b", False), (4, "c", True)],
                                   "id long, query string, resolved boolean").withColumn("created_at", F.current_timestamp())
    vectors = spark.createDataFrame([(1, [1.0, 0.1]), (2, [-1.0, -0.1]), (3, [-1.0, 0.0])], "id long, embedding array<double>")
    clusters, out = jobs.gap_filler_job(misses, vectors, docs)
    assert "CartesianProduct" not in plan(out) + plan(clusters)  # the search is done, whoever reads the misses
    assert rows(out, "id", "resolved") == [(1, True), (2, True), (3, True), (4, True)]
    assert {r.id: r.resolved_by for r in out.collect()} == {
        1: "rag-filler-found", 2: "rag-filler-stub", 3: "rag-filler-stub", 4: None}


@pytest.mark.parametrize("cell, every, words", [(40, 2, ["login", "mobile", "deploy", "cart"]),
                                                (4096, 60, ["logi", "login", "cart", "mail"])])
def test_claims_in_cells(spark, cell, every, words):
    data = table(spark, 60, 200, words, ("hot", "hot", "cold"), every=every)
    new, old = jn.fixes(spark.createDataFrame(data, SCHEMA), AS_OF, 1, 30, None, None)
    want = claims_by_loop(pairs_by_loop(data), 3)
    assert rows(udfs.claim_cells(new, old, 3, cell), "new_id", "old_id", "claim_rank") == want


def test_claims_make_no_pairs(spark, monkeypatch):
    data = table(spark, 60, 250, ["login"])
    monkeypatch.setattr(udfs, "met", None)  # pairs every new task with every older one
    got = udfs.claim_regressions(spark.createDataFrame(data, SCHEMA), AS_OF)
    assert rows(got, "new_id", "old_id", "claim_rank") == claims_by_loop(pairs_by_loop(data), 3)


def claims_by_id(data, k=3):
    """(repo, new_id, old_id, claim_rank) by a loop over each repository; an id is one
    new task of the newest time that has candidates."""
    out = []
    for repo in {r[1] for r in data if r[1]}:
        here = [r for r in data if r[1] == repo]
        ids = {}
        for t in sorted((r for r in here if r[6] > NOW - timedelta(days=1)), key=lambda r: (r[6], r[0]), reverse=True):
            words = set(re.findall(r"\b[a-z]{4,}\b", (t[2] or "").lower()))
            olds = [o for o in here if o[0] != t[0] and o[5] is None and o[6] < t[6] and any(w in (o[2] or "").lower() for w in words)]
            if olds:
                ids.setdefault(t[0], []).extend(o[0] for o in sorted(olds, key=lambda o: (o[6], o[0]), reverse=True))
        out += [(repo, *c) for c in claims_by_loop({i: list(dict.fromkeys(olds)) for i, olds in ids.items()}, k)]
    return sorted(out)


def test_ids_of_two_repositories_make_no_pairs(spark, monkeypatch):
    data = table(spark, 20, 80, ["login", "mobile"])
    data += [(r[0], "other", *r[2:]) for r in data if r[1]]
    monkeypatch.setattr(udfs, "met", None)
    got = udfs.claim_regressions(spark.createDataFrame(data, SCHEMA), AS_OF)
    assert rows(got, "repo", "new_id", "old_id", "claim_rank") == claims_by_id(data)


@pytest.mark.parametrize("block", [4, 64])
def test_ids_that_name_several_tasks_of_a_repository(spark, block, monkeypatch):
    monkeypatch.setattr(udfs.claim_rounds, "__defaults__", (3, block))
    data = table(spark, 24, 60, ["login", "mobile", "deploy", "cart"], ("hot", "cold"))
    data += [(r[0], "hot", "cart mobile", *r[3:6], r[6] - timedelta(hours=i % 5)) for i, r in enumerate(data[::3])]
    got = udfs.claim_regressions(spark.createDataFrame(data, SCHEMA), AS_OF)
    assert rows(got, "repo", "new_id", "old_id", "claim_rank") == claims_by_id(data)


def test_a_task_does_not_claim_its_own_id(spark):
    at = lambda days: NOW - timedelta(days=days, hours=1)
    data = [(5, "hot", "login", "bug", "completed", "failed", at(0)), (5, "hot", "login", "bug", "completed", None, at(3)),
            (6, "hot", "login", "bug", "completed", None, at(4))]
    got = udfs.claim_regressions(spark.createDataFrame(data, SCHEMA), AS_OF)
    assert rows(got, "repo", "new_id", "old_id", "claim_rank") == [("hot", 5, 6, 1)] == claims_by_id(data)
