"""Set-based rewrites equal the reference's literal forms (SURVEY §5 (c), (d))."""

from datetime import datetime

import numpy as np
from pyspark.sql import functions as F

from conftest import rows
from signalmine.operators import joins as jn
from signalmine.operators import similarity as sim
from signalmine.operators import updates as up
from signalmine.operators.matching import keys_found_in
from signalmine.sources.fixtures import Fixtures


def test_duplicates_window_equals_self_join(spark, sf_small):
    items = Fixtures(spark, sf_small).learning_items
    a = items.alias("a")
    b = items.alias("b")
    literal = (a.join(b, (F.col("a.id") > F.col("b.id")) & (F.col("a.source") == F.col("b.source"))
                      & (F.col("a.lesson") == F.col("b.lesson")))
               .filter(~F.col("a.applied") & ~F.col("b.applied")).select(F.col("a.id").alias("id")).distinct())
    assert rows(jn.duplicate_items(items)) == rows(literal)


def test_duplicates_with_null_flags(spark):
    df = spark.createDataFrame(
        [(1, "s", "same text", False), (2, "s", "same text", False), (3, "s", "same text", None),
         (4, "t", "same text", False)], "id long, source string, lesson string, applied boolean")
    assert rows(jn.duplicate_items(df)) == [(2,)]


def test_contains_anti_join_exact_with_wildcards(spark):
    patterns = spark.createDataFrame(
        [("a_b", 5, False), ("50%", 6, False), ("err-1-b2", 7, False), ("zzz", 9, False)],
        "pattern_key string, occurrence_count int, resolved boolean")
    items = spark.createDataFrame(
        [(1, "error", "Recurring problem: err-1-b23 - x"), (2, "error", "saw axb and 50% load"),
         (3, "session", "zzz")], "id long, source string, lesson string")
    exact = rows(jn.errors_without_item(patterns, items), "pattern_key")
    # 'err-1-b2' is a substring of 'err-1-b23'; '_' and '%' are literal; 'zzz' only in a session item
    assert exact == [("a_b",), ("zzz",)]
    keyed = rows(jn.errors_without_item_keyed(patterns, items), "pattern_key")
    assert ("err-1-b2",) in keyed  # the fast path is exact only for generated lessons


def test_keys_found_word_and_prefix_modes(spark):
    texts = spark.createDataFrame([("a", "the my-route and audit_logs"), ("b", "my-route!")], "app string, text string")
    keys = spark.createDataFrame([("a", "my-route"), ("a", "audit_log"), ("b", "my-route")], "app string, term string")
    found = rows(keys_found_in(texts, "text", keys, "term", mode="word", group_col="app"), "grp", "key")
    assert found == [("a", "my-route"), ("b", "my-route")]
    q = spark.createDataFrame([("how to red anvil",), ("how to red",)], "query string")
    c = spark.createDataFrame([("how to red",), ("how to red anvil",)], "query_prefix string")
    pre = rows(keys_found_in(q, "query", c, "query_prefix", mode="prefix", text_id_col="query"), "tid", "key")
    assert pre == [("how to red", "how to red"), ("how to red anvil", "how to red"),
                   ("how to red anvil", "how to red anvil")]


def test_undocumented_terms_token_and_special(spark):
    terms = spark.createDataFrame([("x", "audit_log"), ("x", "my-route"), ("x", "users"), ("y", "users")],
                                  "app string, term string")
    docs = spark.createDataFrame([("x", "Tables: USERS, audit_logs. Route /my-route/ ok")], "app string, text string")
    assert rows(jn.undocumented_terms(terms, docs)) == [("x", "audit_log"), ("y", "users")]


def test_nearest_documents_brute_force(spark):
    rng = np.random.default_rng(7)
    vecs = rng.normal(size=(60, 8)).astype(np.float32)
    vecs[5] = vecs[3]  # exact copy: tie broken by the lower id
    docs = spark.createDataFrame([(i, vecs[i].tolist()) for i in range(60)], "doc_id long, embedding array<float>")
    queries = docs.filter(F.col("doc_id") % 10 == 0)
    got = rows(sim.nearest_documents(docs.repartition(4), queries, 5), "src", "dst", "rank")
    v = vecs.astype(np.float64)
    v = v / np.linalg.norm(v, axis=1, keepdims=True)
    want = []
    for s in range(0, 60, 10):
        sc = np.round(v @ v[s], 9)
        order = sorted((d for d in range(60) if d != s), key=lambda d: (-sc[d], d))[:5]
        want += [(s, d, r + 1) for r, d in enumerate(order)]
    assert got == sorted(want)


def test_archive_noise_bounds(spark):
    as_of = "2024-02-01 00:00:00"
    df = spark.createDataFrame(
        [(1, 1, False, datetime(2024, 1, 18), None),       # exactly 14 d: not older
         (2, 1, False, datetime(2024, 1, 17, 23, 59), None),
         (3, 2, False, datetime(2024, 1, 1), None),
         (4, 2, False, datetime(2024, 1, 2), None),         # exactly 30 d
         (5, 3, False, datetime(2023, 1, 1), None),
         (6, 1, None, datetime(2023, 1, 1), None)],
        "id long, occurrence_count int, applied boolean, created_at timestamp_ntz, applied_at timestamp_ntz")
    got = rows(up.archive_noise(df, as_of), "id", "archived_rule")
    assert got == [(1, 0), (2, 1), (3, 2), (4, 0), (5, 0), (6, 0)]


def test_purge_keeps_null_predicate(spark):
    df = spark.createDataFrame([(1, True, None), (2, True, datetime(2020, 1, 1)), (3, None, datetime(2020, 1, 1))],
                               "id long, applied boolean, applied_at timestamp_ntz")
    assert rows(up.purge_applied(df, "2024-01-01 00:00:00"), "id") == [(1,), (3,)]


def test_mark_regressions_first_claim_wins(spark):
    tasks = spark.createDataFrame([(1, None), (2, "good")], "id long, outcome string")
    pairs = spark.createDataFrame([(10, 1, datetime(2024, 1, 2)), (11, 1, datetime(2024, 1, 3)),
                                   (11, 2, datetime(2024, 1, 3))],
                                  "new_id long, old_id long, new_completed_at timestamp_ntz")
    out = up.mark_regressions(tasks, pairs, "2024-01-04 00:00:00")
    r = {x.id: x for x in out.collect()}
    assert r[1].outcome == "partial" and "new bugfix 11 " in r[1].outcome_reason
    assert r[2].outcome == "good" and r[2].outcome_reason is None


def test_nearest_documents_blocks(spark):
    rng = np.random.default_rng(11)
    vecs = rng.normal(size=(40, 6)).astype(np.float32)
    docs = spark.createDataFrame([(i, vecs[i].tolist()) for i in range(40)], "doc_id long, embedding array<float>")
    queries = docs.filter(F.col("doc_id") % 4 == 0)
    got = rows(sim.nearest_documents(docs.repartition(3), queries, 3, blocks=3), "src", "dst", "rank")
    v = vecs.astype(np.float64)
    v = v / np.linalg.norm(v, axis=1, keepdims=True)
    want = []
    for s in range(0, 40, 4):
        sc = np.round(v @ v[s], 9)
        order = sorted((d for d in range(40) if d != s), key=lambda d: (-sc[d], d))[:3]
        want += [(s, d, r + 1) for r, d in enumerate(order)]
    assert got == sorted(want)
