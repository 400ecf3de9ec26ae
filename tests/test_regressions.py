"""Regression search and claims held against a plain loop over all tasks."""

import random
import re
from datetime import datetime, timedelta

import pytest

from conftest import rows
from signalmine.operators import joins as jn
from signalmine.operators import udfs

SCHEMA = ("id long, target_repo string, prompt string, category string, status string, outcome string, "
          "completed_at timestamp_ntz")
AS_OF = "2026-07-15 12:00:00"
NOW = datetime(2026, 7, 15, 12)


def table(spark, n_new, n_old, words, repos=("hot",), seed=1, every=60):
    rng = random.Random(seed)
    prompts = lambda: " ".join(rng.sample(words, min(3, len(words))))
    data = [(i, rng.choice(repos), prompts(), "bug", "completed", None,
             NOW - timedelta(seconds=(i % every) * (80_000 // every) + 1)) for i in range(n_new)]
    data += [(10**6 + i, rng.choice(repos), prompts() + "x9", "bug", "completed", None,
              NOW - timedelta(days=2, seconds=i * 60)) for i in range(n_old)]
    data += [(-1, repos[0], None, "bug", "completed", None, NOW - timedelta(hours=1)),
             (-2, None, "login broken", "bug", "completed", None, NOW - timedelta(hours=1)),
             (-3, repos[0], "", "ops", "completed", None, NOW - timedelta(days=3))]
    return data


def pairs_by_loop(data):
    found = {}
    new = sorted((r for r in data if r[1] and r[6] > NOW - timedelta(days=1)), key=lambda r: (r[6], r[0]), reverse=True)
    for t in new:
        words = set(re.findall(r"\b[a-z]{4,}\b", (t[2] or "").lower()))
        olds = [o for o in data if o[1] == t[1] and o[0] != t[0] and o[6] < t[6] and o[2] is not None
                and any(w in o[2].lower() for w in words)]
        found[t[0]] = [o[0] for o in sorted(olds, key=lambda o: (o[6], o[0]), reverse=True)]
    return found  # newest new task first


def claims_by_loop(found, k):
    taken, out = set(), []
    for t, olds in found.items():
        mine = [o for o in olds if o not in taken][:k]
        taken.update(mine)
        out += [(t, o, i + 1) for i, o in enumerate(mine)]
    return sorted(out)


@pytest.mark.parametrize("words", [["login", "mobile", "deploy"], ["logi", "login", "relogin", "cart", "cartoon", "mail"]])
def test_pairs_and_newest(spark, words):
    data = table(spark, 30, 120, words, ("hot", "hot", "cold"))
    t = spark.createDataFrame(data, SCHEMA)
    found = pairs_by_loop(data)
    assert rows(jn.regression_pairs(t, AS_OF), "new_id", "old_id") == sorted((n, o) for n, olds in found.items() for o in olds)
    for per in (4, 1000):
        near = jn.newest_pairs(t, AS_OF, per=per, k=3)
        have = {}
        for r in near.orderBy("old_completed_at", "old_id", ascending=False).collect():
            have.setdefault(r.new_id, []).append(r.old_id)
        assert {n: olds[:3] for n, olds in have.items()} == {n: olds[:3] for n, olds in found.items() if olds}
    got = rows(jn.regression_candidates(t, AS_OF), "new_id", "old_id")
    assert got == sorted((n, o) for n, olds in found.items() for o in olds[:3])


def test_rows_made_do_not_grow_with_the_repository(spark):
    made = [jn.newest_pairs(spark.createDataFrame(table(spark, 5, n, ["login"]), SCHEMA), AS_OF, per=64, lookback_days=300).count()
            for n in (1_000, 8_000)]
    assert made[0] == made[1] <= 5 * 2 * 64


@pytest.mark.parametrize("block, every", [(4, 60), (8, 2)])
def test_claims_in_rounds_in_one_hot_repository(spark, block, every):
    data = table(spark, 60, 250, ["login", "mobile", "deploy", "cart"], every=every)
    found = pairs_by_loop(data)
    pairs = jn.regression_pairs(spark.createDataFrame(data, SCHEMA), AS_OF)
    claims, rounds = udfs.claim_rounds(pairs, 3, block)
    assert rows(claims, "new_id", "old_id", "claim_rank") == claims_by_loop(found, 3)
    assert 1 < rounds <= 60 // block + 2
    assert rows(udfs.claim_regressions(spark.createDataFrame(data, SCHEMA), AS_OF),
                "new_id", "old_id", "claim_rank") == claims_by_loop(found, 3)


def test_claims_of_nothing(spark):
    t = spark.createDataFrame([], SCHEMA)
    assert udfs.claim_regressions(t, AS_OF).count() == 0
    assert jn.regression_candidates(t, AS_OF).count() == 0
