"""Goldens from the reference's worked examples (SURVEY §5 (b))."""

from datetime import datetime

from pyspark.sql import functions as F

from conftest import rows
from signalmine.operators import aggregates as agg
from signalmine.operators import joins as jn
from signalmine.operators import ranking as rk
from signalmine.operators import text as tx
from signalmine.operators import udfs
from signalmine.operators import updates as up

FINDINGS = [
    "PLAYBOOK|502-after-deploy|Traefik returns 502 when new container starts before old one stops|"
    "Add health check endpoint, wait for 200 before routing traffic",
    "APPLY|14|Add retry logic to webhook delivery|webhook-handler, add exponential backoff",
    "APPLY|22|Document the user onboarding flow|vault/features/ONBOARDING.md",
    "PATTERN|missing-env-var|Three sessions failed because ENV vars were not set in new containers|"
    "Add env-var validation to deployment script startup",
    "VAULTGAP|rate-limiting-config|architecture/RATE_LIMITING.md",
    "VAULTGAP|backup-restore-procedure|playbooks/BACKUP_RESTORE.md",
]


def findings_df(spark, lines):
    return spark.createDataFrame([(i + 1, l) for i, l in enumerate(lines)], "line_no long, line string")


def test_findings_counters(spark):
    f = findings_df(spark, FINDINGS + ["free text", "APPLY||nothing"])
    s = agg.run_summary(tx.parse_findings(f).filter(F.col("key") != "")).first()
    assert (s.playbooks, s.applied, s.patterns, s.gaps, s.total) == (1, 2, 1, 2, 6)
    assert rows(tx.applied_ids(f)) == [(14,), (22,)]
    pb = tx.playbooks_from_findings(f).first()
    assert pb.path == "playbooks/502-after-deploy.md" and pb.fix.startswith("Add health check")
    assert rows(tx.stubs_from_findings(f), "path") == [("architecture/RATE_LIMITING.md",),
                                                       ("playbooks/BACKUP_RESTORE.md",)]


def test_findings_extra_pipes_and_default_stub(spark):
    f = findings_df(spark, ["PATTERN|k|cause x|try a | b", "PATTERN|k|c|a|b|", "VAULTGAP|topic 5|",
                            "VAULTGAP|t|p/x.md|"])
    got = rows(tx.parse_findings(f), "line_no", "key", "b", "c")
    assert got == [(1, "k", "cause x", "try a | b"), (2, "k", "c", "a|b|"), (3, "topic 5", "", None),
                   (4, "t", "p/x.md", None)]
    stubs = rows(tx.stubs_from_findings(f), "path")
    assert stubs == [("known-issues/STUB_topic_5.md",), ("p/x.md",)]


def test_pattern_notes_in_line_order(spark):
    patterns = spark.createDataFrame([("k", "old", None), ("z", None, None)],
                                     "pattern_key string, root_cause string, mitigation string")
    f = findings_df(spark, ["PATTERN|k|first|fix1", "PATTERN| k |second|fix2"])
    out = up.append_pattern_notes(patterns, tx.pattern_findings(f), "2026-07-15 00:00:00")
    k = out.filter("pattern_key = 'k'").first()
    assert k.root_cause == "old\n[2026-07-15] first\n[2026-07-15] second"
    assert k.mitigation == "\n[2026-07-15] fix1\n[2026-07-15] fix2"
    assert out.filter("pattern_key = 'z'").first().root_cause is None


AS_OF = "2026-07-16 00:00:00"


def misses_df(spark):
    data = [("how to configure rate limiting", 4), ("backup restore procedure postgres", 3),
            ("webhook retry configuration", 2), ("single search", 1)]
    out, i = [], 0
    for q, n in data:
        for _ in range(n):
            i += 1
            out.append((i, q, False, None, datetime(2026, 7, 15, 12, 0)))
    return spark.createDataFrame(out, "id long, query string, resolved boolean, resolved_by string, "
                                      "created_at timestamp_ntz")


def test_misses_to_items_and_resolution(spark):
    m = misses_df(spark)
    items = rows(agg.misses_to_items(m, AS_OF), "lesson", "occurrence_count")
    assert items == [("Knowledge base has no good coverage for: backup restore procedure postgres", 3),
                     ("Knowledge base has no good coverage for: how to configure rate limiting", 4),
                     ("Knowledge base has no good coverage for: webhook retry configuration", 2)]
    resolved = up.resolve_misses_24h(m, AS_OF)
    assert resolved.filter("resolved AND resolved_by = 'learning-loop'").count() == 10


def test_errors_to_items(spark):
    patterns = spark.createDataFrame(
        [("missing-env-deploy", "ENV vars missing after deploy", "deployment", 12, False),
         ("auth-token-expired", "Token refresh not triggered", "auth", 8, False),
         ("db-connection-timeout", "Pool exhausted", "database", 6, False),
         ("old_%_key", "done", "x", 9, True)],
        "pattern_key string, description string, related_skill string, occurrence_count int, resolved boolean")
    items = spark.createDataFrame([(1, "error", "Recurring problem: db-connection-timeout - Pool exhausted")],
                                  "id long, source string, lesson string")
    out = rows(up.errors_to_items(patterns, items), "lesson", "occurrence_count")
    assert out == [("Recurring problem: auth-token-expired - Token refresh not triggered", 8),
                   ("Recurring problem: missing-env-deploy - ENV vars missing after deploy", 12)]


SESSION_MD = """# Session 2026-07-15: Fix login timeout

## Root Cause
Token refresh was not triggered because the refresh endpoint
returned 401 instead of 200 when the token was expired.

## Fix
Changed auth middleware to distinguish between invalid tokens (401)
and expired tokens (419), retry refresh on 419.

## Lesson
- Auth error codes must distinguish invalid vs expired tokens
"""


def lines_df(spark, name, text, file_col="file_name"):
    return spark.createDataFrame([(name, i + 1, l) for i, l in enumerate(text.split("\n"))],
                                 f"{file_col} string, line_no int, line string")


def test_session_item_from_example(spark):
    lines = lines_df(spark, "2026-07-15-fix-login-timeout.md", SESSION_MD)
    none = spark.createDataFrame([], "id long, source string, lesson string")
    out = [r.lesson for r in tx.session_items(lines, none).collect()]
    assert out == ["Session 2026-07-15-fix-login-timeout.md: "
                   "Auth error codes must distinguish invalid vs expired tokens"]
    # idempotent: once the item exists, the file yields nothing
    known = spark.createDataFrame([(1, "session", out[0])], "id long, source string, lesson string")
    assert tx.session_items(lines, known).count() == 0


def test_session_fallback_heading(spark):
    md = "# S\n## Summary\n> quote only\n\n## Result\nAll good now\n## Other\ntext"
    lines = lines_df(spark, "a.md", md)
    got = rows(tx.session_lessons_fallback(lines), "line")
    assert got == [("## Result",)]


CLASSIFIED = [
    "Item #31 | guard   | Create deployment guard that validates ENV vars before container swap",
    "Item #32 | memory  | Add auth-token-refresh gotcha to agent memory",
    "Item #33 | vault   | Document rate limiting configuration in architecture/",
    "Item #34 | config  | Increase DB connection pool from 10 to 25",
    'Item #35 | skip    | Too vague: "improve error handling" (no specific target)',
    "Item #36 | skip    | Already implemented: webhook retry (added in commit abc123)",
    "Item #37 | skip    | One-time problem: disk full event on 2026-07-10",
    "no id | guard | x",
    "38 | unknown | y",
]


def test_parse_classifications(spark):
    c = tx.parse_classifications(findings_df(spark, CLASSIFIED))
    got = rows(c, "id", "action")
    assert got == [(31, "guard"), (32, "memory"), (33, "vault"), (34, "config"), (35, "skip"), (36, "skip"),
                   (37, "skip")]


def tasks_df(spark, extra=()):
    data = [(142, "my-app", "Fix login timeout on mobile", "bug", "completed", None, datetime(2026, 7, 1)),
            (187, "my-app", "Login times out again on mobile after deploy", "bug", "completed", None,
             datetime(2026, 7, 15)),
            (150, "other", "Fix login timeout on mobile", "bug", "completed", None, datetime(2026, 7, 2))] + list(extra)
    return spark.createDataFrame(data, "id long, target_repo string, prompt string, category string, "
                                       "status string, outcome string, completed_at timestamp_ntz")


AS_OF_R = "2026-07-15 12:00:00"


def test_regression_example(spark):
    t = tasks_df(spark)
    kw = tx_kw = jn.task_keywords(t.filter("id = 187")).first().keywords
    assert kw[:5] == ["after", "again", "deploy", "login", "mobile"]
    del tx_kw
    pairs = jn.regression_candidates(t, AS_OF_R, new_days=1, lookback_days=30)
    assert rows(pairs, "new_id", "old_id") == [(187, 142)]
    from signalmine.plans.jobs import regression_job
    marked = regression_job(t, AS_OF_R).filter("id = 142").first()
    assert marked.outcome == "partial"
    assert marked.outcome_reason == "Possible regression: new bugfix 187 for same repo/symptom"


def test_claim_regressions_greedy(spark):
    # two new fixes, one older candidate: the newer new task claims it, the other gets none
    extra = [(190, "my-app", "Mobile login broken", "bug", "completed", None, datetime(2026, 7, 15, 6))]
    t = tasks_df(spark, extra)
    claims = rows(udfs.claim_regressions(t, AS_OF_R, new_days=1, lookback_days=30), "new_id", "old_id")
    # 190 (newest) claims 187 and 142 first; 187 then finds 142 taken
    assert claims == [(190, 142), (190, 187)]
    independent = rows(jn.regression_candidates(t, AS_OF_R, new_days=1, lookback_days=30), "new_id", "old_id")
    assert independent == [(187, 142), (190, 142), (190, 187)]


TASK_MD = """---
title: "Example: Add user profile page"
app: my-app
repo: /home/dev/my-app
branch: feature/user-profile
max_budget_usd: 5.00
max_hours: 4
verification: full
---

# Task: Add User Profile Page

## Phase 1: Database and API

- Add table

## Phase 2: Frontend Components

- Build page

## Notes
not a phase

## Phase 3: Integration and Polish

- Wire up"""


def test_task_document(spark):
    lines = lines_df(spark, "task.md", TASK_MD, "path")
    fm = tx.task_front_matter(lines).first()
    assert fm.title == "Example: Add user profile page" and fm.repo == "/home/dev/my-app"
    assert float(fm.max_budget_usd) == 5.0 and fm.max_hours == 4.0 and fm.verification == "full"
    phases = tx.task_phases(lines).orderBy("phase").collect()
    assert [p.phase for p in phases] == [1, 2, 3]
    assert "not a phase" not in phases[1].prompt
    runs = spark.createDataFrame([("task.md", 5.0, 3)], "path string, max_budget_usd double, n_phases int")
    assert float(rk.budget_per_phase(runs).first().budget_per_phase) == 1.66


LEARNINGS = """# Learnings
## 2026-07-01: Retry webhooks
Score: 5
Runs: 4
## 2026-07-02: Cache tokens
Score: 4
Runs: 2
## 2026-07-03: Done already
Score: 5
Runs: 9
CRYSTALLIZED
## Notes
Score: 9
Runs: 9"""


def test_crystallization(spark):
    lines = lines_df(spark, "deploy", LEARNINGS, "skill")
    got = rows(tx.crystallization_candidates(lines), "skill", "title", "score", "runs")
    assert got == [("deploy", "Retry webhooks", 5, 4)]
