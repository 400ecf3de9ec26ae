"""Registered queries: one Spark callable and (where SQL can say it) one
DuckDB oracle per operator of SURVEY §2.

Each callable takes ``(spark, sf_dir)`` and reads the driver tables under
``sf_dir`` through the derived views of ``signalmine.sources.fixtures``; each
oracle is ANSI SQL over the same driver tables (views inlined as CTEs).
Computed columns carry the same alias on both sides; doubles are rounded and
integers cast to BIGINT on both sides so values hash alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalmine.functions.constants import NOT_TABLES, STOP_WORDS, TABLE_REF, TOPIC_RULES
from signalmine.operators import aggregates as agg
from signalmine.operators import drift
from signalmine.operators import udfs
from signalmine.operators import filters as flt
from signalmine.operators import joins as jn
from signalmine.operators import ranking as rk
from signalmine.operators import similarity as sim
from signalmine.operators import text as tx
from signalmine.operators import updates as up
from signalmine.plans import jobs
from signalmine.plans.oracle_views import with_views
from signalmine.sources import files as src
from signalmine.sources import sinks
from signalmine.sources.fixtures import AS_OF_EVENTS, AS_OF_TASKS, Fixtures

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}

EV = f"TIMESTAMP '{AS_OF_EVENTS}'"
TK = f"TIMESTAMP '{AS_OF_TASKS}'"


def query(name: str, sql: str | None = None, views: tuple[str, ...] = ()):
    def deco(fn: Callable[[Fixtures], DataFrame]) -> Callable[[Fixtures], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Fixtures(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(sql, *views)
        return fn
    return deco


def _big(c: str) -> F.Column:
    return F.col(c).cast("bigint").alias(c)


def _dbl(c: str, digits: int = 4) -> F.Column:
    return F.round(F.col(c).cast("double"), digits).alias(c)


def _topic_sql_cases(col: str = "lesson") -> list[tuple[str, str]]:
    return [(name, f"regexp_matches({col}, '(?i){pattern}')") for name, pattern, _ in TOPIC_RULES]


_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)

# ============================ §2.2 projections, filters ============================


@query("open_items", """
SELECT id, source, CAST(occurrence_count AS BIGINT) AS occurrence_count, created_at
FROM learning_items WHERE applied = false""", ("learning_items",))
def q_open_items(fx: Fixtures) -> DataFrame:
    return flt.open_items(fx.learning_items).select("id", "source", _big("occurrence_count"), "created_at")


@query("recent_open_items", f"""
SELECT id, source, left(lesson, 60) AS lesson, CAST(occurrence_count AS BIGINT) AS occurrence_count, created_at
FROM learning_items WHERE applied = false AND created_at > {EV} - INTERVAL 14 DAY""", ("learning_items",))
def q_recent_open_items(fx: Fixtures) -> DataFrame:
    return flt.recent_open_items(fx.learning_items, AS_OF_EVENTS).select(
        "id", "source", "lesson", _big("occurrence_count"), "created_at")


@query("recurring_errors", """
SELECT pattern_key, category, CAST(occurrence_count AS BIGINT) AS occurrence_count
FROM error_patterns WHERE resolved = false AND occurrence_count >= 5""", ("error_patterns",))
def q_recurring_errors(fx: Fixtures) -> DataFrame:
    return flt.recurring_errors(fx.error_patterns, 5).select("pattern_key", "category", _big("occurrence_count"))


@query("actionable_patterns", """
SELECT pattern_key, CAST(occurrence_count AS BIGINT) AS occurrence_count FROM error_patterns
WHERE resolved = false AND (addressed = false OR addressed IS NULL) AND occurrence_count >= 3""", ("error_patterns",))
def q_actionable_patterns(fx: Fixtures) -> DataFrame:
    return flt.actionable_patterns(fx.error_patterns, 3).select("pattern_key", _big("occurrence_count"))


@query("recent_misses", f"""
SELECT id, query, created_at FROM rag_misses
WHERE resolved = false AND created_at > {EV} - INTERVAL 24 HOUR""", ("rag_misses",))
def q_recent_misses(fx: Fixtures) -> DataFrame:
    return flt.recent_misses(fx.rag_misses, AS_OF_EVENTS, hours=24).select("id", "query", "created_at")


@query("recent_decisions", f"""
SELECT id, skill_name, decision_type, judge_decision, was_applied, created_at FROM skill_decisions
WHERE created_at > {EV} - INTERVAL 7 DAY""", ("skill_decisions",))
def q_recent_decisions(fx: Fixtures) -> DataFrame:
    return flt.recent_decisions(fx.skill_decisions, AS_OF_EVENTS, 7)


@query("recent_completed_tasks", f"""
SELECT id, target_repo, prompt, category, completed_at FROM tasks
WHERE category IN ('bug', 'ops', 'security') AND status = 'completed' AND target_repo IS NOT NULL
  AND completed_at > {TK} - INTERVAL 30 DAY""", ("tasks",))
def q_recent_completed_tasks(fx: Fixtures) -> DataFrame:
    return flt.recent_completed_tasks(fx.tasks, AS_OF_TASKS, days=30)


@query("topic_tags", "SELECT id, source, concat_ws(',', " + ", ".join(
    f"CASE WHEN {cond} THEN '{name}' END" for name, cond in _topic_sql_cases()) +
    ") AS topics FROM learning_items_tagged WHERE applied = false", ("learning_items_tagged",))
def q_topic_tags(fx: Fixtures) -> DataFrame:
    return flt.topic_tags(fx.learning_items_tagged).select("id", "source", F.array_join("topics", ",").alias("topics"))


@query("topic_tags_by_rules", """
SELECT i.id, i.source, coalesce(string_agg(DISTINCT r.name, ',' ORDER BY r.name), '') AS topics FROM learning_items i
LEFT JOIN topic_rules r ON regexp_matches(i.lesson, '(?i)' || r.pattern) WHERE i.applied = false GROUP BY i.id, i.source""",
       ("learning_items", "topic_rules"))
def q_topic_tags_by_rules(fx: Fixtures) -> DataFrame:
    out = flt.topic_tags_by_rules(fx.learning_items, fx.topic_rules)
    return out.select("id", "source", F.array_join("topics", ",").alias("topics"))


@query("topic_counts_by_rules", """
SELECT r.name, count(i.id) AS open_items FROM topic_rules r
LEFT JOIN learning_items i ON i.applied = false AND regexp_matches(i.lesson, '(?i)' || r.pattern) GROUP BY r.name""",
       ("learning_items", "topic_rules"))
def q_topic_counts_by_rules(fx: Fixtures) -> DataFrame:
    return agg.topic_counts_by_rules(fx.learning_items, fx.topic_rules)


@query("daily_quota_gate", """
SELECT DATE '2024-01-30' AS day, count(*) AS auto_today, count(*) >= 3 AS limit_reached FROM skill_decisions
WHERE decision_type = 'autonomous' AND was_applied = true AND CAST(created_at AS DATE) = DATE '2024-01-30'""",
       ("skill_decisions",))
def q_daily_quota_gate(fx: Fixtures) -> DataFrame:
    return flt.daily_quota_gate(fx.skill_decisions, "2024-01-30 00:00:00", 3)


@query("alert_priority", """
WITH t AS (SELECT c.conv_id, string_agg(c.text, ' ' ORDER BY c.turn) AS triage_text, count(*) AS pattern_count
           FROM conversations c WHERE c.role = 'assistant' GROUP BY c.conv_id)
SELECT conv_id, CAST(pattern_count AS BIGINT) AS pattern_count,
 CASE WHEN regexp_matches(triage_text, '(?i)(critical|security|immediate)') THEN 'high'
      WHEN pattern_count > 5 THEN 'default' ELSE 'low' END AS priority FROM t""")
def q_alert_priority(fx: Fixtures) -> DataFrame:
    c = fx.table("conversations").filter(F.col("role") == "assistant")
    t = c.groupBy("conv_id").agg(tx.ordered_text("turn", "text", " ").alias("triage_text"),
                                 F.count(F.lit(1)).alias("pattern_count"))
    return flt.alert_priority(t).select("conv_id", _big("pattern_count"), "priority")


# ============================ §2.4 aggregations ============================


@query("miss_clusters", """
SELECT query AS query_prefix, count(*) AS miss_count, max(created_at) AS last_miss
FROM rag_misses WHERE resolved = false GROUP BY query HAVING count(*) >= 2""", ("rag_misses",))
def q_miss_clusters(fx: Fixtures) -> DataFrame:
    return agg.miss_clusters(fx.rag_misses)


@query("miss_counts_7d", f"""
SELECT query, count(*) AS miss_count FROM rag_misses
WHERE created_at > {EV} - INTERVAL 7 DAY GROUP BY query""",
       ("rag_misses",))
def q_miss_counts_7d(fx: Fixtures) -> DataFrame:
    return agg.miss_counts_7d(fx.rag_misses, AS_OF_EVENTS)


@query("miss_last_seen", """
SELECT query, count(*) AS miss_count, max(created_at) AS last_miss FROM rag_misses WHERE resolved = false
GROUP BY query HAVING count(*) >= 3""", ("rag_misses",))
def q_miss_last_seen(fx: Fixtures) -> DataFrame:
    return agg.miss_last_seen(fx.rag_misses, 3)


@query("misses_to_items", f"""
SELECT 'rag_miss' AS source, 'Knowledge base has no good coverage for: ' || query AS lesson,
 'vault' AS applicable_to, CAST(count(*) AS BIGINT) AS occurrence_count
FROM rag_misses WHERE resolved = false AND created_at > {EV} - INTERVAL 24 HOUR
GROUP BY query HAVING count(*) >= 2""", ("rag_misses",))
def q_misses_to_items(fx: Fixtures) -> DataFrame:
    return agg.misses_to_items(fx.rag_misses, AS_OF_EVENTS).select(
        "source", "lesson", "applicable_to", _big("occurrence_count"))


@query("word_clusters", f"""
WITH words AS (SELECT unnest(string_to_array(regexp_replace(lower(lesson), '[^a-z0-9 ]', ' ', 'g'), ' ')) AS word
               FROM learning_items WHERE applied = false)
SELECT word, count(*) AS occurrences FROM words
WHERE length(word) > 5 AND word NOT IN ({_STOP})
GROUP BY word HAVING count(*) >= 5""", ("learning_items",))
def q_word_clusters(fx: Fixtures) -> DataFrame:
    return agg.word_clusters(fx.learning_items)


@query("topic_counts", "SELECT " + ", ".join(
    f"count(*) FILTER (WHERE {cond}) AS {name}" for name, cond in _topic_sql_cases()) +
    ", count(*) AS open_total FROM learning_items_tagged WHERE applied = false", ("learning_items_tagged",))
def q_topic_counts(fx: Fixtures) -> DataFrame:
    return agg.topic_counts(fx.learning_items_tagged)


@query("skill_scorecard", """
SELECT skill_name, count(*) AS total_uses,
 round(CAST(avg(CASE WHEN success THEN 100 ELSE 0 END) AS DECIMAL(20,6)), 2)::DOUBLE AS success_rate,
 round(avg(duration_minutes * 60000), 0)::DOUBLE AS avg_duration_ms, max(created_at) AS last_used
FROM skill_metrics WHERE invoked = true GROUP BY skill_name""",
       ("skill_metrics",))
def q_skill_scorecard(fx: Fixtures) -> DataFrame:
    return agg.skill_scorecard(fx.skill_metrics)


@query("open_counts", """
SELECT 'open_items' AS metric, count(*) FILTER (WHERE applied = false) AS value FROM learning_items
UNION ALL SELECT 'open_misses', count(*) FILTER (WHERE resolved = false) FROM rag_misses""",
       ("learning_items", "rag_misses"))
def q_open_counts(fx: Fixtures) -> DataFrame:
    return agg.open_counts(fx.learning_items, fx.rag_misses)


@query("phase_summary", """
SELECT run_id, round(CAST(sum(cost_usd) AS DOUBLE), 2) AS total_cost_usd, CAST(sum(duration_s) AS BIGINT) AS total_duration_s,
 count(*) FILTER (WHERE gate_ok) AS phases_ok, count(*) FILTER (WHERE NOT gate_ok) AS phases_failed,
 CASE WHEN count(*) FILTER (WHERE NOT gate_ok) = 0 THEN 'SUCCESS' ELSE 'WITH ERRORS' END AS status
FROM phase_runs GROUP BY run_id""", ("phase_runs",))
def q_phase_summary(fx: Fixtures) -> DataFrame:
    return agg.phase_summary(fx.phase_runs).select(
        "run_id", _dbl("total_cost_usd", 2), "total_duration_s", "phases_ok", "phases_failed", "status")


@query("run_summary", """
WITH f AS (SELECT CASE WHEN split_part(line, '|', 1) IN ('PLAYBOOK','APPLY','PATTERN','VAULTGAP')
                  THEN split_part(line, '|', 1) END AS type, split_part(line, '|', 2) AS key FROM findings)
SELECT count(*) FILTER (WHERE type = 'PLAYBOOK') AS playbooks, count(*) FILTER (WHERE type = 'APPLY') AS applied,
 count(*) FILTER (WHERE type = 'PATTERN') AS patterns, count(*) FILTER (WHERE type = 'VAULTGAP') AS gaps,
 count(*) FILTER (WHERE type IS NOT NULL) AS total FROM f WHERE key <> ''""", ("findings",))
def q_run_summary(fx: Fixtures) -> DataFrame:
    parsed = tx.parse_findings(fx.findings).filter(F.col("key") != "")
    return agg.run_summary(parsed)


# ============================ §2.5 windows ============================


@query("latest_proposal", """
SELECT id, target_skill, status, CAST(recurrence_count AS BIGINT) AS recurrence_count, created_at FROM (
 SELECT *, row_number() OVER (PARTITION BY target_skill ORDER BY created_at DESC, id DESC) AS rn FROM skill_proposals) t
WHERE rn = 1""", ("skill_proposals",))
def q_latest_proposal(fx: Fixtures) -> DataFrame:
    return rk.latest_proposal(fx.skill_proposals).select(
        "id", "target_skill", "status", _big("recurrence_count"), "created_at")


@query("first_per_group", """
SELECT source, sha256(lesson) AS lesson_key, min(id) AS first_id, count(*) AS group_size
FROM learning_items WHERE applied = false GROUP BY source, lesson HAVING count(*) > 1""",
       ("learning_items",))
def q_first_per_group(fx: Fixtures) -> DataFrame:
    return jn.first_per_group(fx.learning_items)


@query("head_lines", """
SELECT session_id, file_name, line_no, line FROM (
 SELECT *, row_number() OVER (PARTITION BY file_name ORDER BY line_no) AS rn FROM session_lines) t WHERE rn <= 3""",
       ("session_lines",))
def q_head_lines(fx: Fixtures) -> DataFrame:
    return rk.head_lines(fx.session_lines, 3).select("session_id", "file_name", "line_no", "line")


_PHASE_ORDER = ("phase", "cost_usd", "duration_s", "gate_ok")


@query("running_budget", """
SELECT run_id, phase, round(CAST(coalesce(sum(cost_usd) OVER (PARTITION BY run_id ORDER BY phase, cost_usd, duration_s, gate_ok
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE), 2) AS spent_before,
 coalesce(sum(cost_usd) OVER (PARTITION BY run_id ORDER BY phase, cost_usd, duration_s, gate_ok ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
  <= max_budget_usd AS runs
FROM phase_runs""", ("phase_runs",))
def q_running_budget(fx: Fixtures) -> DataFrame:
    # phase numbers repeat within a run in the fixture: order by every column so
    # equal rows are interchangeable and the result multiset is deterministic
    return rk.running_budget(fx.phase_runs, order=_PHASE_ORDER).select("run_id", "phase", _dbl("spent_before", 2), "runs")


@query("running_time_limit", """
SELECT run_id, phase, CAST(coalesce(sum(duration_s) OVER (PARTITION BY run_id ORDER BY phase, cost_usd, duration_s, gate_ok
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS elapsed_before_s,
 coalesce(sum(duration_s) OVER (PARTITION BY run_id ORDER BY phase, cost_usd, duration_s, gate_ok ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
  <= 90 AS runs
FROM phase_runs""", ("phase_runs",))
def q_running_time_limit(fx: Fixtures) -> DataFrame:
    # fixture limit: 90 s (0.025 h), so that long runs stop early
    return rk.running_time_limit(fx.phase_runs, 0.025, order=_PHASE_ORDER).select("run_id", "phase", _big("elapsed_before_s"), "runs")


@query("resume_point", """
SELECT run_id, coalesce(max(CASE WHEN gate_ok THEN phase END), 0) + 1 AS resume_phase FROM phase_runs GROUP BY run_id""",
       ("phase_runs",))
def q_resume_point(fx: Fixtures) -> DataFrame:
    return rk.resume_point(fx.phase_runs)


@query("budget_per_phase", """
SELECT run_id, count(*) AS n_phases, CAST(floor(CAST(max(max_budget_usd) AS DECIMAL(20,4)) * 100 / count(*)) / 100 AS DOUBLE)
 AS budget_per_phase FROM phase_runs GROUP BY run_id""", ("phase_runs",))
def q_budget_per_phase(fx: Fixtures) -> DataFrame:
    runs = fx.phase_runs.groupBy("run_id").agg(F.count(F.lit(1)).alias("n_phases"),
                                               F.max("max_budget_usd").alias("max_budget_usd"))
    return rk.budget_per_phase(runs).select("run_id", "n_phases", _dbl("budget_per_phase", 2))


# ============================ §2.6 sorts, limits, top-k ============================


@query("top_open_items", """
SELECT id, source, left(lesson, 150) AS lesson, CAST(occurrence_count AS BIGINT) AS occurrence_count, created_at
FROM learning_items WHERE applied = false ORDER BY occurrence_count DESC, created_at DESC, id LIMIT 15""",
       ("learning_items",))
def q_top_open_items(fx: Fixtures) -> DataFrame:
    return rk.top_open_items(fx.learning_items, 15, 150).select(
        "id", "source", "lesson", _big("occurrence_count"), "created_at")


@query("top_recent_items", f"""
SELECT id, source, left(lesson, 60) AS lesson, CAST(occurrence_count AS BIGINT) AS occurrence_count
FROM learning_items WHERE applied = false AND created_at > {EV} - INTERVAL 14 DAY
ORDER BY occurrence_count DESC, id LIMIT 10""", ("learning_items",))
def q_top_recent_items(fx: Fixtures) -> DataFrame:
    return rk.top_recent_items(fx.learning_items, AS_OF_EVENTS).select(
        "id", "source", "lesson", _big("occurrence_count"))


@query("top_errors", """
SELECT pattern_key, category, CAST(occurrence_count AS BIGINT) AS occurrence_count, left(description, 80) AS description
FROM error_patterns WHERE resolved = false AND occurrence_count >= 2 ORDER BY occurrence_count DESC, pattern_key LIMIT 10""",
       ("error_patterns",))
def q_top_errors(fx: Fixtures) -> DataFrame:
    return rk.top_errors(fx.error_patterns, 10, 2).select(
        "pattern_key", "category", _big("occurrence_count"), "description")


@query("top_error_lessons", """
SELECT id, left(lesson, 200) AS lesson, CAST(occurrence_count AS BIGINT) AS occurrence_count FROM learning_items
WHERE applied = false AND source = 'error' ORDER BY occurrence_count DESC, id LIMIT 5""", ("learning_items",))
def q_top_error_lessons(fx: Fixtures) -> DataFrame:
    return rk.top_error_lessons(fx.learning_items).select("id", "lesson", _big("occurrence_count"))


@query("latest_session_lessons", """
SELECT id, left(lesson, 200) AS lesson, created_at FROM learning_items
WHERE applied = false AND source = 'session' ORDER BY created_at DESC, id DESC LIMIT 10""", ("learning_items",))
def q_latest_session_lessons(fx: Fixtures) -> DataFrame:
    return rk.latest_session_lessons(fx.learning_items)


@query("scan_recent_commits", f"""
SELECT repo, sha, subject, committed_at, rank FROM (
 SELECT *, CAST(row_number() OVER (PARTITION BY repo ORDER BY committed_at DESC, sha DESC) AS INTEGER) AS rank
 FROM commits WHERE NOT is_merge AND committed_at > {TK} - INTERVAL 30 DAY) t WHERE rank <= 5""", ("commits",))
def q_scan_recent_commits(fx: Fixtures) -> DataFrame:
    return src.scan_recent_commits(fx.commits, AS_OF_TASKS, days=30, per_repo=5)


@query("newest_sessions", """
WITH s AS (SELECT file_name, count(*) AS summary_lines FROM session_lines
           WHERE regexp_matches(line, '^#|Root Cause|Result|Fix:|Commit:') GROUP BY file_name)
SELECT file_name, CAST(summary_lines AS BIGINT) AS summary_lines FROM s
ORDER BY file_name DESC LIMIT 10""", ("session_lines",))
def q_newest_sessions(fx: Fixtures) -> DataFrame:
    s = tx.summary_counts(fx.session_lines)
    return rk.newest_sessions(s, 10).select("file_name", _big("summary_lines"))


# ============================ §2.3 joins ============================


@query("duplicate_items", """
SELECT DISTINCT l1.id FROM learning_items l1 JOIN learning_items l2
  ON l1.id > l2.id AND l1.source = l2.source AND l1.lesson = l2.lesson
WHERE l1.applied = false AND l2.applied = false""", ("learning_items",))
def q_duplicate_items(fx: Fixtures) -> DataFrame:
    return jn.duplicate_items(fx.learning_items)


@query("errors_without_item", """
SELECT pattern_key, CAST(occurrence_count AS BIGINT) AS occurrence_count FROM error_patterns p
WHERE resolved = false AND occurrence_count >= 5 AND NOT EXISTS (
  SELECT 1 FROM learning_items li WHERE li.source = 'error' AND contains(li.lesson, p.pattern_key))""",
       ("error_patterns", "learning_items"))
def q_errors_without_item(fx: Fixtures) -> DataFrame:
    return jn.errors_without_item(fx.error_patterns, fx.learning_items, 5).select(
        "pattern_key", _big("occurrence_count"))


@query("sessions_without_item", """
SELECT DISTINCT file_name FROM session_lines s WHERE NOT EXISTS (
  SELECT 1 FROM learning_items li WHERE li.source = 'session' AND contains(li.lesson, s.file_name))""",
       ("session_lines", "learning_items"))
def q_sessions_without_item(fx: Fixtures) -> DataFrame:
    files = fx.session_lines.select("file_name").distinct()
    return jn.sessions_without_item(files, fx.learning_items)


_GAP_CLUSTERS = """c AS (SELECT query AS query_prefix, count(*) AS miss_count FROM rag_misses
  WHERE resolved = false GROUP BY query HAVING count(*) >= 2)"""


@query("misses_by_prefix", f"""
WITH {_GAP_CLUSTERS}
SELECT m.id, c.query_prefix FROM rag_misses m JOIN c ON starts_with(m.query, c.query_prefix)""", ("rag_misses",))
def q_misses_by_prefix(fx: Fixtures) -> DataFrame:
    clusters = agg.miss_clusters(fx.rag_misses)
    return jn.misses_by_prefix(fx.rag_misses, clusters)


_PROPOSAL_CANDS = """top AS (SELECT pattern_key, description, occurrence_count FROM error_patterns
  WHERE resolved = false AND occurrence_count >= 5),
cand AS (SELECT * FROM (SELECT pattern_key, regexp_replace(pattern_key, '[^a-zA-Z0-9_-]', '', 'g') AS key_clean,
  regexp_replace(description, '[^a-zA-Z0-9 _.,;:!?()-]', '', 'g') AS desc_clean,
  CAST(occurrence_count AS INTEGER) AS occurrence_count FROM top) x
  QUALIFY row_number() OVER (PARTITION BY key_clean ORDER BY occurrence_count DESC, pattern_key) = 1),
latest AS (SELECT target_skill, status AS old_status, recurrence_count AS old_count FROM (
  SELECT *, row_number() OVER (PARTITION BY target_skill ORDER BY created_at DESC, id DESC) AS rn FROM skill_proposals) t
  WHERE rn = 1),
pc AS (SELECT c.pattern_key, 'dreaming:' || c.key_clean AS target_skill, c.key_clean, c.desc_clean, c.occurrence_count,
  l.old_status, coalesce(l.old_count, 0) AS old_count
  FROM cand c LEFT JOIN latest l ON l.target_skill = 'dreaming:' || c.key_clean
  WHERE l.old_status IS NULL OR (l.old_status = 'rejected' AND c.occurrence_count > 2 * coalesce(l.old_count, 0))
     OR l.old_status NOT IN ('pending', 'auto_merged', 'rejected'))"""


@query("proposal_candidates", f"""
WITH {_PROPOSAL_CANDS}
SELECT pattern_key, target_skill, CAST(occurrence_count AS BIGINT) AS occurrence_count, old_status,
 CAST(old_count AS BIGINT) AS old_count FROM pc""", ("error_patterns", "skill_proposals"))
def q_proposal_candidates(fx: Fixtures) -> DataFrame:
    return jn.proposal_candidates(fx.error_patterns, fx.skill_proposals).select(
        "pattern_key", "target_skill", _big("occurrence_count"), "old_status", _big("old_count"))


@query("regression_candidates", f"""
WITH new AS (SELECT id AS new_id, target_repo AS repo, completed_at AS new_completed_at,
  list_sort(list_distinct(regexp_extract_all(lower(prompt), '\\b[a-z]{{4,}}\\b'))) AS kws
  FROM tasks WHERE category IN ('bug','ops','security') AND status = 'completed' AND target_repo IS NOT NULL
   AND completed_at > {TK} - INTERVAL 30 DAY),
nk AS (SELECT new_id, repo, new_completed_at, unnest(kws) AS kw FROM new),
old AS (SELECT id AS old_id, target_repo AS repo, completed_at AS old_completed_at, lower(prompt) AS old_prompt FROM tasks
  WHERE category IN ('bug','ops','security') AND status = 'completed' AND target_repo IS NOT NULL
   AND completed_at > {TK} - INTERVAL 365 DAY AND outcome IS NULL),
pairs AS (SELECT DISTINCT nk.new_id, old.old_id, old.repo, old.old_completed_at FROM nk JOIN old ON nk.repo = old.repo
  WHERE old.old_id <> nk.new_id AND old.old_completed_at < nk.new_completed_at AND contains(old.old_prompt, nk.kw))
SELECT new_id, old_id, repo, old_completed_at, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY new_id ORDER BY old_completed_at DESC, old_id DESC) AS INTEGER) AS rank
  FROM pairs) t WHERE rank <= 3""", ("tasks",))
def q_regression_candidates(fx: Fixtures) -> DataFrame:
    return jn.regression_candidates(fx.tasks, AS_OF_TASKS, new_days=30, lookback_days=365, k=3)


@query("task_keywords", """
SELECT id, array_to_string(list_sort(list_distinct(
  regexp_extract_all(lower(prompt), '\\b[a-z]{4,}\\b'))), ',') AS keywords FROM tasks""", ("tasks",))
def q_task_keywords(fx: Fixtures) -> DataFrame:
    return jn.task_keywords(fx.tasks).select("id", F.array_join("keywords", ",").alias("keywords"))


@query("undocumented_terms", """
WITH toks AS (SELECT DISTINCT d.lang AS app, unnest(regexp_extract_all(lower(d.text), '[a-z0-9_]+')) AS term FROM documents d)
SELECT t.app, t.term FROM doc_terms t LEFT JOIN toks ON toks.app = t.app AND toks.term = t.term WHERE toks.term IS NULL""",
       ("doc_terms",))
def q_undocumented_terms(fx: Fixtures) -> DataFrame:
    docs = fx.documents.select(F.col("lang").alias("app"), "text")
    return jn.undocumented_terms(fx.doc_terms, docs)


# ============================ §2.9 table-changing transforms ============================


@query("archive_noise", f"""
SELECT id, (applied OR rule IS NOT NULL) AS applied, CASE WHEN rule IS NOT NULL THEN {EV} ELSE applied_at END AS applied_at,
 CAST(coalesce(rule, 0) AS INTEGER) AS archived_rule FROM (
 SELECT *, CASE WHEN applied = false AND occurrence_count = 1 AND created_at < {EV} - INTERVAL 14 DAY THEN 1
                WHEN applied = false AND occurrence_count <= 2 AND created_at < {EV} - INTERVAL 30 DAY THEN 2 END AS rule
 FROM learning_items) t""", ("learning_items",))
def q_archive_noise(fx: Fixtures) -> DataFrame:
    return up.archive_noise(fx.learning_items, AS_OF_EVENTS).select("id", "applied", "applied_at", "archived_rule")


@query("purge_applied", """
SELECT id FROM learning_items
WHERE NOT coalesce(applied = true AND applied_at < TIMESTAMP '2024-02-14 00:00:00' - INTERVAL 30 DAY, false)""",
       ("learning_items",))
def q_purge_applied(fx: Fixtures) -> DataFrame:
    return up.purge_applied(fx.learning_items, "2024-02-14 00:00:00").select("id")


@query("close_duplicates", f"""
WITH d AS (SELECT DISTINCT l1.id FROM learning_items l1 JOIN learning_items l2
  ON l1.id > l2.id AND l1.source = l2.source AND l1.lesson = l2.lesson
  WHERE l1.applied = false AND l2.applied = false)
SELECT li.id, (li.applied OR d.id IS NOT NULL) AS applied,
 CASE WHEN d.id IS NOT NULL THEN {EV} ELSE li.applied_at END AS applied_at
FROM learning_items li LEFT JOIN d ON d.id = li.id""", ("learning_items",))
def q_close_duplicates(fx: Fixtures) -> DataFrame:
    return up.close_duplicates(fx.learning_items, AS_OF_EVENTS).select("id", "applied", "applied_at")


@query("resolve_misses_24h", f"""
SELECT id, (resolved OR hit) AS resolved, CASE WHEN hit THEN 'learning-loop' END AS resolved_by FROM (
 SELECT *, (resolved = false AND created_at > {EV} - INTERVAL 24 HOUR) AS hit FROM rag_misses) t""", ("rag_misses",))
def q_resolve_misses_24h(fx: Fixtures) -> DataFrame:
    return up.resolve_misses_24h(fx.rag_misses, AS_OF_EVENTS).select("id", "resolved", "resolved_by")


@query("resolve_misses_by_cluster", f"""
WITH {_GAP_CLUSTERS}, hit AS (SELECT DISTINCT m.id FROM rag_misses m JOIN c ON starts_with(m.query, c.query_prefix))
SELECT m.id, (m.resolved OR (h.id IS NOT NULL AND m.resolved = false)) AS resolved,
 CASE WHEN h.id IS NOT NULL AND m.resolved = false THEN 'rag-filler-stub' END AS resolved_by
FROM rag_misses m LEFT JOIN hit h ON h.id = m.id""", ("rag_misses",))
def q_resolve_misses_by_cluster(fx: Fixtures) -> DataFrame:
    clusters = agg.miss_clusters(fx.rag_misses)
    hits = jn.misses_by_prefix(fx.rag_misses, clusters)
    return up.resolve_misses_by_cluster(fx.rag_misses, hits, "rag-filler-stub").select("id", "resolved", "resolved_by")


@query("mark_applied", f"""
WITH ids AS (SELECT DISTINCT TRY_CAST(regexp_replace(split_part(line, '|', 2), '[^0-9]', '', 'g') AS BIGINT) AS id
             FROM findings WHERE split_part(line, '|', 1) = 'APPLY' AND split_part(line, '|', 2) <> '')
SELECT li.id, (li.applied OR (ids.id IS NOT NULL AND li.applied = false)) AS applied,
 CASE WHEN ids.id IS NOT NULL AND li.applied = false THEN {EV} ELSE li.applied_at END AS applied_at,
 coalesce(ids.id IS NOT NULL AND li.applied = false, false) AS changed
FROM learning_items li LEFT JOIN ids ON ids.id = li.id""", ("learning_items", "findings"))
def q_mark_applied(fx: Fixtures) -> DataFrame:
    ids = tx.applied_ids(fx.findings)
    return up.mark_applied(fx.learning_items, ids, AS_OF_EVENTS).select("id", "applied", "applied_at", "changed")


@query("append_pattern_notes", """
WITH pf AS (SELECT line_no, regexp_replace(trim(split_part(line, '|', 2)), '\\s+', ' ', 'g') AS pattern_key,
  split_part(line, '|', 3) AS cause, array_to_string(list_slice(string_split(line, '|'), 4, 1000000), '|') AS fix
  FROM findings WHERE split_part(line, '|', 1) = 'PATTERN' AND split_part(line, '|', 2) <> ''),
notes AS (SELECT pattern_key, string_agg(chr(10) || '[2024-01-31] ' || cause, '' ORDER BY line_no) AS add_cause,
  string_agg(chr(10) || '[2024-01-31] ' || fix, '' ORDER BY line_no) AS add_fix FROM pf
  WHERE pattern_key <> '' GROUP BY pattern_key)
SELECT p.pattern_key, CASE WHEN n.add_cause IS NOT NULL THEN '' || n.add_cause END AS root_cause,
 CASE WHEN n.add_cause IS NOT NULL THEN '' || n.add_fix END AS mitigation, n.add_cause IS NOT NULL AS changed
FROM error_patterns p LEFT JOIN notes n ON n.pattern_key = p.pattern_key""", ("error_patterns", "findings"))
def q_append_pattern_notes(fx: Fixtures) -> DataFrame:
    out = up.append_pattern_notes(fx.error_patterns, tx.pattern_findings(fx.findings), AS_OF_EVENTS)
    return out.select("pattern_key", "root_cause", "mitigation", "changed")


@query("make_proposals", f"""
WITH {_PROPOSAL_CANDS}
SELECT 'NEW_RULE' AS proposal_type, target_skill,
 'Dreaming proposal: Pattern "' || key_clean || '" occurs ' || CAST(occurrence_count AS VARCHAR) || 'x (previously: '
  || CAST(old_count AS VARCHAR) || 'x). ' || desc_clean || '. Recommendation: Create guard or skill for prevention.'
  AS proposal_content,
 CAST(occurrence_count AS BIGINT) AS recurrence_count, CAST(least(occurrence_count, 10) AS BIGINT) AS confidence,
 'pending' AS status FROM pc""", ("error_patterns", "skill_proposals"))
def q_make_proposals(fx: Fixtures) -> DataFrame:
    cands = jn.proposal_candidates(fx.error_patterns, fx.skill_proposals)
    return up.make_proposals(cands, AS_OF_EVENTS).select(
        "proposal_type", "target_skill", "proposal_content", _big("recurrence_count"), _big("confidence"), "status")


@query("errors_to_items", """
SELECT 'error' AS source, 'Recurring problem: ' || pattern_key || ' - ' || coalesce(description, '') AS lesson,
 related_skill AS applicable_to, CAST(occurrence_count AS BIGINT) AS occurrence_count FROM error_patterns p
WHERE resolved = false AND occurrence_count >= 5 AND NOT EXISTS (
  SELECT 1 FROM learning_items li WHERE li.source = 'error' AND contains(li.lesson, p.pattern_key))""",
       ("error_patterns", "learning_items"))
def q_errors_to_items(fx: Fixtures) -> DataFrame:
    return up.errors_to_items(fx.error_patterns, fx.learning_items).select(
        "source", "lesson", "applicable_to", _big("occurrence_count"))


# ============================ §2.10 text extraction ============================


@query("parse_findings", """
SELECT line_no, CASE WHEN split_part(line, '|', 1) IN ('PLAYBOOK','APPLY','PATTERN','VAULTGAP')
   THEN split_part(line, '|', 1) END AS type, split_part(line, '|', 2) AS key,
 CASE WHEN split_part(line, '|', 1) = 'VAULTGAP'
      THEN regexp_replace(array_to_string(list_slice(string_split(line, '|'), 3, 1000000), '|'), '^([^|]*)\\|$', '\\1')
      ELSE split_part(line, '|', 3) END AS b,
 CASE WHEN split_part(line, '|', 1) = 'VAULTGAP' THEN NULL
      WHEN len(string_split(line, '|')) < 4 THEN NULL
      ELSE regexp_replace(array_to_string(list_slice(string_split(line, '|'), 4, 1000000), '|'), '^([^|]*)\\|$', '\\1')
 END AS c
FROM findings""", ("findings",))
def q_parse_findings(fx: Fixtures) -> DataFrame:
    return tx.parse_findings(fx.findings)


@query("playbooks_from_findings", """
WITH p AS (SELECT line_no, split_part(line, '|', 2) AS symptom, split_part(line, '|', 3) AS diagnosis,
  array_to_string(list_slice(string_split(line, '|'), 4, 1000000), '|') AS fix FROM findings
  WHERE split_part(line, '|', 1) = 'PLAYBOOK' AND split_part(line, '|', 2) <> ''),
s AS (SELECT *, regexp_replace(replace(lower(symptom), ' ', '-'), '[^a-z0-9-]', '', 'g') AS slug FROM p)
SELECT 'playbooks/' || slug || '.md' AS path, slug, symptom, diagnosis, fix, line_no FROM (
  SELECT *, row_number() OVER (PARTITION BY slug ORDER BY line_no) AS rn FROM s) t WHERE rn = 1""", ("findings",))
def q_playbooks_from_findings(fx: Fixtures) -> DataFrame:
    return tx.playbooks_from_findings(fx.findings)


@query("stubs_from_findings", """
WITH g AS (SELECT line_no, split_part(line, '|', 2) AS topic,
  regexp_replace(array_to_string(list_slice(string_split(line, '|'), 3, 1000000), '|'), '^([^|]*)\\|$', '\\1') AS p
  FROM findings WHERE split_part(line, '|', 1) = 'VAULTGAP' AND split_part(line, '|', 2) <> ''),
s AS (SELECT line_no, topic, coalesce(nullif(p, ''), 'known-issues/STUB_' || replace(topic, ' ', '_') || '.md') AS path FROM g)
SELECT path, '---' || chr(10) || 'title: ' || topic || chr(10) || 'type: stub' || chr(10) || 'created: 2024-01-31' || chr(10)
 || 'source: dreaming-rag-miss' || chr(10) || 'status: todo' || chr(10) || '---' || chr(10) || chr(10) || '# ' || topic || chr(10) || chr(10)
 || '> This document was automatically created because knowledge base searches' || chr(10)
 || '> for this topic returned no results. Please fill with content.' || chr(10) || chr(10) || '## Context' || chr(10)
 || 'Created by Dreaming Run #7 on 2024-01-31.' || chr(10) AS content
FROM (SELECT *, row_number() OVER (PARTITION BY path ORDER BY line_no) AS rn FROM s) t WHERE rn = 1""", ("findings",))
def q_stubs_from_findings(fx: Fixtures) -> DataFrame:
    return tx.stub_content(tx.stubs_from_findings(fx.findings), AS_OF_EVENTS[:10], 7)


@query("session_headline", """
SELECT file_name, arg_min(line, line_no) AS headline FROM session_lines
WHERE regexp_matches(line, 'RESULT|result|Result|## ') GROUP BY file_name""", ("session_lines",))
def q_session_headline(fx: Fixtures) -> DataFrame:
    return tx.session_headline(fx.session_lines)


@query("session_summary", """
SELECT file_name, string_agg(line, chr(10) ORDER BY line_no) AS summary, count(*) AS summary_lines FROM (
  SELECT * FROM session_lines WHERE regexp_matches(line, '^#|Root Cause|Result|Fix:|Commit:')) t GROUP BY file_name""",
       ("session_lines",))
def q_session_summary(fx: Fixtures) -> DataFrame:
    return tx.session_summary(fx.session_lines)


_LESSON_RE = ("^\\s*[-*]\\s.*(open|lesson|insight|decision|fix|workaround|problem|solution|cause|error|change"
              "|recommendation|important|critical)")


@query("session_lessons", f"""
SELECT file_name, line_no, line, CAST(lesson_rank AS INTEGER) AS lesson_rank FROM (
  SELECT *, row_number() OVER (PARTITION BY file_name ORDER BY line_no) AS lesson_rank FROM session_lines
  WHERE regexp_matches(line, '(?i){_LESSON_RE}')) t""", ("session_lines",))
def q_session_lessons(fx: Fixtures) -> DataFrame:
    return tx.session_lessons(fx.session_lines).select("file_name", "line_no", "line", "lesson_rank")


_FALLBACK_SECTIONS = """s AS (SELECT *, starts_with(line, '##') AS is_head,
  sum(CAST(starts_with(line, '##') AS INTEGER)) OVER (PARTITION BY file_name ORDER BY line_no
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS section FROM session_lines),
sect AS (SELECT file_name, section, max(CASE WHEN is_head THEN line END) AS heading,
  min(CASE WHEN is_head THEN line_no END) AS line_no,
  max(CAST(NOT is_head AND NOT starts_with(line, '>') AND regexp_matches(line, '\\p{L}') AS INTEGER)) AS has_body
  FROM s GROUP BY file_name, section),
fb AS (SELECT file_name, line_no, heading AS line, row_number() OVER (PARTITION BY file_name ORDER BY line_no) AS lesson_rank
  FROM sect WHERE regexp_matches(heading, '(?i)^##.*(result|insight|conclusion|summary|change|completed)') AND has_body = 1)"""


@query("session_lessons_fallback", f"""
WITH {_FALLBACK_SECTIONS}
SELECT file_name, line_no, line, CAST(lesson_rank AS INTEGER) AS lesson_rank FROM fb""",
       ("session_lines",))
def q_session_lessons_fallback(fx: Fixtures) -> DataFrame:
    return tx.session_lessons_fallback(fx.session_lines).select("file_name", "line_no", "line", "lesson_rank")


@query("session_items", f"""
WITH {_FALLBACK_SECTIONS},
bl AS (SELECT file_name, arg_min(line, line_no) AS raw FROM session_lines
  WHERE regexp_matches(line, '(?i){_LESSON_RE}') GROUP BY file_name),
hd AS (SELECT file_name, line AS raw FROM fb WHERE lesson_rank = 1),
best AS (SELECT coalesce(bl.file_name, hd.file_name) AS file_name, coalesce(bl.raw, hd.raw) AS raw
  FROM bl FULL JOIN hd ON bl.file_name = hd.file_name),
todo AS (SELECT DISTINCT file_name FROM session_lines s WHERE NOT EXISTS (
  SELECT 1 FROM learning_items li WHERE li.source = 'session' AND contains(li.lesson, s.file_name)))
SELECT 'session' AS source, 'Session ' || b.file_name || ': ' || regexp_replace(b.raw, '^\\s*[-*]\\s*', '') AS lesson,
 CAST(NULL AS VARCHAR) AS applicable_to, 1 AS occurrence_count
FROM best b JOIN todo t ON t.file_name = b.file_name""", ("session_lines", "learning_items"))
def q_session_items(fx: Fixtures) -> DataFrame:
    return tx.session_items(fx.session_lines, fx.learning_items)


@query("doc_query_text", """
SELECT file_name, string_agg(line, ' ' ORDER BY line_no) AS query_text FROM session_lines
WHERE line <> '---' AND trim(line) <> '' GROUP BY file_name""",
       ("session_lines",))
def q_doc_query_text(fx: Fixtures) -> DataFrame:
    return tx.doc_query_text(fx.session_lines)


@query("bullet_lines", """
SELECT session_id, line_no, line FROM session_lines WHERE regexp_matches(line, '^[0-9]+\\.|^-|^##')""",
       ("session_lines",))
def q_bullet_lines(fx: Fixtures) -> DataFrame:
    return tx.bullet_lines(fx.session_lines).select("session_id", "line_no", "line")


@query("wiki_links", """
SELECT doc_id AS src, CAST(generate_subscripts(m, 1) - 1 AS INTEGER) AS pos, unnest(m) AS dst FROM (
  SELECT doc_id, regexp_extract_all(text, '\\[\\[([^\\]]+)\\]\\]', 1) AS m FROM kb_texts) t""", ("kb_texts",))
def q_wiki_links(fx: Fixtures) -> DataFrame:
    return tx.wiki_links(fx.kb_texts)


# ============================ §2.11 similarity ============================

_KNN = """sims AS (SELECT q.doc_id AS src, d.doc_id AS dst,
   round(list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(d.embedding AS DOUBLE[])), 9) AS score
  FROM kb_docs q JOIN kb_docs d ON q.is_recent AND d.doc_id <> q.doc_id),
nn AS (SELECT src, dst, score, CAST(row_number() OVER (PARTITION BY src ORDER BY score DESC, dst) AS INTEGER) AS rank
  FROM sims QUALIFY rank <= 5)"""


@query("nearest_documents", f"WITH {_KNN} SELECT src, dst, rank FROM nn", ("kb_docs",))
def q_nearest_documents(fx: Fixtures) -> DataFrame:
    docs = fx.kb_docs
    return sim.nearest_documents(docs, docs.filter(F.col("is_recent")), 5).select("src", "dst", "rank")


_MENTIONED = "AND NOT EXISTS (SELECT 1 FROM kb_texts t WHERE t.doc_id = nn.src AND contains(t.text, '[[' || CAST(nn.dst AS VARCHAR) || ']]'))"
_PAIRS = f"""pairs AS (SELECT nn.src, nn.dst, nn.rank FROM nn WHERE nn.src <> nn.dst
  AND NOT EXISTS (SELECT 1 FROM kb_links l WHERE l.src = nn.src AND l.dst = nn.dst)
  AND EXISTS (SELECT 1 FROM kb_docs d WHERE d.doc_id = nn.dst) {_MENTIONED})"""
_KB = ("kb_docs", "kb_links", "kb_texts")


@query("unlinked_neighbours", f"WITH {_KNN}, {_PAIRS} SELECT src, dst, rank FROM pairs", _KB)
def q_unlinked_neighbours(fx: Fixtures) -> DataFrame:
    docs = fx.kb_docs
    nn = sim.nearest_documents(docs, docs.filter(F.col("is_recent")), 5)
    return jn.unlinked_neighbours(nn, fx.kb_links, docs, fx.kb_texts).select("src", "dst", "rank")


@query("propose_links", f"WITH {_KNN}, {_PAIRS} SELECT src, dst, rank FROM pairs", _KB)
def q_propose_links(fx: Fixtures) -> DataFrame:
    return sim.propose_links(fx.kb_docs, fx.kb_links, 5, texts=fx.kb_texts).select("src", "dst", "rank")


@query("global_link_cap", f"WITH {_KNN}, {_PAIRS} SELECT src, dst, rank FROM pairs ORDER BY src, rank, dst LIMIT 10", _KB)
def q_global_link_cap(fx: Fixtures) -> DataFrame:
    return sim.propose_links(fx.kb_docs, fx.kb_links, 5, 10, fx.kb_texts).select("src", "dst", "rank")


_FOUND = """best AS (SELECT m.id, max(round(list_cosine_similarity(v.embedding, CAST(d.embedding AS DOUBLE[])), 9)) AS found_score
  FROM rag_misses m JOIN miss_vectors v ON v.id = m.id, kb_docs d WHERE m.resolved = false GROUP BY m.id),
after_found AS (SELECT m.*, m.resolved OR coalesce(b.found_score > 0.6, false) AS now_resolved,
  CASE WHEN b.found_score > 0.6 THEN 'rag-filler-found' END AS resolved_by, b.found_score
  FROM rag_misses m LEFT JOIN best b ON b.id = m.id)"""


@query("resolve_found_misses", f"""
WITH {_FOUND} SELECT id, now_resolved AS resolved, resolved_by, round(found_score, 6) AS found_score FROM after_found""",
       ("rag_misses", "miss_vectors", "kb_docs"))
def q_resolve_found_misses(fx: Fixtures) -> DataFrame:
    out = sim.resolve_found_misses(fx.rag_misses, fx.miss_vectors, fx.kb_docs, 0.6)
    return out.select("id", "resolved", "resolved_by", _dbl("found_score", 6))


@query("gap_filler_job", f"""
WITH {_FOUND}, c AS (SELECT query AS query_prefix FROM after_found WHERE NOT now_resolved GROUP BY query HAVING count(*) >= 2),
hit AS (SELECT DISTINCT m.id FROM after_found m JOIN c ON starts_with(m.query, c.query_prefix))
SELECT m.id, m.now_resolved OR h.id IS NOT NULL AS resolved,
 CASE WHEN h.id IS NOT NULL AND NOT m.now_resolved THEN 'rag-filler-stub' ELSE m.resolved_by END AS resolved_by
FROM after_found m LEFT JOIN hit h ON h.id = m.id""", ("rag_misses", "miss_vectors", "kb_docs"))
def q_gap_filler_job(fx: Fixtures) -> DataFrame:
    _, out = jobs.gap_filler_job(fx.rag_misses, fx.miss_vectors, fx.kb_docs)
    return out.select("id", "resolved", "resolved_by")


# ============================ §2.13 pluggable / grouped-map ============================

_ACTION_CASE = ("CASE " + " ".join(
    "WHEN " + " OR ".join(f"contains(lower(lesson), '{w}')" for w in pattern.strip("()").split("|"))
    + f" THEN '{udfs.DEFAULT_ACTION_BY_TOPIC[name]}'" for name, pattern, _ in TOPIC_RULES) + " ELSE 'skip' END")

_OPEN = "open_ AS (SELECT id, lesson FROM learning_items WHERE applied = false)"


@query("classify_items", f"""
WITH {_OPEN}
SELECT id, {_ACTION_CASE} AS action, lesson AS description FROM open_""", ("learning_items",))
def q_classify_items(fx: Fixtures) -> DataFrame:
    return udfs.classify_items(flt.open_items(fx.learning_items))


@query("apply_classifications", f"""
WITH {_OPEN}, c AS (SELECT id, {_ACTION_CASE} AS action FROM open_)
SELECT li.id, li.applied OR coalesce(c.action = 'skip', false) AS applied,
 CASE WHEN c.action = 'skip' THEN {EV} ELSE li.applied_at END AS applied_at
FROM learning_items li LEFT JOIN c ON c.id = li.id""", ("learning_items",))
def q_apply_classifications(fx: Fixtures) -> DataFrame:
    """The new table: items classified 'skip' are closed."""
    classified = udfs.classify_items(flt.open_items(fx.learning_items))
    items, _ = tx.apply_classifications(fx.learning_items, classified, AS_OF_EVENTS)
    return items.select("id", "applied", "applied_at")


@query("action_counts", f"""
WITH {_OPEN}, c AS (SELECT id, {_ACTION_CASE} AS action FROM open_)
SELECT action, count(*) AS items FROM c GROUP BY action""", ("learning_items",))
def q_action_counts(fx: Fixtures) -> DataFrame:
    classified = udfs.classify_items(flt.open_items(fx.learning_items))
    return tx.apply_classifications(fx.learning_items, classified, AS_OF_EVENTS)[1]


_WALK = f"""new AS (SELECT id AS new_id, target_repo AS repo, completed_at AS new_completed_at,
  list_sort(list_distinct(regexp_extract_all(lower(prompt), '\\b[a-z]{{4,}}\\b'))) AS kws
  FROM tasks WHERE category IN ('bug','ops','security') AND status = 'completed' AND target_repo IS NOT NULL
   AND completed_at > {TK} - INTERVAL 30 DAY),
nk AS (SELECT new_id, repo, new_completed_at, unnest(kws) AS kw FROM new),
old AS (SELECT id AS old_id, target_repo AS repo, completed_at AS old_completed_at, lower(prompt) AS old_prompt FROM tasks
  WHERE category IN ('bug','ops','security') AND status = 'completed' AND target_repo IS NOT NULL
   AND completed_at > {TK} - INTERVAL 365 DAY AND outcome IS NULL),
pairs AS (SELECT DISTINCT nk.new_id, old.old_id, old.repo, nk.new_completed_at, old.old_completed_at FROM nk JOIN old ON nk.repo = old.repo
  WHERE old.old_id <> nk.new_id AND old.old_completed_at < nk.new_completed_at AND contains(old.old_prompt, nk.kw)),
seqd AS (SELECT repo, new_id, row_number() OVER (PARTITION BY repo ORDER BY new_completed_at DESC, new_id DESC) AS seq
  FROM (SELECT DISTINCT repo, new_id, new_completed_at FROM pairs) n),
cands AS (SELECT p.repo, s.seq, p.new_id, list(p.old_id ORDER BY p.old_completed_at DESC, p.old_id DESC) AS olds
  FROM pairs p JOIN seqd s ON s.repo = p.repo AND s.new_id = p.new_id GROUP BY p.repo, s.seq, p.new_id),
walk(repo, seq, claimed, taken, new_id) AS (
  SELECT repo, CAST(0 AS BIGINT), CAST([] AS BIGINT[]), CAST([] AS BIGINT[]), CAST(NULL AS BIGINT) FROM (SELECT DISTINCT repo FROM cands) r
  UNION ALL
  SELECT w.repo, c.seq, list_concat(w.claimed, t.taken), t.taken, c.new_id
  FROM walk w JOIN cands c ON c.repo = w.repo AND c.seq = w.seq + 1,
  LATERAL (SELECT list_slice(list_filter(c.olds, lambda x: NOT list_contains(w.claimed, x)), 1, 3) AS taken) t)"""


@query("claim_regressions", f"""
WITH RECURSIVE {_WALK}
SELECT repo, new_id, unnest(taken) AS old_id, CAST(generate_subscripts(taken, 1) AS INTEGER) AS claim_rank FROM walk WHERE seq > 0""", ("tasks",))
def q_claim_regressions(fx: Fixtures) -> DataFrame:
    """Sequential (greedy) claims; the oracle walks the new tasks of each repo
    in order with a recursive CTE carrying the claimed ids."""
    return udfs.claim_regressions(fx.tasks, AS_OF_TASKS, new_days=30, lookback_days=365).drop("new_completed_at")


# ============================ §2.10 more text operators ============================


@query("combine_sessions", """
SELECT file_name, chr(10) || chr(10) || '--- SESSION: ' || file_name || ' ---' || chr(10) || string_agg(line, chr(10) ORDER BY line_no)
  AS block FROM session_lines GROUP BY file_name""", ("session_lines",))
def q_combine_sessions(fx: Fixtures) -> DataFrame:
    return tx.combine_sessions(fx.session_lines)


_TABLE_REF_SQL = TABLE_REF.replace("'", "''")
_NOT_TABLES = ", ".join(f"'{w}'" for w in NOT_TABLES)


_CODE_TABLES = f"""code_tables AS (SELECT DISTINCT app, name FROM (
  SELECT app, unnest(regexp_extract_all(content, '{_TABLE_REF_SQL}', 1)) AS name FROM code_files
  WHERE split_part(rel_path, '/', 1) IN ('src', 'lib', 'app')) n WHERE contains(name, '_') AND name NOT IN ({_NOT_TABLES}))"""
_CODE_ROUTES = """code_routes AS (SELECT DISTINCT app, route_group FROM (
  SELECT app, lower(regexp_extract(rel_path, '^(?:src/)?app/api/([^/]+)/(?:.*/)?route\\.(?:ts|js|tsx)$', 1)) AS route_group FROM code_files) r
  WHERE route_group <> '' AND route_group NOT IN ('health', 'auth', 'cron', 'webhook', 'storage', 'upload', 'api'))"""
_DRIFT = f"""{_CODE_TABLES}, {_CODE_ROUTES},
terms AS (SELECT app, 'route' AS kind, route_group AS term FROM code_routes UNION ALL SELECT app, 'table', name FROM code_tables),
missing AS (SELECT t.app, t.kind, t.term FROM terms t JOIN code_apps a ON a.app = t.app JOIN code_docs d ON d.path = a.doc
  WHERE NOT regexp_matches(lower(d.content), '(^|[^a-z0-9_])' || t.term || '($|[^a-z0-9_])'))"""
_CODE = ("code_apps", "code_files", "code_docs")


@query("table_refs", f"WITH {_CODE_TABLES} SELECT app, name FROM code_tables", ("code_files",))
def q_table_refs(fx: Fixtures) -> DataFrame:
    return drift.table_refs(fx.code_files)


@query("route_groups", f"WITH {_CODE_ROUTES} SELECT app, route_group FROM code_routes", ("code_files",))
def q_route_groups(fx: Fixtures) -> DataFrame:
    return drift.route_groups(fx.code_files)


@query("drift_report", f"WITH {_DRIFT} SELECT app, kind, term FROM missing", _CODE)
def q_drift_report(fx: Fixtures) -> DataFrame:
    return drift.drift_report(fx.code_apps, fx.code_files, fx.code_docs)[0]


@query("drift_totals", f"""
WITH {_DRIFT}
SELECT a.app, a.doc, coalesce(array_to_string(list_sort(list(m.term) FILTER (WHERE m.kind = 'route')), ','), '') AS routes,
 coalesce(array_to_string(list_sort(list(m.term) FILTER (WHERE m.kind = 'table')), ','), '') AS tables, count(m.term) AS missing_total
FROM code_apps a JOIN code_docs d ON d.path = a.doc LEFT JOIN missing m ON m.app = a.app GROUP BY a.app, a.doc
UNION ALL SELECT NULL, NULL, '', '', count(*) FROM missing""", _CODE)
def q_drift_totals(fx: Fixtures) -> DataFrame:
    totals = jobs.drift_job(fx.code_apps, fx.code_files, fx.code_docs)["totals"]
    return totals.select("app", "doc", F.array_join("routes", ",").alias("routes"), F.array_join("tables", ",").alias("tables"),
                         _big("missing_total"))


@query("missing_documents", """
SELECT app, doc FROM code_apps WHERE doc NOT IN (SELECT path FROM code_docs)""", ("code_apps", "code_docs"))
def q_missing_documents(fx: Fixtures) -> DataFrame:
    return jn.missing_documents(fx.code_apps, fx.code_docs)


@query("new_documents", """
SELECT 'docs/' || app || '.md' AS path FROM code_apps WHERE 'docs/' || app || '.md' NOT IN (SELECT path FROM code_docs)""",
       ("code_apps", "code_docs"))
def q_new_documents(fx: Fixtures) -> DataFrame:
    return jn.new_documents(fx.code_apps.select(F.col("doc").alias("path")), fx.code_docs)


@query("daily_miss_clusters", """
SELECT date_trunc('day', created_at) AS window_start, query AS query_prefix, count(*) AS miss_count
FROM rag_misses WHERE resolved = false GROUP BY 1, 2 HAVING count(*) >= 2""", ("rag_misses",))
def q_daily_miss_clusters(fx: Fixtures) -> DataFrame:
    """Batch form of ``streaming.stream_miss_clusters`` (tumbling daily windows)."""
    m = fx.rag_misses.filter(F.col("resolved") == F.lit(False))
    g = m.groupBy(F.window("created_at", "1 day").alias("w"), F.col("query").alias("query_prefix")) \
        .agg(F.count(F.lit(1)).alias("miss_count")).filter(F.col("miss_count") >= 2)
    return g.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "query_prefix", "miss_count")


@query("error_digest", """
WITH t AS (SELECT pattern_key, category, occurrence_count FROM error_patterns
           WHERE resolved = false AND occurrence_count >= 2)
SELECT string_agg('- ' || pattern_key || ' (' || category || '): ' || CAST(occurrence_count AS VARCHAR) || 'x',
                  chr(10) ORDER BY -occurrence_count, pattern_key) AS digest, count(*) AS rows FROM t""",
       ("error_patterns",))
def q_error_digest(fx: Fixtures) -> DataFrame:
    top = rk.top_errors(fx.error_patterns, None, 2).withColumn("neg", -F.col("occurrence_count"))
    return tx.digest(top, "- %s (%s): %sx", ["pattern_key", "category", "occurrence_count"], ["neg", "pattern_key"])


@query("apply_links", f"""
WITH {_KNN}, {_PAIRS},
adds AS (SELECT src, string_agg('- [[' || CAST(dst AS VARCHAR) || ']] - Related topic (auto-synapse 2024-01-31)', chr(10)
  ORDER BY rank, dst) AS a FROM pairs GROUP BY src)
SELECT d.doc_id, d.text || CASE WHEN contains(d.text, '## See also') THEN chr(10)
  ELSE chr(10) || chr(10) || '## See also' || chr(10) || chr(10) END || a.a AS text
FROM kb_texts d JOIN adds a ON a.src = d.doc_id""", _KB)
def q_apply_links(fx: Fixtures) -> DataFrame:
    """'See also' sections on the documents that get new links."""
    _, out, _ = jobs.link_job(fx.kb_docs, fx.kb_links, fx.kb_texts, AS_OF_EVENTS[:10])
    return out.filter("changed").select("doc_id", "text")


@query("phase_ledger", """
WITH b AS (SELECT *, coalesce(sum(cost_usd) OVER w, 0) AS spent, coalesce(sum(duration_s) OVER w, 0) AS elapsed FROM phase_runs
  WINDOW w AS (PARTITION BY run_id ORDER BY phase, cost_usd, duration_s, gate_ok ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT *, spent + cost_usd <= max_budget_usd AND elapsed + duration_s <= 90 AS gated FROM b
  WHERE spent <= max_budget_usd AND elapsed <= 90)
SELECT run_id, round(CAST(sum(cost_usd) AS DOUBLE), 2) AS total_cost_usd, CAST(sum(duration_s) AS BIGINT) AS total_duration_s,
 count(*) FILTER (WHERE gated AND gate_ok) AS phases_ok, count(*) FILTER (WHERE gated AND NOT gate_ok) AS phases_failed,
 CASE WHEN count(*) FILTER (WHERE gated AND NOT gate_ok) = 0 THEN 'SUCCESS' ELSE 'WITH ERRORS' END AS status
FROM t GROUP BY run_id""", ("phase_runs",))
def q_phase_ledger(fx: Fixtures) -> DataFrame:
    """Per run: phases within budget and time limit, summarised; the one that
    oversteps a limit is not gated."""
    return jobs.phase_ledger_job(fx.phase_runs, max_hours=0.025, order=_PHASE_ORDER).select(
        "run_id", _dbl("total_cost_usd", 2), "total_duration_s", "phases_ok", "phases_failed", "status")


_DUPES = """dupes AS (SELECT DISTINCT l1.id FROM learning_items l1 JOIN learning_items l2
  ON l1.id > l2.id AND l1.source = l2.source AND l1.lesson = l2.lesson
  WHERE l1.applied = false AND l2.applied = false)"""

_TOPIC_STRUCTS = ", ".join(
    "{'k': '" + n + "', 'v': " + " OR ".join(f"contains(lower(lesson), '{w}')" for w in p.strip("()").split("|")) + "}"
    for n, p, _ in TOPIC_RULES)


@query("consolidate_report", f"""
WITH {_DUPES},
remaining AS (SELECT li.* FROM learning_items li WHERE li.applied = false AND li.id NOT IN (SELECT id FROM dupes)),
words AS (SELECT unnest(string_to_array(regexp_replace(lower(lesson), '[^a-z0-9 ]', ' ', 'g'), ' ')) AS word
          FROM learning_items WHERE applied = false),
wc AS (SELECT word, count(*) AS n FROM words WHERE length(word) > 5 AND word NOT IN ({_STOP})
       GROUP BY word HAVING count(*) >= 5),
topics AS (SELECT unnest([{_TOPIC_STRUCTS}]) AS t FROM remaining)
SELECT 'summary' AS section, 'open_before' AS name, count(*) AS value FROM learning_items WHERE applied = false
UNION ALL SELECT 'summary', 'duplicates', count(*) FROM dupes
UNION ALL SELECT 'summary', 'remaining', count(*) FROM remaining
UNION ALL SELECT 'topic', t.k, CAST(sum(CAST(t.v AS INTEGER)) AS BIGINT) FROM topics GROUP BY t.k
UNION ALL SELECT 'word', word, n FROM wc""", ("learning_items",))
def q_consolidate_report(fx: Fixtures) -> DataFrame:
    """The flagship report rows (summary counters, topics after de-duplication, word clusters before)."""
    return jobs.consolidate_report(fx.learning_items, AS_OF_EVENTS)


@query("mark_regressions", f"""
WITH RECURSIVE {_WALK},
claims AS (SELECT new_id, unnest(taken) AS old_id FROM walk WHERE seq > 0)
SELECT t.id, CASE WHEN c.old_id IS NOT NULL THEN 'partial' END AS outcome,
 'Possible regression: new bugfix ' || CAST(c.new_id AS VARCHAR) || ' for same repo/symptom' AS outcome_reason
FROM tasks t LEFT JOIN claims c ON c.old_id = t.id""", ("tasks",))
def q_mark_regressions(fx: Fixtures) -> DataFrame:
    """The task table after the regression job (30 days against 365)."""
    return jobs.regression_job(fx.tasks, AS_OF_TASKS, 30, 365).select("id", "outcome", "outcome_reason")


# ============================ replies, tasks, documents, ledger ============================


@query("parse_classifications", """
SELECT line_no, id, action, description FROM (SELECT line_no,
  TRY_CAST(regexp_replace(split_part(line, '|', 1), '[^0-9]', '', 'g') AS BIGINT) AS id,
  regexp_replace(lower(split_part(line, '|', 2)), '\\s', '', 'g') AS action,
  regexp_replace(array_to_string(list_slice(string_split(line, '|'), 3, 1000000), '|'), '^([^|]*)\\|$', '\\1') AS description
  FROM reply_lines) t WHERE id IS NOT NULL AND action IN ('guard', 'memory', 'vault', 'config', 'skip')""", ("reply_lines",))
def q_parse_classifications(fx: Fixtures) -> DataFrame:
    return tx.parse_classifications(fx.reply_lines)


@query("parse_stub_reply", """
SELECT query_prefix, folder, file, content FROM (SELECT query_prefix, trim(regexp_extract(reply, '(?m)^FOLDER:[ \\t]*(.*)$', 1)) AS folder,
  trim(regexp_extract(reply, '(?m)^FILE:[ \\t]*(.*)$', 1)) AS file, regexp_extract(reply, '(?s)CONTENT:\\s*(.*)$', 1) AS content
  FROM stub_replies) t WHERE folder <> '' AND file <> ''""", ("stub_replies",))
def q_parse_stub_reply(fx: Fixtures) -> DataFrame:
    return tx.parse_stub_reply(fx.stub_replies).select("query_prefix", "folder", "file", "content")


@query("gap_stubs", """
WITH c AS (SELECT query FROM rag_misses WHERE NOT resolved GROUP BY query HAVING count(*) >= 2),
p AS (SELECT query_prefix AS q, replace(replace(query_prefix, ' ', '_'), '_', ' ') AS title FROM stub_replies JOIN c ON c.query = query_prefix
  WHERE NOT contains(reply, 'FOLDER: ' || chr(10)))
SELECT q AS query_prefix, 'guides/' || replace(q, ' ', '_') || '.md' AS path,
 '---' || chr(10) || 'title: ' || title || chr(10) || 'date: 2024-01-31' || chr(10) || 'status: stub' || chr(10) || 'created_by: gap-filler'
 || chr(10) || 'trigger_query: "' || q || '"' || chr(10) || '---' || chr(10) || chr(10) || '# ' || title || chr(10) || chr(10)
 || '> **STUB** - Automatically created because the search query "' || q || '" returned no results.' || chr(10)
 || '> Please fill with actual content.' || chr(10) || chr(10) || 'About ' || q || '.' || chr(10) || 'More.' || chr(10) || chr(10) || '---' || chr(10)
 || '*Created: 2024-01-31 by gap-filler*' || chr(10) || '*Trigger: RAG miss "' || q || '"*' || chr(10) AS content FROM p""",
       ("rag_misses", "stub_replies"))
def q_gap_stubs(fx: Fixtures) -> DataFrame:
    return jobs.gap_stubs_job(fx.rag_misses, fx.stub_replies, AS_OF_EVENTS).stubs


@query("crystallization_candidates", """
WITH b AS (SELECT skill, line_no // 10 AS part, max(CASE WHEN line_no % 10 = 0 THEN line END) AS heading,
  max(CASE WHEN line_no % 10 = 1 THEN line END) AS facts, max(CASE WHEN line_no % 10 = 2 THEN line END) AS state
  FROM skill_learning_lines GROUP BY 1, 2)
SELECT skill, substring(heading, 16) AS title, CAST(regexp_extract(facts, 'Score: ([0-9]+)', 1) AS BIGINT) AS score,
 CAST(regexp_extract(facts, 'Runs: ([0-9]+)', 1) AS BIGINT) AS runs FROM b WHERE state <> 'CRYSTALLIZED'
 AND CAST(regexp_extract(facts, 'Score: ([0-9]+)', 1) AS INT) >= 4 AND CAST(regexp_extract(facts, 'Runs: ([0-9]+)', 1) AS INT) >= 3""",
       ("skill_learning_lines",))
def q_crystallization_candidates(fx: Fixtures) -> DataFrame:
    return tx.crystallization_candidates(fx.skill_learning_lines).select("skill", "title", _big("score"), _big("runs"))


@query("task_front_matter", """
SELECT path, max(CASE WHEN starts_with(line, 'title: ') THEN replace(substring(line, 8), '"', '') END) AS title,
 CAST(coalesce(nullif(max(CASE WHEN starts_with(line, 'max_budget_usd: ') THEN substring(line, 17) END), ''), '10') AS DOUBLE) AS max_budget_usd,
 CAST(8 AS DOUBLE) AS max_hours, 'full' AS verification FROM task_lines GROUP BY path""", ("task_lines",))
def q_task_front_matter(fx: Fixtures) -> DataFrame:
    return tx.task_front_matter(fx.task_lines).select("path", "title", _dbl("max_budget_usd", 2), "max_hours", "verification")


@query("task_phases", """
WITH s AS (SELECT *, sum(CAST(starts_with(line, '## ') AS INT)) OVER (PARTITION BY path ORDER BY line_no) AS section FROM task_lines),
g AS (SELECT path, section, string_agg(line, chr(10) ORDER BY line_no) AS prompt, min(line_no) AS start FROM s WHERE section > 0 GROUP BY path, section)
SELECT path, CAST(row_number() OVER (PARTITION BY path ORDER BY start) AS INTEGER) AS phase, prompt FROM g WHERE starts_with(prompt, '## Phase ')""",
       ("task_lines",))
def q_task_phases(fx: Fixtures) -> DataFrame:
    return tx.task_phases(fx.task_lines)


@query("purge_staging", f"""
SELECT DISTINCT file_name FROM session_lines WHERE modified_at >= {EV} - INTERVAL 14 DAY""", ("session_lines",))
def q_purge_staging(fx: Fixtures) -> DataFrame:
    files = fx.session_lines.select("file_name", "modified_at").distinct()
    return up.purge_staging(files, AS_OF_EVENTS, 14).select("file_name")


@query("collect_signals", f"""
SELECT 'rag_miss' AS source, 'Knowledge base has no good coverage for: ' || query AS lesson, 'vault' AS applicable_to, count(*) AS occurrence_count
FROM rag_misses WHERE resolved = false AND created_at > {{EV}} - INTERVAL 24 HOUR GROUP BY query HAVING count(*) >= 2
UNION ALL SELECT * FROM ({{errors}}) e UNION ALL SELECT * FROM ({{sessions}}) s""".replace("{EV}", EV)
       .replace("{errors}", ORACLES["errors_to_items"])
       .replace("{sessions}", ORACLES["session_items"]), ("rag_misses",))
def q_collect_signals(fx: Fixtures) -> DataFrame:
    return jobs.collect_signals(fx.learning_items, fx.rag_misses, fx.error_patterns, fx.session_lines, AS_OF_EVENTS).select(
        "source", "lesson", "applicable_to", _big("occurrence_count"))


_MADE = """f AS (SELECT line_no, split_part(line, '|', 1) AS type, split_part(line, '|', 2) AS key,
  regexp_replace(array_to_string(list_slice(string_split(line, '|'), 3, 1000000), '|'), '^([^|]*)\\|$', '\\1') AS p FROM findings),
made AS (SELECT
 (SELECT count(DISTINCT file_name) FROM session_lines) AS sessions_analyzed,
 (SELECT count(*) FROM learning_items WHERE applied = false AND id IN (
   SELECT TRY_CAST(regexp_replace(key, '[^0-9]', '', 'g') AS BIGINT) FROM f WHERE type = 'APPLY')) AS learnings_applied,
 (SELECT count(*) FROM error_patterns WHERE pattern_key IN (SELECT key FROM f WHERE type = 'PATTERN')) AS patterns_updated,
 (SELECT count(DISTINCT regexp_replace(replace(lower(key), ' ', '-'), '[^a-z0-9-]', '', 'g')) FROM f WHERE type = 'PLAYBOOK' AND key <> '') AS playbooks_created,
 (SELECT count(*) FROM pc) AS skill_proposals_created,
 (SELECT count(DISTINCT coalesce(nullif(p, ''), 'known-issues/STUB_' || replace(key, ' ', '_') || '.md')) FROM f
   WHERE type = 'VAULTGAP' AND key <> '') AS rag_gaps_filled)"""
_NIGHTLY = ("learning_items", "error_patterns", "skill_proposals", "findings", "session_lines")


@query("created_summary", f"WITH {_PROPOSAL_CANDS}, {_MADE} SELECT * FROM made", _NIGHTLY)
def q_created_summary(fx: Fixtures) -> DataFrame:
    """What the nightly review made: documents, closed items, changed patterns, proposals."""
    return jobs.nightly_review_job(fx.learning_items, fx.error_patterns, fx.skill_proposals, fx.findings, AS_OF_EVENTS,
                                   session_lines=fx.session_lines).summary


@query("record_run", f"""
WITH {_PROPOSAL_CANDS}, {_MADE},
old AS (SELECT event_id AS id, 'completed' AS status FROM events WHERE event_type = 'signup')
SELECT id, status, 0 AS sessions_analyzed, 0 AS playbooks_created, 0 AS rag_gaps_filled, '' AS vault_report_path FROM old
UNION ALL SELECT -1, 'completed', sessions_analyzed, playbooks_created, rag_gaps_filled, 'reports/2024-01-31.md' FROM made""", _NIGHTLY)
def q_record_run(fx: Fixtures) -> DataFrame:
    """The ledger (a row per signup event stands for the earlier runs) after a nightly run."""
    ledger = fx.table("events").where("event_type = 'signup'").select(
        F.col("event_id").alias("id"), F.to_date("ts").alias("run_date"), F.lit("completed").alias("status"))
    out = jobs.nightly_review_job(fx.learning_items, fx.error_patterns, fx.skill_proposals, fx.findings, AS_OF_EVENTS,
                                  run_id=-1, session_lines=fx.session_lines, ledger=ledger, duration_s=47,
                                  report_path="reports/2024-01-31.md").ledger
    none = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return out.select("id", "status", none("sessions_analyzed"), none("playbooks_created"), none("rag_gaps_filled"),
                      F.coalesce("vault_report_path", F.lit("")).alias("vault_report_path"))


@query("misses_json", """
SELECT to_json(list(struct_pack("query" := query, miss_count := n, last_miss := l) ORDER BY query))::VARCHAR AS json FROM (
  SELECT query, count(*) AS n, strftime(max(created_at), '%Y-%m-%d %H:%M:%S') AS l FROM rag_misses WHERE resolved = false GROUP BY query
  HAVING count(*) >= 3) t""", ("rag_misses",))
def q_misses_json(fx: Fixtures) -> DataFrame:
    top = agg.miss_last_seen(fx.rag_misses, 3)
    rows = top.select("query", "miss_count", F.date_format("last_miss", "yyyy-MM-dd HH:mm:ss").alias("last_miss"))
    return sinks.json_rows(rows, ["query"])


@query("patterns_json", """
SELECT to_json(list(struct_pack(pattern_name := pattern_key, skill_name := coalesce(related_skill, 'unknown'),
  occurrence_count := occurrence_count, category := category, description := description) ORDER BY pattern_key))::VARCHAR AS json FROM (
  SELECT * FROM error_patterns WHERE resolved = false AND (addressed = false OR addressed IS NULL) AND occurrence_count >= 3) t""", ("error_patterns",))
def q_patterns_json(fx: Fixtures) -> DataFrame:
    top = flt.actionable_patterns(fx.error_patterns, 3)
    rows = top.select(F.col("pattern_key").alias("pattern_name"), F.coalesce("related_skill", F.lit("unknown")).alias("skill_name"),
                      "occurrence_count", "category", "description")
    return sinks.json_rows(rows, ["pattern_name"])


@query("decisions_json", f"""
SELECT to_json(list(struct_pack(skill_name := skill_name, decision_type := decision_type, judge_decision := judge_decision,
  was_applied := was_applied, id := id) ORDER BY id))::VARCHAR AS json FROM (
  SELECT * FROM skill_decisions WHERE created_at > {EV} - INTERVAL 7 DAY) t""", ("skill_decisions",))
def q_decisions_json(fx: Fixtures) -> DataFrame:
    top = flt.recent_decisions(fx.skill_decisions, AS_OF_EVENTS, 7)
    return sinks.json_rows(top.select("skill_name", "decision_type", "judge_decision", "was_applied", "id"), ["id"])
