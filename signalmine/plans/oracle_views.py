"""The derived views of ``signalmine.sources.fixtures`` as ANSI SQL text.

Used only to build oracle queries for DuckDB, which sees the driver tables as
pre-registered views. ``with_views(sql, names)`` prefixes the needed views as
CTEs (in dependency order).
"""

from __future__ import annotations

VIEWS: dict[str, str] = {
    "topic_rules": """
SELECT lower(n_name) AS name, concat('(', lower(left(n_name, 3)), '|', lower(right(n_name, 3)), ')') AS pattern FROM nation""",
    "rag_misses": """
SELECT e.event_id AS id, concat('how to ', p.p_name) AS query, CAST(e.value/500 AS DECIMAL(5,4)) AS best_score,
 0 AS result_count, (e.event_id % 3 = 0) AS resolved, e.ts AS created_at
FROM events e JOIN part p ON p.p_partkey = e.user_id WHERE e.event_type = 'view'""",
    "error_patterns": """
SELECT concat('err-', CAST(e.user_id AS VARCHAR), '-b', CAST(CAST(floor(e.value/30) AS INT) AS VARCHAR)) AS pattern_key,
 lower(min(p.p_type)) AS category, concat('failure near ', min(p.p_name)) AS description, lower(min(p.p_brand)) AS related_skill,
 count(*) AS occurrence_count, (e.user_id % 5 = 0) AS resolved, (e.user_id % 7 = 0) AS addressed, min(e.ts) AS first_seen, max(e.ts) AS last_seen
FROM events e JOIN part p ON p.p_partkey = e.user_id WHERE e.event_type = 'error'
GROUP BY e.user_id, CAST(floor(e.value/30) AS INT)""",
    "learning_items": """
SELECT id, source, lesson, applicable_to, occurrence_count, applied, CASE WHEN applied THEN created END AS applied_at, created AS created_at FROM (
SELECT d.doc_id AS id, CASE d.doc_id % 3 WHEN 0 THEN 'error' WHEN 1 THEN 'session' ELSE 'rag_miss' END AS source,
 CASE WHEN d.doc_id % 9 = 0 THEN 'Recurring problem: err-' || CAST((d.doc_id // 9) % 150 AS VARCHAR) || '-b' || CAST((d.doc_id // 27) % 2 AS VARCHAR) || ' - ' || d.text
      WHEN d.doc_id % 15 = 1 THEN 'Session session-' || CAST(d.doc_id // 15 AS VARCHAR) || '.md: ' || d.text ELSE d.text END AS lesson,
 d.source AS applicable_to, CAST(1 + d.doc_id % 7 AS INT) AS occurrence_count, (d.doc_id % 4 = 0) AS applied,
 TIMESTAMP '2023-12-02 00:00:00' + to_minutes((d.doc_id * 7919) % 86400) AS created
FROM documents d) t""",
    "learning_items_tagged": """
SELECT id, source, concat(CASE id % 6 WHEN 0 THEN 'deploy ' WHEN 1 THEN 'login ' WHEN 2 THEN 'sql ' WHEN 3 THEN 'e2e ' WHEN 4 THEN 'vault ' ELSE '' END, lesson) AS lesson,
 applicable_to, occurrence_count, applied, applied_at, created_at FROM learning_items""",
    "skill_metrics": """
SELECT e.event_id AS id, lower(p.p_brand) AS skill_name, (e.event_type <> 'view') AS invoked, (e.event_type <> 'error') AS success,
 CAST(e.value AS DECIMAL(8,2)) AS duration_minutes, e.ts AS created_at FROM events e JOIN part p ON p.p_partkey = e.user_id""",
    "skill_proposals": """
SELECT e.event_id AS id, concat('dreaming:err-', CAST(e.user_id AS VARCHAR), '-b', CAST(CAST(floor(e.value/30) AS INT) AS VARCHAR)) AS target_skill,
 CASE e.event_id % 3 WHEN 0 THEN 'pending' WHEN 1 THEN 'rejected' ELSE 'auto_merged' END AS status,
 CAST(1 + e.event_id % 5 AS INT) AS recurrence_count, e.ts AS created_at FROM events e WHERE e.event_type = 'signup'""",
    "skill_decisions": """
SELECT e.event_id AS id, lower(p.p_brand) AS skill_name, CASE e.event_id % 3 WHEN 0 THEN 'autonomous' ELSE 'manual' END AS decision_type,
 CASE WHEN e.value < 50 THEN 'accept' ELSE 'reject' END AS judge_decision, (e.value < 50) AS was_applied, e.ts AS created_at
FROM events e JOIN part p ON p.p_partkey = e.user_id WHERE e.event_type = 'purchase'""",
    "tasks": """
SELECT o.o_orderkey AS id, concat('repo-', CAST(o.o_custkey % 20 AS VARCHAR)) AS target_repo,
 CASE o.o_orderpriority WHEN '1-URGENT' THEN 'bug' WHEN '2-HIGH' THEN 'security' WHEN '3-MEDIUM' THEN 'ops' ELSE 'feature' END AS category,
 CASE o.o_orderstatus WHEN 'F' THEN 'completed' ELSE 'open' END AS status, concat('Fix ', min(p.p_name), ' in ', max(p.p_name)) AS prompt,
 o.o_orderdate AS completed_at, CAST(NULL AS VARCHAR) AS outcome
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey JOIN part p ON p.p_partkey = l.l_partkey
GROUP BY o.o_orderkey, o.o_custkey, o.o_orderpriority, o.o_orderstatus, o.o_orderdate""",
    "commits": """
SELECT concat('repo-', CAST(o_custkey % 20 AS VARCHAR)) AS repo, o_orderkey AS sha, concat('change ', o_orderpriority) AS subject,
 o_orderdate AS committed_at, (o_orderstatus = 'P') AS is_merge FROM orders""",
    "session_lines": """
SELECT conv_id AS session_id, concat('session-', CAST(conv_id AS VARCHAR), '.md') AS file_name,
 TIMESTAMP '2024-01-01 00:00:00' + to_minutes((conv_id * 7919) % 43200) AS modified_at, CAST(turn AS BIGINT) * 100000 + pos AS line_no, line
FROM (SELECT conv_id, turn, unnest(ls) AS line, generate_subscripts(ls, 1) - 1 AS pos FROM (
  SELECT conv_id, turn, string_split(CASE WHEN turn = 0 THEN '# Session ' || CAST(conv_id AS VARCHAR) || chr(10) ELSE '' END
   || CASE WHEN role = 'user' AND conv_id % 3 <> 0 THEN '- Fix: ' WHEN role = 'user' THEN '## Result' || chr(10) ELSE '' END
   || coalesce(text, ''), chr(10)) AS ls FROM conversations) a) b""",
    "findings": """
SELECT event_id AS line_no, CASE event_type
 WHEN 'error' THEN concat('PATTERN|err-', CAST(user_id AS VARCHAR), '-b', CAST(CAST(floor(value/30) AS INT) AS VARCHAR), '|cause ', props, '|try a | b')
 WHEN 'view' THEN concat('APPLY|', CAST(event_id % 1000 AS VARCHAR), '|where|how')
 WHEN 'click' THEN concat('PLAYBOOK|Slow Page ', CAST(user_id AS VARCHAR), '|diag|fix')
 WHEN 'purchase' THEN concat('VAULTGAP|topic ', CAST(user_id AS VARCHAR), '|')
 ELSE 'free text without a type' END AS line FROM events""",
    "kb_docs": """
SELECT vec_id AS doc_id, embedding, label, (vec_id % 25 = 0) AS is_recent FROM embeddings
UNION ALL SELECT vec_id + 1000000000, embedding, label, false FROM embeddings WHERE vec_id % 25 = 0""",
    "kb_links": """
SELECT vec_id AS src, vec_id + 1 AS dst FROM embeddings WHERE vec_id % 2 = 0
UNION ALL SELECT vec_id, vec_id + 1000000000 FROM embeddings WHERE vec_id % 50 = 0""",
    "phase_runs": """
SELECT l_orderkey AS run_id, l_linenumber AS phase, CAST(CAST(floor(l_extendedprice) AS DECIMAL(12,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(12,2)) AS cost_usd, CAST(l_quantity AS INT) AS duration_s,
 (l_returnflag <> 'R') AS gate_ok, CAST(800 AS DECIMAL(12,2)) AS max_budget_usd FROM lineitem""",
    "doc_terms": """
SELECT DISTINCT ['en','de','fr','es'][1 + item_id % 4] AS app, unnest(regexp_extract_all(lower(text), '[a-z0-9_]+')) AS term FROM benchmark""",
    "kb_texts": """
SELECT doc_id, text || CASE WHEN doc_id % 5 = 0 THEN chr(10) || 'See [[note-' || CAST(doc_id % 7 AS VARCHAR) || ']] and [[' || CAST(doc_id + 1 AS VARCHAR) || ']].' ELSE '' END
 || CASE WHEN doc_id % 100 = 25 THEN chr(10) || '[[' || CAST(doc_id + 1000000000 AS VARCHAR) || ']]' ELSE '' END AS text FROM documents""",
    "miss_vectors": """
SELECT m.id, list_transform(CAST(v.embedding AS DOUBLE[]), lambda x: x * CASE WHEN m.id % 2 = 0 THEN 1.0 ELSE -1.0 END) AS embedding
FROM rag_misses m JOIN embeddings v ON v.vec_id = m.id % 500""",
    "code_apps": """
SELECT DISTINCT lower(replace(p_brand, '#', '-')) AS app, '/r/' || lower(replace(p_brand, '#', '-')) AS repo, 'docs/' || lower(replace(p_brand, '#', '-')) || '.md' AS doc FROM part""",
    "code_files": """
SELECT lower(replace(p_brand, '#', '-')) AS app, CASE p_partkey % 4 WHEN 0 THEN 'src/app/api/' || replace(p_name, ' ', '-') || '/route.ts'
  WHEN 1 THEN 'src/lib/q' || CAST(p_partkey AS VARCHAR) || '.ts' WHEN 2 THEN 'vendor/q' || CAST(p_partkey AS VARCHAR) || '.ts'
  ELSE 'app/api/health/route.js' END AS rel_path,
 'SELECT a FROM ' || replace(p_name, ' ', '_') || ' JOIN created_at; UPDATE "' || lower(p_type) || '_stock" SET x' AS content FROM part""",
    "code_docs": """
SELECT 'docs/' || app || '.md' AS path, string_agg(l, chr(10) ORDER BY l) AS content FROM (
 SELECT DISTINCT lower(replace(p_brand, '#', '-')) AS app, 'Table ' || replace(p_name, ' ', '_') || ', area ' || replace(p_name, ' ', '-') || '.' AS l
 FROM part WHERE p_partkey % 3 = 0 AND CAST(substring(p_brand, 7) AS INT) % 2 = 0) t GROUP BY app""",
    "reply_lines": """
SELECT doc_id AS line_no, CASE WHEN doc_id % 11 = 0 THEN 'none' ELSE '#' || CAST(doc_id AS VARCHAR) END || '|'
 || ['guard',' Memory ','VAULT','config','skip','other'][1 + doc_id % 6] || '|about ' || source || CASE WHEN doc_id % 2 = 0 THEN '|' ELSE '' END AS line FROM documents""",
    "stub_replies": """
SELECT query AS query_prefix, 'FOLDER: ' || CASE WHEN min(id) % 4 = 0 THEN '' ELSE 'guides' END || chr(10) || 'FILE: ' || replace(query, ' ', '_') || '.md'
 || chr(10) || 'CONTENT:' || chr(10) || 'About ' || query || '.' || chr(10) || 'More.' AS reply FROM rag_misses WHERE NOT resolved GROUP BY query""",
    "skill_learning_lines": """
SELECT skill, p_partkey * 10 + pos AS line_no, line FROM (
 SELECT lower(p_brand) AS skill, p_partkey, unnest(ls) AS line, generate_subscripts(ls, 1) - 1 AS pos FROM (
  SELECT p_brand, p_partkey, ['## 2024-01-' || lpad(CAST(1 + p_partkey % 28 AS VARCHAR), 2, '0') || ': ' || p_name,
   'Score: ' || CAST(p_partkey % 6 AS VARCHAR) || ' Runs: ' || CAST(p_partkey % 5 AS VARCHAR),
   CASE WHEN p_partkey % 7 = 0 THEN 'CRYSTALLIZED' ELSE 'open' END] AS ls FROM part) a) b""",
    "task_lines": """
SELECT 'tasks/' || CAST(o_orderkey AS VARCHAR) || '.md' AS path, CAST(generate_subscripts(ls, 1) - 1 AS INTEGER) AS line_no, unnest(ls) AS line FROM (
 SELECT o_orderkey, list_concat(CASE WHEN o_orderkey % 5 = 0 THEN [] ELSE ['---', 'title: "Task ' || CAST(o_orderkey AS VARCHAR) || '"',
  'max_budget_usd: ' || CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE CAST(1 + o_orderkey % 20 AS VARCHAR) END, '---'] END,
  flatten(list_transform(range(1, 2 + o_orderkey % 3), lambda i: ['## Phase ' || CAST(i * 2 AS VARCHAR) || ': do', 'step ' || CAST(i AS VARCHAR),
   CASE WHEN i % 2 = 0 THEN '## Notes' ELSE 'more' END]))) AS ls FROM orders) t""",
}

# Views built on other views.
DEPENDS = {"learning_items_tagged": ["learning_items"], "miss_vectors": ["rag_misses"], "stub_replies": ["rag_misses"]}


def with_views(sql: str, *names: str) -> str:
    ordered: list[str] = []

    def add(n: str) -> None:
        for dep in DEPENDS.get(n, []):
            add(dep)
        if n not in ordered:
            ordered.append(n)

    for n in names:
        add(n)
    body = sql.strip()
    if not ordered:
        return body
    ctes = ",\n".join(f"{n} AS ({VIEWS[n].strip()})" for n in ordered)
    if body[:15].upper() == "WITH RECURSIVE ":
        return f"WITH RECURSIVE {ctes},\n{body[15:]}"
    if body[:5].upper() == "WITH ":
        # merge the query's own CTEs after the views
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
