"""Table-changing operators as pure transforms.

Each takes the current table and returns the new table (same schema, plus a
``changed`` / rule column where useful). No row is mutated in place and no
driver loop walks the rows: the reference's per-row UPDATEs become one
left join + ``when``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signalmine.functions.constants import ERROR_ITEM_PREFIX, PROPOSAL_TEXT, REGRESSION_REASON
from signalmine.functions.text import left
from signalmine.functions.timefn import AsOf, older_than, recent, to_datetime, ts_ntz
from signalmine.operators.filters import is_open
from signalmine.operators.joins import duplicate_items, errors_without_item, mark_by_ids
from signalmine.operators.ranking import top_k


def _close(df: DataFrame, cond, as_of: AsOf, touch_updated: bool = False) -> DataFrame:
    out = (df.withColumn("applied_at", F.when(cond, ts_ntz(as_of)).otherwise(F.col("applied_at")))
           .withColumn("applied", F.when(cond, F.lit(True)).otherwise(F.col("applied"))))
    if touch_updated and "updated_at" in df.columns:
        out = out.withColumn("updated_at", F.when(cond, ts_ntz(as_of)).otherwise(F.col("updated_at")))
    return out


def archive_noise(items: DataFrame, as_of: AsOf, single_days: int = 14, double_days: int = 30) -> DataFrame:
    """Close open noise: rule 1 = seen once and older than 14 d; then rule 2 =
    seen at most twice and older than 30 d. ``archived_rule`` says which rule
    closed the row (0 = unchanged)."""
    rule1 = is_open() & (F.col("occurrence_count") == 1) & older_than("created_at", as_of, days=single_days)
    rule2 = is_open() & (F.col("occurrence_count") <= 2) & older_than("created_at", as_of, days=double_days)
    ruled = items.withColumn("archived_rule", F.when(rule1, F.lit(1)).when(rule2, F.lit(2)).otherwise(F.lit(0)))
    return _close(ruled, F.col("archived_rule") > 0, as_of)


def mark_applied(items: DataFrame, ids: DataFrame, as_of: AsOf) -> DataFrame:
    """Close the items named by ``ids`` (column ``id``) when still open."""
    marked = mark_by_ids(items, ids, flag="_named")
    changed = F.col("_named") & is_open()
    return _close(marked.withColumn("changed", changed), F.col("changed"), as_of, touch_updated=True).drop("_named")


def close_duplicates(items: DataFrame, as_of: AsOf) -> DataFrame:
    marked = mark_by_ids(items, duplicate_items(items), flag="changed")
    return _close(marked, F.col("changed"), as_of)


def purge_applied(items: DataFrame, as_of: AsOf, days: int = 30) -> DataFrame:
    """Drop closed items whose ``applied_at`` is older than ``days``.

    A NULL predicate keeps the row (DELETE only removes rows where it is true)."""
    doomed = (F.col("applied") == F.lit(True)) & older_than("applied_at", as_of, days=days)
    return items.filter(~F.coalesce(doomed, F.lit(False)))


def resolve_misses_24h(misses: DataFrame, as_of: AsOf, hours: int = 24, by: str = "learning-loop") -> DataFrame:
    """Resolve every unresolved miss of the last day (also single ones)."""
    marked = misses.withColumn("changed", (F.col("resolved") == F.lit(False))
                               & recent("created_at", as_of, hours=hours))
    cond = F.col("changed")
    old_by = F.col("resolved_by") if "resolved_by" in misses.columns else F.lit(None).cast("string")
    return (marked.withColumn("resolved_by", F.when(cond, F.lit(by)).otherwise(old_by))
            .withColumn("resolved", F.when(cond, F.lit(True)).otherwise(F.col("resolved"))))


def resolve_misses_by_cluster(misses: DataFrame, cluster_ids: DataFrame, reason: str) -> DataFrame:
    """Resolve unresolved misses whose id is in ``cluster_ids`` (from ``misses_by_prefix``)."""
    marked = mark_by_ids(misses, cluster_ids, flag="_hit")
    marked = marked.withColumn("changed", F.col("_hit") & (F.col("resolved") == F.lit(False)))
    cond = F.col("changed")
    by = F.col("resolved_by") if "resolved_by" in misses.columns else F.lit(None).cast("string")
    return (marked.withColumn("resolved_by", F.when(cond, F.lit(reason)).otherwise(by))
            .withColumn("resolved", F.when(cond, F.lit(True)).otherwise(F.col("resolved"))).drop("_hit"))


def append_pattern_notes(patterns: DataFrame, pattern_findings: DataFrame, as_of: AsOf,
                         max_len: int | None = None) -> DataFrame:
    """root_cause / mitigation <- old || '\\n[date] text' per PATTERN finding, in line order.

    Findings are grouped per key into one ordered note (``array_sort`` of
    (line_no, text) structs, so the order survives the shuffle), then one left
    join updates the patterns."""
    stamp = F.lit("\n[" + to_datetime(as_of).strftime("%Y-%m-%d") + "] ")
    f = pattern_findings.select(
        F.col("key").alias("pattern_key"), "line_no",
        F.concat(stamp, left(F.coalesce(F.col("b"), F.lit("")), max_len)).alias("cause_note"),
        F.concat(stamp, left(F.coalesce(F.col("c"), F.lit("")), max_len)).alias("fix_note"))
    notes = f.groupBy("pattern_key").agg(
        F.array_sort(F.collect_list(F.struct("line_no", "cause_note", "fix_note"))).alias("ns"))
    notes = notes.select(
        "pattern_key",
        F.array_join(F.transform("ns", lambda x: x["cause_note"]), "").alias("add_cause"),
        F.array_join(F.transform("ns", lambda x: x["fix_note"]), "").alias("add_fix"))
    base = patterns
    for c in ("root_cause", "mitigation", "updated_at"):
        if c not in base.columns:
            base = base.withColumn(c, F.lit(None).cast("timestamp_ntz" if c == "updated_at" else "string"))
    j = base.join(notes, "pattern_key", "left")
    hit = F.col("add_cause").isNotNull()
    return (j.withColumn("root_cause", F.when(hit, F.concat(F.coalesce("root_cause", F.lit("")), "add_cause"))
                         .otherwise(F.col("root_cause")))
            .withColumn("mitigation", F.when(hit, F.concat(F.coalesce("mitigation", F.lit("")), "add_fix"))
                        .otherwise(F.col("mitigation")))
            .withColumn("updated_at", F.when(hit, ts_ntz(as_of)).otherwise(F.col("updated_at")))
            .withColumn("changed", hit).drop("add_cause", "add_fix"))


def make_proposals(candidates: DataFrame, as_of: AsOf) -> DataFrame:
    """NEW_RULE proposal rows; confidence = least(count, 10), status pending."""
    content = F.format_string(PROPOSAL_TEXT, "key_clean", F.col("occurrence_count").cast("string"),
                              F.col("old_count").cast("string"), "desc_clean")
    return candidates.select(
        F.lit("NEW_RULE").alias("proposal_type"), "target_skill",
        content.alias("proposal_content"),
        F.col("occurrence_count").alias("recurrence_count"),
        F.least(F.col("occurrence_count"), F.lit(10)).alias("confidence"),
        F.lit("pending").alias("status"), ts_ntz(as_of).alias("created_at"))


def errors_to_items(patterns: DataFrame, items: DataFrame, min_count: int = 5, k: int | None = None) -> DataFrame:
    """'error' items for recurring patterns without one; the ``k`` most frequent if given."""
    cand = errors_without_item(patterns, items, min_count)
    rows = cand.select(
        F.lit("error").alias("source"),
        F.concat(F.lit(ERROR_ITEM_PREFIX), F.col("pattern_key"), F.lit(" - "),
                 F.coalesce(F.col("description"), F.lit(""))).alias("lesson"),
        F.col("related_skill").alias("applicable_to"),
        F.col("occurrence_count").cast("int").alias("occurrence_count"),
        F.col("pattern_key"))
    return top_k(rows, k, F.col("occurrence_count").desc(), F.col("pattern_key")).drop("pattern_key")


def mark_regressions(tasks: DataFrame, pairs: DataFrame, as_of: AsOf) -> DataFrame:
    """outcome='partial' for older tasks named in ``pairs`` (new_id, old_id,
    new_completed_at), when their outcome is still NULL. A task named by
    several new tasks takes the reason of the first one in the reference's
    loop order (newest new task first)."""
    w = Window.partitionBy("old_id").orderBy(F.col("new_completed_at").desc(), F.col("new_id").desc())
    claim = (pairs.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") == 1)
             .select(F.col("old_id").alias("id"), F.col("new_id").alias("_by")))
    j = tasks.join(claim, "id", "left")
    j = j.withColumn("changed", F.col("_by").isNotNull() & F.col("outcome").isNull())
    cond = F.col("changed")
    parts = REGRESSION_REASON.split("{id}")
    reason = F.concat(F.lit(parts[0]), F.col("_by").cast("string"), F.lit(parts[1]))
    base = j
    for c, t in (("outcome_reason", "string"), ("outcome_evaluated_at", "timestamp_ntz")):
        if c not in base.columns:
            base = base.withColumn(c, F.lit(None).cast(t))
    return (base
            .withColumn("outcome", F.when(cond, F.lit("partial")).otherwise(F.col("outcome")))
            .withColumn("outcome_reason", F.when(cond, reason).otherwise(F.col("outcome_reason")))
            .withColumn("outcome_evaluated_at", F.when(cond, ts_ntz(as_of)).otherwise(F.col("outcome_evaluated_at")))
            .drop("_by"))


RUN_COUNTERS = ["sessions_analyzed", "learnings_applied", "patterns_updated", "playbooks_created",
                "skill_proposals_created", "rag_gaps_filled"]


def start_run(ledger: DataFrame, run_id: int, as_of: AsOf) -> DataFrame:
    """The ledger with the opening row of a run (status 'running', no counters)."""
    one = ledger.sparkSession.range(1)
    row = one.select(F.lit(run_id).cast("bigint").alias("id"), F.lit(to_datetime(as_of).date()).alias("run_date"),
                     F.lit("running").alias("status"), ts_ntz(as_of).alias("created_at"))
    return ledger.unionByName(row, allowMissingColumns=True)


def record_run(ledger: DataFrame, summary: DataFrame, run_id: int, duration_s: int | None = None,
               report_path: str | None = None, cost_usd: float = 0.0, status: str = "completed") -> DataFrame:
    """The ledger with run ``run_id`` closed: the counters of ``summary`` (one
    row; RUN_COUNTERS, missing ones 0), duration, report path and cost."""
    have = [c for c in RUN_COUNTERS if c in summary.columns]
    row = summary.select(F.lit(run_id).cast("bigint").alias("_id"), *[
        (F.col(c) if c in have else F.lit(0)).cast("bigint").alias("_" + c) for c in RUN_COUNTERS])
    j = ledger.join(row, F.col("id") == F.col("_id"), "left")
    hit = F.col("_id").isNotNull()
    new = {c: F.col("_" + c) for c in RUN_COUNTERS} | {
        "vault_report_path": F.lit(report_path).cast("string"), "duration_seconds": F.lit(duration_s).cast("bigint"),
        "cost_usd": F.lit(cost_usd).cast("decimal(12,2)"), "status": F.lit(status)}
    for c, value in new.items():
        old = F.col(c) if c in ledger.columns else F.lit(None)
        j = j.withColumn(c, F.when(hit, value).otherwise(old))
    return j.drop("_id", *["_" + c for c in RUN_COUNTERS])


def purge_staging(files: DataFrame, as_of: AsOf, days: int = 14, ts_col: str = "modified_at") -> DataFrame:
    """Keep staging rows/files not older than ``days``."""
    return files.filter(~F.coalesce(older_than(ts_col, as_of, days=days), F.lit(False)))
