"""Composite jobs: compositions of operators.

A job returns DataFrames (new table versions, reports); writing them is the
caller's choice (``signalmine.sources.sinks``). Order matters where the
reference's steps read each other's writes, e.g. word clusters are taken
before duplicates are closed. Jobs are lazy but for ``consolidate_job`` and
``consolidate_report``, which checkpoint the de-duplicated table they read twice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalmine.functions.constants import MAX_AUTO_FIXES_PER_DAY, MAX_LINKS, TOPIC_RULES
from signalmine.functions.timefn import AsOf
from signalmine.operators import aggregates as agg
from signalmine.operators import drift
from signalmine.operators import filters as flt
from signalmine.operators import joins as jn
from signalmine.operators import ranking as rk
from signalmine.operators import similarity as sim
from signalmine.operators import text as tx
from signalmine.operators import updates as up
from signalmine.session import materialize
from signalmine.sources.documents import write_document_files
from signalmine.sources import files as src
from signalmine.sources import sinks


def _metric_rows(section: str, df: DataFrame, name_col: str, value_col: str) -> DataFrame:
    return df.select(F.lit(section).alias("section"), F.col(name_col).cast("string").alias("name"),
                     F.col(value_col).cast("bigint").alias("value"))


def _unpivot(section: str, one_row: DataFrame, cols: list[str]) -> DataFrame:
    return one_row.select(F.lit(section).alias("section"),
                          F.explode(F.map_from_arrays(
                              F.array(*[F.lit(c) for c in cols]),
                              F.array(*[F.col(c).cast("bigint") for c in cols]))).alias("name", "value"))


def _report_of(closed: DataFrame, k: int | None) -> DataFrame:
    """The consolidator report from the marked table: all counters in one
    aggregate, and the words of the items that were open before."""
    was_open = flt.is_open() | F.col("changed")
    flags = flt.topic_flags("lesson", TOPIC_RULES, lowered=True)
    names = ["open_before", "duplicates", "remaining"]
    one = flt.with_lowered(closed).agg(
        F.count_if(was_open).alias("open_before"), F.count_if(F.col("changed")).alias("duplicates"),
        F.count_if(flt.is_open()).alias("remaining"),
        *[F.count_if(flt.is_open() & flag).alias("t_" + name) for name, flag in flags.items()])
    topics = one.select(*[F.col("t_" + name).alias(name) for name in flags])
    words = agg.word_clusters(closed.withColumn("applied", F.col("applied") & ~F.col("changed")), k=k)
    return (_unpivot("summary", one, names).unionByName(_unpivot("topic", topics, list(flags)))
            .unionByName(_metric_rows("word", words, "word", "occurrences")))


def consolidate_report(items: DataFrame, as_of: AsOf, k: int | None = None) -> DataFrame:
    """The consolidator report as (section, name, value) rows: summary counters,
    topic counts after de-duplication, the word clusters before it (the top ``k``
    if given).
    Duplicates are marked once; the marked table is checkpointed and read by the
    counters and by the words."""
    return _report_of(materialize(up.close_duplicates(items, as_of)), k)


@dataclass
class ConsolidateResult:
    items: DataFrame
    report: DataFrame
    top_error_lessons: DataFrame
    latest_session_lessons: DataFrame


def consolidate_job(items: DataFrame, as_of: AsOf, k: int | None = None) -> ConsolidateResult:
    """word clusters (before dedup), close duplicates, topic counts, top
    lessons, report, purge of items closed more than 30 days ago.

    The de-duplicated table feeds all four outputs, so it is checkpointed once
    (shared checkpoint folder) instead of being derived anew for each."""
    closed = materialize(up.close_duplicates(items, as_of))
    return ConsolidateResult(
        items=up.purge_applied(closed.drop("changed"), as_of),
        report=_report_of(closed, k),
        top_error_lessons=rk.top_error_lessons(closed),
        latest_session_lessons=rk.latest_session_lessons(closed))


@dataclass
class LearningLoopResult:
    new_items: DataFrame
    misses: DataFrame
    consolidated: ConsolidateResult | None


def collect_signals(items: DataFrame, misses: DataFrame, patterns: DataFrame, session_lines: DataFrame,
                    as_of: AsOf) -> DataFrame:
    """(source, lesson, applicable_to, occurrence_count) of new items from
    repeated misses, recurring errors and sessions that have none yet."""
    cols = ["source", "lesson", "applicable_to", F.col("occurrence_count").cast("int").alias("occurrence_count")]
    return (agg.misses_to_items(misses, as_of).select(*cols)
            .unionByName(up.errors_to_items(patterns, items).select(*cols))
            .unionByName(tx.session_items(session_lines, items).select(*cols)))


def learning_loop_job(items: DataFrame, misses: DataFrame, patterns: DataFrame, session_lines: DataFrame,
                      as_of: AsOf, consolidate: bool = False) -> LearningLoopResult:
    """New items from repeated misses, recurring errors and sessions; the
    day's misses resolved; with ``consolidate`` the grown table (new items get
    ids above the old ones) goes through ``consolidate_job``. Running it twice
    adds nothing from errors and sessions (their items name the key / file)."""
    from signalmine.functions.timefn import ts_ntz

    new_items = collect_signals(items, misses, patterns, session_lines, as_of)
    done = None
    if consolidate:
        new_items = materialize(new_items)
        last = items.agg(F.coalesce(F.max("id"), F.lit(0)).alias("_last"))
        numbered = new_items.withColumn("_n", F.monotonically_increasing_id() + 1).withColumn("_k", F.lit(1))
        numbered = numbered.join(F.broadcast(last.withColumn("_k", F.lit(1))), "_k").withColumn("id", F.col("_last") + F.col("_n"))
        grown = items.unionByName(numbered.drop("_n", "_k", "_last").withColumn("applied", F.lit(False)).withColumn(
            "created_at", ts_ntz(as_of)), allowMissingColumns=True)
        done = consolidate_job(grown, as_of)
    return LearningLoopResult(new_items=new_items, misses=up.resolve_misses_24h(misses, as_of), consolidated=done)


@dataclass
class NightlyResult:
    items: DataFrame
    patterns: DataFrame
    playbooks: DataFrame
    stubs: DataFrame
    proposals: DataFrame
    summary: DataFrame
    ledger: DataFrame | None
    context: dict[str, DataFrame]


def nightly_review_job(items: DataFrame, patterns: DataFrame, proposals: DataFrame, findings: DataFrame,
                       as_of: AsOf, existing_paths: DataFrame | None = None, run_id: int = 0,
                       session_lines: DataFrame | None = None, misses: DataFrame | None = None,
                       commits: DataFrame | None = None, ledger: DataFrame | None = None,
                       duration_s: int | None = None, report_path: str | None = None) -> NightlyResult:
    """The nightly review. ``context`` is what the reply is asked about (session
    headlines, top open items and errors, miss counts, commits); the reply's
    findings are applied: playbooks and stubs as documents (path, content; never
    overwriting an existing path), APPLY ids closed, PATTERN notes appended,
    proposals for frequent patterns. ``summary`` counts what was made, not the
    reply's lines; it closes the run's row in ``ledger``."""
    day = str(as_of)[:10]
    context = {"top_items": rk.top_open_items(items), "top_errors": rk.top_errors(patterns)}
    if session_lines is not None:
        context["sessions"] = tx.session_headline(session_lines)
    if misses is not None:
        context["miss_counts"] = agg.miss_counts_7d(misses, as_of)
    if commits is not None:
        context["commits"] = src.scan_recent_commits(commits, as_of)
    playbooks = tx.playbook_content(tx.playbooks_from_findings(findings), day, run_id)
    stubs = tx.stub_content(tx.stubs_from_findings(findings), day, run_id)
    if existing_paths is not None:
        playbooks = jn.new_documents(playbooks, existing_paths)
        stubs = jn.new_documents(stubs, existing_paths)
    new_items = up.mark_applied(items, tx.applied_ids(findings), as_of)
    new_patterns = up.append_pattern_notes(patterns, tx.pattern_findings(findings), as_of)
    props = up.make_proposals(jn.proposal_candidates(patterns, proposals), as_of)
    made = {"learnings_applied": new_items.where("changed"), "patterns_updated": new_patterns.where("changed"),
            "playbooks_created": playbooks, "skill_proposals_created": props, "rag_gaps_filled": stubs}
    if session_lines is not None:
        made["sessions_analyzed"] = session_lines.select("file_name").distinct()
    summary = agg.created_summary(**made)
    closed = None
    if ledger is not None:
        closed = up.record_run(up.start_run(ledger, run_id, as_of), summary, run_id, duration_s, report_path)
    return NightlyResult(new_items, new_patterns, playbooks, stubs, props, summary, closed, context)


def link_job(docs: DataFrame, links: DataFrame, texts: DataFrame, day: str, k: int = 5,
             cap: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Recent documents -> proposed links (neither linked nor mentioned yet; at
    most ``cap``, e.g. MAX_LINKS, if given) -> texts with a 'See also' section,
    and the report (src, links, targets)."""
    pairs = sim.propose_links(docs, links, k, cap, texts)
    report = pairs.groupBy("src").agg(F.count(F.lit(1)).alias("links"), F.array_sort(F.collect_list("dst")).alias("targets"))
    return pairs, sim.apply_links(texts, pairs, day), report


def gap_filler_job(misses: DataFrame, vectors: DataFrame | None = None, docs: DataFrame | None = None,
                   max_stubs: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Misses that a document answers by now resolved as found (given vectors and
    documents); of the rest the clusters, and their misses resolved as stubbed."""
    if vectors is not None:
        misses = sim.resolve_found_misses(misses, vectors, docs).drop("found_score", "changed")
    clusters = agg.miss_clusters(misses, k=max_stubs)
    hits = jn.misses_by_prefix(misses, clusters)
    return clusters, up.resolve_misses_by_cluster(misses, hits, "rag-filler-stub")


@dataclass
class GapStubResult:
    stubs: DataFrame
    misses: DataFrame


def gap_stubs_job(misses: DataFrame, replies: DataFrame, as_of: AsOf, existing_paths: DataFrame | None = None,
                  found_prefixes: DataFrame | None = None, max_stubs: int | None = None) -> GapStubResult:
    """The gap filler end to end: clusters already answered by a document
    (``found_prefixes``: query_prefix rows) are resolved as found; for the rest,
    the replies (query_prefix, reply) become stub documents with front matter
    and note (query_prefix, path, content; never overwriting) and their misses
    are resolved as stubbed."""
    clusters = agg.miss_clusters(misses, k=max_stubs)
    out = misses
    if found_prefixes is not None:
        found = clusters.join(found_prefixes.select("query_prefix"), "query_prefix", "left_semi")
        out = up.resolve_misses_by_cluster(out, jn.misses_by_prefix(out, found), "rag-filler-found").drop("changed")
        clusters = clusters.join(found_prefixes.select("query_prefix"), "query_prefix", "left_anti")
    parsed = tx.parse_stub_reply(replies.join(clusters.select("query_prefix"), "query_prefix", "left_semi"))
    stubs = tx.gap_stub_content(parsed, str(as_of)[:10])
    if existing_paths is not None:
        stubs = jn.new_documents(stubs, existing_paths)
    stubbed = clusters.join(stubs.select("query_prefix"), "query_prefix", "left_semi")
    out = up.resolve_misses_by_cluster(out, jn.misses_by_prefix(out, stubbed), "rag-filler-stub")
    return GapStubResult(stubs=stubs, misses=out)


@dataclass
class NightRun:
    gaps: GapStubResult
    review: NightlyResult
    loop: LearningLoopResult
    documents: DataFrame


def night_run(items: DataFrame, patterns: DataFrame, proposals: DataFrame, misses: DataFrame, findings: DataFrame,
              replies: DataFrame, session_lines: DataFrame, as_of: AsOf, existing_paths: DataFrame | None = None,
              run_id: int = 0, ledger: DataFrame | None = None, duration_s: int | None = None,
              root: str | None = None) -> NightRun:
    """One whole night, in order: the gap filler, the review with its findings, the
    learning loop with consolidation. Each step works on the tables as the one before
    left them: a search that got a stub is resolved and makes no learning item, and
    items that the review closed aren't reported. Tables that several steps read are
    checkpointed. ``documents`` (path, content) are the playbooks and all stubs; with
    ``root``, a folder that driver and executors share, they become files below it
    (never overwriting)."""
    gaps = gap_stubs_job(misses, replies, as_of, existing_paths)
    gaps = GapStubResult(stubs=materialize(gaps.stubs), misses=materialize(gaps.misses.drop("changed")))
    review = nightly_review_job(items, patterns, proposals, findings, as_of, existing_paths, run_id, session_lines,
                                gaps.misses, ledger=ledger, duration_s=duration_s)
    review.items, review.patterns = materialize(review.items), materialize(review.patterns)
    review.playbooks, review.stubs = materialize(review.playbooks), materialize(review.stubs)
    loop = learning_loop_job(review.items.drop("changed"), gaps.misses, review.patterns.drop("changed"), session_lines, as_of,
                             consolidate=True)
    cols = ["path", "content"]
    documents = review.playbooks.select(cols).unionByName(review.stubs.select(cols)).unionByName(gaps.stubs.select(cols))
    if root is not None:
        write_document_files(documents, root)
    return NightRun(gaps, review, loop, documents)


def drift_job(apps: DataFrame, code: DataFrame, docs: DataFrame) -> dict[str, DataFrame]:
    """Drift between code and documents: ``totals`` (per app the missing routes
    and tables as lists, and the grand total as app null; ``sinks.json_rows``
    makes JSON of it), ``no_document`` and the Markdown report's ``lines``."""
    missing, _, no_doc = drift.drift_report(apps, code, docs)
    totals = drift.drift_totals(apps, missing, no_doc)
    return {"totals": totals, "no_document": no_doc, "lines": drift.drift_markdown(totals, no_doc)}


def weekly_review_job(lines: DataFrame, as_of: AsOf, reply_lines: DataFrame | None = None, days: int = 7,
                      file_col: str = "file_name") -> tuple[DataFrame, DataFrame | None]:
    """Sessions whose name starts with a date within ``days`` -> their blocks of
    the digest (a row per file); the reply's numbered / bullet / '##' lines kept."""
    from datetime import timedelta

    from signalmine.functions.timefn import to_datetime

    cutoff = (to_datetime(as_of) - timedelta(days=days)).strftime("%Y-%m-%d")
    day = F.substring(F.col(file_col), 1, 10)
    recent_lines = lines.filter(day.rlike(r"^\d{4}-\d{2}-\d{2}$") & (day >= cutoff))
    digest = tx.combine_sessions(recent_lines, file_col)
    kept = tx.bullet_lines(reply_lines) if reply_lines is not None else None
    return digest, kept


def memo_job(items: DataFrame, misses: DataFrame, session_lines: DataFrame, file_col: str = "file_name",
             drift_totals: DataFrame | None = None, n_items: int | None = 15, n_misses: int | None = None,
             n_sessions: int | None = None, text_len: int | None = None) -> dict[str, DataFrame]:
    """The nightly memo's sections: top open items, miss clusters, session summaries,
    the open counters, the drift section if given, and the report as (section,
    name, value) rows. The top ``n_items`` items (None: all); the top ``n_misses``
    clusters, ``n_sessions`` newest files and ``text_len`` characters of a lesson,
    if given."""
    newest = rk.newest_sessions(tx.summary_counts(session_lines, file_col), n_sessions, file_col)
    picked = session_lines.join(newest.select(file_col), file_col, "left_semi")
    out = {
        "top_items": rk.top_open_items(items, n_items, text_len),
        "miss_clusters": agg.miss_clusters(misses, k=n_misses),
        "sessions": tx.session_summary(picked, file_col),
        "counts": agg.open_counts(items, misses),
    }
    report = (_metric_rows("counts", out["counts"], "metric", "value")
              .unionByName(_metric_rows("misses", out["miss_clusters"], "query_prefix", "miss_count"))
              .unionByName(_metric_rows("items", out["top_items"], "id", "occurrence_count"))
              .unionByName(_metric_rows("sessions", out["sessions"], file_col, "summary_lines")))
    if drift_totals is not None:
        out["drift"] = drift_totals
        report = report.unionByName(_metric_rows(
            "drift", drift_totals.select(F.coalesce("app", F.lit("total")).alias("app"), "missing_total"), "app", "missing_total"))
    return out | {"report": report}


@dataclass
class ApplyResult:
    items: DataFrame
    archived: DataFrame
    classified: DataFrame
    action_counts: DataFrame


def apply_job(items: DataFrame, as_of: AsOf, classifier=None, k: int | None = None) -> ApplyResult:
    """Archive noise, classify the open items (the top ``k`` if given), close the 'skip' ones."""
    from signalmine.operators import udfs

    archived = up.archive_noise(items, as_of)
    by_rule = archived.groupBy("archived_rule").agg(F.count(F.lit(1)).alias("items")).filter("archived_rule > 0")
    base = archived.drop("archived_rule")
    top = rk.top_k(flt.open_items(base), k, F.col("occurrence_count").desc(), F.col("created_at").desc(), F.col("id"))
    classified = udfs.classify_items(top) if classifier is None else udfs.classify_items(top, classifier)
    new_items, counts = tx.apply_classifications(base, classified, as_of)
    return ApplyResult(new_items, by_rule, classified, counts)


def crystallize_job(learning_lines: DataFrame, skill_col: str = "skill") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Crystallisation candidates, one alert row (their number) when any exist,
    and the alert's lines, a row per candidate."""
    cands = tx.crystallization_candidates(learning_lines, skill_col)
    alert = cands.agg(F.count(F.lit(1)).alias("candidates")).filter("candidates > 0")
    lines = cands.select(skill_col, F.format_string(
        "- %s: %s (Score %d, Runs %d)", F.col(skill_col), "title", "score", "runs").alias("line"))
    return cands, alert, lines


def regression_job(tasks: DataFrame, as_of: AsOf, new_days: float = 1, lookback_days: float = 30) -> DataFrame:
    """New fixes -> older fixes that they claim, newest new fix first, each older
    one once -> tasks with outcome 'partial'."""
    from signalmine.operators import udfs

    return up.mark_regressions(tasks, udfs.claim_regressions(tasks, as_of, new_days, lookback_days), as_of)


def skill_review_job(decisions: DataFrame, patterns: DataFrame, metrics: DataFrame, misses: DataFrame,
                     as_of: AsOf, triage: DataFrame | None = None,
                     staging_files: DataFrame | None = None, k: int | None = None,
                     n_skills: int | None = None) -> dict[str, DataFrame]:
    """The skill review: the day's gate, the staging sections and the staging
    JSON document; given the triage text (one row: triage_text) the alert and
    its priority; given the staging files (modified_at) those that stay. The top
    ``k`` patterns, decisions and misses and ``n_skills`` skills, if given."""
    actionable = flt.actionable_patterns(patterns, 3)
    gate = flt.daily_quota_gate(decisions, as_of)
    out = {
        "gate": gate,
        "patterns": rk.top_k(actionable, k, F.col("occurrence_count").desc(), F.col("pattern_key")),
        "decisions": flt.recent_decisions(decisions, as_of, k=k),
        "scorecard": agg.skill_scorecard(metrics, n_skills),
        "misses": agg.miss_last_seen(misses, k=k),
    }
    count = actionable.agg(F.count(F.lit(1)).alias("pattern_count"))
    out["staging"] = sinks.staging_document(str(as_of)[:10], count, gate.select("auto_today"), MAX_AUTO_FIXES_PER_DAY, {
        "patterns": out["patterns"], "recent_decisions": out["decisions"], "skill_metrics": out["scorecard"],
        "rag_misses": out["misses"]})
    if triage is not None:
        one = triage.select("triage_text", F.lit(1).alias("_k")).join(
            F.broadcast(count.withColumn("_k", F.lit(1))), "_k").drop("_k")
        out["alert"] = flt.alert_priority(one)
    if staging_files is not None:
        out["staging_files"] = up.purge_staging(staging_files, as_of)
    return out


def phase_ledger_job(phases: DataFrame, max_hours: float = 8, order: tuple[str, ...] = ("phase",),
                     documents: DataFrame | None = None) -> DataFrame:
    """Phases that run under the budget and the time limit, summarised per run.
    The phase that oversteps one of them still adds its cost and time, but the
    run stops before its gate. ``documents`` (task lines: path, line_no, line)
    adds each run's title and number of planned phases, the path being the run_id."""
    ran = rk.running_budget(phases, order=order).filter("runs").drop("runs")
    ran = rk.running_time_limit(ran, max_hours, order=order).filter("runs")
    gated = ((F.col("spent_before") + F.col("cost_usd") <= F.col("max_budget_usd"))
             & (F.col("elapsed_before_s") + F.col("duration_s") <= F.lit(max_hours * 3600)))
    out = agg.phase_summary(ran, gated)
    if documents is None:
        return out
    planned = tx.task_phases(documents).groupBy("path").agg(F.count(F.lit(1)).alias("planned_phases"))
    head = tx.task_front_matter(documents).select("path", "title").join(planned, "path", "left")
    return out.join(head.withColumnRenamed("path", "run_id"), "run_id", "left")
