"""Joins: duplicates, semi/anti joins, latest-row look-ups,
range-limited equi joins.

No join here carries a broadcast hint: AQE measures each side at runtime and
switches a sort-merge join to a broadcast only under
``spark.sql.autoBroadcastJoinThreshold``, and splits skewed partitions of the
large side otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signalmine.functions.constants import ERROR_ITEM_PREFIX
from signalmine.functions.text import keep_chars, left
from signalmine.functions.timefn import AsOf, recent
from signalmine.operators.filters import RISKY_CATEGORIES, is_open, recurring_errors
from signalmine.operators.matching import keys_found_in
from signalmine.operators.ranking import latest_proposal, top_k, top_per_group
from signalmine.session import materialize


# ---- duplicates -------------------------------------------------------------------

def dup_keys(items: DataFrame, prefix_len: int | None = None) -> DataFrame:
    """Open items as (id, source, lesson_key): the key is a 256-bit digest of the
    lesson (of its first ``prefix_len`` characters if given), so that no text is
    shuffled to be compared."""
    return items.filter(is_open()).select(
        "id", "source", F.sha2(F.coalesce(left("lesson", prefix_len), F.lit("")), 256).alias("lesson_key"),
        F.col("lesson").isNull().alias("no_lesson")).filter(~F.col("no_lesson")).drop("no_lesson")


def duplicate_items(items: DataFrame, prefix_len: int | None = None, salts: int = 16) -> DataFrame:
    """Ids of open items that are not the lowest id of their (source, lesson) group.

    Set form of the reference's ``l1.id > l2.id`` self-join: a partial
    ``min(id)`` per group (one row per key and partition leaves the map side,
    however hot the key) joined back on the group key. That join is salted: an
    item carries a salt from its id, each group's one row is there for every
    salt, so a group of any size is spread over ``salts`` tasks.
    """
    keyed = dup_keys(items, prefix_len)
    firsts = keyed.groupBy("source", "lesson_key").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    firsts = firsts.filter(F.col("n") > 1).select(
        "source", "lesson_key", "first_id", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    salted = keyed.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int"))
    return (salted.join(firsts, ["source", "lesson_key", "salt"])
            .filter(F.col("id") > F.col("first_id")).select("id"))


def first_per_group(items: DataFrame, prefix_len: int | None = None) -> DataFrame:
    """Lowest id of every duplicate group with its group size."""
    return (dup_keys(items, prefix_len).groupBy("source", "lesson_key")
            .agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("group_size"))
            .filter(F.col("group_size") > 1))


def mark_by_ids(df: DataFrame, ids: DataFrame, flag: str = "selected", key: str = "id") -> DataFrame:
    """``key IN (subquery)`` as a column: left join to the distinct ids."""
    marks = ids.select(F.col(key).alias("_mk")).distinct().withColumn(flag, F.lit(True))
    return (df.join(marks, df[key] == marks["_mk"], "left").drop("_mk")
            .withColumn(flag, F.coalesce(F.col(flag), F.lit(False))))


# ---- fuzzy anti joins ----------------------------------------------------------------

def errors_without_item(patterns: DataFrame, items: DataFrame, min_count: int = 5) -> DataFrame:
    """Recurring unresolved patterns whose key occurs in no 'error' item's lesson.

    Exact ``NOT EXISTS (lesson LIKE '%' || key || '%')`` by the anchor join of
    ``matching.keys_found_in``.
    """
    cand = recurring_errors(patterns, min_count)
    lessons = items.filter(F.col("source") == "error")
    found = keys_found_in(lessons, "lesson", cand, "pattern_key", mode="contains")
    return cand.join(found.select(F.col("key").alias("pattern_key")), "pattern_key", "left_anti")


def errors_without_item_keyed(patterns: DataFrame, items: DataFrame, min_count: int = 5) -> DataFrame:
    """Fast path when every error item was generated by ``errors_to_items``:
    the key is read back from the fixed lesson text and the anti join is an
    equi-join. Equal to ``errors_without_item`` when no other lesson quotes a key."""
    cand = recurring_errors(patterns, min_count)
    pattern = "^" + ERROR_ITEM_PREFIX.replace(" ", "\\s") + "(.*) - "
    keys = (items.filter(F.col("source") == "error")
            .select(F.regexp_extract("lesson", pattern, 1).alias("pattern_key"))
            .filter(F.col("pattern_key") != ""))
    return cand.join(keys, "pattern_key", "left_anti")


def sessions_without_item(sessions: DataFrame, items: DataFrame, file_col: str = "file_name") -> DataFrame:
    """Session files not yet named in any 'session' item's lesson."""
    lessons = items.filter(F.col("source") == "session")
    found = keys_found_in(lessons, "lesson", sessions, file_col, mode="contains")
    return sessions.join(found.select(F.col("key").alias(file_col)), file_col, "left_anti")


def misses_by_prefix(misses: DataFrame, clusters: DataFrame, prefix_col: str = "query_prefix") -> DataFrame:
    """Every (miss id, cluster prefix) with ``query LIKE prefix || '%'``: an
    equi-join of the distinct queries' beginnings (of the lengths that prefixes
    have), then of the misses on their query."""
    queries = misses.select("query").distinct()
    found = keys_found_in(queries, "query", clusters, prefix_col, mode="prefix", text_id_col="query")
    pairs = found.select(F.col("tid").alias("query"), F.col("key").alias(prefix_col))
    return misses.join(pairs, "query").select("id", prefix_col)


# ---- proposals (latest-row look-up) ------------------------------------------------------

def proposal_candidates(patterns: DataFrame, proposals: DataFrame, min_count: int = 5, k: int | None = None,
                        key_len: int | None = None, desc_len: int | None = None) -> DataFrame:
    """Frequent unresolved patterns that deserve a (new) proposal.

    Left join to the newest proposal of ``dreaming:<key>``; skip pending and
    auto-merged targets; a rejected one only when the count more than doubled.
    Of patterns with the same target the most frequent one stands (then the
    smallest key): the others would meet its pending proposal.
    """
    top = top_k(recurring_errors(patterns, min_count), k,
                F.col("occurrence_count").desc(), F.col("pattern_key"))
    cand = top.select(
        "pattern_key",
        left(keep_chars("pattern_key", "a-zA-Z0-9_-"), key_len).alias("key_clean"),
        keep_chars(left("description", desc_len), "a-zA-Z0-9 _.,;:!?()\\-").alias("desc_clean"),
        F.col("occurrence_count").cast("int").alias("occurrence_count"),
    ).withColumn("target_skill", F.concat(F.lit("dreaming:"), F.col("key_clean")))
    cand = top_per_group(cand, ["target_skill"], [F.col("occurrence_count").desc(), F.col("pattern_key")], 1, "_r").drop("_r")
    latest = latest_proposal(proposals).select(
        "target_skill", F.col("status").alias("old_status"), F.col("recurrence_count").alias("old_count"))
    j = cand.join(latest, "target_skill", "left")
    keep = (F.col("old_status").isNull()
            | ((F.col("old_status") == "rejected")
               & (F.col("occurrence_count") > 2 * F.coalesce(F.col("old_count"), F.lit(0))))
            | ~F.col("old_status").isin("pending", "auto_merged", "rejected"))
    return j.filter(keep).select("pattern_key", "target_skill", "key_clean", "desc_clean",
                                 "occurrence_count", "old_status",
                                 F.coalesce(F.col("old_count"), F.lit(0)).alias("old_count"))


# ---- regressions (range-limited equi join) -------------------------------------------------

def task_keywords(tasks: DataFrame, n: int | None = None, prefix_len: int | None = None) -> DataFrame:
    """Distinct words of >= 4 letters in alphabetical order (the first ``n`` of
    the first ``prefix_len`` characters, if given)."""
    words = F.regexp_extract_all(F.lower(left("prompt", prefix_len)), F.lit(r"\b[a-z]{4,}\b"), 0)
    found = F.array_sort(F.array_distinct(words))
    return tasks.withColumn("keywords", found if n is None else F.slice(found, 1, n))


#: older tasks of a repository in one time slice, and the rounds that read slices one by one
SLICE = 256
SLICE_ROUNDS = 4


def slices(rows: DataFrame, key: str, time: str, per: int, at: DataFrame | None = None) -> DataFrame:
    """(key, minute, n, newer, slice): the minutes of a key with the number of its
    rows in them and in newer minutes; newest first, about ``per`` rows lie in a
    slice. ``at`` (same columns) adds minutes to look up that hold no row.

    Rows are counted per minute first, so the running sum of a key goes over its
    minutes and not over its rows. A minute is never split."""
    minute = F.date_trunc("minute", time).alias("minute")
    counted = rows.select(key, minute, F.lit(1).alias("n"))
    if at is not None:
        counted = counted.unionByName(at.select(key, minute, F.lit(0).alias("n")))
    counted = counted.groupBy(key, "minute").agg(F.sum("n").alias("n"))
    before = Window.partitionBy(key).orderBy(F.col("minute").desc()).rowsBetween(Window.unboundedPreceding, -1)
    counted = counted.withColumn("newer", F.coalesce(F.sum("n").over(before), F.lit(0)))
    return counted.withColumn("slice", F.floor(F.col("newer") / per).cast("long"))


def fixes(tasks: DataFrame, as_of: AsOf, new_days: float, lookback_days: float, max_new: int | None,
           keywords: int | None) -> tuple[DataFrame, DataFrame]:
    """(repo, word, new_id, new_completed_at) and (repo, word, old_id,
    old_completed_at): the words of the older prompts, and which of them each new
    fix looks for.

    A keyword is a run of letters, so a prompt contains it exactly if one of the
    prompt's runs of letters does. Which runs hold which keywords is found between
    the two vocabularies, by the keyword's first four letters and the run's
    4-grams: no row carries a prompt."""
    risky = (F.col("category").isin(RISKY_CATEGORIES) & (F.col("status") == "completed")
             & F.col("target_repo").isNotNull())
    new = tasks.filter(risky & recent("completed_at", as_of, days=new_days))
    new = top_k(new, max_new, F.col("completed_at").desc(), F.col("id").desc())
    new = task_keywords(new, keywords).select(
        F.col("target_repo").alias("repo"), F.col("id").alias("new_id"),
        F.col("completed_at").alias("new_completed_at"), F.explode("keywords").alias("kw"))
    runs = F.array_distinct(F.regexp_extract_all(F.lower("prompt"), F.lit("[a-z]{4,}"), 0))
    old = tasks.filter(risky & recent("completed_at", as_of, days=lookback_days) & F.col("outcome").isNull()).select(
        F.col("target_repo").alias("repo"), F.col("id").alias("old_id"),
        F.col("completed_at").alias("old_completed_at"), F.explode(runs).alias("word"))
    grams = F.array_distinct(F.regexp_extract_all("word", F.lit("(?=([a-z]{4}))"), 1))
    of_old = old.select("word").distinct().withColumn("gram", F.explode(grams))
    of_new = new.select("kw").distinct().withColumn("gram", F.left("kw", F.lit(4)))
    holds = of_new.join(of_old, "gram").filter(F.contains("word", F.col("kw"))).select("kw", "word")
    return new.join(holds, "kw").drop("kw").distinct(), old


def met(new: DataFrame, old: DataFrame, on: list[str]) -> DataFrame:
    return (new.join(old, on)
            .filter((F.col("old_id") != F.col("new_id")) & (F.col("old_completed_at") < F.col("new_completed_at")))
            .select("new_id", "old_id", "repo", "new_completed_at", "old_completed_at"))


def regression_pairs(tasks: DataFrame, as_of: AsOf, new_days: float = 1, lookback_days: float = 30,
                     max_new: int | None = None, keywords: int | None = None) -> DataFrame:
    """Every (new fix, older fix) of the same repo sharing a keyword, with
    both completion times; no per-task limit yet. Tasks without keywords are
    skipped."""
    new, old = fixes(tasks, as_of, new_days, lookback_days, max_new, keywords)
    return met(new, old, ["repo", "word"]).distinct()


def newest_pairs(tasks: DataFrame, as_of: AsOf, new_days: float = 1, lookback_days: float = 30, k: int = 3,
                 max_new: int | None = None, per: int = SLICE) -> DataFrame:
    """Pairs of ``regression_pairs`` that hold the ``k`` newest of every new fix.

    The older fixes of a repository lie in time slices of about ``per``. A new fix
    reads one slice, from its own time backwards, then two, four and so on until
    it has ``k``; after ``SLICE_ROUNDS`` those that still lack some, whose words
    are rare, read all the rest by their words. So the rows made for a new fix
    follow ``k`` and ``per``, not the size of its repository."""
    new, old = fixes(tasks, as_of, new_days, lookback_days, max_new, None)
    new, old = materialize(new), materialize(old)
    times = materialize(slices(old.select("repo", "old_id", "old_completed_at").distinct(), "repo", "old_completed_at", per,
                               new.select("repo", F.col("new_completed_at").alias("old_completed_at"))))
    last = times.agg(F.max("slice")).first()[0] or 0
    where = times.select("repo", "minute", "slice")
    old = old.withColumn("minute", F.date_trunc("minute", "old_completed_at")).join(where, ["repo", "minute"]).drop("minute")
    new = (new.withColumn("minute", F.date_trunc("minute", "new_completed_at")).join(where, ["repo", "minute"])
           .drop("minute").withColumnRenamed("slice", "first"))
    found, begin = None, 0
    for turn in range(SLICE_ROUNDS + 1):
        if turn < SLICE_ROUNDS:
            end = 2 * begin + 1
            reads = new.withColumn("slice", F.explode(F.sequence(F.col("first") + begin, F.col("first") + end - 1)))
            pairs = met(reads, old, ["repo", "word", "slice"])
        else:
            end = last + 1
            rest = new.join(old.withColumnRenamed("repo", "_repo").withColumnRenamed("word", "_word"),
                            (F.col("repo") == F.col("_repo")) & (F.col("word") == F.col("_word"))
                            & (F.col("slice") >= F.col("first") + begin))
            pairs = rest.filter((F.col("old_id") != F.col("new_id"))
                                & (F.col("old_completed_at") < F.col("new_completed_at"))).select(
                "new_id", "old_id", "repo", "new_completed_at", "old_completed_at")
        pairs = pairs.distinct()
        found = materialize(pairs if found is None else found.unionByName(pairs))
        begin = end
        if begin > last:
            break
        full = found.groupBy("new_id").agg(F.count("*").alias("n")).filter(F.col("n") >= k)
        new = materialize(new.join(full, "new_id", "left_anti"))
        if new.isEmpty():
            break
    return found


def regression_candidates(tasks: DataFrame, as_of: AsOf, new_days: float = 1, lookback_days: float = 30,
                          k: int = 3, max_new: int | None = None, keep_new_time: bool = False) -> DataFrame:
    """For each new fix, the ``k`` newest older fixes of the same repo that share a keyword.

    The pairs come from ``newest_pairs``; per new task the top-k is a row_number
    filter (WindowGroupLimit before the shuffle).
    """
    pairs = newest_pairs(tasks, as_of, new_days, lookback_days, k, max_new)
    if not keep_new_time:
        pairs = pairs.drop("new_completed_at")
    w = Window.partitionBy("new_id").orderBy(F.col("old_completed_at").desc(), F.col("old_id").desc())
    return pairs.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


# ---- documents and links -------------------------------------------------------------------

def unlinked_neighbours(nn: DataFrame, links: DataFrame, docs: DataFrame, texts: DataFrame | None = None) -> DataFrame:
    """Candidate pairs minus self pairs, minus pairs the source already links
    to, minus targets that do not exist; with ``texts`` (doc_id, text) also
    minus targets that the source's text mentions as ``[[target]]``."""
    out = (nn.filter(F.col("src") != F.col("dst"))
           .join(links.select("src", "dst"), ["src", "dst"], "left_anti")
           .join(docs.select(F.col("doc_id").alias("dst")), "dst", "left_semi"))
    if texts is None:
        return out
    named = F.regexp_extract_all("text", F.lit(r"\[\[([^\]]+)\]\]"), 1)
    mentions = texts.select(F.col("doc_id").alias("src"), F.explode(named).alias("_name"))
    return out.join(mentions, (out["src"] == mentions["src"]) & (out["dst"].cast("string") == mentions["_name"]), "left_anti")


def new_documents(df: DataFrame, existing: DataFrame, path_col: str = "path") -> DataFrame:
    """Documents whose path does not exist yet (never overwrite)."""
    return df.join(existing.select(path_col), path_col, "left_anti")


def missing_documents(apps: DataFrame, docs: DataFrame) -> DataFrame:
    """Apps whose configured document is absent."""
    return apps.join(docs.select(F.col("path").alias("doc")), "doc", "left_anti").select("app", "doc")


def undocumented_terms(terms: DataFrame, docs: DataFrame, app_col: str = "app", text_col: str = "text") -> DataFrame:
    """(app, term) where the term is not a standalone word in any document of the app.

    Terms made of ``[a-z0-9_]`` are standalone exactly when they equal a maximal
    run of these characters, an equi anti join against the documents' tokens;
    other terms are found by the anchor join of ``matching.keys_found_in``.
    """
    t = terms.select(F.col(app_col).alias("app"), F.col("term")).distinct()
    lowered = docs.select(F.col(app_col).alias("app"), F.lower(F.col(text_col)).alias("text"))
    found = keys_found_in(lowered, "text", t, "term", mode="word", group_col="app") \
        .select(F.col("grp").alias("app"), F.col("key").alias("term"))
    return t.join(found, ["app", "term"], "left_anti")
