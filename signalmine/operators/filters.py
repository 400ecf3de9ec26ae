"""Projections, filters and predicates.

All predicates are plain column expressions so Catalyst pushes them into the
parquet scan (``PushedFilters``) and prunes columns (``ReadSchema``).
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalmine.functions.constants import MAX_AUTO_FIXES_PER_DAY, TOPIC_RULES
from signalmine.functions.text import left
from signalmine.functions.timefn import AsOf, as_of_date, recent, to_datetime


def is_open(col: str = "applied") -> Column:
    """``applied = false``: a NULL flag is neither open nor closed (dropped)."""
    return F.col(col) == F.lit(False)


def open_items(items: DataFrame) -> DataFrame:
    return items.filter(is_open())


def recent_open_items(items: DataFrame, as_of: AsOf, days: int = 14) -> DataFrame:
    """Open items created within ``days`` before ``as_of``; short lesson."""
    return (items.filter(is_open() & recent("created_at", as_of, days=days))
            .select("id", "source", left("lesson", 60).alias("lesson"), "occurrence_count", "created_at"))


def recurring_errors(patterns: DataFrame, min_count: int = 2) -> DataFrame:
    """Unresolved patterns seen at least ``min_count`` times (k = 2, 3 or 5)."""
    return patterns.filter((F.col("resolved") == F.lit(False)) & (F.col("occurrence_count") >= min_count))


def actionable_patterns(patterns: DataFrame, min_count: int = 2) -> DataFrame:
    """Unresolved, not addressed (NULL counts as not addressed), count >= k."""
    return patterns.filter((F.col("resolved") == F.lit(False))
                           & ~F.coalesce(F.col("addressed"), F.lit(False))
                           & (F.col("occurrence_count") >= min_count))


def recent_misses(misses: DataFrame, as_of: AsOf, days: float = 0, hours: float = 0,
                  unresolved_only: bool = True) -> DataFrame:
    cond = recent("created_at", as_of, days=days, hours=hours)
    if unresolved_only:
        cond = cond & (F.col("resolved") == F.lit(False))
    return misses.filter(cond)


def recent_decisions(decisions: DataFrame, as_of: AsOf, days: int = 7, k: int | None = None) -> DataFrame:
    """Decisions of the last ``days``, newest first (tie-break id)."""
    out = decisions.filter(recent("created_at", as_of, days=days)).select(
        "id", "skill_name", "decision_type", "judge_decision", "was_applied", "created_at")
    if k is None:
        return out
    return out.orderBy(F.col("created_at").desc(), F.col("id").desc()).limit(k)


RISKY_CATEGORIES = ["bug", "ops", "security"]


def recent_completed_tasks(tasks: DataFrame, as_of: AsOf, days: int = 1, k: int | None = None) -> DataFrame:
    """Completed bug/ops/security tasks with a repo, finished in the last ``days``."""
    out = tasks.filter(F.col("category").isin(RISKY_CATEGORIES)
                       & (F.col("status") == "completed")
                       & F.col("target_repo").isNotNull()
                       & recent("completed_at", as_of, days=days))
    out = out.select("id", "target_repo", "prompt", "category", "completed_at")
    if k is None:
        return out
    return out.orderBy(F.col("completed_at").desc(), F.col("id").desc()).limit(k)


_LITERAL_ALTERNATION = re.compile(r"^\(?([a-z0-9 _-]+(\|[a-z0-9 _-]+)*)\)?$")


def icontains_pattern(c: Column, pattern: str, lowered: Column | None = None) -> Column:
    """Case-insensitive unanchored match of ``pattern``.

    A pure alternation of lower-case literals, like every topic rule, becomes
    ``contains`` tests on the lower-cased text (a byte search per literal,
    about 3x faster than a case-insensitive regex over long lessons); any
    other pattern stays an ``rlike('(?i)...')``. Pass ``lowered`` (a column
    already holding ``lower(c)``) when several patterns test the same text:
    expressions inside CASE branches are not shared, so lower-case once."""
    m = _LITERAL_ALTERNATION.match(pattern)
    if not m:
        return c.rlike(f"(?i){pattern}")
    low = lowered if lowered is not None else F.lower(c)
    return reduce(lambda a, b: a | b, [low.contains(w) for w in m.group(1).split("|")])


LOWERED = "_lesson_lower"


def with_lowered(df: DataFrame, col: str = "lesson") -> DataFrame:
    """Add the lower-cased text once, for ``topic_flags(..., lowered=True)``."""
    return df.withColumn(LOWERED, F.lower(F.col(col)))


def topic_flags(lesson: Column | str = "lesson", rules=TOPIC_RULES, lowered: bool = False) -> dict[str, Column]:
    c = F.col(lesson) if isinstance(lesson, str) else lesson
    low = F.col(LOWERED) if lowered else None
    return {name: icontains_pattern(c, pattern, low) for name, pattern, _ in rules}


def topic_tags(items: DataFrame, rules=TOPIC_RULES) -> DataFrame:
    """Every open item with the array of topics whose pattern matches (maybe empty)."""
    flags = topic_flags("lesson", rules, lowered=True)
    tags = F.array_compact(F.array(*[F.when(flag, F.lit(name)) for name, flag in flags.items()]))
    return with_lowered(open_items(items)).select("id", "source", tags.alias("topics"))


MOST_RULES = 10_000  # rows of a rule table, which travels as one value


def matched_rules(items: DataFrame, rules: DataFrame, col: str = "lesson") -> DataFrame:
    """``items`` with ``topics``: the names, in order, of the ``rules`` (name, pattern: a
    case-insensitive regular expression found anywhere) that match the text. The
    rules are a user's table; as one array they meet every row through a join with
    one row. A null text, name or pattern matches nothing."""
    if rules.limit(MOST_RULES + 1).count() > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} topic rules")
    named = rules.where("name is not null and pattern is not null")
    one = named.agg(F.array_sort(F.collect_set(F.struct("name", "pattern"))).alias("_rules")).withColumn("_one", F.lit(1))
    found = F.filter("_rules", lambda r: F.regexp_like(F.col(col), F.concat(F.lit("(?i)"), r["pattern"])))
    topics = F.array_distinct(F.transform(found, lambda r: r["name"]))
    return (items.withColumn("_one", F.lit(1)).join(F.broadcast(one), "_one")
            .withColumn("topics", F.coalesce(topics, F.array().cast("array<string>"))).drop("_one", "_rules"))


def topic_tags_by_rules(items: DataFrame, rules: DataFrame) -> DataFrame:
    """``topic_tags`` with the rules from a table."""
    return matched_rules(open_items(items), rules).select("id", "source", "topics")


def daily_quota_gate(decisions: DataFrame, as_of: AsOf, max_per_day: int = MAX_AUTO_FIXES_PER_DAY) -> DataFrame:
    """One row: applied autonomous decisions on the day of ``as_of`` and whether the limit is hit."""
    day = as_of_date(as_of)
    counted = decisions.filter((F.col("decision_type") == "autonomous")
                               & (F.col("was_applied") == F.lit(True))
                               & (F.to_date("created_at") == day))
    return counted.agg(F.count(F.lit(1)).alias("auto_today")).select(
        F.lit(to_datetime(as_of).date()).alias("day"), "auto_today",
        (F.col("auto_today") >= max_per_day).alias("limit_reached"))


def alert_priority(triage: DataFrame, text_col: str = "triage_text", count_col: str = "pattern_count") -> DataFrame:
    """high on critical/security/immediate in the triage text, default above 5 patterns, else low."""
    prio = (F.when(icontains_pattern(F.col(text_col), "(critical|security|immediate)"), "high")
            .when(F.col(count_col) > 5, "default").otherwise("low"))
    return triage.withColumn("priority", prio)
