"""Aggregations.

Every group-by here is a hash aggregate with a map-side partial step, so the
shuffle carries one row per (partition, key), not one per input row. Keys
with a third of all rows therefore cost one partial row per partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalmine.functions.constants import MISS_ITEM_PREFIX, STOP_WORDS, TOPIC_RULES
from signalmine.functions.text import left
from signalmine.functions.timefn import AsOf, recent
from signalmine.operators.filters import is_open, matched_rules, open_items, recent_misses, topic_flags, with_lowered
from signalmine.operators.ranking import top_k


def miss_clusters(misses: DataFrame, width: int | None = None, min_count: int = 2, k: int | None = None) -> DataFrame:
    """Unresolved misses grouped by query (by its first ``width`` characters if
    given), at least ``min_count`` each; the top ``k`` if given."""
    key = left("query", width) if width else F.col("query")
    g = (misses.filter(F.col("resolved") == F.lit(False)).groupBy(key.alias("query_prefix"))
         .agg(F.count(F.lit(1)).alias("miss_count"), F.max("created_at").alias("last_miss"))
         .filter(F.col("miss_count") >= min_count))
    if k is None:
        return g
    return g.orderBy(F.col("miss_count").desc(), F.col("query_prefix")).limit(k)


def miss_counts_7d(misses: DataFrame, as_of: AsOf, days: int = 7, k: int | None = None,
                   width: int | None = None) -> DataFrame:
    """Queries of the last ``days`` with their number of misses (resolved or not)."""
    recent_rows = misses.filter(recent("created_at", as_of, days=days))
    counts = recent_rows.groupBy(left("query", width).alias("query")).agg(F.count(F.lit(1)).alias("miss_count"))
    return top_k(counts, k, F.col("miss_count").desc(), F.col("query"))


def miss_last_seen(misses: DataFrame, min_count: int = 3, k: int | None = None) -> DataFrame:
    """Unresolved misses per query: count and last time, count >= ``min_count``."""
    counts = (misses.filter(F.col("resolved") == F.lit(False)).groupBy("query")
              .agg(F.count(F.lit(1)).alias("miss_count"), F.max("created_at").alias("last_miss"))
              .filter(F.col("miss_count") >= min_count))
    return top_k(counts, k, F.col("miss_count").desc(), F.col("query"))


def misses_to_items(misses: DataFrame, as_of: AsOf, hours: int = 24, min_count: int = 2,
                    width: int | None = None) -> DataFrame:
    """New 'rag_miss' learning items from repeated unresolved searches of the last day."""
    g = (recent_misses(misses, as_of, hours=hours).groupBy(left("query", width).alias("q"))
         .agg(F.count(F.lit(1)).alias("occurrence_count"))
         .filter(F.col("occurrence_count") >= min_count))
    return g.select(
        F.lit("rag_miss").alias("source"),
        F.concat(F.lit(MISS_ITEM_PREFIX), F.col("q")).alias("lesson"),
        F.lit("vault").alias("applicable_to"),
        F.col("occurrence_count").cast("int").alias("occurrence_count"))


def word_clusters(items: DataFrame, min_len: int = 6, min_count: int = 5, k: int | None = None,
                  stop_words=STOP_WORDS) -> DataFrame:
    """Frequent words (occurrences, not items) of open lessons.

    The reference turns every character outside ``[a-z0-9 ]`` into a space
    and splits on single spaces; since only words of ``min_len`` >= 1
    characters count, that equals one split on ``[^a-z0-9]+`` (no rewrite
    pass, no empty tokens). The explode is narrow and the count is a partial
    aggregate, so no per-word list ever forms in one task.
    """
    words = open_items(items).select(F.explode(F.split(F.lower("lesson"), "[^a-z0-9]+")).alias("word"))
    counts = (words.filter((F.length("word") >= min_len) & ~F.col("word").isin(list(stop_words)))
              .groupBy("word").agg(F.count(F.lit(1)).alias("occurrences"))
              .filter(F.col("occurrences") >= min_count))
    return top_k(counts, k, F.col("occurrences").desc(), F.col("word"))


def topic_counts(items: DataFrame, rules=TOPIC_RULES, with_other: bool = False) -> DataFrame:
    """Open items per topic in one pass (the reference scans five times).

    ``with_other`` adds the count of open items without any topic (extension).
    """
    flags = topic_flags("lesson", rules, lowered=True)
    aggs = [F.count_if(flag).alias(name) for name, flag in flags.items()]
    if with_other:
        none = ~F.greatest(*[flag for flag in flags.values()]) if len(flags) > 1 else ~list(flags.values())[0]
        aggs.append(F.count_if(none).alias("other"))
    aggs.append(F.count(F.lit(1)).alias("open_total"))
    return with_lowered(open_items(items).select("lesson")).agg(*aggs)


def topic_counts_by_rules(items: DataFrame, rules: DataFrame) -> DataFrame:
    """(name, open_items): how many open items each rule of a table matches, 0 included."""
    tags = matched_rules(open_items(items).select("lesson"), rules).select(F.explode("topics").alias("name"))
    counts = tags.groupBy("name").agg(F.count(F.lit(1)).alias("open_items"))
    names = rules.where("name is not null and pattern is not null").select("name").distinct()
    return names.join(counts, "name", "left").select("name", F.coalesce("open_items", F.lit(0)).alias("open_items"))


def skill_scorecard(metrics: DataFrame, k: int | None = None) -> DataFrame:
    """Per invoked skill: uses, success %, average duration in ms, last use."""
    g = metrics.filter(F.col("invoked") == F.lit(True)).groupBy("skill_name").agg(
        F.count(F.lit(1)).alias("total_uses"),
        F.round(F.avg(F.when(F.col("success"), 100).otherwise(0)).cast("decimal(20,6)"), 2)
         .cast("double").alias("success_rate"),
        F.round(F.avg(F.col("duration_minutes") * 60000), 0).cast("double").alias("avg_duration_ms"),
        F.max("created_at").alias("last_used"))
    return top_k(g, k, F.col("total_uses").desc(), F.col("skill_name"))


def open_counts(items: DataFrame, misses: DataFrame) -> DataFrame:
    """The memo counters as (metric, value) rows: open items and unresolved misses."""
    a = items.agg(F.lit("open_items").alias("metric"), F.count_if(is_open()).alias("value"))
    b = misses.agg(F.lit("open_misses").alias("metric"),
                   F.count_if(F.col("resolved") == F.lit(False)).alias("value"))
    return a.unionByName(b)


def run_summary(findings: DataFrame) -> DataFrame:
    """Reply lines per finding type and their sum, as one row (what a run made of
    them is ``created_summary``)."""
    t = F.col("type")
    return findings.agg(
        F.count_if(t == "PLAYBOOK").alias("playbooks"),
        F.count_if(t == "APPLY").alias("applied"),
        F.count_if(t == "PATTERN").alias("patterns"),
        F.count_if(t == "VAULTGAP").alias("gaps"),
    ).withColumn("total", F.col("playbooks") + F.col("applied") + F.col("patterns") + F.col("gaps"))


def created_summary(**tables: DataFrame) -> DataFrame:
    """One row with the number of rows of each given table (documents created,
    items closed, patterns changed, proposals made), by its name."""
    rows = None
    for name, df in tables.items():
        one = df.agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n"))
        rows = one if rows is None else rows.unionByName(one)
    return rows.agg(*[F.max(F.when(F.col("name") == name, F.col("n"))).alias(name) for name in tables])


def phase_summary(phases: DataFrame, gated: Column | None = None) -> DataFrame:
    """Per run: total cost and duration, passed / failed phases, status. A phase
    whose gate was not run (``gated`` false) adds cost and time only."""
    ran = F.lit(True) if gated is None else gated
    return phases.groupBy("run_id").agg(
        F.sum("cost_usd").alias("total_cost_usd"),
        F.sum("duration_s").cast("bigint").alias("total_duration_s"),
        F.count_if(ran & F.col("gate_ok")).alias("phases_ok"),
        F.count_if(ran & ~F.col("gate_ok")).alias("phases_failed"),
    ).withColumn("status", F.when(F.col("phases_failed") == 0, "SUCCESS").otherwise("WITH ERRORS"))
