"""Windows, sorts, limits and top-k.

Global top-k is ``orderBy(...).limit(k)``, which plans as
TakeOrderedAndProject: every partition keeps k rows, the driver merges
``partitions x k`` rows. Every order ends with a unique key so ties never make
the result depend on the physical plan. Per-group top-k uses ``row_number``
with a rank filter, which Spark plans with a WindowGroupLimit before the
shuffle, so a hot group sends only k rows per partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalmine.functions.text import left
from signalmine.functions.timefn import AsOf, recent
from signalmine.operators.filters import is_open, open_items, recurring_errors


def top_k(df: DataFrame, k: int | None, *order: Column) -> DataFrame:
    """The first ``k`` rows; all rows (in no order) when None."""
    return df if k is None else df.orderBy(*order).limit(k)


def top_per_group(df: DataFrame, keys: list[str], order: list[Column], k: int | None,
                  rank_col: str = "rank") -> DataFrame:
    """Rows with their rank in the group, the first ``k`` or (None) all."""
    w = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn(rank_col, F.row_number().over(w))
    return ranked if k is None else ranked.filter(F.col(rank_col) <= k)


# ---- §2.6 top-k reports ------------------------------------------------------

def top_open_items(items: DataFrame, k: int | None = 15, text_len: int | None = 150) -> DataFrame:
    return top_k(open_items(items).select("id", "source", left("lesson", text_len).alias("lesson"),
                                          "occurrence_count", "created_at"),
                 k, F.col("occurrence_count").desc(), F.col("created_at").desc(), F.col("id"))


def top_recent_items(items: DataFrame, as_of: AsOf, days: int = 14, k: int = 10) -> DataFrame:
    rows = items.filter(is_open() & recent("created_at", as_of, days=days)).select(
        "id", "source", left("lesson", 60).alias("lesson"), "occurrence_count")
    return top_k(rows, k, F.col("occurrence_count").desc(), F.col("id"))


def top_errors(patterns: DataFrame, k: int | None = 10, min_count: int = 2) -> DataFrame:
    rows = recurring_errors(patterns, min_count).select(
        "pattern_key", "category", "occurrence_count", left("description", 80).alias("description"))
    return top_k(rows, k, F.col("occurrence_count").desc(), F.col("pattern_key"))


def top_error_lessons(items: DataFrame, k: int = 5) -> DataFrame:
    rows = open_items(items).filter(F.col("source") == "error").select(
        "id", left("lesson", 200).alias("lesson"), "occurrence_count")
    return top_k(rows, k, F.col("occurrence_count").desc(), F.col("id"))


def latest_session_lessons(items: DataFrame, k: int = 10) -> DataFrame:
    rows = open_items(items).filter(F.col("source") == "session").select(
        "id", left("lesson", 200).alias("lesson"), "created_at")
    return top_k(rows, k, F.col("created_at").desc(), F.col("id").desc())


def newest_sessions(files: DataFrame, k: int | None = 10, name_col: str = "file_name",
                    count_col: str = "summary_lines") -> DataFrame:
    """Files with a summary, newest name first. Pass counts per file
    (``summary_counts``); texts are best built for the ``k`` files only."""
    return top_k(files.filter(F.col(count_col) > 0), k, F.col(name_col).desc())


def global_link_cap(pairs: DataFrame, cap: int | None = 10) -> DataFrame:
    """At most ``cap`` new links per run, in source order then neighbour rank."""
    return top_k(pairs, cap, F.col("src"), F.col("rank"), F.col("dst"))


# ---- §2.5 windows --------------------------------------------------------------

def latest_per_key(df: DataFrame, key: str, ts: str = "created_at", tie: str = "id") -> DataFrame:
    """Newest row per key (row_number = 1)."""
    return top_per_group(df, [key], [F.col(ts).desc(), F.col(tie).desc()], 1, "_rn").drop("_rn")


def latest_proposal(proposals: DataFrame) -> DataFrame:
    return latest_per_key(proposals, "target_skill")


def head_lines(lines: DataFrame, n: int, file_col: str = "file_name", line_col: str = "line_no") -> DataFrame:
    """First ``n`` lines per file."""
    return top_per_group(lines, [file_col], [F.col(line_col)], n, "_rn").drop("_rn")


def running_budget(phases: DataFrame, max_budget: float | None = None, value: str = "cost_usd",
                   limit_col: str = "max_budget_usd", order: tuple[str, ...] = ("phase",)) -> DataFrame:
    """A phase runs only when the cost *before* it is within the budget.

    The first phase after an overrun still sees the overrun in its prefix sum,
    so "stop after the first overrun" is exactly ``spent_before <= budget``.
    Window partitions are single runs, so the sort is per run, never global.
    """
    w = Window.partitionBy("run_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    spent = F.coalesce(F.sum(value).over(w), F.lit(0))
    budget = F.lit(max_budget) if max_budget is not None else F.col(limit_col)
    return phases.withColumn("spent_before", spent).withColumn("runs", F.col("spent_before") <= budget)


def running_time_limit(phases: DataFrame, max_hours: float = 8, value: str = "duration_s",
                       order: tuple[str, ...] = ("phase",)) -> DataFrame:
    """Same rule for elapsed seconds against ``max_hours``."""
    w = Window.partitionBy("run_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    elapsed = F.coalesce(F.sum(value).over(w), F.lit(0))
    return (phases.withColumn("elapsed_before_s", elapsed)
            .withColumn("runs", F.col("elapsed_before_s") <= F.lit(max_hours * 3600)))


def resume_point(results: DataFrame, ok_col: str = "gate_ok") -> DataFrame:
    """Per run: highest finished phase + 1 (1 when nothing finished)."""
    return results.groupBy("run_id").agg(
        (F.coalesce(F.max(F.when(F.col(ok_col), F.col("phase"))), F.lit(0)) + 1).alias("resume_phase"))


def budget_per_phase(runs: DataFrame, budget: str = "max_budget_usd", phases: str = "n_phases") -> DataFrame:
    """Budget divided by phases, truncated to 2 decimals (``bc scale=2``)."""
    per = F.floor(F.col(budget).cast("decimal(20,4)") * 100 / F.col(phases)) / 100
    return runs.withColumn("budget_per_phase", per.cast("decimal(12,2)"))
