"""Sinks: appended tables, documents that never overwrite, reports, JSON.

All writes go through Spark writers to a path on the shared file system; a
failed task or lost executor is retried by Spark and only committed output is
visible (the file committer's job-level commit), so a rerun after a crash
never sees half a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalmine.operators.joins import new_documents
from signalmine.session import materialize


def append_items(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Append new rows (learning items, proposals, run ledger) as parquet."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)


def write_changes(updated: DataFrame, path: str, partition_by: str, changed: str = "changed") -> None:
    """Write the result of an update (``operators.updates``: the whole table with a
    flag ``changed``) back to the table at ``path``, which is partitioned by
    ``partition_by``: partitions without a changed row keep their files, the others are
    replaced by dynamic partition overwrite. The new rows are checkpointed first, since
    they are read from what is overwritten. An update must leave ``partition_by`` as it
    is and remove no row; a null flag is no change."""
    touched = updated.filter(F.col(changed)).select(F.col(partition_by).alias("_touched")).distinct()
    rows = updated.join(touched, F.col(partition_by).eqNullSafe(F.col("_touched")), "left_semi").drop(changed)
    (materialize(rows).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_by).parquet(path))


def write_ordered(rows: DataFrame, order: list[str], path: str, fmt: str = "json") -> None:
    """Write ``rows`` as files whose names in ascending order hold them in ascending
    order of the columns ``order``: a range of the order per task, so a section, digest
    or report of any size is never one value. ``fmt``: json (a line per row, nulls
    kept), or text (the column ``line``)."""
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    if fmt == "text":
        ranged.select("line").write.mode("overwrite").text(path)
    else:
        ranged.write.mode("overwrite").option("ignoreNullFields", False).format(fmt).save(path)


def write_staging_sections(sections: dict[str, tuple[DataFrame, list[str]]], path: str) -> None:
    """The sections of ``staging_document`` at any size: (rows, order) of each as JSON
    lines in the folder ``section=<name>`` below ``path``."""
    for name, (rows, order) in sections.items():
        write_ordered(rows, order, f"{path}/section={name}")


def write_documents(docs: DataFrame, existing: DataFrame | None, path: str) -> DataFrame:
    """Write (path, content) rows whose path is new; returns what was written.

    ``existing`` holds the paths already present (e.g. from
    ``sources.files.read_texts``); the anti join is the "never overwrite" rule.
    """
    fresh = new_documents(docs, existing) if existing is not None else docs
    fresh.select("path", "content").write.mode("append").parquet(path)
    return fresh


def write_report(metrics: DataFrame, path: str, fmt: str = "json") -> None:
    """Write a (section, name, value) report table; one small file, the rows of
    which are brought together by a shuffle of their own."""
    metrics.repartition(1).write.mode("overwrite").format(fmt).save(path)


def report_lines(metrics: DataFrame) -> DataFrame:
    """A (section, name, value) table as Markdown table lines, a row each."""
    return metrics.select("section", "name", F.concat(
        F.lit("| "), F.col("section"), F.lit(" | "), F.col("name"), F.lit(" | "), F.col("value").cast("string"),
        F.lit(" |")).alias("line"))


def report_markdown(metrics: DataFrame, title: str) -> DataFrame:
    """A report of a few rows (counters, top-k lists) as one Markdown text, in
    section/name order. Large tables: ``report_lines``, which stay rows."""
    rows = F.array_sort(F.collect_list(F.struct("section", "name", "line")))
    return report_lines(metrics).agg(F.concat(
        F.lit(f"# {title}\n\n| Section | Metric | Value |\n|---|---|---|\n"),
        F.array_join(F.transform(rows, lambda r: r["line"]), "\n"), F.lit("\n")).alias("markdown"))


def json_rows(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` as one row with a JSON array (json) of its rows, in ascending order
    of the columns ``order`` (their values are part of the objects)."""
    rows = F.array_sort(F.collect_list(F.struct(*order, F.struct(*df.columns).alias("_row"))))
    return df.agg(F.to_json(F.transform(rows, lambda r: r["_row"])).alias("json"))


def staging_document(day: str, pattern_count: DataFrame, auto_today: DataFrame, max_per_day: int,
                     sections: dict[str, DataFrame]) -> DataFrame:
    """One nested JSON document (patterns, decisions, metrics, misses ...).

    Each section is a small top-k DataFrame folded into an array of structs,
    sorted by the values of its columns from the left;
    ``pattern_count`` / ``auto_today`` are one-row, one-column DataFrames.
    """
    # every part is one row; they are joined on a constant key
    doc = pattern_count.select(F.lit(1).alias("_k"), F.col(pattern_count.columns[0]).alias("pattern_count"))
    doc = doc.join(auto_today.select(F.lit(1).alias("_k"), F.col(auto_today.columns[0]).alias("auto_today")), "_k")
    for name, df in sections.items():
        arr = df.agg(F.lit(1).alias("_k"), F.array_sort(F.collect_list(F.struct(*df.columns))).alias(name))
        doc = doc.join(arr, "_k")
    return doc.select(F.to_json(F.struct(F.lit(day).alias("date"), "pattern_count", "auto_today",
                                         F.lit(max_per_day).alias("max_auto_per_day"),
                                         *sections.keys())).alias("json"))


def write_staging_json(doc: DataFrame, path: str) -> None:
    doc.repartition(1).write.mode("overwrite").text(path)
