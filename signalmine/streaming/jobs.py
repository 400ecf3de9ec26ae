"""Structured Streaming forms of the incremental jobs.

The reference polls by cron with trailing windows and "already seen" checks;
here the same logic runs as streaming queries with event-time watermarks, so
state is bounded and late rows are dropped explicitly. Sources are file
streams (parquet or Markdown); run them with ``trigger(availableNow=True)``
for the nightly batch, or continuously. Checkpoints live under the shared
``spark.checkpoint.dir`` so a restarted driver resumes exactly where it
stopped.

``withWatermark`` needs a zoned TIMESTAMP, while the inputs carry
TIMESTAMP_NTZ: the event time is cast under the session time zone (UTC).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalmine.functions.text import left
from signalmine.session import scratch_path
from signalmine.sources.tables import SCHEMAS


def event_time(df: DataFrame, col: str = "created_at") -> DataFrame:
    return df.withColumn("event_time", F.col(col).cast("timestamp"))


def read_stream(spark: SparkSession, path: str, name: str, max_files: int | None = None) -> DataFrame:
    """Parquet file stream with the declared schema of table ``name``."""
    r = spark.readStream.schema(SCHEMAS[name])
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path)


def stream_miss_clusters(misses: DataFrame, width: int | None = None, min_count: int = 2,
                         watermark: str = "1 day", window: str = "1 day") -> DataFrame:
    """Daily tumbling roll-up of unresolved misses by query (append mode:
    a window is emitted once the watermark passes its end)."""
    m = event_time(misses).filter(F.col("resolved") == F.lit(False)).withWatermark("event_time", watermark)
    g = (m.groupBy(F.window("event_time", window).alias("w"), left("query", width).alias("query_prefix"))
         .agg(F.count(F.lit(1)).alias("miss_count")))
    return g.filter(F.col("miss_count") >= min_count).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "query_prefix", "miss_count")


def stream_miss_clusters_sliding(misses: DataFrame, width: int | None = None, days: int = 7,
                                 watermark: str = "1 day") -> DataFrame:
    """'Last 7 days' counts recomputed each day: sliding 7-day windows every day."""
    m = event_time(misses).withWatermark("event_time", watermark)
    return (m.groupBy(F.window("event_time", f"{days} days", "1 day").alias("w"), left("query", width).alias("query"))
            .agg(F.count(F.lit(1)).alias("miss_count"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "query", "miss_count"))


def stream_error_patterns(errors: DataFrame, watermark: str = "1 day") -> DataFrame:
    """Per (pattern_key, day): occurrences, first and last seen. Run in update
    mode; ``upsert_pattern_counts`` folds each micro-batch into the table."""
    e = event_time(errors, "ts").withWatermark("event_time", watermark)
    return (e.groupBy("pattern_key", F.window("event_time", "1 day").alias("w"))
            .agg(F.count(F.lit(1)).alias("occurrence_count"), F.min("ts").alias("first_seen"),
                 F.max("ts").alias("last_seen"))
            .select("pattern_key", F.col("w.start").alias("day"), "occurrence_count", "first_seen", "last_seen"))


def _exists(spark: SparkSession, path: str) -> bool:
    """Is there anything at ``path``? Asked of its own file system, so that a
    failing read is never taken for a missing table."""
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jvm_path)


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Complete versions ``v=<batch id>`` of a versioned table, ascending."""
    if not _exists(spark, path):
        return []
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(jvm_path)
    names = [f.getPath().getName() for f in found if f.isDirectory()]
    return sorted(int(n[2:]) for n in names if n.startswith("v=") and _exists(spark, f"{path}/{n}/_SUCCESS"))


def _drop(spark: SparkSession, path: str) -> None:
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jvm_path, True)


PATTERN_COUNTS = "pattern_key string, day timestamp, occurrence_count long, first_seen timestamp_ntz, last_seen timestamp_ntz"


def upsert_pattern_counts(table_path: str, keep_versions: int = 3):
    """``foreachBatch`` function: merge a batch of per-day counts into the
    pattern table at ``table_path``: rows of the batch replace the same
    (key, day) rows of the version before it (anti join + union), written as a
    new version ``v=<batch id>``. A replayed batch starts from the same earlier
    version and rewrites its own, so the result is exactly once; versions older
    than the last ``keep_versions`` are dropped after the write."""
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        cols = ["pattern_key", "day", "occurrence_count", "first_seen", "last_seen"]
        rows = batch.select(*cols)
        before = [v for v in _versions(spark, table_path) if v < batch_id]
        if before:
            prev = spark.read.schema(PATTERN_COUNTS).parquet(f"{table_path}/v={before[-1]:012d}")
            rows = prev.join(rows.select("pattern_key", "day"), ["pattern_key", "day"], "left_anti").unionByName(rows)
        rows.write.mode("overwrite").parquet(f"{table_path}/v={batch_id:012d}")
        for v in before[:-keep_versions]:
            _drop(spark, f"{table_path}/v={v:012d}")
    return run


def read_pattern_counts(spark: SparkSession, table_path: str) -> DataFrame:
    """The newest version of the pattern table (empty before the first)."""
    versions = _versions(spark, table_path)
    if not versions:
        return spark.createDataFrame([], PATTERN_COUNTS)
    return spark.read.schema(PATTERN_COUNTS).parquet(f"{table_path}/v={versions[-1]:012d}")


def stream_pattern_lifetimes(errors: DataFrame) -> DataFrame:
    """Per pattern_key over its whole life: occurrence_count, first_seen, last_seen.
    The state is one row per key and never expires, so late rows count. Run in
    update mode with ``pattern_lifetimes_writer``: a batch emits the keys that it
    changed and no others. Rows without a key are one key, rows without a time
    count but are no first or last."""
    return errors.groupBy("pattern_key").agg(
        F.count(F.lit(1)).alias("occurrence_count"), F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"))


LIFETIMES = "pattern_key string, occurrence_count long, first_seen timestamp_ntz, last_seen timestamp_ntz"
MERGE_EVERY = 32


def _folders(spark: SparkSession, path: str) -> dict[str, dict[int, str]]:
    """Complete folders ``<kind>=<number>`` below ``path``: kind -> number -> folder."""
    found: dict[str, dict[int, str]] = {}
    if _exists(spark, path):
        jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        for f in jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(jvm_path):
            kind, _, number = f.getPath().getName().partition("=")
            if number.isdigit() and _exists(spark, f"{path}/{kind}={number}/_SUCCESS"):
                found.setdefault(kind, {})[int(number)] = f"{path}/{kind}={number}"
    return found


def _lifetimes(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """The newest row of each key in the last merged folder and the batches after it."""
    found = _folders(spark, path)
    merged = {n: f for n, f in found.get("merged", {}).items() if before is None or n < before}
    since = max(merged, default=-1)
    parts = [(since, merged[since])] if merged else []
    parts += [(n, f) for n, f in sorted(found.get("batch", {}).items()) if n > since and (before is None or n < before)]
    if not parts:
        return spark.createDataFrame([], LIFETIMES)
    names = [name for name, *_ in (field.split() for field in LIFETIMES.split(", "))]
    rows = None
    for n, folder in parts:
        part = spark.read.schema(LIFETIMES).parquet(folder).withColumn("_batch", F.lit(n))
        rows = part if rows is None else rows.unionByName(part)
    newest = rows.groupBy("pattern_key").agg(F.max_by(F.struct(*names[1:]), "_batch").alias("_row"))
    return newest.select("pattern_key", "_row.*")


def pattern_lifetimes_writer(path: str, merge_every: int = MERGE_EVERY):
    """``foreachBatch`` function: the changed keys of a batch become the folder
    ``batch=<id>``; no other row is read or written. A replayed batch rewrites its own
    folder. Every ``merge_every`` batches the newest rows so far become one folder
    ``merged=<id>``, and what the merged folder before it made superfluous goes."""
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id:012d}")
        if batch_id % merge_every == merge_every - 1:
            _lifetimes(spark, path, batch_id + 1).write.mode("overwrite").parquet(f"{path}/merged={batch_id:012d}")
            found = _folders(spark, path)
            older = [n for n in found["merged"] if n < batch_id]
            if older:
                # readers may still use the last merged folder but one and what came after it
                last = max(older)
                for kind, folders in found.items():
                    for n, folder in folders.items():
                        if n < last or n == last and kind == "batch":
                            _drop(spark, folder)
    return run


def read_pattern_lifetimes(spark: SparkSession, path: str) -> DataFrame:
    """(pattern_key, occurrence_count, first_seen, last_seen) of every key seen so far."""
    return _lifetimes(spark, path)


def stream_dedup_items(items: DataFrame, watermark: str = "14 days", prefix_len: int | None = None) -> DataFrame:
    """Drop later copies (same source and lesson) within the watermark; the state
    keeps a digest per lesson, not its text."""
    i = event_time(items).withColumn("lesson_key", F.sha2(left("lesson", prefix_len), 256))
    return i.withWatermark("event_time", watermark).dropDuplicatesWithinWatermark(["source", "lesson_key"])


def session_file_stream(spark: SparkSession, sessions_dir: str) -> DataFrame:
    """New Markdown session logs as they land: (path, content) per file."""
    return (spark.readStream.format("text").option("wholetext", True).option("pathGlobFilter", "*.md")
            .load(sessions_dir).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("content")))


def session_lines_of(batch: DataFrame) -> DataFrame:
    """(file_name, line_no, line) of a micro-batch of session files."""
    from signalmine.sources.files import to_lines

    name = F.url_decode(F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\+", "%2B"))
    return to_lines(batch.withColumn("file_name", name).drop("path"))


def session_items_batch(batch: DataFrame, items: DataFrame) -> DataFrame:
    """Items from one micro-batch of session files: first lesson per file,
    minus files already named by a session item."""
    from signalmine.operators.text import session_items

    return session_items(session_lines_of(batch), items)


SEEN = "_seen"


def session_items_writer(items_path: str, known_items: str | None = None):
    """``foreachBatch`` function: a batch's new session items become the partition
    ``batch=<id>`` of the item table at ``items_path``, and the names of all its files
    the same partition of a ledger beside it. A file whose name another batch has in the
    ledger is no new one, so no batch reads an earlier item. Both writes replace the
    batch's own partition: a batch that died at any point is done again with the same
    result. The numbers are those of one checkpoint: a table belongs to one stream.

    ``known_items``: an item table that this stream doesn't write; files that its
    session items name are left out too."""
    from signalmine.operators.text import session_items

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        lines, ledger = session_lines_of(batch), f"{items_path}/{SEEN}"
        others = [f for n, f in _folders(spark, ledger).get("batch", {}).items() if n != batch_id]
        if others:
            seen = spark.read.schema("file_name string").parquet(*others)
            lines = lines.join(seen, "file_name", "left_anti")
        items = spark.read.parquet(known_items) if known_items is not None else spark.createDataFrame(
            [], "source string, lesson string")
        session_items(lines, items).write.mode("overwrite").parquet(f"{items_path}/batch={batch_id:012d}")
        lines.select("file_name").distinct().write.mode("overwrite").parquet(f"{ledger}/batch={batch_id:012d}")
    return run


def run_available(df: DataFrame, name: str, mode: str = "append", sink: str = "memory",
                  checkpoint: str | None = None, foreach_batch=None):
    """Run a streaming DataFrame over everything available now, then stop."""
    spark = df.sparkSession
    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint or scratch_path(spark, f"stream-{name}"))
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    else:
        w = w.format(sink).queryName(name)
    q = w.trigger(availableNow=True).start()
    q.awaitTermination()
    return q
