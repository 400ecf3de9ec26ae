"""File sources: session logs, Markdown knowledge bases, code trees, config.

Files are read by Spark's own readers (``text`` with ``wholetext``, ``json``; code
trees by ``sources.code``) so a directory of millions of files is split across
tasks; the path comes from the ``_metadata`` column. Line tables
``(path, modified_at, line_no, line)`` are built from whole texts with
``posexplode(split(content, '\\n'))`` inside the task that read the file, so a
file's lines never cross a shuffle unless an operator groups them.
"""

from __future__ import annotations

import fnmatch
import json
import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalmine.functions.text import basename, parent_name
from signalmine.functions.timefn import AsOf, before, recent, to_datetime
from signalmine.operators.ranking import top_per_group
from signalmine.session import materialize
from signalmine.sources.code import FORMAT, CodeFiles


def read_texts(spark: SparkSession, root: str, glob: str = "*.md", recursive: bool = True) -> DataFrame:
    """(path, modified_at, content) for every matching file under ``root``."""
    # ``text()`` has its own wholetext=False default, so pass it as a keyword
    df = spark.read.text(root, wholetext=True, recursiveFileLookup=recursive, pathGlobFilter=glob)
    # the metadata path is a URL: decode it once, so that names are the files' own ('+' is no blank in a path)
    path = F.url_decode(F.regexp_replace(F.col("_metadata.file_path"), r"\+", "%2B"))
    out = df.select(path.alias("path"),
                    F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("modified_at"),
                    F.col("value").alias("content"))
    # the glob again on the file name: the reader applies it only to the listing it prunes
    return out.filter(basename(F.col("path")).rlike(fnmatch.translate(glob)))


def to_lines(docs: DataFrame, content_col: str = "content") -> DataFrame:
    """Whole texts to a line table; line numbers start at 1 like ``grep -n``.
    A final newline does not make an extra empty line."""
    body = F.regexp_replace(F.col(content_col), r"\n\z", "")
    keep = [c for c in docs.columns if c != content_col]
    return (docs.select(*keep, F.posexplode(F.split(body, "\n")).alias("pos", "line"))
            .withColumn("line_no", (F.col("pos") + 1).cast("int")).drop("pos"))


def numbered_lines(spark: SparkSession, root: str, glob: str = "*.md", recursive: bool = True) -> DataFrame:
    """(path, modified_at, line_no, line) of every matching file, as ``to_lines`` of
    ``read_texts`` gives them but without a task that holds a whole file: a large file
    is read in splits, and a line's number is its place in its split plus the lines of
    the file's splits before. Empty files have no line."""
    df = spark.read.text(root, lineSep="\n", recursiveFileLookup=recursive, pathGlobFilter=glob)
    path = F.url_decode(F.regexp_replace(F.col("_metadata.file_path"), r"\+", "%2B"))
    # the rows of a split are numbered in their order; written, so that both uses see the same numbers
    lines = materialize(df.select(
        path.alias("path"), F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("modified_at"),
        F.col("_metadata.file_block_start").alias("_split"), F.monotonically_increasing_id().alias("_at"),
        F.col("value").alias("line")))
    earlier = Window.partitionBy("path").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    splits = (lines.groupBy("path", "_split").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
              .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n"))
    out = lines.join(splits, ["path", "_split"]).select(
        "path", "modified_at", "line", (F.col("_at") - F.col("_first") + F.col("_before") + 1).cast("int").alias("line_no"))
    return out.filter(basename(F.col("path")).rlike(fnmatch.translate(glob)))


def _depth_ok(path_col: F.Column, root: str, max_depth: int) -> F.Column:
    rel = F.regexp_replace(path_col, "^(file:)?" + _escape(root.rstrip("/")) + "/", "")
    return F.size(F.split(rel, "/")) <= max_depth


def _escape(s: str) -> str:
    return re.escape(s)


def scan_sessions_by_name_date(spark: SparkSession, root: str, as_of: AsOf, days: int = 1,
                               limit: int | None = None, max_depth: int = 2) -> DataFrame:
    """Session logs whose *name* holds a date of the last ``days`` days (today
    included), at most ``max_depth`` levels deep; the first ``limit`` by path if given."""
    docs = read_texts(spark, root, "*.md")
    name = basename(F.col("path"))
    day = F.to_date(F.regexp_extract(name, r"(\d{4}-\d{2}-\d{2})", 1), "yyyy-MM-dd")
    end = to_datetime(as_of).date()
    start = (to_datetime(as_of) - __import__("datetime").timedelta(days=days)).date()
    out = docs.filter(_depth_ok(F.col("path"), root, max_depth) & day.between(F.lit(start), F.lit(end)))
    out = out.withColumn("file_name", name)
    return out.orderBy("path").limit(limit) if limit else out


def scan_sessions_by_prefix_date(spark: SparkSession, root: str, as_of: AsOf, days: int = 7) -> DataFrame:
    """Logs whose first 10 name characters are a date on or after ``as_of - days``;
    every path once (the reference can read a month directory twice)."""
    docs = read_texts(spark, root, "*.md")
    name = basename(F.col("path"))
    cutoff = (to_datetime(as_of) - __import__("datetime").timedelta(days=days)).strftime("%Y-%m-%d")
    return (docs.withColumn("file_name", name)
            .filter(F.substring(name, 1, 10).rlike(r"^\d{4}-\d{2}-\d{2}$") & (F.substring(name, 1, 10) >= cutoff))
            .dropDuplicates(["path"]))


def scan_files_modified_since(spark: SparkSession, root: str, as_of: AsOf, days: float,
                              glob: str = "*.md") -> DataFrame:
    """Files modified within ``days`` before ``as_of`` (strict)."""
    docs = read_texts(spark, root, glob)
    return docs.filter(recent("modified_at", as_of, days=days)).withColumn("file_name", basename(F.col("path")))


def scan_skill_learnings(spark: SparkSession, root: str) -> DataFrame:
    """Every ``<skill>/learnings.md``; the skill is the parent directory."""
    docs = read_texts(spark, root, "learnings.md")
    return docs.withColumn("skill", parent_name(F.col("path")))


def scan_code(spark: SparkSession, roots: list[str] | str, skip_hidden: bool = True) -> DataFrame:
    """(path, content) of code files by extension below the folders ``roots``, which
    driver and executors share. Vendor and build directories aren't entered, nor are
    hidden ones (a leading '.') unless ``skip_hidden`` is False. Bytes that are no
    UTF-8 become U+FFFD."""
    spark.dataSource.register(CodeFiles)
    paths = [re.sub("^file:(//)?", "", root) for root in ([roots] if isinstance(roots, str) else roots)]
    return (spark.read.format(FORMAT).option("roots", json.dumps(paths))
            .option("skip_hidden", "true" if skip_hidden else "false").load())


APP_CONFIG_SCHEMA = T.StructType([
    T.StructField("vault_dir", T.StringType()),
    T.StructField("apps", T.MapType(T.StringType(), T.StructType([
        T.StructField("repo", T.StringType()), T.StructField("doc", T.StringType())]))),
])


def load_app_config(spark: SparkSession, path: str) -> DataFrame:
    """JSON ``{vault_dir, apps: {name: {repo, doc}}}`` -> rows (app, repo, doc)."""
    cfg = spark.read.schema(APP_CONFIG_SCHEMA).option("multiLine", True).json(path)
    return cfg.select(F.explode("apps").alias("app", "spec")).select(
        "app", F.col("spec.repo").alias("repo"), F.col("spec.doc").alias("doc"))


def scan_recent_commits(commits: DataFrame, as_of: AsOf, days: float = 1, per_repo: int = 5) -> DataFrame:
    """Newest ``per_repo`` non-merge commits per repository since ``as_of - days``."""
    recent_rows = commits.filter(~F.col("is_merge") & (F.col("committed_at") > before(as_of, days=days)))
    return top_per_group(recent_rows, ["repo"], [F.col("committed_at").desc(), F.col("sha").desc()],
                         per_repo).select("repo", "sha", "subject", "committed_at", "rank")
