"""Documents as files: a Python data source that writes each (path, content) row as a
file below a root folder that driver and executors share, and never overwrites one.

Tasks write into a staging folder of the job, a folder per attempt; when all tasks
are done the driver gives each staged file its name by a hard link, which fails if
the name is taken, so a document that somebody else made meanwhile stays. A failed
or repeated task leaves nothing but staged files, which go with the staging folder.
"""

from __future__ import annotations

import os
import shutil
import uuid
from dataclasses import dataclass

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

FORMAT = "document_files"
STAGING = ".staging-"


@dataclass
class Staged(WriterCommitMessage):
    """What one task has staged: (staged file, document's path below the root)."""

    files: list[tuple[str, str]]


def below(path: str) -> str:
    """``path`` if it is relative and stays below the folder that it is read in."""
    clean = os.path.normpath(path)
    if not path or os.path.isabs(path) or clean.split(os.sep)[0] in ("..", "."):
        raise ValueError(f"not a path below the documents' folder: {path!r}")
    return clean


class DocumentWriter(DataSourceWriter):
    def __init__(self, root: str):
        self.root, self.staging = root, os.path.join(root, f"{STAGING}{uuid.uuid4().hex}")

    def write(self, iterator):
        folder = os.path.join(self.staging, str(TaskContext.get().taskAttemptId()))
        os.makedirs(folder, exist_ok=True)
        files = []
        for row in iterator:
            staged, name = os.path.join(folder, str(len(files))), below(row["path"])
            with open(staged, "w", encoding="utf-8", newline="") as f:
                f.write(row["content"] or "")
            files.append((staged, name))
        return Staged(files)

    def commit(self, messages):
        for message in messages:
            for staged, name in message.files if message is not None else ():
                target = os.path.join(self.root, name)
                os.makedirs(os.path.dirname(target), exist_ok=True)
                try:
                    os.link(staged, target)
                except FileExistsError:
                    pass  # there already: never overwritten
        shutil.rmtree(self.staging, ignore_errors=True)

    def abort(self, messages):
        shutil.rmtree(self.staging, ignore_errors=True)


class DocumentFiles(DataSource):
    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        return "path string, content string"

    def writer(self, schema, overwrite):
        if overwrite:
            raise ValueError("documents are never overwritten: write with mode append")
        return DocumentWriter(self.options["path"])


def write_document_files(docs: DataFrame, root: str) -> None:
    """Write each (path, content) row of ``docs`` as a file below ``root``, a folder that
    driver and executors share. Files that exist stay as they are. Of rows with one
    path the smallest content is written; a null content is an empty file, a null path is
    left out, and a path that leaves ``root`` fails the job before any file has its name."""
    spark: SparkSession = docs.sparkSession
    spark.dataSource.register(DocumentFiles)
    once = docs.where("path is not null").groupBy("path").agg(F.min(F.coalesce("content", F.lit(""))).alias("content"))
    once.write.format(FORMAT).mode("append").option("path", root).save()
