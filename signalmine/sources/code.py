"""Code trees as a Python data source: folders are listed as Spark's own readers do
not, names that start with '.' or '_' included, and each task walks and reads the
folders of its share. Driver and executors share the folders that are read."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from signalmine.functions.constants import CODE_EXTENSIONS, SKIP_DIRS

FORMAT = "code_files"
FOLDERS = 256  # folders from which the driver leaves the rest of the tree to the tasks
TASKS = 64     # tasks that they are dealt to


@dataclass
class Share(InputPartition):
    """Folders of one task, each with: walk below it too?"""

    folders: list[tuple[str, bool]]


def _failed(error: OSError):
    raise error


class CodeReader(DataSourceReader):
    def __init__(self, roots: list[str], skip_hidden: bool):
        self.roots, self.skip_hidden = roots, skip_hidden

    def entered(self, name: str) -> bool:
        return name not in SKIP_DIRS and not (self.skip_hidden and name.startswith("."))

    def partitions(self):
        open_, listed = sorted({os.path.normpath(root) for root in self.roots}), []
        while open_ and len(open_) < FOLDERS:
            below = []
            for folder in open_:
                with os.scandir(folder) as entries:
                    below += [e.path for e in entries if e.is_dir(follow_symlinks=False) and self.entered(e.name)]
            listed += [(folder, False) for folder in open_]
            open_ = sorted(below)
        work = listed + [(folder, True) for folder in open_]
        return [Share(work[at::TASKS]) for at in range(min(TASKS, len(work)))]

    def _files(self, folder: str, deep: bool) -> Iterator[str]:
        for at, inner, names in os.walk(folder, onerror=_failed):
            inner[:] = sorted(d for d in inner if self.entered(d)) if deep else []
            for name in sorted(names):
                if os.path.splitext(name)[1].lower() in CODE_EXTENSIONS:
                    yield os.path.join(at, name)

    def read(self, partition):
        for folder, deep in partition.folders:
            for path in self._files(folder, deep):
                try:
                    with open(path, encoding="utf-8", errors="replace", newline="") as f:
                        content = f.read()
                except FileNotFoundError:
                    continue  # a link to nothing
                yield path, content


class CodeFiles(DataSource):
    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        return "path string, content string"

    def reader(self, schema):
        return CodeReader(json.loads(self.options["roots"]), self.options["skip_hidden"] == "true")
