"""Line numbers and sections of files that are read in parts."""

import os
import tempfile

from pyspark.sql import functions as F

from conftest import rows
from signalmine.operators import text
from signalmine.sources import files as fsrc

NAMES = ("path", "line_no", "line")


def test_lines_of_splits_are_those_of_whole_texts(spark):
    d = tempfile.mkdtemp(prefix="sm-test-")
    texts = {"long.md": "".join(f"## line {i} é\n" + "x" * (i % 90) + "\n" for i in range(4000)), "no end.md": "a\nb",
             "blank+end.md": "a\n\n", "cr.md": "a\r\nb\rc\n", "one.md": "\n", "other.txt": "no"}
    for name, content in texts.items():
        with open(os.path.join(d, name), "w", newline="") as f:
            f.write(content)
    open(os.path.join(d, "empty.md"), "w").close()
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        got = fsrc.numbered_lines(spark, d)
        assert fsrc.numbered_lines(spark, d).rdd.getNumPartitions() > 1
        splits = spark.read.text(d, lineSep="\n", pathGlobFilter="long.md").select("_metadata.file_block_start").distinct().count()
        assert splits > 10
        got = rows(got, *NAMES)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    want = rows(fsrc.to_lines(fsrc.read_texts(spark, d)), *NAMES)
    assert [w for w in want if not w[0].endswith("/empty.md")] == got and len(got) == 8000 + 2 + 2 + 2 + 1


def test_sections_over_chunks(spark):
    lines = spark.createDataFrame(
        [(f, i, None if i % 17 == 3 else f"## h{i}" if i % 7 == 5 else "text") for f in ("a", "b", None) for i in range(1, 200)]
        + [("c", 1, "text")], "file_name string, line_no int, line string").repartition(6)
    head = F.col("line").startswith("## ")
    got = [rows(text.section_ids(lines, "file_name", head, n).na.fill("-"), "file_name", "line_no", "section")
           for n in (1, 10, 64, 10_000)]
    want = sorted((f, i, sum(j % 7 == 5 and j % 17 != 3 for j in range(1, i + 1))) for f in ("a", "b", "-") for i in range(1, 200))
    assert all(g == sorted([*want, ("c", 1, 0)]) for g in got)
    assert text.section_ids(lines, "file_name", head).columns == ["file_name", "line_no", "line", "_is_head", "section"]
    assert text.section_ids(lines.limit(0), "file_name", head).isEmpty()


def test_front_matter_ends_at_the_second_dashes(spark):
    doc = ["---", "title: \"A\"", "other: x", "title: B", "max_hours: 3", "---", "app: no", "---", "repo: no"]
    files = {"a": doc, "open": doc[:5], "none": ["app: x"], "late": ["app: early", *doc]}
    lines = spark.createDataFrame([(p, i, x) for p, d in files.items() for i, x in enumerate(d, 1)],
                                  "path string, line_no int, line string")
    got = {r.path: (r.title, r.app, r.repo, r.max_hours, r.verification) for r in text.task_front_matter(lines).collect()}
    usual = ("A", None, None, 3.0, "full")
    assert got == {"a": usual, "open": usual, "late": usual, "none": (None, None, None, 8.0, "full")}
