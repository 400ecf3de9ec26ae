import os

import pytest
from pyspark.sql import functions as F

from signalmine.sources.documents import write_document_files

SCHEMA = "path string, content string, more int"


def tree(root):
    return {os.path.relpath(os.path.join(d, f), root): open(os.path.join(d, f), encoding="utf-8", newline="").read()
            for d, _, files in os.walk(root) for f in files}


def test_documents_are_files_and_never_overwritten(spark, tmp_path):
    (tmp_path / "stubs").mkdir()
    (tmp_path / "stubs/old.md").write_text("mine")
    docs = spark.createDataFrame([("stubs/new.md", "# é\r\nline", 1), ("stubs/old.md", "other", 1), ("a/b/c.md", None, 1), (None, "x", 1),
                                  ("twice.md", "b", 1), ("twice.md", "a", 2)], SCHEMA).repartition(3)
    write_document_files(docs, str(tmp_path))
    want = {"stubs/new.md": "# é\r\nline", "stubs/old.md": "mine", "a/b/c.md": "", "twice.md": "a"}
    assert tree(tmp_path) == want
    write_document_files(docs.withColumn("content", F.lit("again")), str(tmp_path))
    assert tree(tmp_path) == want
    write_document_files(docs.limit(0), str(tmp_path))
    assert tree(tmp_path) == want


def test_a_failing_task_leaves_no_document(spark, tmp_path):
    docs = spark.createDataFrame([(f"d{i}.md", str(i), i) for i in range(20)], SCHEMA)
    bad = docs.withColumn("content", F.when(F.col("more") == 13, F.raise_error(F.lit("lost"))).otherwise(F.col("content")))
    with pytest.raises(Exception, match="lost"):
        write_document_files(bad, str(tmp_path))
    assert tree(tmp_path) == {}
    write_document_files(docs, str(tmp_path))
    assert len(tree(tmp_path)) == 20


@pytest.mark.parametrize("path", ["../out.md", "/tmp/out.md", "a/../../out.md", ""])
def test_paths_stay_below_the_folder(spark, tmp_path, path):
    with pytest.raises(Exception, match="not a path below"):
        write_document_files(spark.createDataFrame([("fine.md", "x", 1), (path, "y", 1)], SCHEMA), str(tmp_path / "root"))
    assert not any("out.md" in p or "fine.md" in p for p in tree(tmp_path))
