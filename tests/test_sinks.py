"""Updates that rewrite only what they touch; ordered files of any size."""

import json
import os
import tempfile
from datetime import datetime

from pyspark.sql import functions as F

from conftest import rows
from signalmine.operators import updates as up
from signalmine.sources import sinks

AS_OF = "2024-02-01 00:00:00"


def _files(d):
    return {os.path.relpath(os.path.join(at, f), d): os.stat(os.path.join(at, f)).st_ino
            for at, _, names in os.walk(d) for f in names if f.endswith(".parquet")}


def test_only_touched_partitions_get_new_files(spark):
    d = tempfile.mkdtemp(prefix="sm-test-") + "/misses"
    misses = spark.createDataFrame(
        [(i, f"q{i}", i % 10 >= 2, datetime(2024, 1, 28 + i % 4, 12), f"2024-01-{28 + i % 4}" if i % 4 else None) for i in range(80)],
        "id long, query string, resolved boolean, created_at timestamp_ntz, day string")
    misses.repartition("day").write.partitionBy("day").parquet(d)
    table = spark.read.schema(misses.schema).parquet(d)
    before, old = _files(d), rows(table, "id", "query", "resolved")
    # rows of one day, and of the partition without a day
    updated = table.withColumn("changed", F.col("created_at") < "2024-01-30").withColumn(
        "changed", F.when(F.col("id") == 3, None).otherwise(F.col("changed"))).withColumn(
        "resolved", F.coalesce("changed", F.lit(False)) | F.col("resolved"))
    want = rows(updated, "id", "query", "resolved")
    assert want != old
    sinks.write_changes(updated, d, "day")
    after = _files(d)
    kept = {f for f in before if after.get(f) == before[f]}
    assert {f.split("/")[0] for f in kept} == {"day=2024-01-30", "day=2024-01-31"}
    assert {f.split("/")[0] for f in set(before) - kept} == {"day=2024-01-29", "day=__HIVE_DEFAULT_PARTITION__"}
    again = spark.read.schema(misses.schema).parquet(d)
    assert rows(again, "id", "query", "resolved") == want
    sinks.write_changes(again.withColumn("changed", F.lit(False)), d, "day")
    assert _files(d) == after


def test_close_duplicates_written_back(spark):
    d = tempfile.mkdtemp(prefix="sm-test-") + "/items"
    items = spark.createDataFrame(
        [(i, "s", f"lesson {i if day == 1 else i % 3}", False, None, f"2024-01-0{day}")
         for day in (1, 2) for i in range(10 * day, 10 * day + 10)],
        "id long, source string, lesson string, applied boolean, applied_at timestamp_ntz, day string")
    items.write.partitionBy("day").parquet(d)
    table = spark.read.schema(items.schema).parquet(d)
    before, closed = _files(d), up.close_duplicates(table, AS_OF)
    want = rows(closed, "id", "applied")
    sinks.write_changes(closed, d, "day")
    assert rows(spark.read.schema(items.schema).parquet(d), "id", "applied") == want and sum(a for _, a in want) == 7
    assert {f.split("/")[0] for f in before if f not in _files(d)} == {"day=2024-01-02"}


def test_ordered_files(spark):
    d = tempfile.mkdtemp(prefix="sm-test-")
    n = 5000
    found = spark.range(n).select((F.col("id") * 7919 % n).alias("rank"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("v"),
                                  F.concat(F.lit("line "), F.col("id") * 7919 % n).alias("line")).repartition(7)
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # small parts would be joined to one
    try:
        sinks.write_staging_sections({"misses": (found, ["rank"]), "none": (found.limit(0), ["rank"])}, f"{d}/staging")
        sinks.write_ordered(found, ["rank"], f"{d}/report", "text")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)

    def lines(folder):
        names = sorted(f for f in os.listdir(folder) if f.startswith("part-"))
        return len(names), [x for f in names for x in open(os.path.join(folder, f)).read().splitlines()]

    parts, got = lines(f"{d}/staging/section=misses")
    got = [json.loads(x) for x in got]
    assert parts > 1 and [r["rank"] for r in got] == list(range(n)) and all("v" in r for r in got)
    assert lines(f"{d}/staging/section=none")[1] == []
    assert lines(f"{d}/report")[1] == [f"line {i}" for i in range(n)]
