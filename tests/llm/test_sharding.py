import random
import zlib
from collections import defaultdict

from signalmine.llm.sharding import sharded

SCHEMA = "doc_id long, text string, slot string, shard string"


def test_shards(spark):
    rng = random.Random(3)
    rows = [(i * 3, "é" * rng.choice([0, 1, 400, 3000]), "", "") for i in range(1500)]
    rows += [(9000 + i, "copy " * 50, "", "") for i in range(700)] + [(8001, None, "", ""), (8002, "x" * 900_000, "", ""),
             (8003, "twice", "", ""), (8003, "twice", "", ""), (None, "no id", "", "")]
    df = spark.createDataFrame(rows, SCHEMA)
    out = sharded(df, bucket_bytes=20_000).collect()
    want = sorted((str(d), len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t, *_ in rows)
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in out) == want
    by = defaultdict(list)
    for r in out:
        assert r.law == "key" and r.grown_shard in (r.shard, 24)
        by[r.shard].append(r)
    assert set(by) == set(range(24))
    for s, rs in by.items():
        assert sorted(r.slot for r in rs) == list(range(len(rs)))
        ids = [r.doc_id or 0 for r in sorted(rs, key=lambda r: r.slot)]
        up = sum(a < b for a, b in zip(ids, ids[1:]))
        assert 0.25 * len(ids) < up < 0.75 * len(ids)
    moved = sum(r.grown_shard == 24 for r in out)
    assert 0.02 < moved / len(out) < 0.07
    again = sharded(df.repartition(5), bucket_bytes=20_000).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))


def test_empty(spark):
    assert sharded(spark.createDataFrame([], SCHEMA)).count() == 0
