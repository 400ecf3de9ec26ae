import os

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from signalmine.llm import hard_negatives
from signalmine.llm.hard_negatives import Index, mined, quantised

SCHEMA = "vec_id long, label int, embedding array<double>"
COLS = "anchor_id positive_id rank negative_id positive_score negative_score".split()


def brute(rows):
    fine = {(i, lab, tuple(int(np.floor(256 * c)) for c in v)) for i, lab, v in rows
            if i is not None and lab is not None and v is not None and all(c is not None and np.isfinite(c) for c in v)}
    out = []
    for a, lab, x in fine:
        if a % 100:
            continue
        score = [(-sum(p * q for p, q in zip(x, y, strict=True)), i, m) for i, m, y in fine if i != a and len(y) == len(x)]
        same = sorted({(s, i) for s, i, m in score if m == lab})[:5]
        for ps, p in same:
            near = sorted({(s, i) for s, i, m in score if m != lab and 30 * -ps <= 100 * -s <= 90 * -ps})[:10]
            out += [(a, p, r, i, -ps, -s) for r, (s, i) in enumerate(near, 1)]
    return sorted(out)


def got(spark, rows, **more):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("x", quantised(F.col("embedding")))
    return sorted(tuple(r[c] for c in COLS) for r in mined(df, F.col("vec_id") % 100 == 0, **more).collect())


def made(seed, n=700, d=24, spread=0.6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, d)) * (np.arange(d, 0, -1) / d)
    x = centres[rng.integers(0, 12, n)] + spread * rng.normal(size=(n, d))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return [(int(i), int(rng.integers(0, 4)), [float(c) for c in np.round(v, 2)]) for i, v in enumerate(x)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK", 128)
    monkeypatch.setattr(hard_negatives, "FIRST_ROWS", 50)
    rows = made(seed)
    assert got(spark, rows) == brute(rows)
    assert got(spark, rows, queries=3) == brute(rows)


def test_nulls_ties_and_repeated_rows(spark):
    rows = made(3, 150, 8)
    rows += rows[:40] + [(1000 + i, 1, rows[100][2]) for i in range(60)]  # copies of an anchor's vector, some anchors
    rows += [(2000, None, [1.0] * 8), (2001, 1, None), (2100, 1, [float("nan")] * 8), (2200, 1, [float("inf")] * 8), (None, 1, [1.0] * 8),
             (2300, 1, [None] + [1.0] * 7), (2400, 2, [0.0] * 8), (2401, 2, [0.0] * 8), (2500, 2, []), (2501, 2, []), (2502, 3, []),
             (2600, 1, [1.0, -2.0]), (2601, 1, [1.0, -1.0]), (2602, 2, [0.5, -1.0]), (200, 2, rows[7][2])]
    assert got(spark, rows) == brute(rows)


def test_empty_and_clashing_columns(spark):
    rows = spark.createDataFrame(made(4, 300, 6), SCHEMA).withColumn("x", quantised(F.col("embedding")))
    more = rows.withColumns({"window": F.lit("w"), "score": F.lit("s"), "asks": F.lit(1), "rank": F.lit(0)})
    anchor = F.col("vec_id") % 100 == 0
    key = lambda df: sorted(map(tuple, df.collect()))
    assert key(mined(more, anchor)) == key(mined(rows, anchor))
    assert mined(rows.limit(0), anchor).count() == 0
    assert mined(rows, F.lit(False)).count() == 0


def test_index_finds_all_pairs_and_prunes():
    """Vectors whose weight lies in a few dimensions: most products are never made."""
    rng = np.random.default_rng(5)
    x = np.floor(256 * rng.normal(size=(2000, 64)) * 0.8 ** np.arange(64)).astype(np.int64)
    q = np.floor(256 * rng.normal(size=(20, 64)) * 0.8 ** np.arange(64)).astype(np.int64)
    index = Index(x)
    least = np.quantile(x @ q.T, 0.995, axis=0)
    rows, which, score = index.joined(*index.arranged(q), least)
    want = {(int(i), int(j), int((x[i] * q[j]).sum())) for i, j in zip(*np.nonzero(x @ q.T >= least), strict=True)}
    assert set(zip(rows.tolist(), which.tolist(), score.tolist(), strict=True)) == want
    assert index.multiplied < 0.5 * x.size * len(q)


def test_oracle(spark, sf_small):
    from signalmine.llm.queries import ORACLES, op13_hard_negatives

    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{os.path.join(sf_small, 'embeddings')}.parquet')")
    want = con.execute(f"SELECT {', '.join(COLS)} FROM ({ORACLES['op13_hard_negatives']})").fetchall()
    assert sorted(tuple(r[c] for c in COLS) for r in op13_hard_negatives(spark, sf_small).collect()) == sorted(want)
    assert want
