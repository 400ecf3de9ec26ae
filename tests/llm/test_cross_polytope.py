import numpy as np
import pytest

from signalmine.llm import cross_polytope as C

SCHEMA = "vec_id long, embedding array<float>, rep string, hash string"
ASKS = "vec_id % 100 = 0"


def brute(rows, k=10):
    rows = [(i, np.array(v, np.float64)) for i, v in rows if i is not None and v is not None and len(v) and None not in v
            and np.isfinite(v).all() and any(v)]
    out = {}
    for q, v in rows:
        if q % 100 == 0:
            near = sorted({(float(np.sqrt(((w - v) ** 2).sum())), i) for i, w in rows if i != q and len(w) == len(v)})
            out.setdefault(q, near[:k])
    return out


def test_rotation_keeps_lengths_and_spreads():
    x = np.eye(48)[:5]
    y = C.rotate(x, 1)
    assert y.shape == (5, 64) and np.allclose(np.linalg.norm(y, axis=1), 1) and np.allclose(y @ y.T, np.eye(5))
    assert abs(y).max() < 0.6
    assert set(C.codes(np.random.default_rng(1).normal(size=(4000, 8)), 0, 1)) == set(range(16))


def recall(got, want):
    return np.mean([len({i for _, i in got.get(q, [])} & {i for _, i in near}) / len(near) for q, near in want.items() if near])


@pytest.mark.parametrize("how", [{}, {"bucket_rows": 4, "block": 40}])
def test_recall_on_the_table(spark, how):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    want = brute([(r.vec_id, r.embedding) for r in table.collect()])
    got = {}
    for r in C.nearest(table, ASKS, **how).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.score, r.vec_id))
    for q in got:
        got[q] = [(s, i) for _, s, i in sorted(got[q])]
        assert got[q] == sorted(got[q]) and len({i for _, i in got[q]}) == len(got[q]) and q not in {i for _, i in got[q]}
    assert recall(got, want) >= 0.9


def test_copies_ties_and_rows_that_take_no_part(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(1, 60)]
    hot = rng.normal(size=6).tolist()
    rows += [(i, hot) for i in range(100, 420)] + [(1000, [1.0, 0.0]), (1001, [2.0, 0.0]), (1002, [0.0, 1.0]), (1003, [-1.0, 0.0])]
    rows += [(500, None), (600, []), (700, [0.0] * 6), (800, [1.0, None] * 3), (900, [float("nan")] * 6),
             (901, [float("inf")] * 6), (None, hot), (2000, [3.0]), (7, rows[7][1]), (8, rows[20][1]), (200, hot)]
    df = spark.createDataFrame([(*r, "", "") for r in rows], SCHEMA)
    # every bucket probed: exact
    got = {}
    for r in C.nearest(df, ASKS, n_probes=64, block=16).collect():
        got.setdefault(r.query_id, []).append((r.rank, round(r.score, 6), r.vec_id))
    single = [(i, np.float32(v).tolist() if v and None not in v else v) for i, v in rows]
    want = {q: [(n, round(s, 6), i) for n, (s, i) in enumerate(near, 1)] for q, near in brute(single).items() if near}
    assert {q: sorted(v) for q, v in got.items()} == want
    assert C.nearest(df.limit(0), ASKS).count() == 0


@pytest.mark.parametrize("split, bucket_rows", [(2, 8), (8, 2), (128, 0.125)])
def test_recall_at_each_split(spark, split, bucket_rows):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    assert C.splits(len(rows), 64, bucket_rows) == split
    got = {}
    for r in C.nearest(table, ASKS, bucket_rows=bucket_rows).collect():
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
    found = recall(got, brute(rows))
    print(f"split {split}: recall {found:.3f}")
    assert found >= 0.9
