"""Exact nearest neighbours over pivot cells, held against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from signalmine.operators import knn

SCHEMA = "doc_id long, embedding array<double>"


def frame(spark, vectors, ids=None):
    return spark.createDataFrame(
        [(i, [float(x) for x in v]) for i, v in zip(ids or range(len(vectors)), vectors, strict=True)], SCHEMA)


def all_pairs(vectors, queries, k, exclude_self=True):
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    v = vectors / np.where(norms == 0, 1, norms)
    out = []
    for q in queries:
        score = np.round(v @ v[q], 9)
        order = sorted((d for d in range(len(v)) if d != q or not exclude_self), key=lambda d: (-score[d], d))[:k]
        out += [(q, d, r + 1) for r, d in enumerate(order)]
    return sorted(out)


def clustered(n, centres, seed):
    rng = np.random.default_rng(seed)
    at = rng.normal(size=(centres, 16))
    return at[rng.integers(0, centres, n)] + rng.normal(scale=0.05, size=(n, 16))


def test_clusters_save_most_pairs(spark):
    v = clustered(6000, 40, 1)
    docs = frame(spark, v).repartition(5)
    queries = docs.where("doc_id % 50 = 0")
    found, visits = knn.searched(docs, queries, 5, cells=60, block_rows=64)
    assert rows(found, "src", "dst", "rank") == all_pairs(v, range(0, 6000, 50), 5)
    assert visits.groupBy("src", "block").count().where("count > 1").isEmpty()
    compared = visits.agg(F.sum("n")).first()[0]
    assert compared < 0.2 * 6000 * 120, compared


@pytest.mark.parametrize("k", [1, 3, 200])
def test_no_clusters_ties_zero_vectors(spark, k):
    rng = np.random.default_rng(3)
    v = rng.integers(-1, 2, size=(150, 4)).astype(float)  # many exact copies, some zero vectors
    assert (np.abs(v).sum(axis=1) == 0).any()
    docs = frame(spark, v).repartition(3)
    found, _ = knn.searched(docs, docs.where("doc_id % 5 = 0"), k, cells=7, block_rows=4)
    assert rows(found, "src", "dst", "rank") == all_pairs(v, range(0, 150, 5), k)


def test_a_hot_cell_is_many_blocks(spark):
    v = np.vstack([np.tile(clustered(1, 1, 5), (300, 1)), clustered(100, 10, 6)])
    docs = frame(spark, v)
    blocks, _ = knn.index(docs, cells=6, block_rows=16)
    assert blocks.agg(F.max("n")).first()[0] <= 16 and blocks.agg(F.sum("n")).first()[0] == 400
    found, _ = knn.searched(docs, docs.where("doc_id % 40 = 0"), 4, cells=6, block_rows=16)
    assert rows(found, "src", "dst", "rank") == all_pairs(v, range(0, 400, 40), 4)


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    docs = spark.createDataFrame(
        [(1, [1.0, 0.0]), (2, [1.0, 0.1]), (3, None), (4, []), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]),
         (None, [1.0, 0.0]), (8, [1.0, 0.0, 0.0]), (9, [1e300, 1e300]), (2, [1.0, 0.1])], SCHEMA)
    got = knn.nearest_documents(docs, docs, 3)
    # document 2 is there twice, as query and as document
    assert rows(got.where("src <> 2"), "src", "dst", "rank") == [
        (1, 2, 1), (1, 2, 2), (1, 9, 3), (9, 1, 3), (9, 2, 1), (9, 2, 2)]
    assert rows(got.where("src = 2").select("dst")) == [(1,), (1,), (9,)]
    other = knn.nearest_documents(docs, docs.where("doc_id = 1"), 1, exclude_self=False)
    assert rows(other, "src", "dst", "score") == [(1, 1, 1.0)]
    assert knn.nearest_documents(docs.limit(0), docs, 3).isEmpty()
    assert knn.nearest_documents(docs, docs.limit(0), 3).isEmpty()
    assert knn.nearest_documents(docs, docs.where("doc_id = 8"), 3).isEmpty()
