"""The search for found misses at size: shelves, slices, single precision."""

from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import rows
from test_knn import all_pairs, frame
from signalmine.operators import knn
from signalmine.plans import jobs


def test_queries_meet_shelves_not_blocks(spark):
    v = np.random.default_rng(1).normal(size=(2000, 8))
    docs = frame(spark, v)
    blocks, idx = knn.index(docs, cells=5, block_rows=16)
    shelves = blocks.where("vectors is not null").count()
    assert blocks.count() > 120 and shelves == 1  # all vectors are read in one row
    packs = knn._packs(docs.where("doc_id % 20 = 0"), idx).withColumn("q_least", F.lit(None).cast("binary"))
    near = knn._compared(knn._routed(packs, idx, 40), blocks, idx, 40, True)
    assert near.groupBy("src").count().where("count > 40").isEmpty()  # of a shelf, not of each of three blocks
    found = knn.nearest_documents(docs, docs.where("doc_id % 20 = 0"), 3)
    assert rows(found, "src", "dst", "rank") == all_pairs(v, range(0, 2000, 20), 3)


@pytest.mark.parametrize("kind", ["double", "float"])
def test_scores_closer_than_single_precision(spark, kind):
    rng = np.random.default_rng(2)
    v = rng.normal(size=12) + rng.normal(scale=3e-5, size=(400, 12))  # scores differ from the 9th digit on
    v = np.vstack([v, v[:40], rng.normal(size=(100, 12))]).astype(np.float32 if kind == "float" else float).astype(float)
    docs = frame(spark, v).withColumn("embedding", F.col("embedding").cast(f"array<{kind}>"))
    found = knn.nearest_documents(docs, docs.where("doc_id % 9 = 0"), 4)
    assert rows(found, "src", "dst", "rank") == all_pairs(v, range(0, 540, 9), 4)


@pytest.mark.parametrize("k", [1, 6])
def test_slices_and_tiles(monkeypatch, k):
    monkeypatch.setattr(knn, "SLICE_ROWS", 7)
    monkeypatch.setattr(knn, "TILE_ROWS", 3)
    monkeypatch.setattr(knn, "PART_BYTES", 2000)
    v = np.random.default_rng(4).integers(-2, 3, size=(90, 5)).astype(float)
    pivots = {5: np.unique(knn._unit(v[:4], 0), axis=0)}
    apart = knn._distance(knn._unit(v, 0), pivots[5])
    docs = pd.DataFrame({"doc_id": range(90), "dim": 5, "embedding": list(v), "cell": apart.argmin(axis=1),
                         "dist": apart.min(axis=1)}).sort_values(["cell", "dist", "doc_id"])
    blocks = pd.concat(knn._rings(8)(iter([docs])), ignore_index=True)
    blocks = blocks.assign(block=range(len(blocks)), first=blocks["vectors"].notnull())
    assert 1 < blocks["first"].sum() < len(blocks)
    idx = knn.Index(pivots, blocks)
    pack = next(knn._pack(iter([docs]))).assign(pack=0, q_least=None)
    shelves = blocks.loc[blocks["first"], ["block", "ids", "vectors"]]

    def found(pack):
        return pd.concat(knn._scored(idx, k, True)(iter([pack.merge(shelves, how="cross")])))

    near = found(pack)
    reach = np.full(90, np.nan)
    for at, part in near.groupby("at"):
        if len(part) >= k:
            reach[at] = part["score"].nlargest(k).min()
    both = pd.concat([near, found(pack.assign(q_least=[reach.tobytes()]))])
    assert not both.duplicated(["src", "dst"]).any()
    both = both.sort_values(["src", "score", "dst"], ascending=[True, False, True])
    both["rank"] = both.groupby("src").cumcount() + 1
    got = both[both["rank"] <= k]
    assert sorted(zip(got["src"], got["dst"], got["rank"], strict=True)) == all_pairs(v, range(90), k)


def test_gap_filler_derives_its_vectors_once(spark):
    rng = np.random.default_rng(6)
    v, d = rng.normal(size=(300, 6)), rng.normal(size=(6, 6))
    query = [f"how to {i % 120:03d}." for i in range(300)]
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for pdf in batches:
            read.add(len(pdf))
            yield pdf

    vectors = frame(spark, v).withColumnRenamed("doc_id", "id").mapInPandas(counted, "id long, embedding array<double>")
    misses = spark.createDataFrame([(i, q, False) for i, q in enumerate(query)], "id long, query string, resolved boolean")
    _, out = jobs.gap_filler_job(misses.withColumn("created_at", F.current_timestamp()), vectors, frame(spark, d))
    best = ((v / np.linalg.norm(v, axis=1, keepdims=True)) @ (d / np.linalg.norm(d, axis=1, keepdims=True)).T).max(axis=1)
    assert 50 < (best > 0.6).sum() < 250
    left = Counter(q for q, score in zip(query, best, strict=True) if score <= 0.6)
    want = ["rag-filler-found" if s > 0.6 else "rag-filler-stub" if left[q] > 1 else None for q, s in zip(query, best, strict=True)]
    assert {r.id: r.resolved_by for r in out.collect()} == dict(enumerate(want))
    assert read.value == 300
