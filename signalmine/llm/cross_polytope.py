"""Nearest neighbours by cross-polytope hashing.

A table's hash of a vector: scale it to length 1, turn it by a pseudo-rotation
(three rounds of random signs and a fast Hadamard transform) and name the
nearest signed axis. When there are more vectors than a table has axes times
``BUCKET_ROWS``, a second rotation's first axes split the buckets further. Every
distinct vector goes into one bucket of each of ``TABLES`` tables; a query probes
the ``PROBES`` best buckets of each (times the second split to the power of
``GROWTH``, so that the recall holds at every split).
Candidates are ranked by their exact Euclidean distance to the query.

Vectors travel packed by bucket. Crowded buckets are dealt into blocks of about
``BLOCK`` vectors, by counts that are taken first; each pair of a block of
vectors and a block of queries is a task of its own and returns the best few per
query, so nothing is capped and no group outgrows its task.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalmine.llm.common import stored

TABLES = 8
PROBES = 16
GROWTH = 0.9
BUCKET_ROWS = 4096
BLOCK = 8192
ASKED = 1 << 17         # vectors of queries, probes counted, that are packed at once
SEED = 3


def rotate(unit: np.ndarray, seed: int) -> np.ndarray:
    """Pseudo-rotation of rows, padded to a power of two."""
    n, d = unit.shape
    m = 1 << (d - 1).bit_length() if d > 1 else 1
    x = np.zeros((n, m))
    x[:, :d] = unit
    rng = np.random.default_rng([SEED, seed, m])
    for _ in range(3):
        x *= rng.choice([-1.0, 1.0], m)
        h = 1
        while h < m:
            x = x.reshape(n, -1, 2, h)
            x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], 2).reshape(n, m)
            h *= 2
        x /= math.sqrt(m)
    return x


def _nearness(unit: np.ndarray, table: int, split: int) -> tuple[np.ndarray, np.ndarray | None]:
    """Dot products with the signed axes of the first rotation (2m) and, if
    split > 1, of the second one's first split / 2 axes."""
    first = rotate(unit, 2 * table)
    second = rotate(unit, 2 * table + 1)[:, :split // 2] if split > 1 else None
    both = lambda x: np.concatenate([x, -x], 1)
    return both(first), None if second is None else both(second)


def codes(unit: np.ndarray, table: int, split: int) -> np.ndarray:
    """The bucket of each vector."""
    first, second = _nearness(unit, table, split)
    code = first.argmax(1)
    return code if second is None else code * second.shape[1] + second.argmax(1)


def probes(unit: np.ndarray, table: int, split: int, n: int) -> np.ndarray:
    """The n best buckets of each query (all, if there are fewer)."""
    first, second = _nearness(unit, table, split)
    score = first if second is None else (first[:, :, None] + second[:, None, :]).reshape(len(unit), -1)
    n = min(n, score.shape[1])
    return np.argpartition(-score, n - 1, axis=1)[:, :n]


def splits(n: int, dim: int, bucket_rows: int = BUCKET_ROWS) -> int:
    """Values of the second hash: 1, or a power of two up to twice the axes."""
    axes = 2 * (1 << (dim - 1).bit_length() if dim > 1 else 1)
    want = n / (axes * bucket_rows)
    return 1 if want <= 1 else min(axes, 1 << math.ceil(math.log2(want)))


def probe_count(n_probes: int, split: int) -> int:
    return math.ceil(n_probes * split ** GROWTH)


def _vectors(batch: pa.RecordBatch):
    """(rows, matrix) of an Arrow batch (rep, embedding) for each length."""
    column = batch.column(1)
    flat, offset = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64), np.asarray(column.offsets)
    offset = offset - offset[0]
    length = np.diff(offset)
    for d in np.unique(length):
        rows = np.flatnonzero(length == d)
        yield rows, flat[offset[rows][:, None] + np.arange(d)]


_BLOBS = "key long, n long, first long, dim int, reps binary, vectors binary"


def _hashed(vectors: DataFrame, split_of: dict[int, int], tables: int, n_probes: int) -> DataFrame:
    """Packed by (length, table, bucket): the vectors (n_probes 0) or the queries."""

    def _parts(batch):
        for rows, x in _vectors(batch):
            n = max(1, ASKED // probe_count(n_probes, split_of.get(x.shape[1], 1))) if n_probes else len(rows)
            for lo in range(0, len(rows), n):
                yield rows[lo:lo + n], x[lo:lo + n]

    def run(batches):
        for batch in batches:
            reps = batch.column(0).to_numpy()
            out, held = [], 0
            for rows, x in _parts(batch):
                d = x.shape[1]
                split = split_of.get(d, 1)
                unit = x / np.linalg.norm(x, axis=1, keepdims=True)
                for t in range(tables):
                    got = (probes(unit, t, split, probe_count(n_probes, split)) if n_probes
                           else codes(unit, t, split)[:, None])
                    code, at = got.ravel(), np.repeat(np.arange(len(rows)), got.shape[1])
                    order = np.argsort(code, kind="stable")
                    code, at = code[order], at[order]
                    start = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
                    for lo, hi in zip(start, np.append(start[1:], len(code)), strict=True):
                        ids = reps[rows[at[lo:hi]]]
                        out.append(((d * tables + t) << 40 | int(code[lo]), hi - lo, int(ids[0]), d, ids.tobytes(),
                                    x[at[lo:hi]].tobytes()))
                    held += len(code)
                    if len(out) > 4096 or held >= ASKED:
                        yield pa.RecordBatch.from_pandas(pd.DataFrame(out, columns=_names), preserve_index=False)
                        out, held = [], 0
            if out:
                yield pa.RecordBatch.from_pandas(pd.DataFrame(out, columns=_names), preserve_index=False)

    _names = ["key", "n", "first", "dim", "reps", "vectors"]

    def typed(batches):
        schema = pa.schema([("key", pa.int64()), ("n", pa.int64()), ("first", pa.int64()), ("dim", pa.int32()),
                            ("reps", pa.binary()), ("vectors", pa.binary())])
        for batch in run(batches):
            yield batch.cast(schema)

    return vectors.select("rep", "embedding").mapInArrow(typed, _BLOBS)


def _best(dist: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k smallest by (distance, id)."""
    if len(dist) > k:
        edge = np.partition(dist, k - 1)[k - 1]
        some = np.flatnonzero(dist <= edge)
    else:
        some = np.arange(len(dist))
    return some[np.lexsort((ids[some], dist[some]))[:k]]


def _ranked(k: int):
    def run(key, vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(vectors) and len(queries):
            d = int(vectors["dim"].iloc[0])
            ids = np.frombuffer(b"".join(vectors["reps"]), np.int64)
            x = np.frombuffer(b"".join(vectors["vectors"]), np.float64).reshape(-1, d)
            asks = np.frombuffer(b"".join(queries["reps"]), np.int64)
            y = np.frombuffer(b"".join(queries["vectors"]), np.float64).reshape(-1, d)
            for q, v in zip(asks.tolist(), y, strict=True):
                dist = np.sqrt(((x - v) ** 2).sum(1))
                dist[ids == q] = np.inf
                top = _best(dist, ids, k)
                top = top[np.isfinite(dist[top])]
                out.append((q, ids[top].tobytes(), dist[top].tobytes()))
        return pd.DataFrame(out, columns=["query", "reps", "dists"])

    return run


def nearest(vectors: DataFrame, is_query: Column | str, k: int = 10, tables: int = TABLES, n_probes: int = PROBES,
            bucket_rows: int = BUCKET_ROWS, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each row that
    ``is_query`` (a condition on vec_id and embedding), by Euclidean distance,
    ties to the smaller vec_id; fewer if fewer are found.

    Rows take no part if their vec_id is null or their vector is null, empty,
    zero or holds a null or non-finite component. Vectors are compared with those
    of the same length. A repeated row counts once; a row is no neighbour of
    another with its vec_id. Equal vectors are hashed once, and each keeps the
    k + 1 smallest ids, which is all that a result can hold.
    """
    x = F.transform("embedding", lambda c: c.cast("double"))
    fine = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    rows = (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("embedding"), (F.expr(is_query) if isinstance(is_query, str) else is_query).alias("asks"))
            .where("vec_id is not null and embedding is not null")
            .where(F.forall("embedding", fine) & F.exists("embedding", lambda c: c != 0)))
    rank = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    once = rows.groupBy("vec_id", "embedding").agg(F.max("asks").alias("asks"))
    alike = stored(once.withColumn("rank", rank).where(F.col("rank") <= k + 1).groupBy("embedding").agg(
        F.array_sort(F.collect_list("vec_id")).alias("ids")).withColumn("rep", F.col("ids")[0])
        .withColumn("hash", F.xxhash64("embedding")), "vectors")
    asking = once.where("asks").select("vec_id", "embedding", F.xxhash64("embedding").alias("hash"))
    asking = stored(asking.join(alike.drop("ids"), ["hash", "embedding"]).select("vec_id", "embedding", "rep"), "queries")
    # rep: the smallest id of the vector's rows; two vectors may share it if an id repeats, so name vectors anew
    alike = stored(alike.withColumn("rep", F.xxhash64("embedding", "rep")), "vectors")
    asking = asking.withColumn("rep", F.xxhash64("embedding", "rep"))
    sizes = {r.d: r["count"] for r in alike.groupBy(F.size("embedding").alias("d")).count().collect()}  # a row per length
    split_of = {d: splits(n, d, bucket_rows) for d, n in sizes.items()}

    index = _hashed(alike, split_of, tables, 0)
    asked = _hashed(asking.select("rep", "embedding").dropDuplicates(["rep"]), split_of, tables, n_probes)
    part = lambda df, name: df.groupBy("key").agg(F.ceil(F.sum("n") / block).cast("int").alias(name))
    counts = stored(part(index, "vb").join(part(asked, "qb"), "key"), "buckets")
    spread = lambda n: F.pmod(F.xxhash64("first", "reps"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    blobs = ["n", "first", "dim", "reps", "vectors"]
    index = index.join(counts, "key").select(F.col("key").alias("key"), *blobs, spread("vb").alias("v"), every("qb").alias("q"))
    asked = asked.join(counts, "key").select(F.col("key").alias("key"), *blobs, spread("qb").alias("q"), every("vb").alias("v"))
    found = (index.groupBy("key", "v", "q").cogroup(asked.groupBy("key", "v", "q"))
             .applyInPandas(_ranked(k + 1), "query long, reps binary, dists binary"))

    def merged(key, got: pd.DataFrame) -> pd.DataFrame:
        ids = np.frombuffer(b"".join(got["reps"]), np.int64)
        dist = np.frombuffer(b"".join(got["dists"]), np.float64)
        ids, at = np.unique(ids, return_index=True)
        top = _best(dist[at], ids, len(at))
        return pd.DataFrame({"query": key[0], "rep": ids[top], "score": dist[at][top]})

    near = found.groupBy("query").applyInPandas(merged, "query long, rep long, score double")
    own = asking.select(F.col("rep").alias("query"), "rep", F.lit(0.0).alias("score")).distinct()
    near = near.unionByName(own).join(alike.select("rep", "ids"), "rep")
    near = near.select("query", "score", F.explode("ids").alias("near_id"))
    order = Window.partitionBy("query").orderBy("score", "near_id")
    near = near.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1).drop("r")
    pairs = asking.select(F.col("vec_id").alias("query_id"), F.col("rep").alias("query")).join(near, "query")
    order = Window.partitionBy("query_id", "query").orderBy("score", "near_id")
    pairs = pairs.where("near_id <> query_id").withColumn("rank", F.row_number().over(order))
    return pairs.where(F.col("rank") <= k).select("query_id", "rank", F.col("near_id").alias("vec_id"), "score")
