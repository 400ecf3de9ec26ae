"""Hard negatives by threshold joins in the manner of L2AP.

A row's score is its integer inner product with an anchor. An anchor's positives
are the best rows of its own label; for each positive, the hard negatives are the
best rows of other labels whose score lies in a window below the positive's.

Vectors come in blocks. A block orders the dimensions by weight and indexes of each
vector only the leading ones: what is left out has a norm so small that no query
reaches its threshold by that alone. For a batch of queries the partial scores
are accumulated over the index; a pair goes as soon as its partial score and the
product of the remaining norms stay below the threshold; the survivors get their
exact scores. Thresholds start high and fall until the windows of a query are
full or the window's lower end is reached, so every pair that belongs in a window
is found.

Anchors are a stated query set: they are broadcast in blocks of ``QUERIES`` and meet
all rows. A share of the rows is searched first; the scores at which its windows
are full are valid thresholds for all other rows, so that these send little.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalmine.llm.common import stored

QUERIES = 8192          # anchors that are broadcast at once
QUERY_BATCH = 128       # and of these, searched at once
BLOCK = 8192            # vectors of one index
CHUNK = 8               # dimensions that are accumulated at once
FIRST_SHARE = 64        # one row in so many is searched first, and
FIRST_ROWS = 4096       # about so many at least
LEVELS = (0.9, 0.6, 0.4, 0.25, 0.1)  # thresholds, as shares of the highest score that can count
FEW = 0.125             # share of pairs alive from which they are finished one by one
LARGEST = 1 << 26       # of components: sums of 2**11 products fit in a long
ANY = 1 << 62           # beyond all scores


# ------------------------------------------------------------------------ index

class Index:
    """A block of vectors (integers) with the dimensions in order of weight."""

    def __init__(self, x: np.ndarray):
        self.order = np.argsort(-(x.astype(float) ** 2).sum(0), kind="stable")
        self.cuts = [*range(0, max(1, x.shape[1]), CHUNK), x.shape[1]]
        self.x, self.norms = self.arranged(x)
        self.multiplied = 0  # products made, of len(x) * queries * dimensions

    def arranged(self, x: np.ndarray):
        """Vectors with their dimensions in order, and the norms from each cut on (a
        little too large, so that rounding never prunes)."""
        large = x.size and float(np.abs(x).max()) ** 2 * x.shape[1] >= 2.0**53
        x = x[:, self.order].astype(np.int64 if large else np.float64)
        squares = np.cumsum((x[:, ::-1].astype(float) ** 2), 1)[:, ::-1]
        norms = np.sqrt(np.concatenate([squares, np.zeros((len(x), 1))], 1))[:, self.cuts]
        return x, norms * (1 + 1e-9)

    def joined(self, queries: np.ndarray, norms: np.ndarray, least: np.ndarray):
        """(vector, query, score) of all pairs with a score of at least the query's ``least``."""
        none = np.zeros(0, np.int64)
        if not len(queries) or not len(self.x):
            return none, none, none
        bound = self.norms * norms.max(0)
        indexed = (bound[:, :-1] >= max(0.0, float(least.min()))).sum(1)  # cuts to index: beyond, no query's threshold is near
        if least.min() <= 0:
            indexed[:] = len(self.cuts) - 1
        rows = np.argsort(-indexed, kind="stable")
        indexed = indexed[rows]
        rows, indexed = rows[indexed > 0], indexed[indexed > 0]
        if not len(rows):
            return none, none, none
        x, norm = self.x[rows], self.norms[rows]
        a = np.zeros((len(rows), len(queries)), np.result_type(x, queries))
        done = np.zeros(len(rows), np.int64)
        alive = None
        for g, (lo, hi) in enumerate(zip(self.cuts, self.cuts[1:], strict=False)):
            n = int(np.searchsorted(-indexed, -g, "left"))  # vectors whose index holds this chunk
            if not n:
                break
            a[:n] += x[:n, lo:hi] @ queries[:, lo:hi].T
            self.multiplied += n * len(queries) * (hi - lo)
            done[:n] = g + 1
            if 4 * (g + 1) % (len(self.cuts) - 1) < 4 and g + 2 < len(self.cuts):  # at the quarters
                alive = a + norm[np.arange(len(rows)), done][:, None] * norms[:, g + 1] >= least
                if alive.mean() < FEW:
                    break
        rest = norm[np.arange(len(rows)), done][:, None] * norms[:, done].T
        i, q = np.nonzero(a + rest >= least)
        score = a[i, q]
        part = done[i] < len(self.cuts) - 1
        if part.any():
            for g in np.unique(done[i[part]]):
                some = np.flatnonzero(part & (done[i] == g))
                for at in np.array_split(some, len(some) * x.shape[1] // (1 << 22) + 1):
                    lo = self.cuts[g]
                    score[at] += (x[i[at], lo:] * queries[q[at], lo:]).sum(1)
                    self.multiplied += len(at) * (x.shape[1] - lo)
        good = score >= least[q]
        return rows[i[good]], q[good], np.rint(score[good]).astype(np.int64)


def _best(score: np.ndarray, ids: np.ndarray, k: int):
    """The k first by falling score, then id; the same id with the same score counts once."""
    order = np.lexsort((ids, -score))
    score, ids = score[order], ids[order]
    once = np.concatenate([[True], (score[1:] != score[:-1]) | (ids[1:] != ids[:-1])]) if len(ids) else order
    return score[once][:k], ids[once][:k]


class Search:
    """The windows of a block of anchors while vectors pass by. asked: ids, labels, x
    (one matrix per vector length with the places it holds), windows (anchor, low, high,
    floor: a score that the window's last row has at least). same: windows are over
    rows of the anchor's label, else over those of others; each holds its k best."""

    def __init__(self, asked: dict, k: int, same: bool):
        self.asked, self.k, self.same = asked, k, same
        w = asked["windows"]
        self.of = {}
        for i, a in enumerate(w["anchor"]):
            self.of.setdefault(int(a), []).append(i)
        self.low, self.high = w["low"], w["high"]
        self.goal = np.maximum(w["low"], w["floor"])  # scores below it aren't wanted
        self.held = {}

    def add(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray) -> None:
        """Search a block of vectors of one length."""
        for places, queries in self.asked["x"]:
            if queries.shape[1] != x.shape[1]:
                continue
            index = Index(x)
            wanted = np.array([i for i, p in enumerate(places) if int(p) in self.of], np.int64)
            for lo in range(0, len(wanted), QUERY_BATCH):
                at = wanted[lo:lo + QUERY_BATCH]
                self._batch(index, ids, labels, places[at], *index.arranged(queries[at]))

    def _batch(self, index: Index, ids, labels, places, queries, norms) -> None:
        top = float(index.norms[:, 0].max()) * norms[:, 0]
        high = np.array([max(self.high[w] for w in self.of[int(p)]) for p in places])
        start, level = np.minimum(top, high), 0
        left = np.arange(len(places))
        while len(left):
            goal = np.array([min(self.goal[w] for w in self.of[int(places[i])]) for i in left], float)
            fall = start[left] * LEVELS[level] if level < len(LEVELS) else np.full(len(left), -np.inf)
            least = np.where(fall > goal, fall, goal)
            rows, which, score = index.joined(queries[left], norms[left], least)
            cut = np.searchsorted(which, np.arange(len(left) + 1), sorter=(order := np.argsort(which, kind="stable")))
            open_ = []
            for j, i in enumerate(left):
                some = order[cut[j]:cut[j + 1]]
                if not self._filled(int(places[i]), ids, labels, rows[some], score[some], least[j]):
                    open_.append(i)
            left, level = np.array(open_, np.int64), level + 1

    def _filled(self, place: int, ids, labels, rows, score, least: float) -> bool:
        """Put what was found into the anchor's windows, if ``least`` is low enough for all."""
        a, label = self.asked["ids"][place], self.asked["labels"][place]
        fits = ((labels[rows] == label) == self.same) & (ids[rows] != a)
        near, score = ids[rows[fits]], score[fits]
        got = {}
        for w in self.of[place]:
            mine = (score >= self.low[w]) & (score <= self.high[w])
            s, n = self.held.get(w, (score[:0], near[:0]))
            got[w] = _best(np.concatenate([s, score[mine]]), np.concatenate([n, near[mine]]), self.k)
        full = all(least <= max(self.goal[w], got[w][0][-1] if len(got[w][0]) == self.k else -ANY) for w in got)
        if full:
            self.held |= got
            for w, (s, _) in got.items():
                if len(s) == self.k:
                    self.goal[w] = max(self.goal[w], s[-1])
        return full


# ------------------------------------------------------------------------ Spark

def _matrices(batch: pa.RecordBatch):
    """(rows, matrix) of an Arrow batch (vec_id, label, x) for each vector length."""
    column = batch.column(2)
    flat, offset = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.asarray(column.offsets)
    offset = offset - offset[0]
    length = np.diff(offset)
    for d in np.unique(length):
        rows = np.flatnonzero(length == d)
        yield rows, flat[offset[rows][:, None] + np.arange(d)]


def _searched(rows: DataFrame, asked: dict, k: int, same: bool) -> DataFrame:
    """(window, near_id, score): the k best of each window in each part of ``rows``."""
    shared = rows.sparkSession.sparkContext.broadcast(asked)  # QUERIES anchors at most

    def run(batches):
        search, waiting = Search(shared.value, k, same), {}

        def flush(d):
            ids, labels, x = zip(*waiting.pop(d), strict=True)
            search.add(np.concatenate(ids), np.concatenate(labels), np.concatenate(x))

        for batch in batches:
            ids, labels = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for some, x in _matrices(batch):
                d = x.shape[1]
                waiting.setdefault(d, []).append((ids[some], labels[some], x))
                if sum(len(p[0]) for p in waiting[d]) >= BLOCK:
                    flush(d)
        for d in list(waiting):
            flush(d)
        if search.held:
            w = np.repeat(list(search.held), [len(s) for s, _ in search.held.values()])
            s, n = (np.concatenate(v) for v in zip(*search.held.values(), strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(w.astype(np.int64)), pa.array(n.astype(np.int64)), pa.array(s)],
                                             ["window", "near_id", "score"])

    return rows.select("vec_id", "label", "x").mapInArrow(run, "window long, near_id long, score long")


def _first(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("window").orderBy(F.desc("score"), "near_id")
    return found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _windows(rows: DataFrame, asked: dict, k: int, same: bool, share: Column) -> DataFrame:
    """The k best of each window among all rows: those of the first share, then, with
    what fills their windows as floors, those of the others."""
    first = stored(_first(_searched(rows.where(share), asked, k, same), k), "first-share")
    full = first.where(F.col("rank") == k).select("window", "score").toPandas()  # a row per window of the block at most
    floor = asked["windows"]["floor"].copy()
    floor[full["window"].to_numpy(np.int64)] = full["score"].to_numpy(np.int64)
    asked = asked | {"windows": asked["windows"] | {"floor": floor}}
    rest = _searched(rows.where(~share), asked, k, same)
    return stored(_first(first.drop("rank").unionByName(rest), k), "windows")


def mined(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
          queries: int = QUERIES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score from
    ``vectors`` (vec_id, label, x: an array of integers): for each row that ``is_anchor``
    (a condition on vec_id and label), its ``positives`` best other rows of its label and for
    each of these the ``negatives`` best rows of other labels whose score is ``low`` to
    ``high`` percent of the positive's. Ties go to the smaller vec_id.

    Rows with a null vec_id, label, vector or component take no part, nor do those with a
    component beyond 2**26, whose scores might not fit in a long. Vectors are compared
    with those of the same length. A repeated row counts once, and a row is no partner
    of another with its vec_id. A positive with a negative score has an empty window.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                          F.col("x").cast("array<long>").alias("x"), is_anchor.alias("asks"))
    rows = rows.where("vec_id is not null and label is not null and x is not null").where(
        F.forall("x", lambda c: c.isNotNull() & (F.abs(c) <= LARGEST)))
    rows = stored(rows, "vectors")
    anchors = stored(rows.where("asks").select("vec_id", "label", "x").distinct(), "anchors")
    n, n_anchors = rows.count(), anchors.count()
    part = max(1 / FIRST_SHARE, min(1.0, FIRST_ROWS / n)) if n else 1.0
    share = F.pmod(F.xxhash64("vec_id", F.lit("first")), F.lit(1 << 20)) < int(part * (1 << 20))
    n_blocks = max(1, -(-n_anchors // queries))
    out = None
    for i in range(n_blocks):
        mine = anchors.where(F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)) == i).toPandas()  # about QUERIES rows
        mine = mine.sort_values(["vec_id", "label"], kind="stable")
        ids, labels = mine["vec_id"].to_numpy(np.int64), mine["label"].to_numpy(np.int64)
        length = np.array([len(v) for v in mine["x"]], np.int64)
        x = [(p, np.array([np.asarray(mine["x"].iloc[j], np.int64) for j in p]).reshape(len(p), d))
             for d in np.unique(length) if len(p := np.flatnonzero(length == d))]
        every = np.arange(len(mine))
        asked = {"ids": ids, "labels": labels, "x": x, "windows": {
            "anchor": every, "low": np.full(len(mine), -ANY), "high": np.full(len(mine), ANY), "floor": np.full(len(mine), -ANY)}}
        best = _windows(rows, asked, positives, True, share).toPandas().sort_values(["window", "rank"])
        a, p = best["window"].to_numpy(np.int64), best["score"].to_numpy(np.int64)
        lo, hi = -(-low * p // 100), high * p // 100
        some = np.flatnonzero(lo <= hi)
        asked["windows"] = {"anchor": a[some], "low": lo[some], "high": hi[some], "floor": np.full(len(some), -ANY)}
        named = pd.DataFrame({"window": np.arange(len(some)), "anchor_id": ids[a[some]],
                              "positive_id": best["near_id"].to_numpy(np.int64)[some], "positive_score": p[some]})
        names = spark.createDataFrame(named, "window long, anchor_id long, positive_id long, positive_score long")
        hard = _windows(rows, asked, negatives, False, share).join(names, "window").select(
            "anchor_id", "positive_id", "rank", F.col("near_id").alias("negative_id"), "positive_score",
            F.col("score").alias("negative_score"))
        hard = stored(hard, "negatives")
        out = hard if out is None else out.unionByName(hard)
    return out


def quantised(embedding: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component (null: a null or non-finite component)."""
    def one(c):
        x = c.cast("double")
        fine = x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= LARGEST / scale)
        return F.when(fine, F.floor(x * scale).cast("long"))
    return F.transform(embedding, one)
