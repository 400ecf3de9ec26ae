"""Exact cosine nearest neighbours over pivot (Voronoi) cells.

On unit vectors the cosine is a distance, ``sqrt(2 - 2 cos)``, so the triangle
inequality tells which parts of the corpus can't hold a neighbour:

1. pivots are documents picked by the hash of their id, one for every
   ``CELL_ROWS`` documents; each document belongs to its nearest pivot;
2. documents are sorted by (cell, distance to the pivot) over range partitions,
   so a cell with a third of all documents lies in many tasks, and packed into
   blocks that are rings of a cell: all their distances lie in ``[lo, hi]``; the
   blocks of a partition stand on shelves of about ``PART_BYTES``, a row each;
3. queries that lie close together form packs of about ``PACK_BYTES``, written with
   their blocks of step 4 and once more with the scores of it;
4. every query is compared with the blocks of least bound until they hold ``k``
   documents, which gives it a score to reach;
5. it is then compared with the other blocks whose bound allows that score, and
   with no more.

Packs meet shelves in a Cartesian product that reads both where they were written:
what is written grows with the queries and the documents, not with the pairs
compared, and nothing is broadcast (no plan knows how large packs and shelves are).
A pack and a shelf are large, so that a task compares far longer than it reads.
They are compared in single precision, tile by tile; what comes to a query's least
score within the rounding error of that is computed again in double precision, so
no score or order rests on the single one. A task returns a query's best ``k`` of a
shelf, not of each block.

The bounds only save work: the result is that of comparing all pairs. Vectors
without clusters save little; then it costs what all pairs cost. What tasks hold
of the index is the pivots (at most ``MAX_CELLS`` a vector length) and a row of
numbers per block: blocks grow with the corpus once there are ``MAX_BLOCKS``.
Scores are rounded to 9 decimals before ordering so that exact copies tie and
the tie-break (lower doc id) decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signalmine.session import materialize

CELL_ROWS = 4096
MAX_CELLS = 1024
BLOCK_ROWS = 1024
MAX_BLOCKS = 1 << 18
PACK_BYTES = 1 << 25     # of the vectors of a pack, at most
PART_BYTES = 1 << 24     # of the vectors of the blocks on a shelf
SLICE_ROWS = 8192     # queries of a pack whose bounds are held at once,
HELD = 1 << 22     # and the best documents of these, at most
TILE_ROWS = 512     # queries compared with a block at once
ROUTE_ROWS = 64     # queries whose bounds to all blocks are held at once
PACK_ROWS = 256     # queries that are worth a task
SCORE_DIGITS = 9
SLACK = 1e-7        # more than the rounding errors of distances
_PART = 33          # monotonically_increasing_id: the partition's number is above these bits


def _rows(vectors) -> np.ndarray:
    """Vectors as they are kept: single precision stays single."""
    m = np.concatenate(list(vectors)).reshape(len(vectors), -1)
    return m if m.dtype == np.float32 else m.astype(np.float64)


def _read(kept: bytes, n: int, dim: int) -> np.ndarray:
    return np.frombuffer(kept, np.dtype(f"f{len(kept) // (n * dim)}")).reshape(n, dim)


def _unit(vectors, spare: int) -> np.ndarray:
    """Unit vectors with two more components. A zero vector lies on one of these
    (``spare``: 0 for documents, 1 for queries), so that all its scores are 0."""
    m = vectors if isinstance(vectors, np.ndarray) and vectors.ndim == 2 else _rows(vectors)
    m = m.astype(np.float64)
    top = np.abs(m).max(axis=1, keepdims=True)
    m = m / np.where(top == 0, 1.0, top)
    norms = np.linalg.norm(m, axis=1, keepdims=True)
    m = np.hstack([m / np.where(norms == 0, 1.0, norms), np.zeros((len(m), 2))])
    m[top[:, 0] == 0, -2 + spare] = 1.0
    return m


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (a @ b.T)))


def _usable(docs: DataFrame) -> DataFrame:
    """(doc_id, dim, embedding) of the rows with an id and a finite vector."""
    def finite(x):
        return x.isNotNull() & (F.abs(x.cast("double")) < F.lit(float("inf")))

    return docs.filter(F.col("doc_id").isNotNull() & (F.size("embedding") > 0) & F.forall("embedding", finite)).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.size("embedding").alias("dim"), "embedding")


def _vector_type(docs: DataFrame) -> str:
    return docs.schema["embedding"].dataType.simpleString()


def _pivots(docs: DataFrame, cells: int | None) -> tuple[dict[int, np.ndarray], dict[int, int]]:
    """(vector length -> its pivots, vector length -> number of documents)."""
    counts = {r.dim: r.n for r in docs.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}
    wanted = {dim: cells or min(MAX_CELLS, -(-n // CELL_ROWS)) for dim, n in counts.items()}
    w = Window.partitionBy("dim").orderBy(F.xxhash64("doc_id"), "doc_id")
    picked = (docs.withColumn("at", F.row_number().over(w)).filter(F.col("at") <= max(wanted.values(), default=0))
              .orderBy("dim", "at").toPandas())
    return {int(dim): np.unique(_unit(part["embedding"][:wanted[dim]], 0), axis=0)
            for dim, part in picked.groupby("dim")}, counts


def _assigned(pivots: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim in sorted(set(batch["dim"].to_pylist()) & set(pivots)):
                part = batch.filter(pc.equal(batch["dim"], dim))
                vectors = part["embedding"].flatten().to_numpy(zero_copy_only=False).reshape(len(part), dim)
                apart = _distance(_unit(vectors, 0), pivots[dim])
                cell = apart.argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(cell, pa.int32()), pa.array(apart[np.arange(len(cell)), cell])],
                    names=[*part.schema.names, "cell", "dist"])
    return run


def _rings(block_rows: int):
    """Sorted rows packed into blocks of one cell, and these into shelves of one
    vector length: the row of a shelf's first block has the vectors of all of them."""
    def block(parts: list[pd.DataFrame]) -> pd.DataFrame:
        part = pd.concat(parts)
        return pd.DataFrame({
            "dim": [part["dim"].iloc[0]], "cell": [part["cell"].iloc[0]], "lo": [part["dist"].min()],
            "hi": [part["dist"].max()], "n": [len(part)], "ids": [part["doc_id"].to_numpy(np.int64).tobytes()],
            "vectors": [_rows(part["embedding"]).tobytes()]})

    def shelf(blocks: list[pd.DataFrame]) -> pd.DataFrame:
        out = pd.concat(blocks, ignore_index=True)
        rest = [None] * (len(out) - 1)
        return out.assign(ids=[b"".join(out["ids"]), *rest], vectors=[b"".join(out["vectors"]), *rest])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, full = [], 0
        for ring in rings(batches):
            size = len(ring["vectors"][0])
            if held and (full + size > PART_BYTES or ring["dim"][0] != held[0]["dim"][0]):
                yield shelf(held)
                held, full = [], 0
            held.append(ring)
            full += size
        if held:
            yield shelf(held)

    def rings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, key, n = [], None, 0
        for pdf in batches:
            for found, part in pdf.groupby(["dim", "cell"]):
                if held and found != key:
                    yield block(held)
                    held, n = [], 0
                key = found
                while len(part):
                    some, part = part[:block_rows - n], part[block_rows - n:]
                    held.append(some)
                    n += len(some)
                    if n == block_rows:
                        yield block(held)
                        held, n = [], 0
        if held:
            yield block(held)
    return run


class Index:
    """What a task knows of the corpus: per vector length the pivots, the blocks'
    (number, cell, lo, hi, n) and which of them begin a shelf."""

    def __init__(self, pivots: dict[int, np.ndarray], blocks: pd.DataFrame):
        self.pivots = pivots
        parts = {int(dim): part for dim, part in blocks.sort_values("block").groupby("dim")}
        self.blocks = {dim: tuple(part[c].to_numpy() for c in ("block", "cell", "lo", "hi", "n"))
                       for dim, part in parts.items()}
        self.shelves = {dim: np.flatnonzero(part["first"]) for dim, part in parts.items()}

    def shelf(self, dim: int, number: int) -> range:
        """The rows of the block table that stand on the shelf of a first block."""
        starts, n = self.shelves[dim], len(self.blocks[dim][0])
        nth = int(np.searchsorted(starts, np.searchsorted(self.blocks[dim][0], number)))
        return range(starts[nth], starts[nth + 1] if nth + 1 < len(starts) else n)

    def places(self, dim: int, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per query and cell: how far the pivot is, and how far the cell is at least,
        its documents being nearer to their pivot than to the query's."""
        pivots = self.pivots[dim]
        apart = _distance(q, pivots)
        between = _distance(pivots, pivots[apart.argmin(axis=1)]).T
        # beyond the plane halfway
        beyond = (apart ** 2 - apart.min(axis=1, keepdims=True) ** 2) / np.where(between > 1e-6, 2 * between, np.inf)
        return apart, np.maximum(beyond, 0.0)

    def least(self, dim: int, places: tuple[np.ndarray, np.ndarray], at) -> np.ndarray:
        """Per query and block (``at``: one or many of the table): what the distance to
        its documents is at least."""
        _, cell, lo, hi, _ = (column[at] for column in self.blocks[dim])
        apart, beyond = (x[:, cell] for x in places)
        return np.maximum(np.maximum(apart - hi, lo - apart), beyond)

    def bounds(self, dim: int, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per query and block: what the distance to its documents is at least, and
        how far the middle of the ring is from the query's own."""
        places = self.places(dim, q)
        _, cell, lo, hi, _ = self.blocks[dim]
        return self.least(dim, places, slice(None)), np.abs(places[0][:, cell] - (lo + hi) / 2)

    def first(self, dim: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(row of the block table, query) of each query's blocks of least bound that
        hold more than ``k`` documents, by block."""
        size = self.blocks[dim][-1]
        most = min(k + 1, len(size))
        found = []
        for lo in range(0, len(q), ROUTE_ROWS):
            least, off = self.bounds(dim, q[lo:lo + ROUTE_ROWS])
            key = least + off / 1024
            near = np.argpartition(key, most - 1, axis=1)[:, :most]
            near = np.take_along_axis(near, np.argsort(np.take_along_axis(key, near, 1), axis=1), 1)
            query, nth = np.nonzero(np.cumsum(size[near], axis=1) - size[near] <= k)
            found.append((near[query, nth], query + lo))
        block, query = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(block, kind="stable")
        return block[order], query[order]

    def mask(self, dim: int, open_: np.ndarray) -> list[bytes]:
        """The shelves with open blocks of a vector length, as a byte per block and partition."""
        starts = self.shelves[dim]
        number = self.blocks[dim][0][np.unique(starts[np.searchsorted(starts, open_, side="right") - 1])]
        out = []
        for part in range(int(number.max() >> _PART) + 1 if len(number) else 0):
            at = number[number >> _PART == part] & ((1 << _PART) - 1)
            here = np.zeros(int(at.max()) + 1 if len(at) else 0, np.uint8)
            here[at] = 1
            out.append(here.tobytes())
        return out


class _Pack:
    """A pack of queries in a task."""

    def __init__(self, idx: Index, k: int, row):
        self.idx, self.k, self.dim = idx, k, int(row.dim)
        self.ids = np.frombuffer(row.q_ids, np.int64)
        self.vectors = _read(row.q_vectors, len(self.ids), self.dim)
        self.reach = None if row.q_least is None else np.frombuffer(row.q_least, np.float64)
        known = getattr(row, "q_near", None)
        self.near = None if known is None else np.frombuffer(known, np.int32).reshape(2, -1)

    def slices(self) -> Iterator[_Slice]:
        step = max(TILE_ROWS, min(SLICE_ROWS, HELD // self.k))
        for lo in range(0, len(self.ids), step):
            yield _Slice(self, lo, lo + step)


class _Slice:
    """Some queries of a pack (from number ``start``), with their bounds."""

    def __init__(self, pack: _Pack, lo: int, hi: int):
        self.idx, self.dim, self.start = pack.idx, pack.dim, lo
        self.ids, self.vectors = pack.ids[lo:hi], _unit(pack.vectors[lo:hi], 1)
        if pack.near is None:
            self.near = self.idx.first(self.dim, self.vectors, pack.k)
        else:
            block, query = pack.near[:, (pack.near[1] >= lo) & (pack.near[1] < hi)]
            self.near = block, query - lo
        self.reach = None
        if pack.reach is not None:
            self.reach = pack.reach[lo:hi]
            far = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (self.reach - 2 * 10.0 ** -SCORE_DIGITS))) + SLACK
            self.far = np.where(np.isnan(self.reach), np.inf, far)
            self.places = self.idx.places(self.dim, self.vectors)

    def asks(self, at: int) -> np.ndarray:
        """The queries to compare with a block (its row of the table): with their first
        ones, or, once there is a score to reach, with the others that may hold it."""
        block, query = self.near
        first = np.sort(query[slice(*np.searchsorted(block, [at, at + 1]))])
        if self.reach is None:
            return first
        open_ = self.idx.least(self.dim, self.places, at) <= self.far
        open_[first] = False
        return np.flatnonzero(open_)

    def blocks(self) -> np.ndarray:
        """The blocks that any query asks."""
        n = len(self.idx.blocks[self.dim][0])
        return np.unique(self.near[0]) if self.reach is None else np.array(
            [at for at in range(n) if len(self.asks(at))], np.int64)


_ORDER = ("dim", "cell", "dist", "doc_id")


def _assigned_type(docs: DataFrame) -> str:
    return f"doc_id long, dim int, embedding {_vector_type(docs)}, cell int, dist double"


def index(docs: DataFrame, cells: int | None = None, block_rows: int | None = None) -> tuple[DataFrame, Index]:
    """Blocks of the corpus (block, dim, cell, lo, hi, n, and in the first block of a
    shelf the ids and vectors of it) and what tasks need to choose among them."""
    docs = _usable(docs)
    pivots, counts = _pivots(docs, cells)
    n, width = sum(counts.values()), 4 if _vector_type(docs) == "array<float>" else 8
    parts = max(1, -(-sum(width * n * dim for dim, n in counts.items()) // PART_BYTES))
    assigned = docs.mapInArrow(_assigned(pivots), _assigned_type(docs))
    blocks = (assigned.repartitionByRange(parts, *_ORDER).sortWithinPartitions(*_ORDER)
              .mapInPandas(_rings(block_rows or max(BLOCK_ROWS, -(-n // MAX_BLOCKS))),
                           "dim int, cell int, lo double, hi double, n long, ids binary, vectors binary")
              .withColumn("block", F.monotonically_increasing_id()))
    blocks = materialize(blocks)
    return blocks, Index(pivots, blocks.select(
        "block", "dim", "cell", "lo", "hi", "n", F.col("vectors").isNotNull().alias("first")).toPandas())


def _pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted queries in packs of one vector length."""
    def pack(parts: list[pd.DataFrame]) -> pd.DataFrame:
        part = pd.concat(parts)
        return pd.DataFrame({"dim": [part["dim"].iloc[0]], "q_ids": [part["doc_id"].to_numpy(np.int64).tobytes()],
                             "q_vectors": [_rows(part["embedding"]).tobytes()]})

    held, key, n = [], None, 0
    for pdf in batches:
        for dim, part in pdf.groupby("dim"):
            if held and dim != key:
                yield pack(held)
                held, n = [], 0
            key, rows = dim, max(64, PACK_BYTES // (8 * dim))
            while len(part):
                some, part = part[:rows - n], part[rows - n:]
                held.append(some)
                n += len(some)
                if n == rows:
                    yield pack(held)
                    held, n = [], 0
    if held:
        yield pack(held)


def _packs(queries: DataFrame, idx: Index, k: int | None = None) -> DataFrame:
    """(pack, dim, q_ids, q_vectors): queries in the order of cells; with ``k`` routed to
    their first blocks."""
    asked = _usable(queries)
    assigned = materialize(asked.mapInArrow(_assigned(idx.pivots), _assigned_type(queries)))  # counted, sampled and read
    rows = {r.dim: r.n for r in assigned.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}
    full = sum(-(-10 * n * dim // PACK_BYTES) for dim, n in rows.items())  # ranges are not quite equal
    some = min(4 * queries.sparkSession.sparkContext.defaultParallelism, -(-sum(rows.values()) // PACK_ROWS))
    packs = (assigned.repartitionByRange(max(1, full, some), *_ORDER).sortWithinPartitions(*_ORDER)
             .mapInPandas(_pack, "dim int, q_ids binary, q_vectors binary")
             .withColumn("pack", F.monotonically_increasing_id()))
    return materialize(packs if k is None else _routed(packs.withColumn("q_least", F.lit(None).cast("binary")), idx, k))


def _routed(packs: DataFrame, idx: Index, k: int) -> DataFrame:
    """``packs`` (with q_least), the first blocks of their queries, and the shelves that
    these ask, as masks."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for i, row in enumerate(pdf.itertuples()):
                near, asked = [], []
                for part in _Pack(idx, k, row).slices():
                    block, query = part.near
                    near.append(np.vstack([block, query + part.start]))
                    asked.append(part.blocks())
                near = np.hstack(near).astype(np.int32)
                yield pdf[i:i + 1].assign(q_near=[near[:, np.argsort(near[0], kind="stable")].tobytes()],
                                          open=[idx.mask(row.dim, np.unique(np.concatenate(asked)))])

    columns = "pack long, dim int, q_ids binary, q_vectors binary, q_least binary, q_near binary"
    known = F.col("q_near") if "q_near" in packs.columns else F.lit(None).cast("binary").alias("q_near")
    return packs.select("pack", "dim", "q_ids", "q_vectors", "q_least", known).mapInPandas(run, columns + ", open array<binary>")


def _visited(packs: DataFrame, idx: Index, k: int) -> DataFrame:
    """(src, block) that are compared."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.itertuples():
                for part in _Pack(idx, k, row).slices():
                    for at in part.blocks():
                        src = part.ids[part.asks(at)]
                        yield pd.DataFrame({"src": src, "block": np.full(len(src), idx.blocks[part.dim][0][at])})

    return packs.select("dim", "q_ids", "q_vectors", "q_least").mapInPandas(run, "src long, block long")


class _Found:
    """The best ``k`` documents so far of a slice's queries, best first. Only those
    count that come to the query's score in ``reach``."""

    def __init__(self, part: _Slice, k: int, exclude_self: bool, block_rows: int):
        n, self.k, self.exclude_self = len(part.ids), k, exclude_self
        self.vectors, self.q_ids = part.vectors[:, :-2], part.ids
        self.single, self.tile = self.vectors.astype(np.float32), np.empty(TILE_ROWS * block_rows, np.float32)
        self.reach = np.full(n, -np.inf) if part.reach is None else np.where(np.isnan(part.reach), -np.inf, part.reach)
        self.score, self.ids = np.full((n, k), -np.inf), np.full((n, k), np.iinfo(np.int64).max)
        # more than single precision errs in a product of unit vectors, and rounding beyond
        self.slack = (part.dim + 8) * 2.0 ** -23 + 2 * 10.0 ** -SCORE_DIGITS

    def meet(self, at: np.ndarray, block: np.ndarray, single: np.ndarray, ids: np.ndarray) -> None:
        """Compare the queries ``at`` (sorted) with a block (``single``: it turned round)."""
        for lo in range(0, len(at), TILE_ROWS):
            some = at[lo:lo + TILE_ROWS]
            whole = some[-1] - some[0] + 1 == len(some)
            sims = self.tile[:len(some) * len(ids)].reshape(len(some), -1)
            np.matmul(self.single[some[0]:some[-1] + 1] if whole else self.single[some], single, out=sims)
            floor = (np.maximum(self.reach[some], self.score[some, -1]) - self.slack).astype(np.float32)
            up = np.flatnonzero(sims.max(axis=1) >= floor)
            if len(up):
                self._add(some[up], sims[up], floor[up], block, ids)

    def _add(self, at: np.ndarray, sims: np.ndarray, floor: np.ndarray, block: np.ndarray, ids: np.ndarray) -> None:
        if self.exclude_self:
            sims[self.q_ids[at][:, None] == ids[None, :]] = -np.inf
        free = np.flatnonzero(np.isneginf(floor))
        if len(free):  # nothing to reach yet: the best of the block
            kk = min(self.k, len(ids))
            floor[free] = -np.partition(-sims[free], kk - 1, axis=1)[:, kk - 1] - 2 * np.float32(self.slack)
        r, c = np.nonzero((sims >= floor[:, None]) & np.isfinite(sims))
        if len(r) * 32 > sims.size:
            score = (self.vectors[at] @ block.T)[r, c]
        else:
            score = np.einsum("ij,ij->i", self.vectors[at[r]], block[c])
        r, c, score = at[r], ids[c], np.round(score, SCORE_DIGITS)
        last = self.score[r, -1]
        keep = (score >= self.reach[r]) & ((score > last) | ((score == last) & (c < self.ids[r, -1])))
        r, c, score = r[keep], c[keep], score[keep]
        if not len(r):
            return
        held = r[np.r_[True, r[1:] != r[:-1]]]
        r = np.concatenate([np.repeat(held, self.k), r])
        c = np.concatenate([self.ids[held].ravel(), c])
        score = np.concatenate([self.score[held].ravel(), score])
        order = np.lexsort((c, -score, r))
        r, c, score = r[order], c[order], score[order]
        nth = np.arange(len(r)) - np.searchsorted(r, r, side="left")
        best = nth < self.k
        self.score[r[best], nth[best]], self.ids[r[best], nth[best]] = score[best], c[best]


def _scored(idx: Index, k: int, exclude_self: bool):
    def compared(row) -> Iterator[pd.DataFrame]:
        pack, shelf = _Pack(idx, k, row), idx.shelf(row.dim, row.block)
        ids = np.frombuffer(row.ids, np.int64)
        kept = _read(row.vectors, len(ids), row.dim)
        sizes = idx.blocks[row.dim][-1][shelf.start:shelf.stop]
        ends = np.cumsum(sizes)
        met = {}
        for part in pack.slices():
            found = _Found(part, k, exclude_self, int(sizes.max()))
            for at, lo, hi in zip(shelf, [0, *ends[:-1]], ends, strict=True):
                asks = part.asks(at)
                if len(asks):
                    if at not in met:
                        block = _unit(kept[lo:hi], 0)[:, :-2]
                        met[at] = block, block.T.astype(np.float32, order="C")
                    found.meet(asks, *met[at], ids[lo:hi])
            r, nth = np.nonzero(np.isfinite(found.score))
            if len(r):
                yield pd.DataFrame({"src": found.q_ids[r], "dst": found.ids[r, nth], "score": found.score[r, nth],
                                    "pack": np.full(len(r), row.pack), "at": r + part.start})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.itertuples():
                yield from compared(row)
    return run


def _compared(routed: DataFrame, blocks: DataFrame, idx: Index, k: int, exclude_self: bool) -> DataFrame:
    """The best ``k`` of each query (number ``at`` of its pack) and shelf it asks."""
    is_open = F.expr(f"substring(get(open, cast(shiftright(block, {_PART}) as int)), "
                     f"cast(block & {(1 << _PART) - 1}L as int) + 1, 1) = X'01'")
    shelves = blocks.where("vectors is not null").select(F.col("dim").alias("_dim"), "block", "ids", "vectors")
    pairs = routed.hint("shuffle_replicate_nl").crossJoin(shelves)
    return pairs.filter((F.col("dim") == F.col("_dim")) & is_open).mapInPandas(  # not copied by a projection
        _scored(idx, k, exclude_self), "src long, dst long, score double, pack long, at int")


def _best(near: DataFrame, k: int, by: tuple[str, ...] = ("src",)) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("dst"))
    return near.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _reached(packs: DataFrame, near: DataFrame, k: int) -> DataFrame:
    """``packs`` with the score that each query has to reach (NaN: any), hardly two in
    a partition."""
    reach = _best(near, k, ("pack", "at")).groupBy("pack", "at").agg(
        F.when(F.count(F.lit(1)) == k, F.min("score")).alias("least")).filter(F.col("least").isNotNull())
    parts = max(1, 2 * packs.count())  # they have been written
    of_pack = reach.repartition(parts, "pack").groupBy("pack").agg(
        F.collect_list("at").alias("ats"), F.collect_list("least").alias("leasts"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            least = []
            for ids, ats, leasts in zip(pdf["q_ids"], pdf["ats"], pdf["leasts"], strict=True):
                here = np.full(len(ids) // 8, np.nan)
                if ats is not None:
                    here[np.asarray(ats)] = leasts
                least.append(here.tobytes())
            yield pdf.drop(columns=["ats", "leasts"]).assign(q_least=least)

    joined = packs.repartition(parts, "pack").join(of_pack.hint("shuffle_hash"), "pack", "left")
    return joined.select("pack", "dim", "q_ids", "q_vectors", "q_near", "ats", "leasts").mapInPandas(
        run, "pack long, dim int, q_ids binary, q_vectors binary, q_near binary, q_least binary")


def searched(docs: DataFrame, queries: DataFrame, k: int, exclude_self: bool = True, cells: int | None = None,
             block_rows: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(neighbours of ``nearest_documents``, the (src, block, n) that were compared)."""
    blocks, idx = index(docs, cells, block_rows)
    packs = _packs(queries, idx, k)
    near = materialize(_compared(packs, blocks, idx, k, exclude_self)).coalesce(
        4 * docs.sparkSession.sparkContext.defaultParallelism)
    others = materialize(_routed(_reached(packs, near, k), idx, k))
    far = _compared(others, blocks, idx, k, exclude_self)
    found = _best(near.unionByName(far).drop("pack", "at"), k)
    visits = _visited(packs, idx, k).unionByName(_visited(others, idx, k))
    return found, visits.join(blocks.select("block", "n"), "block")


def nearest_documents(docs: DataFrame, queries: DataFrame, k: int = 5, exclude_self: bool = True,
                      blocks: int | None = None) -> DataFrame:
    """For every query document the ``k`` most cosine-similar documents.

    ``docs`` and ``queries`` have (doc_id, embedding). Result (src, dst,
    score, rank); ties broken by the lower dst id. Without ``exclude_self`` a
    query's id is no document id, and a document with the same number counts.
    Rows without an id, or whose vector is null, empty or not finite, take no
    part; a zero vector scores 0 with every other; vectors of different lengths
    aren't compared. ``blocks``: number of pivots (None: by the rows)."""
    return searched(docs, queries, k, exclude_self, blocks)[0]
