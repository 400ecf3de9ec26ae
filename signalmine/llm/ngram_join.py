"""Exact Jaccard self-join on word shingles by universe partition.

Two sets of n and s shingles with a Jaccard similarity of at least 0.8 differ in
at most ``H = (n + s) // 9`` shingles. Sets are put into size bands (octaves).
The shingles are hashed into the ``m`` segments of a band (``m`` above the
band's largest H), so a set falls into m sub-sets. By the pigeonhole principle a
set that gives its segments allocations e (0, 1 or 2) with a sum over H shares,
with each of its partners, a segment with e = 1 exactly, or one with e = 2 but
for at most one shingle. Every set is indexed in its own band and probes the
bands in which a partner can lie.

Costs decide the allocation. Segments that are empty or hold nothing but
shingles that are frequent (in a bounded sample of sets) have long lists and get
e = 0; of the rest the H + 1 largest get e = 1. A set that has too few such
segments probes with one-deletion neighbourhoods (e = 2) instead, against sets
that are in the same position; a pair with one set that isn't is found from
that set. So no link is lost, whatever the sample says.

Sets that share a segment form a list. Of each list the set that most others of
the bucket's lists share is the centre; each set is first verified, on whole
texts, with the centre that it shares most lists with, which gives components.
Then every pair of a list that lies in different components is tested: each set
has a parity sketch, whose bits that differ between two sets are at most the
shingles that differ, so a pair with more than H such bits is no link for sure;
all others are verified. Copies (equal sets) are one entry throughout, and pairs
leave a task only after that test.

Sets are sets of 64-bit shingle hashes.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalmine.llm.common import (U64, buckets, mix, packed, stored, text_steps, unpacked,
                                   window_hashes, word_hashes)
from signalmine.llm.components import components

SHINGLE = 5
SAMPLE_SETS = 1024      # sets that the frequent shingles are taken from
FREQUENT_IN = 6         # of them: a shingle in so many sets is frequent
MOST_FREQUENT = 200_000  # frequent shingles kept (for costs only)
FLUSH = 500_000         # signatures that a task holds before it sends them


def shingle_sets(column: pa.Array, k: int = SHINGLE):
    """(row, sorted distinct shingle hashes) of every text of an Arrow column."""
    for lo, hi, data, starts in text_steps(column):
        hashes, counts, _, _ = word_hashes(data, starts, lower=True)
        windows = window_hashes(hashes, k)
        at = 0
        for row, n in enumerate(counts, lo):
            if n >= k:
                yield row, np.unique(windows[at:at + n - k + 1])
            else:
                yield row, window_hashes(hashes[at:at + n], max(1, n))
            at += n


def set_id(shingles: np.ndarray) -> int:
    """A 64-bit name of a set (signed), from the sum of its mixed hashes."""
    total = np.array([mix(shingles).sum(dtype=U64) + U64(len(shingles))], U64)
    return int(mix(total).view(np.int64)[0])


def _sets(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, n_shingles, set_id): set_id is null for an empty set."""

    def run(batches):
        for batch in batches:
            n, ids = np.zeros(batch.num_rows, np.int64), [None] * batch.num_rows
            for row, s in shingle_sets(batch.column(2)):
                n[row] = len(s)
                ids[row] = set_id(s) if len(s) else None
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(n), pa.array(ids, pa.int64())],
                                             ["doc_id", "text_hash", "n_shingles", "set_id"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        run, "doc_id long, text_hash long, n_shingles long, set_id long")


def _frequent(docs: DataFrame, classes: DataFrame) -> np.ndarray:
    """Shingles in FREQUENT_IN of SAMPLE_SETS sets (picked by hash). Bounded by
    MOST_FREQUENT and used for costs alone."""
    picked = F.broadcast(classes.where("doc_id is not null")
                         .orderBy(F.xxhash64("set_id"), "set_id").limit(SAMPLE_SETS).select("doc_id"))

    def run(batches):
        for batch in batches:
            seen = {}
            for _, s in shingle_sets(batch.column(0)):
                if len(s):
                    seen[set_id(s)] = s
            if seen:
                h, n = np.unique(np.concatenate(list(seen.values())), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["h", "n"])

    counted = (docs.join(picked, "doc_id", "left_semi").select("text")
               .mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
               .where(F.col("n") >= FREQUENT_IN).orderBy(F.desc("n"), "h").limit(MOST_FREQUENT))
    return np.sort(counted.select("h").toPandas()["h"].to_numpy(np.int64).view(U64))


def _segments_of(band: int) -> int:
    return int(np.ceil(0.29 * 2 ** (band + 1))) + 2


def _signatures(s: np.ndarray, mixed: np.ndarray, rare: np.ndarray):
    """(signature, flags) arrays of one set; flag 1: index, flag 2: probe."""
    n = len(s)
    own = n.bit_length() - 1
    out, flags, poor = [], [], []
    cut = {}

    def segments(band: int):
        if band not in cut:
            m = _segments_of(band)
            seg = ((s >> U64(32)) * U64(m)) >> U64(32)
            start = np.flatnonzero(np.concatenate([[True], seg[1:] != seg[:-1]]))
            cut[band] = (m, seg[start], start, np.diff(np.append(start, n)),
                         np.add.reduceat(mixed, start), np.add.reduceat(rare, start) > 0)
        return cut[band]

    def name(total, seg, band, deep):
        return mix(total + mix(seg.astype(U64) + U64((band * 2 + deep) << 40)))

    for band in range(max(1, -(-4 * n // 5)).bit_length() - 1, (5 * n // 4).bit_length()):
        m, seg, start, size, total, light = segments(band)
        allowed = (n + min(2 ** (band + 1) - 1, 5 * n // 4)) // 9
        usable = np.flatnonzero(light)
        enough = len(usable) > allowed
        if not enough:
            poor.append((band, allowed))
        probe = usable[np.argsort(-size[usable], kind="stable")[:allowed + 1]] if enough else usable[:0]
        if band == own:
            flag = np.ones(len(seg), np.uint8)
            flag[probe] |= 2
            out.append(name(total[usable], seg[usable], band, 0))
            flags.append(flag[usable])
        elif enough:
            out.append(name(total[probe], seg[probe], band, 0))
            flags.append(np.full(len(probe), 2, np.uint8))
    if poor:
        m, seg, start, size, total, _ = segments(own)
        empty = np.setdiff1d(np.arange(m), seg.astype(np.int64))
        where = np.repeat(np.arange(len(seg)), size)
        for t, g in ((total, seg), (total[where] - mixed, seg[where]), (np.zeros(len(empty), U64), empty)):
            out.append(name(t, g, own, 1))
            flags.append(np.ones(len(g), np.uint8))
    for band, allowed in poor:
        m, seg, start, size, total, light = segments(band)
        order = np.lexsort((size, ~light))[:(allowed + 2) // 2]
        left = allowed + 1 - 2 * len(order)
        empty = np.setdiff1d(np.arange(m), seg.astype(np.int64))[:max(0, left)]
        taken = np.zeros(len(seg), bool)
        taken[order] = True
        where = np.repeat(np.arange(len(seg)), size)
        inside = taken[where]
        for t, g in ((total[order], seg[order]), (total[where[inside]] - mixed[inside], seg[where[inside]]),
                     (np.zeros(len(empty), U64), empty)):
            out.append(name(t, g, band, 1))
            flags.append(np.full(len(g), 2, np.uint8))
    return np.concatenate(out), np.concatenate(flags)


def _index(docs: DataFrame, frequent: np.ndarray, n_buckets: int) -> DataFrame:
    """Packed (bucket; high, low, set): 38 bits of each signature with its flags."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def sent(parts):
        if parts:
            sig, flag, sets = (np.concatenate(x) for x in zip(*parts, strict=True))
            yield packed((sig & U64((1 << 26) - 1)).astype(np.int64) % n_buckets, n_buckets, {
                "high": (sig >> U64(32)).astype(np.uint32),
                "low": ((((sig >> U64(26)) & U64(63)) << U64(2)).astype(np.uint8) | flag), "sets": sets})

    def run(batches):
        for batch in batches:
            hot, seen, parts, held = shared.value, set(), [], 0
            for _, s in shingle_sets(batch.column(0)):
                if held > FLUSH:
                    yield from sent(parts)
                    parts, held = [], 0
                if not len(s) or (name := set_id(s)) in seen:
                    continue
                seen.add(name)
                if len(hot):
                    rare = hot[np.minimum(np.searchsorted(hot, s), len(hot) - 1)] != s
                else:
                    rare = np.ones(len(s), bool)
                sig, flag = _signatures(s, mix(s + U64(1)), rare.astype(np.int32))
                parts.append((sig, flag, np.full(len(sig), name, np.int64)))
                held += len(sig)
            yield from sent(parts)

    return docs.select("text").mapInArrow(run, "bucket int, high binary, low binary, sets binary")


PACKED = "kind int, bucket int, x binary, y binary"


def _frame(batch: pa.RecordBatch | None, names: list[str], **more) -> pd.DataFrame:
    return batch.to_pandas().assign(**more)[names] if batch is not None else pd.DataFrame({c: [] for c in names})


def _starts(x: np.ndarray) -> np.ndarray:
    """Where a run of equal values of a sorted array begins."""
    return np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.zeros(0, np.int64)


def _lists(index: DataFrame, n_buckets: int) -> DataFrame:
    """From the index: packed (kind 0: the centre of its list, or for a centre the
    next best, and each set; by the set) and (kind 1: list, member; by the
    member). Equal lists of a bucket are one."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        here = int(rows["bucket"].iloc[0])
        low = unpacked(rows, "low", np.uint8)
        key = (unpacked(rows, "high", np.uint32).astype(np.int64) << 6) | (low >> 2)
        sets = unpacked(rows, "sets", np.int64)
        order = np.argsort(key, kind="stable")
        again = key[order][1:] == key[order][:-1]
        order = order[np.concatenate([[False], again]) | np.concatenate([again, [False]])]  # signatures seen twice
        order = order[np.lexsort((sets[order], key[order]))]
        key, sets, flag = key[order], sets[order], low[order] & 3
        names = ["kind", "bucket", "x", "y"]
        if not len(key):
            return _frame(None, names)
        at = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (sets[1:] != sets[:-1])]))
        flag, key, sets = np.bitwise_or.reduceat(flag, at), key[at], sets[at]
        start = _starts(key)
        size = np.diff(np.append(start, len(key)))
        good = np.flatnonzero((size > 1) & (np.bitwise_or.reduceat(flag, start) == 3))
        members = np.add.reduceat(mix(sets.view(U64)), start)
        keep = np.zeros(len(start), bool)
        keep[good[np.unique(members[good], return_index=True)[1]]] = True
        keep = np.repeat(keep, size)
        key, sets, size = key[keep], sets[keep], np.repeat(size, size)[keep]
        if not len(key):
            return _frame(None, names)
        found, which = np.unique(sets, return_inverse=True)
        weight = np.bincount(which, size)[which]  # sets met in this bucket's lists
        start = _starts(key)
        list_of = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(key))))
        ranked = sets[np.lexsort((sets, -weight, list_of))]
        centre = ranked[start][list_of]
        partner = np.where(sets != centre, centre, ranked[start + 1][list_of])
        pairs = packed(sets % n_buckets, n_buckets, {"x": partner, "y": sets})
        lists = packed(sets % n_buckets, n_buckets, {"x": (here << 38) | key, "y": sets})
        return pd.concat([_frame(pairs, names, kind=0), _frame(lists, names, kind=1)])

    return index.groupBy("bucket").applyInPandas(run, PACKED)


def _best_centre(rows: pd.DataFrame) -> pd.DataFrame:
    """(a, b): of each set b the centre a that it shares most lists with."""
    a, b = unpacked(rows, "x", np.int64), unpacked(rows, "y", np.int64)
    order = np.lexsort((a, b))
    a, b = a[order], b[order]
    at = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
    shared = np.diff(np.append(at, len(a)))
    a, b = a[at], b[at]
    order = np.lexsort((a, -shared, b))
    return pd.DataFrame({"a": a[order][_starts(b[order])], "b": b[order][_starts(b[order])]})


def _sketches(texts: DataFrame, exact: bool) -> DataFrame:
    """(node, n, sketch, shingles): of each set its size and the parities of its shingles'
    low hash bits, as many as the next power of two of 4 n (64 at least): with so
    many the bits that differ are nearly as many as the shingles that do. shingles:
    the set itself, if ``exact``."""

    def run(batches):
        for batch in batches:
            out = []
            for _, s in shingle_sets(batch.column(1)):
                bits = max(64, 1 << (4 * len(s) - 1).bit_length())
                odd = np.bincount((mix(s + U64(2)) & U64(bits - 1)).astype(np.int64), minlength=bits) & 1
                out.append((len(s), np.packbits(odd.astype(np.uint8), bitorder="little").tobytes(),
                            s.tobytes() if exact else None))
            n, sketch, shingles = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(sketch, pa.binary()),
                                              pa.array(shingles, pa.binary())], ["node", "n", "sketch", "shingles"])

    return texts.select("set_id", "text").mapInArrow(run, "node long, n long, sketch binary, shingles binary")


def _near(row: np.ndarray, n: int, sketches: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Of sets with sketches of one length (64-bit words) those that one set's
    sketch and size don't rule out. The longer sketch is folded to the shorter."""
    while len(row) > sketches.shape[1]:
        row = row[:len(row) // 2] ^ row[len(row) // 2:]
    while sketches.shape[1] > len(row):
        half = sketches.shape[1] // 2
        sketches = sketches[:, :half] ^ sketches[:, half:]
    differ = np.bitwise_count(sketches ^ row).sum(1, dtype=np.int64)
    return (differ <= (n + sizes) // 9) & (5 * np.minimum(n, sizes) >= 4 * np.maximum(n, sizes))


class _Joined:
    """Union-find over the components of a bucket."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self, c: np.ndarray) -> np.ndarray:
        r = self.parent[c]
        while (self.parent[r] != r).any():
            r = self.parent[r]
        self.parent[c] = r
        return r


def _spanning(lists, at, comp, ids, sizes, words, exact, percent: int) -> set[tuple[int, int]]:
    """Of the pairs of a list that lie in different components and that sketches (with
    shingles at hand: these) don't rule out, so many that all others
    lie within what these unite: less than there are components."""
    _, comp = np.unique(comp, return_inverse=True)
    joined, found = _Joined(int(comp.max()) + 1), set()
    widths = np.array([len(x) for x in words])
    order = np.lexsort((comp, widths[at], lists))
    lists, at, comp = lists[order], at[order], comp[order]
    start = _starts(lists)
    for lo, hi in zip(start, np.append(start[1:], len(lists)), strict=True):
        m, c = at[lo:hi], comp[lo:hi]
        root = joined.roots(c)
        _, which, many = np.unique(root, return_inverse=True, return_counts=True)
        if len(many) == 1:
            continue
        cut = _starts(widths[m])
        groups = [(g0, g1, np.stack([words[j] for j in m[g0:g1]])) for g0, g1 in zip(cut, np.append(cut[1:], len(m)), strict=True)]
        for i in np.flatnonzero(which != many.argmax()):  # every open pair has one that isn't in the largest
            root = joined.roots(c)
            apart = root != root[i]
            if not apart.any():
                break
            me = m[i]
            for g0, g1, theirs in groups:
                some = np.flatnonzero(apart[g0:g1])
                if not len(some):
                    continue
                some = some[_near(words[me], int(sizes[me]), theirs[some], sizes[m[g0:g1][some]])] + g0
                for r in np.unique(root[some]):
                    for j in some[root[some] == r]:
                        you = m[j]
                        if exact[me] is None or _linked(exact[me], exact[you], percent):
                            mine, other = joined.roots(c[[i, j]])
                            joined.parent[other] = mine
                            found.add((int(min(ids[me], ids[you])), int(max(ids[me], ids[you]))))
                            break
    return found


def _linked(s: np.ndarray, t: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(s, t, assume_unique=True))
    return common * 100 >= percent * (len(s) + len(t) - common)


def _open_pairs(lists: DataFrame, known: DataFrame, sketches: DataFrame, n_buckets: int, percent: int, others: bool) -> DataFrame:
    """Pairs (a < b) of a list that lie in different components, as ``_spanning`` picks
    them. Members without a component in ``known`` are one each, if ``others``, or left out."""
    placed = lambda df: df.withColumn("bucket", F.pmod("node", F.lit(n_buckets)).cast("int"))

    def with_component(rows: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        names = ["bucket", "x", "y", "z"]
        if not len(rows):
            return _frame(None, names)
        lists, member = unpacked(rows, "x", np.int64), unpacked(rows, "y", np.int64)
        known = known.sort_values("node")
        node, comp = known["node"].to_numpy(np.int64), known["component"].to_numpy(np.int64)
        if len(node):
            at = np.minimum(np.searchsorted(node, member), len(node) - 1)
            there = node[at] == member
            comp = np.where(there, comp[at], member)
        else:
            there, comp = np.zeros(len(member), bool), member
        if not others:
            lists, member, comp = lists[there], member[there], comp[there]
        return _frame(packed(lists % n_buckets, n_buckets, {"x": lists, "y": member, "z": comp}), names)

    def mixed(rows: pd.DataFrame) -> pd.DataFrame:
        names = ["bucket", "x", "y", "z"]
        lists, member, comp = (unpacked(rows, c, np.int64) for c in "xyz")
        order = np.lexsort((comp, lists))
        lists, member, comp = lists[order], member[order], comp[order]
        start = _starts(lists)
        size = np.diff(np.append(start, len(lists)))
        open_ = np.repeat(comp[start] != comp[start + size - 1], size)
        lists, member, comp = lists[open_], member[open_], comp[open_]
        return _frame(packed(member % n_buckets, n_buckets, {"x": lists, "y": member, "z": comp}), names)

    def with_sketch(rows: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        names = ["bucket", "x", "y", "z", "member", "n", "sketch", "exact"]
        out = []
        if len(rows):
            lists, member, comp = (unpacked(rows, c, np.int64) for c in "xyz")
            known = known.drop_duplicates("node").set_index("node")
            order = np.argsort(lists % n_buckets, kind="stable")
            to = (lists % n_buckets)[order]
            start = _starts(to)
            for lo, hi in zip(start, np.append(start[1:], len(to)), strict=True):
                some = order[lo:hi]
                ids, which = np.unique(member[some], return_inverse=True)
                info = known.loc[ids]
                width = np.array([len(x) for x in info["sketch"]], np.int64)
                whole = [b"" if x is None else x for x in info["shingles"]]
                length = np.array([len(x) for x in whole], np.int64)
                out.append((int(to[lo]), lists[some].tobytes(), which.astype(np.int64).tobytes(), comp[some].tobytes(),
                            ids.tobytes(), np.stack([info["n"].to_numpy(np.int64), width, length]).tobytes(),
                            b"".join(info["sketch"]), b"".join(whole)))
        return pd.DataFrame(out, columns=names)

    def cross(rows: pd.DataFrame) -> pd.DataFrame:
        parts, ids, sizes, words, exact, base = [], [], [], [], [], 0
        for r in rows.itertuples():
            member = np.frombuffer(r.member, np.int64)
            n, width, length = np.frombuffer(r.n, np.int64).reshape(3, -1)
            for raw, size, to in ((r.sketch, width, words), (r.exact, length, exact)):
                raw, ends = np.frombuffer(raw, U64), np.cumsum(size // 8)
                to += [raw[e - w:e] if w else None for w, e in zip(size // 8, ends, strict=True)]
            ids.append(member)
            sizes.append(n)
            parts.append((np.frombuffer(r.x, np.int64), np.frombuffer(r.y, np.int64) + base, np.frombuffer(r.z, np.int64)))
            base += len(member)
        lists, at, comp = (np.concatenate(x) for x in zip(*parts, strict=True))
        found = _spanning(lists, at, comp, np.concatenate(ids), np.concatenate(sizes), words, exact, percent)
        return pd.DataFrame(sorted(found), columns=["a", "b"])

    one = lists.groupBy("bucket").cogroup(placed(known).groupBy("bucket")).applyInPandas(
        with_component, "bucket int, x binary, y binary, z binary")
    two = stored(one.groupBy("bucket").applyInPandas(mixed, "bucket int, x binary, y binary, z binary"), "open-lists")
    three = two.groupBy("bucket").cogroup(placed(sketches).groupBy("bucket")).applyInPandas(
        with_sketch, "bucket int, x binary, y binary, z binary, member binary, n binary, sketch binary, exact binary")
    return three.groupBy("bucket").applyInPandas(cross, "a long, b long").distinct()


def _verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole texts reach the similarity."""

    def run(batches):
        for batch in batches:
            good = np.zeros(batch.num_rows, bool)
            for (row, s), (_, t) in zip(shingle_sets(batch.column(2)), shingle_sets(batch.column(3)), strict=True):
                good[row] = _linked(s, t, percent)
            yield batch.select(["a", "b"]).filter(pa.array(good))

    a = texts.select(F.col("set_id").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("set_id").alias("b"), F.col("text").alias("text_b"))
    return (pairs.select("a", "b").join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b")
            .mapInArrow(run, "a long, b long"))


def near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs`` (doc_id, text).

    A null or empty text, or one without words, has no shingles and is its own
    component; fewer than five words are one shingle. Copies are linked. Repeated
    rows and repeated ids give a row each. A null doc_id never names a component
    that has another id. Other columns are ignored. ``percent`` of 80 or more.
    """
    named = _components(docs, percent)
    smallest = (named.where("component is not null").groupBy("component")
                .agg(F.min("doc_id").alias("component_id")))
    return named.join(smallest, "component", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def _components(docs: DataFrame, percent: int) -> DataFrame:
    """(doc_id, text_hash, n_shingles, set_id, component) of every row: component
    is null for an empty set."""
    if not 80 <= percent <= 100:
        raise ValueError("percent: 80 to 100")
    spark = docs.sparkSession
    n_buckets = buckets(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sets = stored(_sets(docs), "sets")
    classes = sets.where("set_id is not null").groupBy("set_id").agg(F.min("doc_id").alias("doc_id"))
    frequent = _frequent(docs, classes)
    lists = stored(_lists(_index(docs, frequent, n_buckets), n_buckets), "lists")
    best = stored(lists.where("kind = 0").groupBy("bucket").applyInPandas(_best_centre, "a long, b long"), "best")
    wanted = best.select(F.col("a").alias("set_id")).union(best.select("b")).distinct().join(classes, "set_id")
    texts = stored(_texts(docs, wanted), "texts")
    links = stored(_verified(best, texts, percent), "verified")
    reached = stored(components(links, "a", "b"), "reached")

    lists = lists.where("kind = 1").drop("kind")
    known, exact = reached, False
    while True:
        tried = stored(_open_pairs(lists, known, _sketches(texts, exact), n_buckets, percent, not exact), "tried")
        good = stored(_verified(tried, texts, percent), "verified")
        if not good.isEmpty():
            links = links.unionByName(good)
            reached = stored(components(links, "a", "b"), "reached")
        if exact or tried.join(good, ["a", "b"], "left_anti").isEmpty():
            break
        # what a wrong pair united may lie apart: once more for the components that pairs were tried of, by their shingles
        name = F.coalesce("component", "node").alias("component")
        was = texts.select(F.col("set_id").alias("node")).join(known, "node", "left").select("node", name)
        ends = tried.select(F.col("a").alias("node")).union(tried.select("b")).distinct()
        touched = was.join(ends.join(was, "node").select("component").distinct(), "component", "left_semi").select("node")
        known = stored(touched.join(reached, "node", "left").select("node", name), "known")
        texts, exact = texts.join(known.select(F.col("node").alias("set_id")), "set_id", "left_semi"), True

    return (sets.join(reached.select(F.col("node").alias("set_id"), "component"), "set_id", "left")
            .withColumn("component", F.coalesce("component", "set_id")))


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(set_id, text) of the wanted sets, from their smallest documents."""

    def run(batches):
        for batch in batches:
            wants = batch.column(0).to_pylist()
            last = {}
            for row, s in shingle_sets(batch.column(1)):
                if len(s) and set_id(s) == wants[row] and wants[row] not in last:
                    last[wants[row]] = row
            yield batch.take(pa.array(sorted(last.values()), pa.int64()))

    joined = docs.join(wanted.select("set_id", F.col("doc_id").alias("wanted_id")),
                       F.col("doc_id").eqNullSafe(F.col("wanted_id")))
    return joined.select("set_id", "text").mapInArrow(run, "set_id long, text string")


def deduplicated(docs: DataFrame, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the row with the
    smallest id, then text hash, stays, once; rows of other components with its id
    aren't touched. Rows without words stay once per id and text, rows without an
    id all."""
    rows = _components(docs, percent).where("doc_id is not null").select("component", F.struct("doc_id", "text_hash").alias("row"))
    first = rows.where("component is not null").groupBy("component").agg(F.min("row").alias("row")).select("row")
    keep = first.union(rows.where("component is null").select("row").distinct()).select(
        F.col("row.doc_id").alias("_id"), F.col("row.text_hash").alias("_hash"))
    marked = docs.withColumns({"_id": F.col("doc_id").cast("long"), "_hash": F.xxhash64("text")})
    kept = marked.join(keep, ["_id", "_hash"], "left_semi").dropDuplicates(["_id", "_hash"])
    return kept.drop("_id", "_hash").unionByName(docs.where("doc_id is null")).select(*docs.columns)
