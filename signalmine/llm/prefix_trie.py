"""A trie of conversation prefixes as a minimal-perfect-hash node table.

A conversation's prefix of d turns is named by a 128-bit digest, the exclusive or
of its turns' hashes with their places, so that prefix digests are running values
and a conversation of any length can be cut over many tasks. Equal digests are one
node of the trie.

The trie is cut into shards: subtrees of at most ``LIGHT_ROWS`` prefixes, a number
that is known before the subtrees are, since a node's subtree holds as many
prefixes as its members have turns from it on. Subtrees are dealt by hash into
tasks. In a shard the distinct digests get the slots of a minimal perfect hash,
each slot verified against its digest; counts are scattered into flat arrays by
slot, parents' slots are looked up in the same table, and sums are accumulated
through them from the deepest nodes up.

The few nodes above (a subtree of more prefixes: the root, and what a large part
of all conversations share) are plain Spark aggregates: each node is owned by its
smallest member, a node's subtree is what its members own from its depth on, so
its sums are sums over its members of running sums along them.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalmine.llm.common import U64, buckets, mix, stored, word_count

LIGHT_ROWS = 1 << 16    # prefixes of a subtree that one task may hold at most; a quarter of a task's share,
LEAST_ROWS = 1 << 10    # if that is less, but always so many
SHARD_ROWS = 1 << 18    # prefixes that are dealt to one task, about
HEAD = 64               # characters of a text that range bounds look at

NODE = ["pos", "d1", "d2"]


# -------------------------------------------------------------- running values

def running(df: DataFrame, key: str, order: list[Column], by: list[Column], sums: list[str], xors: list[str],
            keep: list[str], name: str) -> DataFrame:
    """``keep`` and, for each column of ``sums`` and ``xors``, its running sum or
    exclusive or within ``key`` (a long, no nulls) in ``order``.

    Rows are range-partitioned by key and ``by`` (a prefix of the order), so a key
    may lie in many partitions; the totals of the parts before, of the keys that a
    partition border cuts (one per partition at most), are added afterwards."""
    spark = df.sparkSession
    values = [*sums, *xors]
    laid = df.repartitionByRange(buckets(spark), F.col(key), *by).sortWithinPartitions(F.col(key), *order)
    laid = laid.select(key, *[c for c in keep if c != key], *values)
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in laid.schema.fields)
    fields += ", part int" + "".join(f", _{c} long" for c in values)

    def run(batches):
        last, held = None, {c: 0 for c in values}
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(0).to_numpy()
            start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            lead = np.searchsorted(start, np.arange(len(keys)), "right") - 1
            into = int(start[1]) if len(start) > 1 else len(keys)  # rows of the first key
            if last is None or last != keys[0]:
                held = {c: 0 for c in values}
            out = []
            for c in values:
                x = batch.column(c).to_numpy().astype(np.int64)
                fold, undo = (np.add, np.subtract) if c in sums else (np.bitwise_xor, np.bitwise_xor)
                total = np.concatenate([[0], fold.accumulate(x)])
                got = undo(total[1:], total[start][lead])
                got[:into] = fold(got[:into], held[c])
                held[c] = got[-1]
                out.append(pa.array(got))
            last = keys[-1]
            part = pa.array(np.full(len(keys), TaskContext.get().partitionId(), np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, part, *out],
                                             [*batch.schema.names, "part", *(f"_{c}" for c in values)])

    done = stored(laid.mapInArrow(run, fields), name)
    ends = sorted(done.groupBy("part").agg(F.min(key).alias("lo"), F.max(key).alias("hi")).collect())  # a row per partition
    cut = {b.lo for a, b in zip(ends, ends[1:], strict=False) if a.hi == b.lo}
    if cut:
        whole = [F.sum(c).alias(c) for c in sums] + [F.bit_xor(c).alias(c) for c in xors]
        before, seen = [], {}
        for r in sorted(done.where(F.col(key).isin(*cut)).groupBy(key, "part").agg(*whole).collect(), key=lambda r: (r[0], r.part)):
            at = seen.setdefault(r[0], dict.fromkeys(values, 0))
            before.append((r[0], r.part, *(at[c] for c in values)))
            for c in values:
                at[c] = at[c] + r[c] if c in sums else at[c] ^ r[c]
        offsets = spark.createDataFrame(before, f"{key} long, part int" + "".join(f", o_{c} long" for c in values))
        done = done.join(F.broadcast(offsets), [key, "part"], "left")  # a row per partition and key that a border cuts
        for c in values:
            off = F.coalesce(F.col(f"o_{c}"), F.lit(0).cast("long"))
            done = done.withColumn(f"_{c}", F.col(f"_{c}") + off if c in sums else F.col(f"_{c}").bitwiseXOR(off))
    return done.select(*keep, *(F.col(f"_{c}").alias(c) for c in values))


# ----------------------------------------------------------------------- turns

def numbered(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, t1, t2, words) of every turn: its place from 1, two hashes of its
    role and text, the words of its text. Turns go by number (null first), then role,
    then text; a null role or text is empty; turns without a conv_id are left out."""
    t = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", *(F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text"))
    ).where("conv_id is not null")
    t = t.withColumns({"t1": F.xxhash64("role", "text"), "t2": F.xxhash64(F.lit("turn"), "role", "text"),
                       "words": word_count(F.col("text")), "pos": F.lit(1)})
    turn = F.col("turn").asc_nulls_first()
    return running(t, "conv_id", [turn, F.col("role"), F.col("text")], [turn, F.col("role"), F.left("text", F.lit(HEAD))],
                   ["pos"], [], ["conv_id", "t1", "t2", "words"], "turns")


def _ids(turns: DataFrame) -> DataFrame:
    return turns.groupBy("conv_id").agg(F.max("pos").cast("long").alias("n"))


def rebuilt(turns: DataFrame, family: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations (conv_id, n)) where each conversation's first h turns are
    those of the first of its family (conv_id less conv_id % family): h is crc32 of the
    id's digits % heads. A conversation may lose all its turns; it stays one."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    base = F.col("conv_id") - F.col("conv_id") % family
    first = stored(turns.where((F.col("conv_id") % family == 0) & (F.col("pos") < heads)), "heads").select(
        F.col("conv_id").alias("base"), *(F.col(c).alias(f"b_{c}") for c in ("pos", "t1", "t2", "words")))
    given = first.groupBy("base").agg(F.count("*").alias("given"))
    convs = _ids(turns).withColumns({"h": h, "base": base}).join(given, "base", "left").withColumn(
        "taken", F.least("h", F.coalesce("given", F.lit(0))))
    convs = stored(convs.withColumn("len", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "conversations")
    # turns before the cut come from the family's first conversation, later ones move
    own = turns.join(convs.select("conv_id", "h", "taken"), "conv_id").where("pos > h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("taken")).cast("long").alias("pos"), "t1", "t2", "words")
    grafted = convs.where("h > 0").join(first, "base").where("b_pos <= h").select(
        "conv_id", F.col("b_pos").cast("long").alias("pos"), F.col("b_t1").alias("t1"), F.col("b_t2").alias("t2"),
        F.col("b_words").alias("words"))
    return own.unionByName(grafted), convs.select("conv_id", F.col("len").cast("long").alias("n"))


# --------------------------------------------------------- minimal perfect hash

class PerfectHash:
    """Slots 0 to n - 1 of n distinct pairs of 64-bit digests. Level by level the keys
    that no other shares a place with get theirs; the rest go to the next level."""

    def __init__(self, d1: np.ndarray, d2: np.ndarray):
        self.levels, self.d1, self.d2 = [], np.empty_like(d1), np.empty_like(d2)
        left, done = np.arange(len(d1)), 0
        while len(left):
            place = self._place(d1[left], d2[left], len(self.levels), len(left) * 5 // 4 + 1)
            single = np.bincount(place, minlength=len(left) * 5 // 4 + 1) == 1
            slots = np.where(single, done + np.cumsum(single) - 1, -1)
            mine = single[place]
            self.d1[slots[place[mine]]], self.d2[slots[place[mine]]] = d1[left[mine]], d2[left[mine]]
            self.levels.append(slots)
            done += int(mine.sum())
            left = left[~mine]

    @staticmethod
    def _place(d1, d2, level: int, size: int) -> np.ndarray:
        return (mix(d1.view(U64) + mix(d2.view(U64) + U64(level))) % U64(size)).astype(np.int64)

    def slots(self, d1: np.ndarray, d2: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 for a pair that isn't in the table: the digest that
        a slot holds must be the one asked for."""
        out, left = np.full(len(d1), -1), np.arange(len(d1))
        for level, slots in enumerate(self.levels):
            got = slots[self._place(d1[left], d2[left], level, len(slots))]
            out[left[got >= 0]] = got[got >= 0]
            left = left[got < 0]
        return np.where((out >= 0) & (self.d1[out] == d1) & (self.d2[out] == d2), out, -1) if len(self.d1) else out


def _sha256(ids) -> str:
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


_SHARD = ("conv_id long, pos long, parent_conv_id long, p1 long, p2 long, n_convs long, n_children long, n_leaves long, "
          "saved long, ends_sha256 string, top boolean")


def _shard(rows: pd.DataFrame) -> pd.DataFrame:
    """The nodes of the subtrees whose prefixes are ``rows``."""
    conv, pos, n, words, d1, d2, p1, p2 = (rows[c].to_numpy(np.int64) for c in
                                           ("conv_id", "pos", "n", "words", "d1", "d2", "p1", "p2"))
    order = np.lexsort((d2, d1))
    new = np.concatenate([[True], (d1[order][1:] != d1[order][:-1]) | (d2[order][1:] != d2[order][:-1])])
    node = order[new]
    table = PerfectHash(d1[node], d2[node])
    slot = table.slots(d1, d2)
    if (slot < 0).any():
        raise ValueError("a slot holds another digest than its key")
    size = len(node)
    at = slot[node]
    depth, word, up1, up2 = (np.empty(size, np.int64) for _ in range(4))
    depth[at], word[at], up1[at], up2[at] = pos[node], words[node], p1[node], p2[node]
    parent = table.slots(up1, up2)
    convs = np.bincount(slot, minlength=size)
    owner = np.full(size, np.iinfo(np.int64).max)
    np.minimum.at(owner, slot, conv)
    inner = parent >= 0
    children = np.bincount(parent[inner], minlength=size)
    leaves, saved = (children == 0).astype(np.int64), (convs - 1) * word
    deep = np.argsort(-depth, kind="stable")
    deep = deep[inner[deep]]
    for level in np.split(deep, np.flatnonzero(np.diff(depth[deep])) + 1) if len(deep) else []:
        np.add.at(leaves, parent[level], leaves[level])
        np.add.at(saved, parent[level], saved[level])
    ends = np.full(size, _sha256([]), object)
    last = np.flatnonzero(pos == n)
    last = last[np.lexsort((conv[last], slot[last]))]
    for some in np.split(last, np.flatnonzero(np.diff(slot[last])) + 1) if len(last) else []:
        ends[slot[some[0]]] = _sha256(conv[some].tolist())
    above = pd.Series(owner[parent], dtype="Int64").mask(~inner)
    return pd.DataFrame({"conv_id": owner, "pos": depth, "parent_conv_id": above, "p1": up1, "p2": up2, "n_convs": convs,
                         "n_children": children, "n_leaves": leaves, "saved": saved, "ends_sha256": ends, "top": ~inner})


# --------------------------------------------------------------- nodes above

def _ends(rows: DataFrame) -> DataFrame:
    """(pos, d1, d2, ends_sha256) of nodes from rows (pos, d1, d2, conv_id) of the
    conversations that end there: ids are sorted and joined in chunks by many tasks,
    a node's chunks then run through one digest, one at a time."""
    spark = rows.sparkSession
    laid = rows.repartitionByRange(buckets(spark), *NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id")

    def chunks(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(c).to_numpy() for c in NODE])
            conv = batch.column("conv_id").to_numpy()
            start = np.flatnonzero(np.concatenate([[True], (key[:, 1:] != key[:, :-1]).any(0)]))
            text = [",".join(map(str, x.tolist())) for x in np.split(conv, start[1:])]
            yield pa.RecordBatch.from_arrays([*(pa.array(k[start]) for k in key), pa.array(conv[start]), pa.array(text)],
                                             [*NODE, "conv_id", "ids"])

    def digests(batches):
        key, now = None, None
        for batch in batches:
            done = []
            for *k, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if k != key:
                    if key is not None:
                        done.append((*key, now.hexdigest()))
                    key, now = k, hashlib.sha256(ids.encode())
                else:
                    now.update(b"," + ids.encode())
            yield _batch(done)
        if key is not None:
            yield _batch([(*key, now.hexdigest())])

    def _batch(done):
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in done], pa.string() if i == 3 else pa.int64()) for i in range(4)], [*NODE, "ends_sha256"])

    node = "pos long, d1 long, d2 long"
    return (laid.select(*NODE, "conv_id").mapInArrow(chunks, f"{node}, conv_id long, ids string")
            .repartition(buckets(spark), *NODE).sortWithinPartitions(*NODE, "conv_id")
            .mapInArrow(digests, f"{node}, ends_sha256 string"))


def trie(turns: DataFrame, conversations: DataFrame, light_rows: int = LIGHT_ROWS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per distinct prefix, from ``turns`` (conv_id, pos from 1, t1, t2, words) and
    ``conversations`` (conv_id, n: its number of turns, which may be 0): conv_id (its
    smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256. No conversation, no row."""
    spark = turns.sparkSession
    t = turns.withColumns({"d1": F.xxhash64("t1", "pos"), "d2": F.xxhash64("t2", "pos", F.lit(1))})
    t = t.withColumns({"x1": F.col("d1"), "x2": F.col("d2")})
    pre = running(t, "conv_id", [F.col("pos")], [F.col("pos")], [], ["d1", "d2"], ["conv_id", "pos", "words", "x1", "x2"], "prefixes")
    zero = F.lit(0).cast("long")
    pre = pre.withColumns({"p1": F.col("d1").bitwiseXOR(F.col("x1")), "p2": F.col("d2").bitwiseXOR(F.col("x2"))}).drop("x1", "x2")
    root = conversations.select("conv_id", "n", *(zero.alias(c) for c in ("pos", "words", "d1", "d2", "p1", "p2")))
    rows = stored(pre.join(conversations, "conv_id").unionByName(root), "trie-rows")

    # the cut: nodes whose subtrees hold too many prefixes for a task, or too large a part of what one gets, and the root
    total = rows.count()
    n_shards = max(buckets(spark), -(-total // shard_rows))
    light_rows = min(light_rows, max(LEAST_ROWS, total // (4 * n_shards)))
    heavy = rows.groupBy(*NODE).agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("owner"), F.max("words").alias("words"), F.max("p1").alias("p1"),
        F.max("p2").alias("p2"), F.sum(F.col("n") - F.col("pos") + 1).alias("prefixes"))
    heavy = stored(heavy.where((F.col("prefixes") > light_rows) | (F.col("pos") == 0)), "heavy-nodes")
    own = heavy.select(*NODE, "owner", ((F.col("n_convs") - 1) * F.col("words")).alias("worth"))
    rows = stored(rows.join(own, NODE, "left"), "marked-rows")
    light, above = rows.where("owner is null"), rows.where("owner is not null")

    # subtrees below the cut, each whole in one task
    tops = light.groupBy("conv_id").agg(F.min(F.struct(*NODE)).alias("top"))
    dealt = light.join(tops, "conv_id").withColumn("shard", F.pmod(F.xxhash64("top.d1", "top.d2"), F.lit(n_shards)))
    dealt = dealt.select("shard", "conv_id", "pos", "n", "words", "d1", "d2", "p1", "p2")
    below = stored(dealt.groupBy("shard").applyInPandas(_shard, _SHARD), "shards")
    top = below.where("top")

    # nodes above the cut
    up = [(F.col("pos") - 1).alias("pos"), F.col("p1").alias("d1"), F.col("p2").alias("d2")]
    children = (heavy.where("pos > 0").select(*up).unionByName(top.select(*up))
                .groupBy(*NODE).agg(F.count("*").alias("n_children")))
    heavy = stored(heavy.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", zero)), "heavy-nodes")
    barren = heavy.where("n_children = 0").select(*NODE, F.lit(1).cast("long").alias("leaf"))
    mine = F.col("conv_id") == F.col("owner")
    along = above.join(barren, NODE, "left").select(
        "conv_id", *NODE, F.when(mine, F.col("worth")).otherwise(zero).alias("saved"),
        F.when(mine, F.coalesce("leaf", zero)).otherwise(zero).alias("leaves"))
    ended = top.select("conv_id", "pos", zero.alias("d1"), zero.alias("d2"), "saved", F.col("n_leaves").alias("leaves"))
    both = along.withColumn("node", F.lit(True)).unionByName(ended.withColumn("node", F.lit(False)))
    deep = F.col("pos").desc()
    sums = running(both, "conv_id", [deep], [deep], ["saved", "leaves"], [], ["conv_id", *NODE, "node"], "sums")
    sums = sums.where("node").groupBy(*NODE).agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("n_leaves"))
    ends = _ends(above.where("pos = n").select(*NODE, "conv_id"))
    parents = heavy.select((F.col("pos") + 1).alias("pos"), F.col("d1").alias("p1"), F.col("d2").alias("p2"), F.col("owner").alias("parent_conv_id"))
    over = (heavy.join(sums, NODE).join(ends, NODE, "left").join(parents, ["pos", "p1", "p2"], "left")
            .withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256))).withColumnRenamed("owner", "conv_id"))
    cols = ["conv_id", "pos", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", "ends_sha256"]
    out = (over.select(cols).unionByName(below.where("not top").select(cols))
           .unionByName(top.drop("parent_conv_id").join(parents, ["pos", "p1", "p2"]).select(cols)))
    return out.withColumnsRenamed({"pos": "depth", "saved": "saved_tokens"})


def prefix_trie(conversations: DataFrame, **more) -> DataFrame:
    """The trie of ``conversations`` (conv_id, turn, role, text) as they are; see ``numbered``
    and ``trie``. Repeated rows are turns of their own; other columns are ignored."""
    turns = numbered(conversations)
    return trie(turns, _ids(turns), **more)


def rebuilt_trie(conversations: DataFrame, **more) -> DataFrame:
    """The trie of the conversations that ``rebuilt`` makes of ``conversations``."""
    turns, convs = rebuilt(numbered(conversations))
    return trie(turns, convs, **more)
