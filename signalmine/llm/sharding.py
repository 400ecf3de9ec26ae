"""Shards in random order by a two-pass external shuffle.

Law ``key``: a document's id and the number of shards decide its shard, by the
highest of its seeded hashes, one per shard; one more shard takes documents only
into itself. The first pass scatters the rows of each shard by another seeded
hash into buckets of about ``BUCKET_BYTES``; the second reads one bucket at a
time, shuffles it (Fisher-Yates, seeded by shard and bucket) and writes it. A
row's slot is the number of rows in its shard's earlier buckets plus its place.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalmine.llm.common import stored
from signalmine.session import ensure_checkpoint_dir

SHARDS = 24
SEED = 8
BUCKET_BYTES = 16 << 20


def shard_of(key: Column, shards: int, seed: int = SEED) -> Column:
    """The shard with the highest hash of (seed, shard, key)."""
    rank = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)),
                       lambda s: F.struct(F.xxhash64(F.lit(seed), s, key).alias("h"), s.alias("s")))
    return F.array_max(rank)["s"]


def size_of(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED,
                 bucket_bytes: int = BUCKET_BYTES) -> None:
    """Write ``docs`` to ``path``: one folder ``_shard=N`` per shard, the columns
    of ``docs`` and ``_slot``. Rows with equal ids share a shard, null ids too.
    Identical rows are kept, each with a slot of its own."""
    total = docs.agg(F.sum(size_of(F.col("text")))).first()[0] or 0
    buckets = max(1, -(-int(total) // (shards * bucket_bytes)))
    dealt = docs.select(
        F.struct(*docs.columns).alias("doc"), shard_of(F.col("doc_id"), shards, seed).alias("_shard"),
        F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id", "text"), F.lit(buckets)).cast("int").alias("_bucket"))
    counts = dealt.groupBy("_shard", "_bucket").count()
    before = F.sum("count").over(Window.partitionBy("_shard").orderBy("_bucket")) - F.col("count")
    offsets = stored(counts.select("_shard", "_bucket", before.alias("_before")), "offsets")
    placed = dealt.join(offsets, ["_shard", "_bucket"]).select(
        "_shard", "_bucket", "_before", F.xxhash64("doc.doc_id", "doc.text").alias("_order"), "doc")

    def shuffled(rows: pa.Table) -> pa.Table:
        shard, bucket, before = (rows.column(c)[0].as_py() for c in ("_shard", "_bucket", "_before"))
        order = np.argsort(rows.column("_order").to_numpy(), kind="stable")
        order = order[np.random.default_rng([seed, shard, bucket]).permutation(len(order))]
        rows = rows.take(pa.array(order))
        slot = pa.array(before + np.arange(len(order), dtype=np.int64))
        return pa.table([rows.column("doc"), rows.column("_shard"), slot], ["doc", "_shard", "_slot"])

    schema = placed.select("doc", "_shard", F.col("_before").alias("_slot")).schema
    out = placed.groupBy("_shard", "_bucket").applyInArrow(shuffled, schema)
    out.select("doc.*", "_shard", "_slot").write.partitionBy("_shard").parquet(path)


def sharded(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, **how) -> DataFrame:
    """Write the shards under the shared folder and read them back: (doc_id,
    size, text_crc32, law, shard, slot, grown_shard) of every row.

    A null text has size 8 and checksum 0, as an empty one. An empty table gives
    no row."""
    spark = docs.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/shards-{uuid.uuid4().hex}"
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    write_shards(slim, path, shards, seed, **how)
    back = spark.read.schema("doc_id long, text string, _slot long, _shard int").parquet(path)
    return back.select(
        "doc_id", size_of(F.col("text")).alias("size"), F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.lit("key").alias("law"), F.col("_shard").alias("shard"), F.col("_slot").alias("slot"),
        shard_of(F.col("doc_id"), shards + 1, seed).alias("grown_shard"))
