"""Benchmark decontamination by Wu-Manber multi-pattern search.

A test string is a window of ``WINDOW`` consecutive words of a benchmark item (an
item of fewer words is one test string). The alphabet of the search is words:
texts and test strings are lower-cased (A-Z), cut into words and every word
hashed. Test strings of one length m share three tables:

* the shift table: for each block of two words, how far the end of a test string
  is at least away, so that a text position whose block occurs in no test string
  is passed with the m - 2 after it;
* the suffix-hash buckets: at shift 0 the test strings whose last block is the
  text's (and, within the bucket, whose first block is too) are selected;
* the test strings themselves, which are compared word by word with the text.

Texts are cut into segments that advance together, one numpy step for all of
them. The test strings are dealt into blocks of bounded size; each block is
broadcast and searched for in all documents, so the benchmark may grow.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalmine.llm.common import U64, _BASE, mix, stored, text_steps, word_hashes

WINDOW = 10
BLOCK_STRINGS = 200_000     # test strings that are searched for at once, and
BLOCK_BYTES = 32 << 20      # their bytes: the size of one broadcast
SEGMENT = 128               # text positions that one lane of a step covers
PAIRS = 1 << 18             # pairs of a position and a test string compared at once

# Characters that aren't part of a word (fixed values): U+0000 to U+002F, U+003A to U+0060, U+007B to U+007F.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPACED = np.arange(256, dtype=np.uint8)
_SPACED[65:91] += 32
_SPACED[[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = 32


# ----------------------------------------------------------------- test strings

def test_strings(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id string, string_id, words): the distinct test strings of each item, words
    joined by a space. Items without an id or without words have none."""
    lowered = F.translate(F.coalesce("text", F.lit("")), _UPPER, _LOWER)
    ws = items.where("item_id is not null").select(
        F.col("item_id").cast("string").alias("item_id"), F.regexp_extract_all(lowered, F.lit(WORD), 0).alias("ws"))
    last = F.greatest(F.size("ws") - window, F.lit(0))
    out = ws.where(F.size("ws") > 0).select("item_id", F.explode(F.transform(
        F.sequence(F.lit(0), last), lambda i: F.array_join(F.slice("ws", i + 1, F.lit(window)), " "))).alias("words"))
    return out.distinct().withColumn("string_id", F.xxhash64("words"))


def _blocks(strings: DataFrame, most: int, most_bytes: int) -> Iterator[pd.DataFrame]:
    """The blocks of distinct test strings (string_id, words), each about
    half of the two bounds; one block at a time is on the driver."""
    once = stored(strings.select("string_id", "words").dropDuplicates(["words"]), "strings")
    size = once.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("words")), F.lit(0)).alias("b")).first()
    n = max(1, -(-2 * size.n // most), -(-2 * size.b // most_bytes)) if 2 * size.n > most or 2 * size.b > most_bytes else 1
    for i in range(n):
        yield once.where(F.pmod("string_id", F.lit(n)) == i).toPandas()


def _block(hashes: np.ndarray, last: np.ndarray, width: int) -> np.ndarray:
    """Hash of the block of ``width`` (1 or 2) words that ends at each place."""
    return mix(hashes[last - 1] * U64(_BASE) + hashes[last]) if width == 2 else hashes[last]


def search_tables(ids, strings: list[bytes]) -> list[dict]:
    """For each length of test strings in words: shift table, buckets, strings."""
    if not len(strings):
        return []
    starts = np.cumsum([0, *(len(s) for s in strings)])
    hashes, counts, _, _ = word_hashes(np.frombuffer(b"".join(strings), np.uint8), starts, lower=False)
    begin = np.cumsum(counts) - counts
    tables = []
    for m in np.unique(counts).tolist():
        which = np.flatnonzero(counts == m)
        width = min(2, m)
        size = 1 << max(10, min(23, int(16 * len(which) * m - 1).bit_length()))
        shift = np.full(size, m - width + 1, np.int32)
        for j in range(width - 1, m):
            np.minimum.at(shift, (_block(hashes, begin[which] + j, width) & U64(size - 1)).astype(np.int64), m - 1 - j)
        key = _bucket(hashes, begin[which] + m - 1, m, width)
        order = np.argsort(key, kind="stable")
        tables.append({"m": m, "width": width, "shift": shift, "key": key[order],
                       "id": np.asarray(ids, np.int64)[which][order], "string": [strings[i] for i in which[order]]})
    return tables


def _bucket(hashes: np.ndarray, end: np.ndarray, m: int, width: int) -> np.ndarray:
    """The bucket of the test string of m words that ends at each place: suffix, then prefix."""
    return mix(_block(hashes, end, width) * U64(_BASE) + _block(hashes, end - m + width, width))


# ----------------------------------------------------------------------- search

def _at_shift_0(table: dict, hashes: np.ndarray, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Places of the texts [first, stop) where a test string may end."""
    m, width, shift = table["m"], table["width"], table["shift"]
    lo = first + m - 1
    some = lo < stop
    lo, stop = lo[some], stop[some]
    n = -(-(stop - lo) // SEGMENT)
    lane = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    at = np.repeat(lo, n) + lane * SEGMENT
    stop = np.minimum(at + SEGMENT, np.repeat(stop, n))
    found = []
    while len(at):
        jump = shift[(_block(hashes, at, width) & U64(len(shift) - 1)).astype(np.int64)]
        here = jump == 0
        if here.any():
            found.append(at[here])
        at = at + np.maximum(jump, 1)
        going = at < stop
        at, stop = at[going], stop[going]
    return np.sort(np.concatenate(found)) if found else np.zeros(0, np.int64)


def occurrences(tables: list[dict], low: np.ndarray, hashes: np.ndarray, counts: np.ndarray, begin: np.ndarray,
                end: np.ndarray):
    """(first word, word after the last, id) arrays of all occurrences of test strings
    in texts laid end to end; words are counted from the first text's first."""
    stop = np.cumsum(counts)
    out = []
    for table in tables:
        m = table["m"]
        at = _at_shift_0(table, hashes, stop - counts, stop)
        for part in range(0, len(at), PAIRS):
            places = at[part:part + PAIRS]
            key = _bucket(hashes, places, m, table["width"])
            left = np.searchsorted(table["key"], key, "left")
            n = np.searchsorted(table["key"], key, "right") - left
            for p, lo, k in zip(places[n > 0].tolist(), left[n > 0].tolist(), n[n > 0].tolist(), strict=True):
                text = b" ".join(low[begin[p - m + 1]:end[p]].tobytes().split())
                out += [(p - m + 1, p + 1, table["id"][i]) for i in range(lo, lo + k) if table["string"][i] == text]
    return np.array(out, np.int64).reshape(-1, 3).T


def _scanned(docs: DataFrame, tables: list[dict]) -> DataFrame:
    """(doc_id, text_key, n_words, n_hit, spans, found) of every row: spans has first word
    and word after the last of each joined hit, one after the other; found, the ids of
    the test strings found."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(tables)
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            n_words = np.zeros(batch.num_rows, np.int64)
            n_hit, spans, found = np.zeros(batch.num_rows, np.int64), [[]] * batch.num_rows, [[]] * batch.num_rows
            for lo, hi, data, starts in text_steps(batch.column(2)):
                low = _SPACED[data]
                hashes, counts, begin, end = word_hashes(low, starts, lower=False)
                n_words[lo:hi] = counts
                first, stop, ids = occurrences(shared.value, low, hashes, counts, begin, end)
                if not len(first):
                    continue
                ends = np.cumsum(counts)
                row = np.searchsorted(ends, first, "right")
                order = np.lexsort((first, row))
                cuts = np.flatnonzero(np.diff(row[order])) + 1
                for some in np.split(order, cuts):
                    r = int(row[some[0]])
                    base = ends[r] - counts[r]
                    got = _joined(first[some] - base, stop[some] - base)
                    n_hit[lo + r] = np.diff(got, axis=1).sum()
                    spans[lo + r] = got.ravel().tolist()
                    found[lo + r] = np.unique(ids[some]).tolist()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(n_words), pa.array(n_hit), pa.array(spans, pa.list_(pa.int64())),
                 pa.array(found, pa.list_(pa.int64()))], ["doc_id", "text_key", "n_words", "n_hit", "spans", "found"])

    return rows.mapInArrow(run, f"doc_id {kind}, text_key long, n_words long, n_hit long, spans array<long>, found array<long>")


def _joined(first: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Union of the spans [first, stop), as rows (first, stop)."""
    order = np.argsort(first, kind="stable")
    first, reach = first[order], np.maximum.accumulate(stop[order])
    new = np.flatnonzero(np.concatenate([[True], first[1:] > reach[:-1]]))
    return np.stack([first[new], reach[np.append(new[1:], len(first)) - 1]], 1).astype(np.int64)


def _over_blocks(scans: list[DataFrame]) -> DataFrame:
    """One scan from those of several blocks of test strings: equal texts have equal
    hits, so the later scans bring a row for each text that they hit."""
    def united(rows: pd.DataFrame) -> pd.DataFrame:
        every = np.concatenate([np.asarray(x, np.int64) for x in rows["spans"]]).reshape(-1, 2)
        got = _joined(every[:, 0], every[:, 1])
        return pd.DataFrame({"hit_key": rows["text_key"].iloc[:1], "n_hit2": [np.diff(got, axis=1).sum()],
                             "spans2": [got.ravel()], "found2": [np.unique(np.concatenate(list(rows["found"])))]})

    rest = None
    for i, scan in enumerate(scans):
        some = scan.where("size(found) > 0").dropDuplicates(["text_key"]).select("text_key", "spans", "found", F.lit(i).alias("block"))
        rest = some if rest is None else rest.unionByName(some)
    hits = stored(rest.groupBy("text_key").applyInPandas(united, "hit_key long, n_hit2 long, spans2 array<long>, found2 array<long>"), "hits")
    base = scans[0]
    return base.join(hits, base["text_key"] == hits["hit_key"], "left").select(
        "doc_id", "text_key", "n_words", *(F.coalesce(c + "2", c).alias(c) for c in ("n_hit", "spans", "found")))


# --------------------------------------------------------------------- operator

def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, block_strings: int = BLOCK_STRINGS,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text) against ``items`` (item_id, text):
    doc_id, n_words, n_hit (words inside an occurrence of a window of an item), n_items
    (items with occurring windows), items_sha256 (of their ids as strings, sorted,
    comma-joined), contaminated, spans (first word and word after the last of each
    joined hit, one after the other).

    A null or empty text has no words and no hits. Rows and ids may repeat: each row is
    judged alone; rows of one item_id are one item. Items without an id take no part. An
    empty ``docs`` gives no rows, empty ``items`` no hits. Other columns are ignored.
    """
    strings = stored(test_strings(items, window), "test-strings")
    docs = docs.select("doc_id", "text")
    scans = [stored(_scanned(docs, search_tables(b["string_id"], [s.encode() for s in b["words"]])), "scan")
             for b in _blocks(strings, block_strings, block_bytes)]
    scan = scans[0] if len(scans) == 1 else stored(_over_blocks(scans), "scan")
    # documents that hold the same test strings share a list of items: made once, however many they are
    hit = scan.where("size(found) > 0").withColumn("set_key", F.xxhash64("found"))
    sets = hit.dropDuplicates(["set_key"]).select("set_key", F.explode("found").alias("string_id"))
    listed = sets.join(strings.select("string_id", "item_id"), "string_id").groupBy("set_key").agg(
        F.array_sort(F.collect_set("item_id")).alias("ids"))
    listed = stored(listed.select("set_key", F.size("ids").cast("long").alias("n_items"),
                                  F.sha2(F.array_join("ids", ","), 256).alias("items_sha256")), "item-lists")
    none = scan.where("size(found) = 0").withColumns(
        {"n_items": F.lit(0).cast("long"), "items_sha256": F.sha2(F.lit(""), 256)})
    cols = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", (F.col("n_hit") > 0).alias("contaminated"), "spans"]
    return none.select(cols).unionByName(hit.join(listed, "set_key").select(cols))
