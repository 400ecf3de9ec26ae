"""Repeated passages by a sparse suffix array.

Of each text only the suffixes at minimisers are retained: positions whose
``ANCHOR``-word prefix has the smallest hash of some window, so that every
passage of ``min_words`` words holds one, chosen by its content alone. The
suffixes are sorted by that prefix, bucket by bucket, and neighbours compared;
a suffix that equals a neighbour is an anchor. Each anchor is then extended left
and right in its whole text to the ``min_words``-word windows that hold it,
which are sorted and compared in the same way. Overlapping repeated windows join
to maximal passages. That finds every repeated window and no other (up to 64-bit
hashes).

Equal texts are one text here, and equal prefixes of one Arrow batch are sent as
one, so a passage in a third of all documents costs a row per batch.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalmine.llm.common import (U64, buckets, mix, packed, stored, text_steps, unpacked,
                                   window_hashes, word_hashes)

MIN_WORDS = 50
ANCHOR = 26

_MARKS = {"doc": np.int64, "pos": np.int32, "first": np.uint8}
_SENT = "kind int, bucket int, key binary, doc binary, pos binary, first binary"


def _slide(x: np.ndarray, n: int, fold) -> np.ndarray:
    """fold (minimum or maximum) of every n consecutive values."""
    have = 1
    while have * 2 <= n:
        x = fold(x[:-have], x[have:])
        have *= 2
    return fold(x[:len(x) - (n - have)], x[n - have:]) if n > have else x


def _minimisers(hashes: np.ndarray, min_words: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of the anchor-word prefix, position) of the retained suffixes of one text."""
    prefix = window_hashes(hashes, anchor)
    span = min_words - anchor + 1
    if len(prefix) < span:
        return prefix[:0], np.zeros(0, np.int64)
    low = _slide(prefix, span, np.minimum)
    edge = np.zeros(span - 1, U64)
    best = _slide(np.concatenate([edge, low, edge]), span, np.maximum)
    at = np.flatnonzero(best == prefix)
    return prefix[at], at


def _near(at: np.ndarray, n_words: int, min_words: int, anchor: int) -> np.ndarray:
    """Starts of the windows of a text that hold one of the anchors."""
    n = n_words - min_words + 1
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, np.clip(at - (min_words - anchor), 0, n), 1)
    np.add.at(change, np.clip(at + 1, 0, n), -1)
    return np.flatnonzero(np.cumsum(change[:-1]) > 0)


def _send(key: np.ndarray, doc: np.ndarray, pos: np.ndarray, n_buckets: int):
    """Of the occurrences of each key in this batch the first goes to the key's
    bucket (kind 0; first: 0 if it repeats here already); the others are known
    to repeat (kind 1)."""
    order = np.lexsort((pos, doc, key))
    key, doc, pos = key[order], doc[order], pos[order].astype(np.int32)
    head = np.concatenate([[True], key[1:] != key[:-1]])
    alone = head & np.concatenate([head[1:], [True]])
    bucket = (key % U64(n_buckets)).astype(np.int64)
    for kind, some, first in ((0, head, alone), (1, ~head, np.zeros(len(key), bool))):
        got = packed(bucket[some], n_buckets, {
            "key": key[some] if kind == 0 else np.zeros(some.sum(), "S1"), "doc": doc[some], "pos": pos[some],
            "first": first[some].astype(np.uint8)})
        if got is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.full(got.num_rows, kind, np.int32)), *got.columns],
                                             ["kind", *got.schema.names])


def _repeated(sent: DataFrame, n_buckets: int) -> DataFrame:
    """Packed (bucket of the text; doc, pos, first) of all keys that occur twice;
    first: it is the key's smallest (doc, pos)."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        heads, known = rows[rows["kind"] == 0], rows[rows["kind"] == 1]
        key = unpacked(heads, "key", U64)
        doc, pos, single = (unpacked(heads, c, t) for c, t in _MARKS.items())
        order = np.lexsort((pos, doc, key))
        key, doc, pos, single = key[order], doc[order], pos[order], single[order]
        out = [[unpacked(known, c, t) for c, t in _MARKS.items()]]
        if len(key):
            new = np.flatnonzero(np.concatenate(
                [[True], (key[1:] != key[:-1]) | (doc[1:] != doc[:-1]) | (pos[1:] != pos[:-1])]))
            single = np.minimum.reduceat(single, new)
            key, doc, pos = key[new], doc[new], pos[new]
            start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            size = np.diff(np.append(start, len(key)))
            again = np.repeat((size > 1) | (np.minimum.reduceat(single, start) == 0), size)
            first = np.zeros(len(key), np.uint8)
            first[start] = 1
            out.append([doc[again], pos[again], first[again]])
        doc, pos, first = (np.concatenate(x) for x in zip(*out, strict=True))
        got = packed(doc % n_buckets, n_buckets, {"doc": doc, "pos": pos, "first": first})
        return got.to_pandas() if got is not None else pd.DataFrame({"bucket": [], "doc": [], "pos": [], "first": []})

    return sent.groupBy("bucket").applyInPandas(run, "bucket int, doc binary, pos binary, first binary")


def _by_text(marks: pd.DataFrame):
    """(doc, positions, first flags) of each text, in order."""
    doc, pos, first = (unpacked(marks, c, t) for c, t in _MARKS.items())
    order = np.lexsort((first, pos, doc))
    doc, pos, first = doc[order], pos[order], first[order]
    if len(doc):
        # the same text in two batches: a position is no first once it is known not to be
        one = np.concatenate([[True], (doc[1:] != doc[:-1]) | (pos[1:] != pos[:-1])])
        doc, pos, first = doc[one], pos[one], first[one]
        start = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
        for lo, hi in zip(start, np.append(start[1:], len(doc)), strict=True):
            yield int(doc[lo]), pos[lo:hi], first[lo:hi]


def _merged(pos: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Union of the intervals [p, p + n) of sorted positions."""
    if not len(pos):
        return []
    cut = np.flatnonzero(pos[1:] > pos[:-1] + n)
    return list(zip(pos[np.concatenate([[0], cut + 1])].tolist(),
                    (pos[np.concatenate([cut, [len(pos) - 1]])] + n).tolist(), strict=True))


def passages(docs: DataFrame, min_words: int = MIN_WORDS, anchor: int = ANCHOR) -> DataFrame:
    """(text_id, drop, start_word, end_word) of the distinct texts of ``docs``:
    the maximal passages that occur at another place too (drop false), and the
    parts of them that aren't the first such place (drop true). ``text_id`` is
    ``xxhash64(text)``; first: by text_id and position."""
    if not 0 < anchor <= min_words:
        raise ValueError("anchor: 1 to min_words")
    spark = docs.sparkSession
    n_buckets = buckets(spark)
    texts = docs.where("text is not null").select(F.xxhash64("text").alias("doc"), "text")

    def retained(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy()
            parts, seen = [], set()
            for lo, hi, data, starts in text_steps(batch.column(1)):
                hashes, counts, _, _ = word_hashes(data, starts, lower=False)
                ends = np.cumsum(counts)
                for row in range(lo, hi):
                    if counts[row - lo] >= min_words and ids[row] not in seen:
                        seen.add(ids[row])
                        key, at = _minimisers(hashes[ends[row - lo] - counts[row - lo]:ends[row - lo]], min_words, anchor)
                        parts.append((key, np.full(len(key), ids[row]), at))
            if parts:
                yield from _send(*(np.concatenate(x) for x in zip(*parts, strict=True)), n_buckets)

    anchors = _repeated(texts.mapInArrow(retained, _SENT), n_buckets)

    def positions(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(doc, pos.tobytes()) for doc, pos, _ in _by_text(rows)], columns=["doc", "at"])

    wanted = stored(anchors.groupBy("bucket").applyInPandas(positions, "doc long, at binary"), "anchors")
    one_id = (docs.where("text is not null").select("doc_id", F.xxhash64("text").alias("doc"))
              .join(wanted, "doc").groupBy("doc").agg(F.min("doc_id").alias("doc_id")))
    wanted = one_id.join(wanted, "doc").select("doc", "at", F.col("doc_id").alias("wanted_id"))
    held = (docs.select("doc_id", "text").join(wanted, F.col("doc_id").eqNullSafe(F.col("wanted_id")))
            .where(F.xxhash64("text") == F.col("doc")).select("doc", "at", "text"))

    def extended(batches):
        for batch in batches:
            ids, anchored = batch.column(0).to_numpy(), batch.column(1)
            parts, seen = [], set()
            for lo, hi, data, starts in text_steps(batch.column(2)):
                hashes, counts, _, _ = word_hashes(data, starts, lower=False)
                ends = np.cumsum(counts)
                for row in range(lo, hi):
                    if ids[row] not in seen:
                        seen.add(ids[row])
                        h = hashes[ends[row - lo] - counts[row - lo]:ends[row - lo]]
                        at = np.frombuffer(anchored[row].as_py(), np.int32).astype(np.int64)
                        begin = _near(at, len(h), min_words, anchor)
                        parts.append((window_hashes(h, min_words)[begin], np.full(len(begin), ids[row]), begin))
            if parts:
                yield from _send(*(np.concatenate(x) for x in zip(*parts, strict=True)), n_buckets)

    windows = _repeated(held.mapInArrow(extended, _SENT), n_buckets)

    def joined(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for doc, pos, first in _by_text(rows):
            out += [(doc, False, *x) for x in _merged(pos, min_words)]
            out += [(doc, True, *x) for x in _merged(pos[first == 0], min_words)]
        return pd.DataFrame(out, columns=["text_id", "drop", "start_word", "end_word"])

    return windows.groupBy("bucket").applyInPandas(
        joined, "text_id long, drop boolean, start_word long, end_word long")


def _texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text_id, n_words) of every row with a text."""

    def run(batches):
        for batch in batches:
            n = np.zeros(batch.num_rows, np.int64)
            for lo, hi, data, starts in text_steps(batch.column(2)):
                n[lo:hi] = word_hashes(data, starts, lower=False)[1]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(n)], ["doc_id", "text_id", "n_words"])

    return docs.where("text is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_id"), "text").mapInArrow(
        run, "doc_id long, text_id long, n_words long")


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS, anchor: int = ANCHOR) -> DataFrame:
    """One row per document and maximal passage of at least ``min_words`` words
    that also occurs elsewhere (in another document, or at another place of its
    own): doc_id, start_word (from 0), n_words, n_drop_words (of these, words
    that a passage's first place keeps and this place loses).

    A text that another document repeats as a whole is one passage; of such
    copies the smallest doc_id is first. A repeated row (same id, same text) is
    the same document and no copy. Null, empty and short texts give no row.
    """
    texts = stored(_texts(docs), "texts")
    found = stored(passages(docs, min_words, anchor), "passages")
    copies = (texts.where(F.col("n_words") >= min_words).groupBy("text_id", "n_words")
              .agg(F.countDistinct(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("copies"),
                   F.min("doc_id").alias("first_id")))
    lost = (found.where("drop").alias("d").join(found.where("not drop").alias("s"), "text_id")
            .where("d.start_word >= s.start_word and d.end_word <= s.end_word")
            .groupBy("text_id", F.col("s.start_word").alias("start_word"))
            .agg(F.sum(F.col("d.end_word") - F.col("d.start_word")).alias("lost")))
    spans = (found.where("not drop").join(lost, ["text_id", "start_word"], "left")
             .select("text_id", "start_word", (F.col("end_word") - F.col("start_word")).alias("n_words"),
                     F.coalesce("lost", F.lit(0)).alias("n_drop_words")))
    whole = copies.where("copies > 1")
    inner = spans.groupBy("text_id").agg(F.sum("n_drop_words").alias("lost"))
    whole = whole.join(inner, "text_id", "left").select(
        "text_id", F.lit(0).cast("long").alias("start_word"), "n_words", "first_id",
        F.coalesce("lost", F.lit(0)).alias("n_drop_words"))
    parts = spans.join(whole, "text_id", "left_anti").withColumn("first_id", F.lit(None).cast("long"))
    every = whole.unionByName(parts)
    ids = texts.select("doc_id", "text_id").distinct()
    return ids.join(every, "text_id").select(
        "doc_id", "start_word", "n_words",
        F.when(F.col("first_id").isNull() | F.col("doc_id").eqNullSafe(F.col("first_id")), F.col("n_drop_words"))
        .otherwise(F.col("n_words")).cast("long").alias("n_drop_words"))


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS, anchor: int = ANCHOR) -> DataFrame:
    """``docs`` with the words of repeated passages cut out of all places but the
    first (``n_chars``, if there, follows). A document that loses all its words
    goes; all others stay, texts without repeats unchanged to the byte."""
    found = stored(passages(docs, min_words, anchor), "passages")
    cuts = found.where("drop").groupBy("text_id").agg(
        F.sort_array(F.collect_list(F.struct("start_word", "end_word"))).alias("cuts"))
    ids = docs.where("text is not null").select("doc_id", F.xxhash64("text").alias("text_id"))
    copied = (ids.groupBy("text_id").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
              .where("first_id < last_id").select("text_id", "first_id"))
    named = (ids.distinct().join(copied, "text_id", "left").join(cuts, "text_id", "left")
             .where("cuts is not null or first_id is not null")
             .select(F.col("doc_id").alias("cut_id"), "text_id", "cuts",
                     F.coalesce(F.col("first_id") != F.coalesce("doc_id", F.lit(-1) - F.abs("first_id")),
                                F.lit(False)).alias("copy")))
    named = stored(named, "cuts")
    fields = [c for c in docs.columns if c != "text"]
    row = docs.join(named, F.col("doc_id").eqNullSafe(F.col("cut_id"))
                    & (F.xxhash64("text") == F.col("text_id")), "left")
    row = row.select(F.struct(*fields).alias("_rest"), "text", "cuts", "copy")

    def run(batches):
        for batch in batches:
            out = batch.column(1).to_pylist()
            cuts, copy = batch.column(2), batch.column(3).to_pylist()
            keep = np.ones(batch.num_rows, bool)
            for lo, hi, data, starts in text_steps(batch.column(1)):
                if cuts.slice(lo, hi - lo).null_count == hi - lo and True not in copy[lo:hi]:
                    continue
                _, counts, begin, end = word_hashes(data, starts, lower=False)
                stop = np.cumsum(counts)
                for row in range(lo, hi):
                    n = int(counts[row - lo])
                    if copy[row] and n >= min_words:
                        keep[row] = False
                        continue
                    if (spans := cuts[row].as_py()) is None:
                        continue
                    b = np.append(begin[stop[row - lo] - n:stop[row - lo]], starts[row - lo + 1])
                    at, parts = int(starts[row - lo]), []
                    for span in spans:
                        parts.append(data[at:b[span["start_word"]]].tobytes())
                        at = int(b[span["end_word"]])
                    parts.append(data[at:starts[row - lo + 1]].tobytes())
                    out[row] = b"".join(parts).decode()
                    keep[row] = bool(out[row].strip(" \t\n\x0b\x0c\r"))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())],
                                             ["_rest", "text"]).filter(pa.array(keep))

    schema = row.select("_rest", "text").schema
    done = row.mapInArrow(run, schema).select(
        *[F.col("_rest")[c].alias(c) if c != "text" else F.col("text") for c in docs.columns])
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        done = done.withColumn("n_chars", F.length("text").cast(kind)).select(*docs.columns)
    return done
