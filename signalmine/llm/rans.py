"""Token ids as static range-asymmetric-numeral-system (rANS) files.

Texts are encoded in ascending order of doc_id, an end id after each. All ids
are counted first; the counts, scaled to 2**SCALE, are the frequency table that
all blocks share. A block holds whole documents, about ``BLOCK`` ids (more only
if one document has more), and is coded on its own: ``LANES`` interleaved coder
states, so that a step codes or decodes LANES ids at once, the 32-bit words that
they shed, a checksum of its ids, and every ``CHECKPOINT`` steps a checkpoint
(states and place in the words) from which decoding can start.

A written corpus is a folder: ``model`` (id, frequency), ``blocks`` (one row per
block, a folder per part of the order; see BLOCKS) and ``parts`` (part, ids
before it). Parts and blocks are read and decoded in any order, in parallel.
"""

from __future__ import annotations

import os
import uuid
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from signalmine.llm.common import U64, _powers, buckets, mix, text_steps
from signalmine.session import ensure_checkpoint_dir

SCALE = 20
LANES = 4096
BLOCK = 1 << 20
CHECKPOINT = 64
END = 0
CACHED = 500_000   # pieces of text in each of the two sets whose ids a worker remembers

_LOW = 1 << 31     # states are kept in [2**31, 2**63)

BLOCKS = ("seq long, start long, n_ids int, doc_ids array<bigint>, lengths binary, lanes int, states binary, "
          "words binary, checkpoints binary, crc32 long, part int")


# ------------------------------------------------------------------- coder

class Model:
    """Frequencies (id -> 1..2**SCALE, summing to 2**SCALE) ready for numpy."""

    def __init__(self, ids: np.ndarray, freqs: np.ndarray):
        size = int(ids.max()) + 1 if len(ids) else 1
        self.freq, self.cum = np.zeros(size, np.uint64), np.zeros(size, np.uint64)
        self.freq[ids] = freqs
        self.cum[1:] = np.cumsum(self.freq)[:-1]
        self.ids, self._slots = ids, None

    @property
    def slots(self) -> np.ndarray:
        if self._slots is None:
            self._slots = np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq.astype(np.int64))
        return self._slots


def scaled(counts: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Counts (all above 0) as frequencies of at least 1 that sum to 2**scale;
    what rounding leaves goes to, or comes from, the largest."""
    if len(counts) > 1 << scale:
        raise ValueError("more ids than the scale has places")
    whole = 1 << scale
    total = int(counts.sum())
    freqs = np.array([max(1, int(c) * whole // total) for c in counts.tolist()], np.int64)
    order = np.lexsort((np.arange(len(counts)), -counts))
    left = whole - int(freqs.sum())
    if len(counts) and left > 0:
        freqs[order[0]] += left
    for i in order:
        if left >= 0:
            break
        cut = min(-left, int(freqs[i]) - 1)
        freqs[i] -= cut
        left += cut
    return freqs


def encode(ids: np.ndarray, model: Model, lanes: int = LANES, checkpoint: int = CHECKPOINT):
    """(lanes, states, words, checkpoints): id number i is coded by lane i % lanes."""
    lanes = max(1, min(lanes, len(ids)))
    x = np.full(lanes, _LOW, np.uint64)
    steps = -(-len(ids) // lanes)
    shed, counts, marks = [], np.zeros(steps, np.int64), []
    freq, cum = model.freq[ids], model.cum[ids]
    limit = freq << np.uint64(63 - SCALE)
    low, by, scale = np.uint64(0xFFFFFFFF), np.uint64(32), np.uint64(SCALE)
    for s in range(steps - 1, -1, -1):
        here = slice(s * lanes, min((s + 1) * lanes, len(ids)))
        f, y = freq[here], x[:here.stop - here.start]
        over = np.flatnonzero(y >= limit[here])
        full = y[over]
        shed.append((full & low).astype(np.uint32))
        counts[s] = len(over)
        y[over] = full >> by
        q = y // f
        y[:] = (q << scale) + (y - q * f) + cum[here]
        if s and s % checkpoint == 0:
            marks.append((s, x.copy()))
    words = np.concatenate(shed[::-1]) if shed else np.zeros(0, np.uint32)
    before = np.concatenate([[0], np.cumsum(counts)])
    kept = [np.concatenate([np.array([s, before[s]], np.uint64), states]) for s, states in reversed(marks)]
    return lanes, x, words, np.concatenate(kept) if kept else np.zeros(0, np.uint64)


def decode(n: int, lanes: int, states: np.ndarray, words: np.ndarray, model: Model,
           first_step: int = 0, last_step: int | None = None, place: int = 0) -> np.ndarray:
    """The n ids of a block, or those of steps first_step to last_step from the
    states and the place in the words that a checkpoint has."""
    steps = -(-n // lanes) if n else 0
    last_step = steps if last_step is None else min(last_step, steps)
    x = states.copy()
    out = np.zeros(max(0, min(last_step * lanes, n) - first_step * lanes), np.uint32)
    mask, scale, by = np.uint64((1 << SCALE) - 1), np.uint64(SCALE), np.uint64(32)
    slots, freq, cum, low = model.slots, model.freq, model.cum, np.uint64(_LOW)
    at = 0
    for s in range(first_step, last_step):
        m = min(lanes, n - s * lanes)
        y = x[:m]
        slot = y & mask
        t = slots[slot]
        out[at:at + m] = t
        at += m
        y[:] = freq[t] * (y >> scale) + slot - cum[t]
        need = np.flatnonzero(y < low)
        if len(need):
            y[need] = (y[need] << by) | words[place:place + len(need)]
            place += len(need)
    return out


def decode_from_checkpoints(n: int, lanes: int, states: np.ndarray, words: np.ndarray, checkpoints: np.ndarray,
                            model: Model) -> np.ndarray:
    """The n ids of a block: the stretches between checkpoints are decoded side by
    side, a step of each at once; the last, which may be shorter, by itself."""
    marks = checkpoints.reshape(-1, lanes + 2)
    if not len(marks):
        return decode(n, lanes, states, words, model)
    steps, last = int(marks[0, 0]), marks[-1]
    x = np.concatenate([states, marks[:-1, 2:].ravel()])
    place = np.concatenate([[0], marks[:-1, 1].astype(np.int64)])
    out = np.zeros((len(place), steps, lanes), np.uint32)
    mask, scale, by = np.uint64((1 << SCALE) - 1), np.uint64(SCALE), np.uint64(32)
    for s in range(steps):
        slot = x & mask
        t = model.slots[slot]
        out[:, s] = t.reshape(-1, lanes)
        x = model.freq[t] * (x >> scale) + slot - model.cum[t]
        need = np.flatnonzero(x < np.uint64(_LOW))
        many = np.diff(np.searchsorted(need, np.arange(len(place) + 1) * lanes))
        shed = np.concatenate([words[p:p + n] for p, n in zip(place.tolist(), many.tolist(), strict=True)])
        x[need] = (x[need] << by) | shed
        place += many
    return np.concatenate([out.ravel(), decode(n, lanes, last[2:], words, model, int(last[0]), None, int(last[1]))])


# --------------------------------------------------------------- tokenizing

class PieceEncoder:
    """Encodes texts with a byte-level BPE tokenizer, each piece once.

    No pre-token reaches over a space or line feed from a character before that isn't
    white space, nor over a full stop or comma from a letter or digit, and what stands
    on one side of such a place doesn't change how the other is cut. Texts are cut
    at all of these places and the pieces encoded apart.

    The pieces of a step of texts are found, named by two 64-bit hashes, made
    distinct, and replaced by their ids with numpy; only new ones meet the tokenizer.
    """

    # what a piece begins with, and the characters before it that allow the cut (fixed values)
    _SIGNS, _STOPS, _SOLID, _ALNUM = (np.zeros(256, bool) for _ in range(4))
    _SIGNS[[10, 32, 44, 46]] = True
    _STOPS[[44, 46]] = True
    _SOLID[:128] = True
    _SOLID[[*range(9, 14), *range(28, 33)]] = False
    _ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
    _HASHES = [(mix(np.arange(1, 257, dtype=U64) * U64(k)), k | 1) for k in (0xD1342543DE82EF95, 0xA0761D6478BD642F)]

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        tokens = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        # ids that begin with each sign a piece may begin with, as a byte-level vocabulary writes it
        self.first = {sign: np.array([t.startswith(written) for t in tokens])
                      for sign, written in ((" ", "\u0120"), ("\n", "\u010a"), (".", "."), (",", ","))}
        self.place, self.pool, self.table, self.check = {}, np.zeros(0, np.uint32), np.zeros((0, 2), np.int64), np.zeros(0, U64)
        self._reset()

    def _reset(self) -> None:
        """Start an empty set of pieces and keep the last one, so that pieces which come
        again needn't meet the tokenizer. place: of a piece's first hash; pool: ids of
        all pieces, end to end; a row of table per piece: where its ids begin and how
        many; check: its second hash."""
        self.last = (self.place, self.pool, self.table, self.check)
        self.place: dict[int, int] = {}
        self.pool, self.used = np.zeros(1 << 16, np.uint32), 0
        self.table, self.check = np.zeros((1 << 14, 2), np.int64), np.zeros(1 << 14, U64)

    def _recall(self, h1: list[int], h2: np.ndarray) -> None:
        """Take pieces of the last set into this one."""
        place, pool, table, check = self.last
        at = np.array([place[h] for h in h1], np.int64)
        if (check[at] != h2).any():
            raise ValueError("two pieces of one hash")  # one in 2**64 pairs
        of, size = table[at].T
        total = np.cumsum(size)
        self._add(pool[np.repeat(of - (total - size), size) + np.arange(int(total[-1]))], size, h1, h2)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _apart(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the pieces end to end, how many each has)."""
        ids = self._ids(pieces)
        return np.fromiter(chain.from_iterable(ids), np.uint32), np.fromiter(map(len, ids), np.int64, len(ids))

    def _words(self, sign: str, pieces: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """As ``_apart``, for pieces of the sign and letters or digits: many are encoded
        as one text, whose ids are cut where one begins with the sign."""
        out, first = [], self.first[sign]
        parts = [pieces[lo:lo + 1000] for lo in range(0, len(pieces), 1000)]
        for some, ids in zip(parts, self._ids(["".join(p) for p in parts]), strict=True):
            ids = np.array(ids, np.uint32)
            cut = np.flatnonzero(first[ids])
            out.append((ids, np.diff(np.append(cut, len(ids)))) if len(cut) == len(some) else self._apart(some))
        return out

    def _learn(self, pieces: list[str], h1: list[int], h2: np.ndarray) -> None:
        alike: dict[str, list[int]] = {sign: [] for sign in self.first}
        rest = []
        for i, p in enumerate(pieces):
            (alike[p[0]] if p[1:].isalnum() and p[0] in alike else rest).append(i)
        got = [self._apart([pieces[i] for i in rest])]
        for sign, some in alike.items():
            got += self._words(sign, [pieces[i] for i in some])
        order = [*rest, *chain.from_iterable(alike.values())]
        new, size = (np.concatenate(x) for x in zip(*got, strict=True))
        self._add(new, size, [h1[i] for i in order], h2[order])

    def _add(self, new: np.ndarray, size: np.ndarray, h1: list[int], h2: np.ndarray) -> None:
        n, more = len(self.place), len(size)
        if n + more > len(self.table):
            grown = max(len(self.table) * 2, n + more) - len(self.table)
            self.table = np.concatenate([self.table, np.zeros((grown, 2), np.int64)])
            self.check = np.concatenate([self.check, np.zeros(grown, U64)])
        if self.used + len(new) > len(self.pool):
            self.pool = np.concatenate([self.pool[:self.used], np.zeros(max(self.used, len(new)) + len(new), np.uint32)])
        self.pool[self.used:self.used + len(new)] = new
        self.table[n:n + more] = np.stack([self.used + np.cumsum(size) - size, size], 1)
        self.check[n:n + more] = h2
        self.place.update(zip(h1, range(n, n + more), strict=True))
        self.used += len(new)

    def _cuts(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Where the pieces begin."""
        at = np.flatnonzero(self._SIGNS[data])
        at = at[at > 0]
        before = data[at - 1]
        good = np.where(self._STOPS[data[at]], self._ALNUM[before], self._SOLID[before])
        wide = np.flatnonzero(before >= 0x80)
        if len(wide):  # the last character before, if it isn't ASCII
            end = at[wide]
            n = np.select([data[end - 2] >= 0xC0, data[end - 3] >= 0xE0], [2, 3], 4)
            code = sum(np.where(n > k, data[end - 1 - k].astype(np.int64) << 8 * k, 0) for k in range(4))
            kinds, which = np.unique(code, return_inverse=True)
            letters = [int(k).to_bytes(4, "big").lstrip(b"\0").decode(errors="ignore")[-1:].isalnum() for k in kinds]
            good[wide] = np.array(letters)[which]
        cut = np.zeros(len(data), bool)
        cut[at[good]] = True
        cut[starts[:-1][starts[:-1] < len(data)]] = True
        return np.flatnonzero(cut)

    def step(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts end to end, how many each has) of texts laid end to end in
        ``data`` (bytes); ``starts`` has each text's first byte plus the end."""
        n_texts = len(starts) - 1
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(n_texts, np.int64)
        if len(self.place) > CACHED:
            self._reset()
        begin = self._cuts(data, starts)
        length = np.diff(np.append(begin, len(data)))
        within = np.arange(len(data)) - np.repeat(begin, length)
        h1, h2 = (mix(np.add.reduceat(table[data] * _powers(base, int(length.max()))[within], begin) + length.astype(U64))
                  for table, base in self._HASHES)
        keys, at, which = np.unique(h1, return_index=True, return_inverse=True)
        keys = keys.tolist()
        new = [i for i, k in enumerate(keys) if k not in self.place]
        if known := [i for i in new if keys[i] in self.last[0]]:
            self._recall([keys[i] for i in known], h2[at[known]])
            new = [i for i in new if keys[i] not in self.place]
        if new:
            lo, hi = begin[at[new]].tolist(), (begin + length)[at[new]].tolist()
            raw = data.tobytes()
            self._learn([raw[a:b].decode() for a, b in zip(lo, hi, strict=True)], [keys[i] for i in new], h2[at[new]])
        piece = np.fromiter(map(self.place.__getitem__, keys), np.int64, len(keys))[which]
        if (self.check[piece] != h2).any():
            raise ValueError("two pieces of one hash")  # one in 2**64 pairs
        of, size = self.table[piece].T
        total = np.cumsum(size)
        ids = self.pool[np.repeat(of - (total - size), size) + np.arange(int(total[-1]))]
        text = np.searchsorted(starts, begin, "right") - 1
        return ids, np.bincount(text, size, n_texts).astype(np.int64)

    def __call__(self, texts: list[str]) -> list[bytes]:
        out = []
        for _, _, data, starts in text_steps(pa.array(texts, pa.string())):
            ids, counts = self.step(data, starts)
            out += [x.tobytes() for x in np.split(ids, np.cumsum(counts)[:-1])]
        return out


_ENCODERS: dict[str, PieceEncoder] = {}


def _encoder(path: str) -> PieceEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def _tokenized(docs: DataFrame, tokenizer: str, end: int) -> DataFrame:
    """(part, seq, start, doc_id, ids): documents in ascending order over the
    parts; seq and start: documents and ids before it in its part."""
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = (ordered.withColumn("tie", F.xxhash64("text"))
               .repartitionByRange(buckets(docs.sparkSession), "doc_id", "tie")
               .sortWithinPartitions("doc_id", "tie").select("doc_id", "text"))

    def run(batches):
        code = _encoder(tokenizer)
        part, seq, start = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            for lo, hi, data, starts in text_steps(batch.column(1)):
                ids, n = code.step(data, starts)
                ids = np.insert(ids, np.cumsum(n), end)
                n += 1
                ends = np.cumsum(n)
                narrow = np.maximum.reduceat(ids, ends - n) < 1 << 16
                small, ids = ids.astype(np.uint16).tobytes(), ids.tobytes()
                packed = [small[2 * a:2 * b] if few else ids[4 * a:4 * b]
                          for few, a, b in zip(narrow.tolist(), (ends - n).tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(hi - lo, part, np.int32)), pa.array(np.arange(seq, seq + hi - lo)), pa.array(start + ends - n),
                     batch.column(0).slice(lo, hi - lo), pa.array(n), pa.array(packed, pa.binary())],
                    ["part", "seq", "start", "doc_id", "n", "ids"])
                seq, start = seq + hi - lo, start + int(ends[-1])

    return ordered.mapInArrow(run, "part int, seq long, start long, doc_id long, n long, ids binary")


def _wide(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, np.uint16).astype(np.uint32) if len(raw) == 2 * n else np.frombuffer(raw, np.uint32)


# ------------------------------------------------------------------- files

def write_corpus(docs: DataFrame, path: str, tokenizer: str, end: int = END) -> None:
    """Tokenize ``docs`` (doc_id, text) and write the folder ``path``. Null text:
    the end id alone. Null ids come first; ties go by the text's hash."""
    spark = docs.sparkSession
    temporary = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    tokens = _tokenized(docs, tokenizer, end)
    tokens.write.option("compression", "zstd").parquet(temporary)
    tokens = spark.read.schema(tokens.schema).parquet(temporary)

    def count(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            n, raw = batch.column(1).to_numpy(), batch.column(0)
            narrow = pc.binary_length(raw).to_numpy() == 2 * n
            for some, kind in ((narrow, np.uint16), (~narrow, np.uint32)):
                got = np.bincount(np.frombuffer(b"".join(raw.filter(pa.array(some)).to_pylist()), kind))
                if len(got) > len(total):
                    total = np.concatenate([total, np.zeros(len(got) - len(total), np.int64)])
                total[:len(got)] += got
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["id", "n"])

    # at most one row per id of the vocabulary
    counted = tokens.select("ids", "n").mapInArrow(count, "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))
    counted = sorted((r.id, r.n) for r in counted.collect())
    ids = np.array([i for i, _ in counted], np.int64)
    freqs = scaled(np.array([n for _, n in counted], np.int64)) if counted else ids
    spark.createDataFrame([(int(i), int(f)) for i, f in zip(ids, freqs, strict=True)], "id int, frequency int").coalesce(
        1).write.parquet(f"{path}/model")

    parts = tokens.groupBy("part").agg(F.sum("n").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts.select("part", before.alias("before")).write.parquet(f"{path}/parts")

    shared = spark.sparkContext.broadcast((ids, freqs))

    def blocks(batches):
        model = Model(*shared.value)
        held, meta, size = [], [], 0

        def block():
            all_ids = np.concatenate(held)
            lanes, states, words, marks = encode(all_ids, model)
            part, seq, start = meta[0][:3]
            return pa.RecordBatch.from_arrays([
                pa.array([seq]), pa.array([start]), pa.array([len(all_ids)], pa.int32()),
                pa.array([[m[3] for m in meta]], pa.list_(pa.int64())),
                pa.array([np.array([len(h) for h in held], np.uint32).tobytes()], pa.binary()),
                pa.array([lanes], pa.int32()), pa.array([states.tobytes()], pa.binary()),
                pa.array([words.tobytes()], pa.binary()), pa.array([marks.tobytes()], pa.binary()),
                pa.array([zlib.crc32(all_ids.tobytes())]), pa.array([part], pa.int32())],
                ["seq", "start", "n_ids", "doc_ids", "lengths", "lanes", "states", "words", "checkpoints", "crc32", "part"])

        for batch in batches:
            for row in batch.to_pylist():
                follows = meta and (row["part"], row["seq"]) == (meta[-1][0], meta[-1][1] + 1)
                if meta and (not follows or size + row["n"] > BLOCK):
                    yield block()
                    held, meta, size = [], [], 0
                held.append(_wide(row["ids"], row["n"]))
                meta.append((row["part"], row["seq"], row["start"], row["doc_id"]))
                size += row["n"]
        if meta:
            yield block()

    tokens.mapInArrow(blocks, BLOCKS).write.partitionBy("part").parquet(f"{path}/blocks")


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document of a written corpus;
    ids: little-endian unsigned 32-bit. A block that fails its checksum is an
    error."""
    pairs = spark.read.schema("id int, frequency int").parquet(f"{path}/model").orderBy("id").toPandas()
    shared = spark.sparkContext.broadcast((pairs["id"].to_numpy(np.int64), pairs["frequency"].to_numpy(np.int64)))
    parts = spark.read.schema("part int, before long").parquet(f"{path}/parts")

    def run(batches):
        model = Model(*shared.value)
        for batch in batches:
            for row in batch.to_pylist():
                ids = decode_from_checkpoints(row["n_ids"], row["lanes"], np.frombuffer(row["states"], np.uint64),
                                              np.frombuffer(row["words"], np.uint32),
                                              np.frombuffer(row["checkpoints"], np.uint64), model)
                if zlib.crc32(ids.tobytes()) != row["crc32"]:
                    raise ValueError(f"block {row['part']}/{row['seq']}: checksum differs")
                n = np.frombuffer(row["lengths"], np.uint32).astype(np.int64)
                ends = np.cumsum(n)
                for lo in range(0, len(n), 256):
                    some = slice(lo, lo + 256)
                    raw = [ids[e - k:e].tobytes() for k, e in zip(n[some], ends[some], strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(raw), row["part"], np.int32)), pa.array(row["doc_ids"][some], pa.int64()),
                         pa.array(row["start"] + ends[some] - n[some]), pa.array(n[some]), pa.array(raw, pa.binary())],
                        ["part", "doc_id", "start", "n_tokens", "ids"])

    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    docs = blocks.select("seq", "n_ids", "start", "doc_ids", "lengths", "lanes", "states", "words", "checkpoints", "crc32", "part")
    docs = docs.mapInArrow(run, "part int, doc_id long, start long, n_tokens long, ids binary")
    return docs.join(parts, "part").select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids")


def round_trip(docs: DataFrame, tokenizer: str, end: int = END) -> DataFrame:
    """Write ``docs`` under the shared folder and read it back: (doc_id, start,
    n_tokens, ids_crc32)."""
    spark = docs.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    write_corpus(docs, path, tokenizer, end)
    return read_corpus(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
