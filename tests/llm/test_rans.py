import random
import uuid
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from signalmine.llm import rans as R
from signalmine.session import ensure_checkpoint_dir

SCHEMA = "doc_id long, text string, start string, ids string"
PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_coder():
    rng = np.random.default_rng(1)
    for n in (0, 1, 7, 1023, 1024, 1025, 5000, 300_000):
        ids = np.minimum(rng.zipf(1.3, n), 50_000).astype(np.int64) if n else np.zeros(0, np.int64)
        some, counts = np.unique(np.append(ids, [0, 65_535, 9]), return_counts=True)
        freqs = R.scaled(counts)
        assert freqs.min() >= 1 and freqs.sum() == 1 << R.SCALE
        model = R.Model(some, freqs)
        lanes, states, words, marks = R.encode(ids, model, checkpoint=16)
        assert (R.decode(n, lanes, states, words, model) == ids).all()
        assert (R.decode_from_checkpoints(n, lanes, states, words, marks, model) == ids).all()
        marks = marks.reshape(-1, lanes + 2)
        assert len(marks) == max(0, -(-(-(-n // lanes)) // 16) - 1)
        for step, place, *x in marks.tolist():
            part = R.decode(n, lanes, np.array(x, np.uint64), words, model, step, step + 16, place)
            assert (part == ids[step * lanes:(step + 16) * lanes]).all()
        if n == 300_000:
            p = counts / counts.sum()
            entropy = -(p * np.log2(p)).sum() * n / 8
            assert len(words) * 4 < 1.02 * entropy + 2000


def test_one_id_only():
    model = R.Model(np.array([5]), R.scaled(np.array([99])))
    lanes, states, words, _ = R.encode(np.full(3000, 5), model)
    assert (R.decode(3000, lanes, states, words, model) == 5).all() and not len(words)


def test_pieces_equal_whole_texts(sf_small, spark):
    t = Tokenizer.from_file(PATH)
    rng = random.Random(1)
    texts = [r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    texts += ["", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "\n\na b \t", "x  y", "it's 's  's", "\x1c \x85 q", "<|endoftext|> z",
              "é 漢字 12 3a", "a b c"]
    texts += ["".join(rng.choice(" \n\t.,a1é' ") for _ in range(rng.randint(1, 60))) for _ in range(500)]
    encoder = R.PieceEncoder(PATH)
    got = encoder(texts)
    assert got == encoder(texts)
    encoder._reset()
    assert got == encoder(texts)  # from the last set
    for text, ids in zip(texts, got, strict=True):
        assert np.frombuffer(ids, np.uint32).tolist() == t.encode(text, add_special_tokens=False).ids


def test_round_trip(spark, sf_small):
    t = Tokenizer.from_file(PATH)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    rows += [(10**9 + 3, "x <|endoftext|> y"), (10**9, "w" * 3 + " x y" * 150_000), (10**9 + 1, None), (10**9 + 2, ""), (5, "tie b"), (5, "tie a"), (5, "tie a"), (None, "no id")]
    df = spark.createDataFrame([(*r, "", "") for r in rows], SCHEMA).repartition(5)
    path = f"{ensure_checkpoint_dir(spark)}/test-{uuid.uuid4().hex}"
    R.write_corpus(df, path, PATH)
    got = R.read_corpus(spark, path).orderBy("start").collect()
    ids = {text: t.encode(text or "", add_special_tokens=False).ids + [0] for _, text in rows}
    assert [r.doc_id for r in got] == sorted((d for d, _ in rows), key=lambda d: -1 if d is None else d)
    want = sorted((str(d), len(ids[x]), zlib.crc32(np.array(ids[x], "<u4").tobytes())) for d, x in rows)
    assert sorted((str(r.doc_id), r.n_tokens, zlib.crc32(r.ids)) for r in got) == want
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    raw, coded = sum(map(len, (r.ids for r in got))), 0
    for b in spark.read.parquet(f"{path}/blocks").collect():
        coded += len(b.words) + len(b.states)
    assert coded < raw / 2
    bad = spark.read.parquet(f"{path}/blocks")
    broken = f"{path}-broken"
    bad.withColumn("crc32", bad.crc32 + 1).write.partitionBy("part").parquet(f"{broken}/blocks")
    for name in ("model", "parts"):
        spark.read.parquet(f"{path}/{name}").write.parquet(f"{broken}/{name}")
    with pytest.raises(Exception, match="checksum differs"):
        R.read_corpus(spark, broken).collect()


def test_empty(spark):
    assert R.round_trip(spark.createDataFrame([], SCHEMA), PATH).count() == 0
