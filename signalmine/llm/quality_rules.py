"""Quality rules: base counts and a hashed n-gram log-likelihood ratio.

Words and word pairs are hashed into ``BUCKETS`` buckets. One pass counts them
over all documents (the raw corpus) and over the trusted ones (labelled good and
not toxic), giving two multinomials. A document's score is the mean over its
n-grams of ``log(p_trusted / p_raw)``; it is kept at ``THRESHOLD`` or more. The
trusted estimate is smoothed towards the raw one with the weight of ``PRIOR``
n-grams, so an n-gram that the trusted texts lack costs a bounded amount.

All on DataFrame functions. What reaches the driver is BUCKETS pairs of counts;
the ratios go back as one constant array. No text is shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalmine.llm.common import SPACES, let, words

BUCKETS = 8192
TRUSTED_DOCS = 20_000   # labelled rows that the trusted side is counted on, picked by hash
PRIOR = 200_000.0       # keeps scores near 0 while few trusted n-grams are known
THRESHOLD = -0.045
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

_INDEX_BITS = 24
_INDEX = (1 << _INDEX_BITS) - 1


def _hashes(w: Column) -> Column:
    return F.transform(w, lambda x: F.xxhash64(x))


def _twice(items: Column, key) -> Column:
    """Items of a sorted array whose key equals that of a neighbour."""
    return let(items, lambda s: F.filter(s, lambda x, i:
               ((i > 0) & key(x).eqNullSafe(key(F.get(s, i - 1)))) | key(x).eqNullSafe(key(F.get(s, i + 1)))))


def repeat_words(w: Column, h: Column) -> Column:
    """Words inside 3-word windows that occur twice or more. ``w``: words; ``h``:
    their hashes. Windows are sorted by 40 hash bits with their place (one
    long each); those that meet there are compared as text."""
    n = F.size(w)
    rough = F.transform(F.slice(h, 1, F.greatest(n - 2, F.lit(0))), lambda x, i:
                        F.shiftleft(F.xxhash64(x, F.get(h, i + 1), F.get(h, i + 2)), _INDEX_BITS).bitwiseOR(i.cast("long")))
    some = F.transform(_twice(F.sort_array(rough), lambda x: F.shiftright(x, _INDEX_BITS)),
                       lambda x: x.bitwiseAND(F.lit(_INDEX).cast("long")).cast("int"))
    places = F.when(n <= _INDEX, some).otherwise(F.sequence(F.lit(0), n - 3))
    exact = F.sort_array(F.transform(places, lambda i: F.struct(
        F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("t"), i.alias("i"))))
    found = F.sort_array(F.transform(_twice(exact, lambda x: x["t"]), lambda x: x["i"].cast("long")))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).cast("long").alias("last"))
    return F.when(n < 3, F.lit(0).cast("long")).otherwise(F.aggregate(
        found, start, lambda a, x: F.struct((a["n"] + F.least(F.lit(3).cast("long"), x - a["last"])).alias("n"),
                                            x.alias("last")), lambda a: a["n"]))


def _bucket(h: Column) -> Column:
    return h.bitwiseAND(F.lit(BUCKETS - 1).cast("long")).cast("int")


def ratios(docs: DataFrame, labels: DataFrame, prior: float = PRIOR) -> list[float] | None:
    """log(p_trusted / p_raw) of each bucket; None without trusted words."""
    trusted = (labels.groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("toxic").alias("t"))
               .where("doc_id is not null and q = 1 and t = 0")
               .orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRUSTED_DOCS)
               .select(F.col("doc_id").alias("trusted_id")))
    said = docs.select("doc_id", words(F.col("text")).alias("w")).join(
        F.broadcast(trusted), F.col("doc_id") == F.col("trusted_id"), "left")
    # F.get(w, pos + 1) is null at the last word, which has no pair
    one = said.select(F.col("trusted_id").isNotNull().cast("long").alias("good"), "w", F.posexplode("w"))
    one = one.select("good", F.xxhash64("col").alias("h"), F.get("w", F.col("pos") + 1).alias("next"))
    grams = one.select("good", F.explode(F.array(
        _bucket(F.col("h")),
        F.when(F.col("next").isNotNull(), _bucket(F.xxhash64("h", F.xxhash64("next")))))).alias("b"))
    counted = (grams.where("b is not null").groupBy("b")
               .agg(F.sum("good").alias("good"), F.count("*").alias("raw")).collect())
    good, raw = [0] * BUCKETS, [0] * BUCKETS
    for r in counted:
        good[r.b], raw[r.b] = r.good, r.raw
    n_good, n_raw = sum(good), sum(raw)
    if not n_good:
        return None
    out = []
    for g, r in zip(good, raw, strict=True):
        p_raw = (r + 1) / (n_raw + BUCKETS)
        out.append(math.log((g + prior * p_raw) / (n_good + prior) / p_raw))
    return out


def _score(h: Column, table: list[float] | None) -> Column:
    if table is None:
        return F.lit(0.0)
    ratio = F.split(F.lit(",".join(map(repr, table))), ",").cast("array<double>")
    n = F.size(h)
    total = F.aggregate(
        F.sequence(F.lit(0), n - 1), F.lit(0.0),
        lambda a, i: a + F.get(ratio, _bucket(F.get(h, i)))
        + F.when(i < n - 1, F.get(ratio, _bucket(F.xxhash64(F.get(h, i), F.get(h, i + 1))))).otherwise(0.0))
    return F.when(n > 0, total / (2 * n - 1)).otherwise(0.0)


def judged(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, prior: float = PRIOR) -> DataFrame:
    """(doc, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, score,
    base_failed, kept) of every row; ``doc`` is the row itself as a struct.

    A null or empty text has no words and fails the base rules. Without trusted
    rows, or words in them, every score is 0. Repeated rows are judged each.
    """
    table = ratios(docs, labels, prior)
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0)
    split = docs.select(F.struct(*docs.columns).alias("doc"), text.alias("text"), words(F.col("text")).alias("w"))
    inner = let(F.struct(F.col("w"), _hashes(F.col("w")).alias("h")), lambda x: F.struct(
        repeat_words(x["w"], x["h"]).alias("n_repeat_words"), _score(x["h"], table).alias("score")))
    counts = split.select(
        "doc", F.size("w").cast("long").alias("n_words"),
        F.length(F.translate("text", SPACES, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        inner.alias("inner"))
    out = counts.select("doc", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                        F.col("inner.n_repeat_words").alias("n_repeat_words"), F.col("inner.score").alias("score"))
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("score") >= threshold))


def kept_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, prior: float = PRIOR) -> DataFrame:
    """The rows of ``docs`` that pass, unchanged."""
    return judged(docs, labels, threshold, prior).where("kept").select("doc.*")
