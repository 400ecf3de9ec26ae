"""Mixing sources to target weights by Pareto order sampling.

A source's target is its weight's share of the budget, at most ``cap`` times its
size; what a cap cuts off goes to the others by weight. Each document of a
source first gets the certain whole copies, floor(target / size of the source).
For the fraction p of the source that is left to take, documents have unequal
inclusion odds: p / (1 - p), times the root of the document's bytes over the root
of the source's mean (``LONGER``; 0 makes the odds equal). Documents are ranked by
their random odds u / (1 - u) divided by their inclusion odds, and taken from the
lowest rank on while the words fit, so the sample's size in words is fixed. Last,
the documents whose sizes come nearest to the gap left are added, if they make it
smaller.

The random numbers are hashes of id and text, so reruns agree and identical
rows share a fate. A rank's prefix sums are taken in two steps, over SLICES
ranges of ranks and inside the one where the target falls, so that no source is
sorted as a whole. Decisions are one row per source; documents meet them by a
join, which Spark broadcasts only if the stored table is small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signalmine.llm.common import stored, word_count

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2
SEED = 20
SLICES = 4096
LONGER = 0.5    # power of a document's bytes in its inclusion odds
TOP_UPS = 2


def _key(seed: int):
    return F.xxhash64(F.lit(seed), "doc_id", "text")


def _bytes():
    return F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")


def _place():
    """q / (1 + q) of the rank q: from 0 to 1 in the order of the ranks (needs key and
    bytes, and p and mean of the source)."""
    u = (F.shiftrightunsigned("key", 11) + 0.5) / float(1 << 53)
    odds = F.col("p") * F.pow(F.col("bytes") / F.greatest("mean", F.lit(1.0)), F.lit(LONGER))
    return u * (1 - F.col("p")) / (u * (1 - F.col("p")) + odds * (1 - u))


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(source, source_size, mean, target) from (source, size, bytes): one row per source.
    Sources rank by code point, null last, and take the weights in turn; this
    list of sources (not their rows) is numbered in one window."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.avg("bytes").alias("mean"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.array(*[F.lit(float(w)) for w in weights])
    per = stored(per.withColumn("weight", F.get(weight, (rank - 1) % len(weights))), "sources")
    first = per.agg(F.sum("source_size"), F.sum("weight")).first()
    budget, level, seen = share * (first[0] or 0), 0.0, -1
    level = budget / first[1] if first[1] else 0.0
    while True:
        over = F.col("source_size") * F.lit(float(cap)) < F.col("weight") * level
        got = per.agg(F.sum(F.when(over, F.col("source_size") * float(cap)).otherwise(0.0)),
                      F.sum(F.when(over, 0.0).otherwise(F.col("weight"))),
                      F.coalesce(F.sum(over.cast("long")), F.lit(0))).first()
        if got[2] == seen or not got[1]:
            break
        seen, level = got[2], (budget - got[0]) / got[1]
    if got[1] == 0:
        level = float("inf")
    return per.select("source", "source_size", "mean", F.least(
        F.col("source_size") * float(cap), F.col("weight") * level).alias("target"))


def decisions(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP,
              seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(documents, sources), both stored: documents are (doc_id, source, size, bytes,
    key), sources (source, source_size, mean, target, whole, p, slice, cut, picks)."""
    rows = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source",
                              word_count(F.col("text")).alias("size"), _bytes().alias("bytes"), _key(seed).alias("key")), "sizes")
    goal = targets(rows.select("source", "size", "bytes"), weights, share, cap)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    goal = goal.withColumn("whole", F.floor(ratio).cast("long")).withColumn("p", ratio - F.col("whole"))
    goal = stored(goal.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")), "targets")
    placed = _with(rows, goal, ["p", "mean", "rest"]).where("p > 0").withColumn("place", _place())
    placed = placed.withColumn("slice", F.floor(F.col("place") * SLICES).cast("int"))

    sums = placed.groupBy("source", "slice").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
    run = F.sum("words").over(Window.partitionBy("source").orderBy("slice"))
    before = sums.withColumn("until", run).where("until > rest").groupBy("source").agg(
        F.min(F.struct("slice", F.col("until") - F.col("words"))).alias("s"))
    before = stored(before.select("source", F.col("s.slice").alias("cut_slice"), F.col("s.col2").alias("base")), "slices")
    inside = _with(placed, before, ["cut_slice", "base"]).where("slice = cut_slice")
    run = F.sum("size").over(Window.partitionBy("source").orderBy("place"))
    fits = inside.withColumn("until", F.col("base") + run).where("until <= rest")
    fits = fits.groupBy("source").agg(F.max("place").alias("cut"), F.max("until").alias("had"))
    state = _with(_with(goal, before, ["cut_slice", "base"]), fits, ["cut", "had"])
    state = state.withColumn("gap", F.col("rest") - F.coalesce("had", "base", F.lit(0)))
    state = stored(state.withColumn("picks", F.array().cast("array<bigint>")), "cuts")
    for _ in range(TOP_UPS):
        free = _with(rows, state, ["p", "mean", "cut_slice", "cut", "gap", "picks"]).where("p > 0 and gap > 0 and size > 0")
        free = free.withColumn("place", _place()).where(~_taken())
        off = F.abs(F.col("gap") - F.col("size"))
        pick = free.where(off < F.col("gap")).groupBy("source").agg(
            F.min(F.struct(off.alias("off"), "place", "key", "size")).alias("pick"))
        state = _with(state, pick, ["pick"])
        state = state.withColumn("gap", F.col("gap") - F.coalesce("pick.size", F.lit(0))).withColumn(
            "picks", F.when(F.col("pick").isNotNull(), F.array_append("picks", F.col("pick.key"))).otherwise(F.col("picks")))
        state = stored(state.drop("pick"), "cuts")
    return rows, state.select("source", "source_size", "target", "mean", "whole", "p", "cut_slice", "cut", "picks")


def _with(left: DataFrame, right: DataFrame, columns: list[str]) -> DataFrame:
    """Left join on source, null matching null."""
    right = right.select(F.col("source").alias("_source"), *columns)
    return left.join(right, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")


def _taken():
    """Is a fraction's document taken? (needs place and its source's decision)"""
    at = F.floor(F.col("place") * SLICES).cast("int")
    return F.coalesce((at < F.col("cut_slice")) | ((at == F.col("cut_slice")) & (F.col("place") <= F.col("cut"))),
                      F.lit(False)) | F.array_contains("picks", F.col("key"))


def _copies(rows: DataFrame, sources: DataFrame) -> DataFrame:
    joined = _with(rows, sources, ["source_size", "target", "mean", "whole", "p", "cut_slice", "cut", "picks"])
    joined = joined.withColumn("place", _place())
    return joined.withColumn("copies", F.col("whole") + F.when(F.col("p") > 0, _taken().cast("long")).otherwise(0))


def mixture(docs: DataFrame, **how) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every row of ``docs``
    (doc_id, source, text). A null text has size 0 and takes 0; a null source is
    a source; an empty table gives none. Rows with the same id and text share a fate, and
    ranks that tie are taken together. A document of any length is one row of numbers
    here; one that doesn't fit in what is left of its target isn't taken. Other columns
    are ignored."""
    rows, sources = decisions(docs, **how)
    return _copies(rows, sources).select("doc_id", "size", "source_size", "target",
                                         (F.col("copies") * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, seed: int = SEED, **how) -> DataFrame:
    """``docs`` as mixed: each row as often as it has copies (0 or more). Nulls, empty texts,
    repeated rows and empty tables: as in ``mixture``; a row without words comes as often as
    its source's whole copies say."""
    _, sources = decisions(docs, seed=seed, **how)
    rows = docs.select(F.struct(*docs.columns).alias("doc"), "source", _bytes().alias("bytes"), _key(seed).alias("key"))
    return (_copies(rows, sources).select("doc", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))))
            .select("doc.*"))
