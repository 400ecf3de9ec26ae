"""The two order-dependent or pluggable operators that need Python in tasks
(SURVEY §2.13): greedy regression claims and item classification.

Both run per Arrow batch / per group inside Spark tasks; Spark
partitions and shuffles the work.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyspark.sql import Window

from signalmine.functions.constants import CLASSIFY_ACTIONS, TOPIC_RULES
from signalmine.functions.timefn import AsOf
from signalmine.operators.filters import icontains_pattern
from signalmine.operators.joins import fixes, met, slices
from signalmine.session import materialize

CLAIM_SCHEMA = "repo string, new_id long, old_id long, claim_rank int, new_completed_at timestamp_ntz"
#: new tasks of a repository that are matched among themselves in one task
BLOCK = 64
#: new tasks, and older tasks, of a repository that meet in one group
CELL = 4096
_STATE = ("kind string, repo string, block long, last long, id long, at timestamp_ntz, words array<string>, n int, "
          "new_id long, new_at timestamp_ntz")


def _greedy_claims(k: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        # new tasks newest first; each takes its k newest still unclaimed candidates
        pdf = pdf.sort_values(["new_completed_at", "new_id", "by_at", "old_completed_at", "old_id"], ascending=False)
        claimed: set[int] = set()
        out = []
        for (new_id,), grp in pdf.groupby(["new_id"], sort=False):
            n = 0
            for old_id in grp["old_id"]:
                if old_id in claimed:
                    continue
                n += 1
                claimed.add(old_id)
                out.append((grp["repo"].iloc[0], new_id, old_id, n, grp["new_completed_at"].iloc[0]))
                if n >= k:
                    break
        return pd.DataFrame(out, columns=["repo", "new_id", "old_id", "claim_rank", "new_completed_at"])
    return run


def claim_rounds(pairs: DataFrame, k: int = 3, block: int = BLOCK) -> tuple[DataFrame, int]:
    """Greedy claims of ``pairs`` in rounds: (claims, number of rounds).

    The new tasks of a repository are dealt by time into blocks of ``block``. In a
    round each block matches its tasks among themselves, on the candidates that no
    newer task of another block holds; an older task keeps the newest of its
    claimants, and who lost one looks further in the next round. A candidate lost
    once is lost for good, so the rounds end at the same claims as one pass over
    all new tasks, newest first. A group holds at most ``k * block**2`` pairs
    whatever the size of the repository; rounds are at most the blocks of one
    repository plus one, and few where their words differ.

    Ids count per repository. Where one names several new tasks there, these are one
    task of the newest time that has candidates, which takes those of the newer first.
    """
    of_new = ["repo", "new_id"]
    pairs = (pairs.groupBy(*of_new, "old_id").agg(F.max(F.struct("new_completed_at", "old_completed_at")).alias("by"))
             .select(*of_new, "old_id", F.col("by.new_completed_at").alias("by_at"), "by.old_completed_at")
             .withColumn("new_completed_at", F.max("by_at").over(Window.partitionBy(*of_new))))
    newest = Window.partitionBy(*of_new).orderBy(F.col("by_at").desc(), F.col("old_completed_at").desc(), F.col("old_id").desc())
    new = pairs.select(*of_new, "new_completed_at").distinct()
    # a new task can lose at most k candidates to each other new task of its repository
    pairs = pairs.withColumn("_r", F.row_number().over(newest)).join(new.groupBy("repo").agg(F.count(F.lit(1)).alias("_n")), "repo")
    pairs = pairs.filter(F.col("_r") <= F.col("_n") * k).drop("_r", "_n")
    times = slices(new, "repo", "new_completed_at", block).select("repo", "minute", "newer")
    inside = Window.partitionBy("repo", "minute").orderBy(F.col("new_completed_at").desc(), F.col("new_id").desc())
    dealt = (new.withColumn("minute", F.date_trunc("minute", "new_completed_at"))
             .withColumn("at", F.row_number().over(inside)).join(times, ["repo", "minute"])
             .select(*of_new, F.floor((F.col("newer") + F.col("at") - 1) / block).alias("block")))
    pairs = materialize(pairs.join(dealt, of_new))
    free, rounds = pairs, 0
    while True:
        # a task can lose at most k candidates to each other task of its block
        near = free.withColumn("_r", F.row_number().over(newest)).filter(F.col("_r") <= k * block).drop("_r")
        claims = materialize(near.groupBy("repo", "block").applyInPandas(_greedy_claims(k), CLAIM_SCHEMA))
        rounds += 1
        held = claims.groupBy("repo", "old_id").agg(F.max(F.struct("new_completed_at", "new_id")).alias("holder"))
        n, kept = claims.agg(F.count("*"), F.count_distinct("repo", "old_id")).first()
        if n == kept:
            return claims, rounds
        free = (pairs.join(held, ["repo", "old_id"], "left")
                .filter(F.col("holder").isNull() | (F.struct("new_completed_at", "new_id") >= F.col("holder")))
                .drop("holder"))


def _dealt(words: DataFrame, kind: str, per: int) -> DataFrame:
    """The tasks of (repo, word, <kind>_id, <kind>_completed_at) as rows of the state,
    dealt by time into blocks of ``per``, newest first."""
    rows = words.groupBy("repo", F.col(f"{kind}_id").cast("long").alias("id"), F.col(f"{kind}_completed_at").alias("at")) \
        .agg(F.collect_set("word").alias("words"))
    times = slices(rows, "repo", "at", per).select("repo", "minute", "newer")
    inside = Window.partitionBy("repo", "minute").orderBy(F.col("at").desc(), F.col("id").desc())
    nth = rows.withColumn("minute", F.date_trunc("minute", "at")).withColumn("nth", F.row_number().over(inside))
    block = F.floor((F.col("newer") + F.col("nth") - 1) / per)
    return nth.join(times.hint("merge"), ["repo", "minute"]).select(
        F.lit(kind).alias("kind"), "repo", block.alias("block"), "id", "at", "words", F.lit(0).alias("n"))


def _cell_claims(k: int):
    def run(key, new: pd.DataFrame, old: pd.DataFrame) -> pd.DataFrame:
        # new tasks newest first; each takes its newest free candidates until it has k
        new = new.sort_values(["at", "id"], ascending=False)
        old = old.sort_values(["at", "id"], ascending=False)
        begin = np.searchsorted(-old["at"].to_numpy().astype(np.int64), -new["at"].to_numpy().astype(np.int64), side="right")
        having: dict[str, list[int]] = {}
        for i, words in enumerate(old["words"]):
            for word in words:
                having.setdefault(word, []).append(i)
        free, next_ = np.ones(len(old), bool).tolist(), dict.fromkeys(having, 0)
        ids, counts, claims = old["id"].tolist(), [], []
        for new_id, at, words, n, first in zip(new["id"], new["at"], new["words"], new["n"], begin.tolist(), strict=True):
            words = [w for w in words if w in having]
            while n < k:
                best = len(ids)
                for word in words:
                    places, p = having[word], next_[word]
                    # neither those taken nor those too new are wanted by a later new task
                    while p < len(places) and (places[p] < first or not free[places[p]]):
                        p += 1
                    next_[word] = p
                    if p < len(places):
                        best = min(best, places[p])
                if best == len(ids):
                    break
                free[best] = False
                n += 1
                claims.append(("claim", key[0], ids[best], n, new_id, at))
            counts.append(n)
        new = new.assign(n=counts)
        made = pd.DataFrame(claims, columns=["kind", "repo", "id", "n", "new_id", "new_at"]).assign(words=None)
        kept = [new[(new["n"] < k) & (new["other"] < new["last"])], old[np.array(free, bool) & (old["other"] < old["last"])]]
        out = pd.concat([x for x in (*kept, made) if len(x)] or [made])
        return out.reindex(columns=[c.split()[0] for c in _STATE.split(", ")]).astype({c: "Int64" for c in (
            "block", "last", "id", "n", "new_id")}).astype({"at": "datetime64[ns]", "new_at": "datetime64[ns]"})
    return run


def claim_cells(new: DataFrame, old: DataFrame, k: int = 3, cell: int = CELL) -> DataFrame:
    """Greedy claims of (repo, word, new_id, new_completed_at) on (repo, word, old_id,
    old_completed_at), a row per word; an id names one task of its repository.

    A repository's new and older tasks are dealt by time into blocks of ``cell``. New
    block i meets old block j once new block i has met the old blocks before j, and old
    block j the new blocks before i: new tasks then lack what the newer older tasks could
    not give, and the older tasks left are those that no newer new task took, as in one
    pass. So in round r all blocks with i + j = r meet at once, each pair in a group of
    two blocks; what is left goes on to the next. Tasks without a word in common are
    never paired: rows follow the tasks, not their pairs."""
    wanted = new.select("repo", "word").distinct()
    new, old = _dealt(new, "new", cell), _dealt(old.join(wanted.hint("merge"), ["repo", "word"], "left_semi"), "old", cell)
    both = materialize(new.unionByName(old))
    ends = both.groupBy("repo").agg(F.max(F.when(F.col("kind") == "new", F.col("block"))).alias("last_new"),
                                    F.max(F.when(F.col("kind") == "old", F.col("block"))).alias("last_old"))
    both = materialize(both.join(ends, "repo").withColumn("last", F.when(
        F.col("kind") == "new", F.col("last_old")).otherwise(F.col("last_new"))).filter(F.col("last").isNotNull())
        .select("kind", "repo", "block", "last", "id", "at", "words", "n"))
    ends = both.groupBy("kind").agg(F.max("block")).collect()
    ends = {r.kind: r[1] for r in ends}
    states = [both.sparkSession.createDataFrame([], _STATE)]
    for r in range(ends["new"] + ends["old"] + 1 if ends else 0):
        left = states[-1].filter(F.col("kind") != "claim").select(both.columns).unionByName(
            both.filter(F.col("block") == r)).withColumn("other", F.lit(r) - F.col("block"))
        groups = [left.filter(F.col("kind") == kind).withColumn("cell", of).groupBy("repo", "cell")
                  for kind, of in (("new", F.col("block")), ("old", F.col("other")))]
        states.append(materialize(groups[0].cogroup(groups[1]).applyInPandas(_cell_claims(k), _STATE)))
        if r >= ends["new"] and states[-1].filter(F.col("kind") == "new").isEmpty():
            break
    claims = [s.filter(F.col("kind") == "claim") for s in states]
    return reduce(DataFrame.unionByName, claims).select(
        "repo", "new_id", F.col("id").alias("old_id"), F.col("n").alias("claim_rank"), F.col("new_at").alias("new_completed_at"))


def claim_regressions(tasks: DataFrame, as_of: AsOf, new_days: float = 1, lookback_days: float = 30,
                      k: int = 3, max_new: int | None = None) -> DataFrame:
    """Sequential form of ``regression_candidates``: new tasks newest first, an
    older task already marked by an earlier new task is not reused.

    The claims are made by ``claim_cells``; repositories where an id names several of
    their tasks are matched by their pairs, in ``claim_rounds``. Ids of other
    repositories don't matter.
    """
    new, old = fixes(tasks, as_of, new_days, lookback_days, max_new, None)
    new, old = materialize(new.filter(F.col("new_id").isNotNull())), materialize(old.filter(F.col("old_id").isNotNull()))
    ids = [rows.select("repo", F.col(f"{kind}_id").alias("id"), F.col(f"{kind}_completed_at").alias("at"))
           for kind, rows in (("new", new), ("old", old))]
    several = materialize(ids[0].unionByName(ids[1]).distinct().groupBy("repo", "id").agg(F.count(F.lit(1)).alias("n"))
                          .filter(F.col("n") > 1).select("repo").distinct())
    if several.isEmpty():
        return claim_cells(new, old, k)
    pairs = met(new.join(several, "repo", "left_semi"), old.join(several, "repo", "left_semi"), ["repo", "word"]).distinct()
    claims = claim_rounds(pairs, k)[0]
    return claim_cells(new.join(several, "repo", "left_anti"), old.join(several, "repo", "left_anti"), k).unionByName(claims)


# ---- classification -------------------------------------------------------------------

# default rule: topic -> action (a user may pass any classifier instead)
DEFAULT_ACTION_BY_TOPIC = {
    "deployment": "guard", "auth": "memory", "database": "config", "testing": "guard", "rag": "vault",
}


def rule_classifier(items: DataFrame) -> DataFrame:
    """(id, action, description): first matching topic's action, else 'skip'. The lesson
    is lower-cased once (a one-element ``transform``), also where a filter on the action
    is pushed below."""
    def action(low):
        out = F.lit("skip")
        for name, pattern, _ in reversed(TOPIC_RULES):
            out = F.when(icontains_pattern(low, pattern, low), F.lit(DEFAULT_ACTION_BY_TOPIC[name])).otherwise(out)
        return out

    return items.select("id", F.transform(F.array(F.lower("lesson")), action)[0].alias("action"),
                        F.col("lesson").alias("description"))


def pandas_classifier(fn):
    """Wrap ``fn(pd.Series[str]) -> pd.Series[str]`` (lesson -> action) as an
    Arrow-batched classifier; unknown actions are dropped later."""
    @F.pandas_udf("string")
    def udf(lessons: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in lessons:
            yield fn(batch).astype("string")

    def classify(items: DataFrame) -> DataFrame:
        return items.select("id", udf(F.col("lesson")).alias("action"),
                            F.col("lesson").alias("description"))
    return classify


def classify_items(items: DataFrame, classifier=rule_classifier) -> DataFrame:
    """Classify items into the five actions with a pluggable classifier (a
    DataFrame function, e.g. ``rule_classifier`` / ``pandas_classifier(fn)``,
    or a reply table joined by id)."""
    if isinstance(classifier, DataFrame):
        out = items.select("id").join(classifier, "id")
    else:
        out = classifier(items)
    if classifier is rule_classifier:  # knows no other actions
        return out
    return out.filter(F.col("action").isin(CLASSIFY_ACTIONS))
