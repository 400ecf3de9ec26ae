import random
import re

import pytest

from signalmine.llm.mixing import LONGER, SEED, TOP_UPS, _key, mixed_documents, mixture

SCHEMA = "doc_id long, source string, text string, target string, copies string"


def goal(sizes):
    """source -> target by water filling, one capped source at a time."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    budget, out, free = 1.5 * sum(sizes.values()), {}, set(names)
    while free:
        level = budget / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > 2 * sizes[s]}
        if not over:
            return out | {s: weight[s] * level for s in free}
        out |= {s: 2.0 * sizes[s] for s in over}
        budget -= sum(out[s] for s in over)
        free -= over
    return out


def made(n=900, seed=5):
    rng = random.Random(seed)
    names = ["a", "B", "é", "zz", "m1", "m2", None]
    rows = []
    for i in range(n):
        s = "m1" if rng.random() < 0.4 else rng.choice(names)
        rows.append((i, s, "w " * int(rng.lognormvariate(3, 1)), "x", "y"))
    return rows + [(n, "a", None, "x", "y"), (n + 1, "B", "", "x", "y"), (n + 2, "a", "v " * 3, "x", "y"),
                   (n + 2, "a", "v " * 3, "x", "y"), (None, "zz", "q " * 9, "x", "y"), (None, "zz", "r " * 7, "x", "y"),
                   (n + 5, "solo", "one two", "x", "y"), (n + 6, "none", None, "x", "y")]


def test_targets_and_copies(spark):
    rows = made()
    df = spark.createDataFrame(rows, SCHEMA)
    got = mixture(df).collect()
    assert len(got) == len(rows)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes, by_id = {}, {}
    for i, s, t, *_ in rows:
        sizes[s] = sizes.get(s, 0) + size(t)
        by_id[i, size(t)] = s
    want = goal(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        s = by_id[r.doc_id, r.size]
        taken[s] += r.taken
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s])
        whole = int(r.target / r.source_size) if r.source_size else 0
        assert r.taken in ([0] if not r.size else [whole * r.size, min(2, whole + 1) * r.size])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(3, 0.02 * want[s]), s
    again = mixture(df.repartition(7))
    assert sorted(map(str, got)) == sorted(map(str, again.collect()))
    mixed = mixed_documents(df)
    assert mixed.columns == df.columns
    assert sum(size(r.text) for r in mixed.collect()) == sum(taken.values())


def test_ranks_equal_brute_force(spark):
    """Random odds over unequal inclusion odds, from the lowest on while the words fit."""
    rows = [r for r in made(1500, 8) if r[0] is not None]
    rows = list({r[0]: r for r in rows}.values())
    df = spark.createDataFrame(rows, SCHEMA)
    key = {r.doc_id: r.key for r in df.select("doc_id", _key(SEED).alias("key")).collect()}
    got = {r.doc_id: r for r in mixture(df).collect()}
    words = {i: len((t or "").split()) for i, _, t, *_ in rows}
    for source in {r[1] for r in rows}:
        mine = [r for r in rows if r[1] == source]
        total, target = sum(words[r[0]] for r in mine), got[mine[0][0]].target
        ratio = target / total if total else 0.0
        whole = int(ratio)
        p, rest = ratio - whole, target - whole * total
        mean = max(1.0, sum(len((r[2] or "").encode()) for r in mine) / len(mine))

        def rank(r, p=p, mean=mean):
            u = ((key[r[0]] % 2**64 >> 11) + 0.5) / 2**53
            odds = p / (1 - p) * (len((r[2] or "").encode()) / mean) ** LONGER
            return u / (1 - u) / odds if odds else float("inf")

        sample, left = set(), rest
        ranked = sorted(mine, key=rank) if p else []
        for r in ranked:
            if words[r[0]] > left:
                break
            sample.add(r[0])
            left -= words[r[0]]
        for _ in range(TOP_UPS):
            free = [r for r in ranked if r[0] not in sample and words[r[0]] and abs(left - words[r[0]]) < left]
            if free:
                pick = min(free, key=lambda r: (abs(left - words[r[0]]), rank(r)))
                sample.add(pick[0])
                left -= words[pick[0]]
        assert {r[0] for r in mine if got[r[0]].taken > whole * words[r[0]]} == {i for i in sample if words[i]}, source


def test_longer_documents_have_better_odds(spark):
    df = spark.createDataFrame([(i, "ab"[i % 2], "w " * (5 if i % 4 < 2 else 500), "", "") for i in range(4000)], SCHEMA)
    got = [r for r in mixture(df, share=1.0).collect() if r.target < r.source_size]
    share = [sum(r.taken for r in got if r.size == n) / sum(r.size for r in got if r.size == n) for n in (5, 500)]
    assert 0 < share[0] < 0.7 * share[1]


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert mixture(df).count() == 0 and mixed_documents(df).count() == 0
    one = spark.createDataFrame([(1, None, None, "", "")], SCHEMA)
    assert [(r.size, r.taken) for r in mixture(one).collect()] == [(0, 0)]
