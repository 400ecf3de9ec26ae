import random
import re

import pytest

from signalmine.llm.ngram_join import deduplicated, near_duplicates

SCHEMA = "doc_id long, text string, set_id string, component_id string"


def brute(rows):
    """doc_id -> (n, component) by comparing all pairs."""
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(d, low.get(find(i), d))
    return [(d, len(sets[i]), low.get(find(i), d)) for i, (d, _) in enumerate(rows)]


def made(seed, hot=False):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocab) for _ in range(60)]
    rows = []
    for _ in range(60):
        n = rng.choice([1, 3, 5, 6, 9, 12, 20, 40, 64, 130, 300])
        base = [rng.choice(vocab) for _ in range(n)]
        if hot and rng.random() < 0.5:
            base = passage + base[:rng.choice([0, 5, 10, 15, 30])]
        for _ in range(rng.choice([1, 1, 2, 6])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, max(1, n // 60), max(1, n // 25)])):
                at = rng.randrange(len(copy))
                how = rng.random()
                if how < 0.4:
                    copy[at] = rng.choice(vocab)
                elif how < 0.7:
                    copy.insert(at, rng.choice(vocab))
                elif len(copy) > 1:
                    del copy[at]
            rows.append((len(rows) * 7 % 1009, rng.choice([" ", "\n", " \t"]).join(copy)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,hot", [(1, False), (2, True), (3, True)])
def test_same_as_all_pairs(spark, seed, hot):
    rows = made(seed, hot)
    got = near_duplicates(spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)).collect()
    assert sorted(map(tuple, got)) == sorted(brute(rows))


def test_edges(spark):
    long = " ".join(f"a{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "One two"), (5, "one TWO"), (6, "one two three"), (7, long),
            (8, long + " end"), (8, long + " end"), (9, "É x"), (10, "é x"), (None, "one two"), (None, "solo text")]
    df = spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA)
    got = near_duplicates(df).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute(rows)))
    kept = deduplicated(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [1, 2, 3, 4, 6, 7, 9, 10]
    assert near_duplicates(df.limit(0)).count() == 0 and deduplicated(df.limit(0)).count() == 0


def test_repeated_ids_of_other_components(spark):
    one, two = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    rows = [(1, two + " end"), (5, one), (5, two), (5, one), (6, one + " end"), (7, ""), (7, "c d e f g h"), (7, ""), (None, one)]
    for order in (rows, rows[::-1]):
        kept = deduplicated(spark.createDataFrame([(*r, None, None) for r in order], SCHEMA)).collect()
        want = [(1, two + " end"), (5, one), (7, ""), (7, "c d e f g h"), (None, one)]
        assert sorted(map(str, ((r.doc_id, r.text) for r in kept))) == sorted(map(str, want))
