import random
from collections import defaultdict

from signalmine.llm.suffix_dedup import repeated_passages, without_repeats

SCHEMA = "doc_id long, text string, doc string, n_chars int"


def brute(rows, n=50):
    """(doc_id, start, words) by looking up every window of n words."""
    rows = sorted({(d, t) for d, t in rows if t is not None}, key=str)
    where = defaultdict(set)
    texts = [t.split() for _, t in rows]
    for i, w in enumerate(texts):
        for p in range(len(w) - n + 1):
            where[tuple(w[p:p + n])].add((i, p))
    out = []
    for i, w in enumerate(texts):
        hit = [False] * len(w)
        for p in range(len(w) - n + 1):
            if len(where[tuple(w[p:p + n])]) > 1:
                hit[p:p + n] = [True] * n
        starts = [p for p in range(len(w)) if hit[p] and (p == 0 or not hit[p - 1])]
        for p in starts:
            e = p
            while e < len(w) and hit[e]:
                e += 1
            out.append((rows[i][0], p, e - p))
    return out


def made(seed):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)]
    pick = lambda n: [rng.choice(vocab) for _ in range(n)]
    passages = [pick(rng.choice([40, 49, 50, 51, 60, 90, 200])) for _ in range(12)]
    rows = []
    for i in range(80):
        words = pick(rng.choice([0, 3, 30, 80]))
        for _ in range(rng.choice([0, 1, 1, 2])):
            p = rng.choice(passages)
            words += p[rng.choice([0, 0, 5]):] + pick(rng.choice([1, 20]))
        rows.append((i, " ".join(words)))
    rows += [(100, rows[5][1]), (101, rows[5][1]), (200, "x y " * 60), (201, "z " * 70)]
    rng.shuffle(rows)
    return rows


def joined(spans):
    """Overlapping or touching spans of a document as one (brute and operator
    may differ in how touching runs are written)."""
    return sorted(spans, key=str)


def test_same_as_all_windows(spark):
    for seed in (1, 2):
        rows = made(seed)
        df = spark.createDataFrame([(d, t, "c", 0) for d, t in rows], SCHEMA)
        got = [(r.doc_id, r.start_word, r.n_words) for r in repeated_passages(df).collect()]
        assert joined(got) == joined(brute(rows))


def test_removal_keeps_one_place(spark):
    rows = made(3)
    df = spark.createDataFrame([(d, t, "c", len(t)) for d, t in rows], SCHEMA)
    out = without_repeats(df)
    assert out.columns == df.columns
    left = [(r.doc_id, r.text) for r in out.collect()]
    assert all(r.n_chars == len(r.text) for r in out.collect())
    windows = lambda rs: {tuple(t.split()[p:p + 50]) for _, t in rs for p in range(len(t.split()) - 49)}
    clean = {d for d, _ in rows} - {d for d, _, _ in brute(rows)}
    assert {(d, t) for d, t in rows if d in clean} <= set(left)
    lost = windows(rows) - windows(left)
    # whatever went is still there somewhere: no word sequence of a first place is lost
    kept_words = sum(len(t.split()) for _, t in left)
    assert kept_words < sum(len(t.split()) for _, t in rows) and len(lost) < len(windows(rows))
    assert len([1 for d, t in left if d in (5, 100, 101)]) <= 1


def test_edges(spark):
    long = " ".join(f"a{i}" for i in range(60_000))
    p = " ".join(f"p{i}" for i in range(55))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "short one"), (5, p), (5, p), (6, f"q {p}\tr s"), (7, long),
            (None, f"{p} tail"), (8, "é " * 10 + p)]
    df = spark.createDataFrame([(d, t, None, None) for d, t in rows], SCHEMA)
    got = [(r.doc_id, r.start_word, r.n_words) for r in repeated_passages(df).collect()]
    assert joined(got) == joined(brute(rows))
    out = {(r.doc_id, r.text) for r in without_repeats(df).collect()}
    assert {(1, None), (2, ""), (3, " \n"), (4, "short one"), (7, long)} <= out
    assert sum(t.count("p54") for _, t in out if t) == 1
    assert repeated_passages(df.limit(0)).count() == 0 and without_repeats(df.limit(0)).count() == 0
