import hashlib
import os
import random
import re

import duckdb
import pytest

from signalmine.llm.decontamination import contamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window=10):
    strings = {}
    for item, text in items:
        w = words(text)
        if item is not None and w:
            m = min(window, len(w))
            for i in range(len(w) - m + 1):
                strings.setdefault(tuple(w[i:i + m]), set()).add(str(item))
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for m in {len(s) for s in strings}:
            for i in range(len(w) - m + 1):
                if (s := tuple(w[i:i + m])) in strings:
                    hit.update(range(i, i + m))
                    found |= strings[s]
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit),
                    sorted(hit)))
    return sorted(out, key=str)


def got(df):
    rows = []
    for r in df.collect():
        hit = [w for a, b in zip(r.spans[::2], r.spans[1::2], strict=True) for w in range(a, b)]
        rows.append((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated, hit))
    return sorted(rows, key=str)


def made(seed):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(30)] + ["é1", "日本", "Zz"]
    text = lambda n: rng.choice([" ", ", ", "\n", "-"]).join(rng.choice(vocab) for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 3, 9, 10, 11, 25]) if rng.random() < .3 else rng.choice([10, 14, 30]))) for i in range(30)]
    items += [(3, items[9][1]), (None, text(12)), (77, None), (78, "... !"), (79, items[5][1].upper())]
    docs = []
    for i in range(120):
        t = text(rng.choice([0, 1, 8, 40, 300]))
        if rng.random() < .5:
            w = words(rng.choice(items)[1])
            lo = rng.randrange(max(1, len(w) - 9))
            t = t + " " + " ".join(w[lo:lo + rng.choice([9, 10, 12, 30])]).upper() + ", " + text(rng.choice([0, 5]))
        docs.append((i, t))
    return docs + [(1, docs[1][1]), (1, docs[2][1]), (None, docs[3][1]), (900, None), (901, ""), (902, " \n"),
                   (903, (text(40) + " ") * 2000 + words(items[0][1] or "w1")[0])], items


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("block", [200_000, 60])
def test_equals_brute_force(spark, seed, block):
    docs, items = made(seed)
    out = contamination(spark.createDataFrame(docs, "doc_id long, text string"),
                        spark.createDataFrame(items, "item_id long, text string"), block_strings=block)
    assert got(out) == brute(docs, items)


def test_empty_tables_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b", "x", 5, "k")], "doc_id long, text string, item_id string, n_words int, spans string")
    items = spark.createDataFrame([(1, "B!", "y")], "item_id long, text string, doc_id string")
    assert got(contamination(docs, items)) == brute([(1, "a b")], [(1, "B!")])
    assert got(contamination(docs, items.limit(0))) == brute([(1, "a b")], [])
    assert contamination(docs.limit(0), items).count() == 0


def test_hot_passage_in_all(spark):
    passage = " ".join(f"p{i}" for i in range(40))
    docs = [(i, f"x{i} {passage} y{i % 7}") for i in range(400)]
    items = [(i, f"{passage} z{i}") for i in range(50)]
    out = contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert got(out) == brute(docs, items)


def test_oracle(spark, sf_small):
    from signalmine.llm.queries import ORACLES, op11_wu_manber_decontamination

    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(sf_small, t)}.parquet')")
    want = con.execute(ORACLES["op11_wu_manber_decontamination"]).df()
    out = op11_wu_manber_decontamination(spark, sf_small).toPandas()[list(want.columns)]
    assert sorted(map(tuple, out.itertuples(index=False))) == sorted(map(tuple, want.itertuples(index=False)))
    assert out["contaminated"].any()
