import hashlib
import os
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from signalmine.llm.prefix_trie import PerfectHash, prefix_trie, rebuilt_trie

SCHEMA = "conv_id long, turn long, role string, text string"
COLS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def brute(rows, rebuild=True):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c > 0 else -1)
        whole[c] = own.get(base, [])[:h] + turns[h:] if rebuild else turns
    members = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = Counter(n[:-1] for n in members if n)
    leaves, saved = Counter(), Counter()
    for node, ms in members.items():
        worth = (len(ms) - 1) * len([w for w in node[-1][1].replace(" ", "x").split()]) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += kids[node] == 0
            saved[node[:d]] += worth
    return sorted((min(ms), len(n), min(members[n[:-1]]) if n else None, len(ms), kids[n], leaves[n], saved[n], hashlib.sha256(
        ",".join(str(c) for c in sorted(ms) if len(whole[c]) == len(n)).encode()).hexdigest()) for n, ms in members.items())


def got(df):
    return sorted(tuple(r[c] for c in COLS) for r in df.collect())


def made(seed, n=150):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-30, 400), n):
        depth = rng.choice([0, 1, 1, 2, 4, 7])
        for t in range(depth):
            text = rng.choice(["a b", "", None, "c\td  e"]) if rng.random() < .8 else f"x{rng.randrange(9)} y"
            rows.append((c, rng.choice([t, t, None]) if rng.random() < .2 else t, rng.choice(["user", "user", None]), text))
    rows += [r for r in rows if rng.random() < .1] + [(None, 0, "user", "lost")]
    rng.shuffle(rows)
    return rows


def test_perfect_hash():
    rng = np.random.default_rng(1)
    keys = rng.integers(-2**63, 2**63 - 1, (5000, 2))
    table = PerfectHash(keys[:, 0], keys[:, 1])
    assert sorted(table.slots(keys[:, 0], keys[:, 1]).tolist()) == list(range(5000))
    assert (table.slots(keys[:, 0], keys[:, 1] ^ 1) == -1).all()


@pytest.mark.parametrize("seed, light", [(1, 1 << 16), (2, 40), (3, 6)])
def test_equals_brute_force(spark, seed, light):
    rows = made(seed)
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(rebuilt_trie(df, light_rows=light, shard_rows=50)) == brute(rows)
    assert got(prefix_trie(df, light_rows=light)) == brute(rows, rebuild=False)


def test_hot_conversations(spark):
    """A long conversation and many copies of another lie across partitions and above the cut."""
    rows = [(40, t, "user", f"turn {t % 3}") for t in range(600)]
    rows += [(c, t, "user", "same words here") for c in range(1000, 1300) for t in range(5)]
    rows += [(c, 0, "user", f"w{c}") for c in range(200)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(rebuilt_trie(df, light_rows=64)) == brute(rows)


def test_empty_and_clashing_columns(spark):
    df = spark.createDataFrame([(20, 1, "u", "a b c", 5, "x"), (21, 1, "u", "a b c", 6, "y")],
                               SCHEMA + ", pos int, d1 string")
    assert got(rebuilt_trie(df)) == brute([(20, 1, "u", "a b c"), (21, 1, "u", "a b c")])
    assert rebuilt_trie(df.limit(0)).count() == 0


def test_oracle(spark, sf_small):
    from signalmine.llm.queries import ORACLES, op12_prefix_trie

    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{os.path.join(sf_small, 'conversations')}.parquet')")
    want = con.execute(f"SELECT {', '.join(COLS)} FROM ({ORACLES['op12_prefix_trie']})").fetchall()
    assert got(op12_prefix_trie(spark, sf_small)) == sorted(want)
