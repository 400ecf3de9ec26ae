import random
from collections import defaultdict

import numpy as np
import pytest

from signalmine.llm.packing import best_fit, cost, pack
from signalmine.llm.packing import LENGTHS as PERMITTED

SCHEMA = "doc_id long, text string, length string, bin_id string"
LENGTHS = (8, 16, 32)


def shrunk(n):
    return min(c for c in LENGTHS if c >= n)


def naive(sizes):
    """The rule, by looking at all bins and all pieces still to come for each size."""
    free, used, where = [], [], []

    def price(c, s, coming):
        held = s
        for x in coming:  # in falling order
            held += x if held + x <= c else 0
        return cost(shrunk(held)) / held

    for i, s in enumerate(sizes):
        fit = [(f, b) for b, f in enumerate(free) if f >= s]
        if fit:
            b = min(fit)[1]
        else:
            b = len(free)
            free.append(min((c for c in LENGTHS if c >= s), key=lambda c: (price(c, s, sizes[i + 1:]), c)))
            used.append(0)
        free[b] -= s
        used[b] += s
        where.append(b)
    return where, used


def total(sizes, lengths):
    """(cost, share filled) of a packing's bins."""
    where, _, capacity, used = best_fit(sizes, lengths)
    of = dict(zip(where.tolist(), capacity.tolist(), strict=True))
    return sum(map(cost, of.values())), sum(used) / sum(of.values())


def spread(name, n=4_000):
    rng = np.random.default_rng(3)
    sizes = {"small": lambda: rng.integers(1, 61, n), "middle": lambda: rng.integers(200, 901, n),
             "odd": lambda: rng.integers(690, 711, n), "long": lambda: rng.integers(2_100, 2_800, n),
             "log": lambda: np.minimum(rng.lognormal(6, 1.2, n).astype(int) + 1, 8192)}[name]()
    return -np.sort(-sizes)


@pytest.mark.parametrize("name", ["small", "middle", "odd", "long", "log"])
def test_lengths_together_cost_no_more_than_one_length_alone(name):
    sizes = spread(name)
    joint, filled = total(sizes, PERMITTED)
    alone = [total(sizes, [c])[0] for c in PERMITTED if c >= sizes[0]]
    assert joint <= min(alone) and filled > 0.89


def test_the_sizes_to_come_decide_the_length():
    # the same first piece opens another length when other pieces follow
    assert best_fit([700] * 11, PERMITTED)[2][0] == 8192
    assert best_fit([700] + [324] * 40, PERMITTED)[2][0] == 1024
    assert len(set(best_fit(spread("log"), PERMITTED)[2].tolist())) > 2


def test_best_fit():
    rng = random.Random(1)
    for n in (0, 1, 5, 200):
        sizes = sorted((rng.randint(1, 32) for _ in range(n)), reverse=True)
        where, offset, capacity, used = best_fit(sizes, LENGTHS)
        want, want_used = naive(sizes)
        assert list(where) == want and used == want_used
        fill = defaultdict(int)
        for b, o, c, s in zip(where, offset, capacity, sizes, strict=True):
            assert o == fill[b]
            fill[b] += s
            assert c == min(x for x in LENGTHS if x >= used[b])


def test_every_token_is_packed_once(spark):
    rng = random.Random(2)
    rows = [(i, " ".join("w" for _ in range(rng.choice([0, 1, 5, 30, 31, 32, 70, 500]))), "", "") for i in range(300)]
    rows += [(1000, None, "", ""), (1001, "w " * 20_000, "", ""), (1002, "a b", "", ""), (1002, "a b", "", ""), (None, "x", "", "")]
    out = pack(spark.createDataFrame(rows, SCHEMA), LENGTHS, group=400).collect()
    have, bins = defaultdict(list), defaultdict(list)
    for r in out:
        have[r.doc_id].append((r.start, r.length))
        bins[r.bin_id, r.capacity, r.used].append((r.offset, r.length))
    for d, t, *_ in rows:
        n = (len(t.split()) if t else 0) + 1
        assert sum(x for _, x in have[d]) == n * (2 if d == 1002 else 1)
        assert sorted(set(have[d])) == [(s, min(32, n - s)) for s in range(0, n, 32)]
    assert len({b for b, _, _ in bins}) == len(bins)
    for (_, capacity, used), parts in bins.items():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at == used <= capacity == min(c for c in LENGTHS if c >= used)
    fill = sum(u for _, _, u in bins) / sum(c for _, c, _ in bins)
    assert fill > 0.95


def test_empty(spark):
    assert pack(spark.createDataFrame([], SCHEMA)).count() == 0
