import inspect
import re

import corpus_pipeline as P
from signalmine.llm.queries import QUERIES


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_stages_by_hand(spark, sf_small):
    """Each stage on the one before, held against plain Python."""
    raw = spark.read.parquet(f"{sf_small}/documents.parquet")
    docs, kept = raw, {}
    for name, stage in P.STAGES[:-1]:
        docs = P.stored(stage(spark, docs, sf_small), "test")
        assert docs.columns == raw.columns and docs.dtypes == raw.dtypes
        kept[name] = docs.collect()
    first = {r.doc_id: r for r in raw.collect()}
    quality, near, cut, mixed = kept.values()
    assert quality and all(first[r.doc_id] == r and len(words(r.text)) >= 50 for r in quality)

    shingles = {r.doc_id: {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
                for r in quality for w in [words(re.sub("[A-Z]", lambda m: m[0].lower(), r.text))]}
    same = lambda a, b: 100 * len(shingles[a] & shingles[b]) >= 80 * len(shingles[a] | shingles[b])
    root = {d: d for d in shingles}
    for a in sorted(shingles):
        for b in sorted(shingles):
            if a < b and same(a, b) and root[a] != root[b]:
                low, high = sorted((root[a], root[b]))
                root = {d: low if r == high else r for d, r in root.items()}
    assert sorted(r.doc_id for r in near) == sorted(set(root.values()))

    where = {}
    for r in cut:
        w = words(r.text)
        for p in range(len(w) - 49):
            where.setdefault(tuple(w[p:p + 50]), set()).add((r.doc_id, p))
        assert r.n_chars == len(r.text)
    before = {r.doc_id: r.text for r in near}
    touched = [r.doc_id for r in cut if r.text != before[r.doc_id]]
    assert all(len(v) == 1 for v in where.values()) and len(touched) < len(near)

    by_source = {}
    for r in cut:
        by_source[r.source] = by_source.get(r.source, 0) + len(words(r.text))
    assert {r.doc_id for r in mixed} <= {r.doc_id for r in cut}
    total = sum(len(words(r.text)) for r in mixed)
    assert abs(total - 1.5 * sum(by_source.values())) < 0.05 * total

    packed = P.STAGES[-1][1](spark, docs, sf_small).collect()
    assert sum(r.length for r in packed) == total + len(mixed)


def test_run_is_the_stages(spark, sf_small):
    assert QUERIES["pipeline"](spark, sf_small).count() > 0
    assert [len(inspect.signature(f).parameters) for _, f in P.STAGES] == [3] * 5
