import pytest

from signalmine.operators import aggregates as agg
from signalmine.operators import filters as flt
from conftest import rows

ITEMS = "id long, source string, lesson string, applied boolean"


def made(spark):
    return spark.createDataFrame([(1, "s", "Deploy the Vault", False), (2, "s", "sql (index)", False), (3, "s", None, False),
                                  (4, "s", "deploy", True), (5, "s", "", False)], ITEMS)


def test_a_row_of_the_table_changes_tags_and_counts(spark):
    rules = [("rag", "vault|chunk"), ("ops", "^deploy"), ("none", "zzz"), (None, "x"), ("y", None)]
    df = spark.createDataFrame(rules, "name string, pattern string")
    tags = {r.id: r.topics for r in flt.topic_tags_by_rules(made(spark), df).collect()}
    assert tags == {1: ["ops", "rag"], 2: [], 3: [], 5: []}
    assert rows(agg.topic_counts_by_rules(made(spark), df)) == [("none", 0), ("ops", 1), ("rag", 1)]
    more = spark.createDataFrame([*rules, ("db", r"SQL \(")], "name string, pattern string")
    assert ("db", 1) in rows(agg.topic_counts_by_rules(made(spark), more))
    assert {r.id: r.topics for r in flt.topic_tags_by_rules(made(spark), more).collect()}[2] == ["db"]


def test_no_rules(spark):
    none = spark.createDataFrame([], "name string, pattern string")
    assert {tuple(r.topics) for r in flt.topic_tags_by_rules(made(spark), none).collect()} == {()}
    assert agg.topic_counts_by_rules(made(spark), none).count() == 0


def test_rules_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(flt, "MOST_RULES", 2)
    many = spark.createDataFrame([("a", "a"), ("b", "b"), ("c", "c")], "name string, pattern string")
    with pytest.raises(ValueError):
        flt.topic_tags_by_rules(made(spark), many)
