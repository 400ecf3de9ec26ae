"""Jobs hold all rows unless a limit is given."""

from datetime import datetime

from pyspark.sql import functions as F

from signalmine.plans import jobs
from signalmine.sources.fixtures import AS_OF_EVENTS, Fixtures


def test_jobs_hold_all_rows(spark, sf_small):
    fx = Fixtures(spark, sf_small)
    n = 27
    ids = spark.range(n * 3)
    misses = ids.select("id", F.concat(F.lit("query "), F.col("id") % n).alias("query"), F.lit(False).alias("resolved"),
                        F.lit(datetime(2024, 1, 30)).cast("timestamp_ntz").alias("created_at"))
    decisions = ids.limit(n).select("id", F.lit("s").alias("skill_name"), F.lit("t").alias("decision_type"),
                                    F.lit("j").alias("judge_decision"), F.lit(True).alias("was_applied"),
                                    F.expr(f"timestamp_ntz '{AS_OF_EVENTS}' - interval 1 hour").alias("created_at"))
    skills = ids.limit(n).select(F.concat(F.lit("s"), "id").alias("skill_name"), F.lit(True).alias("invoked"))
    first = fx.skill_metrics.drop("skill_name", "invoked").limit(1)
    metrics = skills.crossJoin(first).select(*fx.skill_metrics.columns)
    review = jobs.skill_review_job(decisions, fx.error_patterns, metrics, misses, AS_OF_EVENTS)
    assert (review["decisions"].count(), review["misses"].count(), review["scorecard"].count()) == (n, n, n)
    some = jobs.skill_review_job(decisions, fx.error_patterns, metrics, misses, AS_OF_EVENTS, k=10, n_skills=15)
    assert (some["decisions"].count(), some["misses"].count(), some["scorecard"].count()) == (10, 10, 15)

    lines = spark.range(n).select(F.format_string("2024-01-%02d-a.md", F.col("id") + 1).alias("file_name"),
                                  F.explode(F.array(*[F.struct(F.lit(i).alias("line_no"), F.lit(t).alias("line"))
                                                      for i, t in enumerate(("## Summary", "did a thing"), 1)])).alias("l"))
    lines = lines.select("file_name", "l.*")
    memo = jobs.memo_job(fx.learning_items, misses, lines)
    assert (memo["miss_clusters"].count(), memo["sessions"].count()) == (n, n)

    words = [chr(97 + i) * 8 for i in range(26)]
    item = fx.learning_items.drop("id", "lesson").where("not applied").limit(1)
    items = spark.range(6).select("id", F.concat(F.lit(" ".join(words) + " "), "id").alias("lesson")).crossJoin(item)
    report = jobs.consolidate_report(items.select(*fx.learning_items.columns), AS_OF_EVENTS)
    assert report.where("section = 'word'").count() == len(words)
