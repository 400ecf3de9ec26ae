"""Derived views: the knowledge-base tables expressed over the driver's parquet.

The reference ships no data, so each of its tables is derived from the
driver's TPC-H-like tables and event stream (FIXTURES.md §2). The same
definitions exist as SQL text in ``signalmine.plans.oracle_views`` for the
DuckDB oracle. All joins here are equi-joins on keys; the planner picks the
strategy (AQE turns a side into a broadcast only when its measured size is
under ``spark.sql.autoBroadcastJoinThreshold``).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalmine.sources.tables import load_table

AS_OF_EVENTS = "2024-01-31 00:00:00"
AS_OF_TASKS = "2001-08-02 00:00:00"


def _bucket(value: F.Column) -> F.Column:
    return F.floor(value / 30).cast("int").cast("string")


def _pattern_key(user_id: F.Column, value: F.Column) -> F.Column:
    return F.concat(F.lit("err-"), user_id.cast("string"), F.lit("-b"), _bucket(value))


class Fixtures:
    """Lazily built derived views over one scale-factor directory."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base

    def table(self, name: str) -> DataFrame:
        return load_table(self.spark, self.base, name)

    # -- topic rules that a user keeps as a table -----------------------------
    @cached_property
    def topic_rules(self) -> DataFrame:
        n = F.lower("n_name")
        return self.table("nation").select(n.alias("name"), F.concat(
            F.lit("("), F.left(n, F.lit(3)), F.lit("|"), F.right(n, F.lit(3)), F.lit(")")).alias("pattern"))

    # -- failed searches ---------------------------------------------------
    @cached_property
    def rag_misses(self) -> DataFrame:
        e = self.table("events").filter(F.col("event_type") == "view")
        p = self.table("part").select("p_partkey", "p_name")
        return e.join(p, p.p_partkey == e.user_id).select(
            e.event_id.alias("id"),
            F.concat(F.lit("how to "), p.p_name).alias("query"),
            (e.value / 500).cast("decimal(5,4)").alias("best_score"),
            F.lit(0).alias("result_count"),
            (e.event_id % 3 == 0).alias("resolved"),
            e.ts.alias("created_at"),
        )

    # -- recurring problems, one row per key -------------------------------
    @cached_property
    def error_patterns(self) -> DataFrame:
        e = self.table("events").filter(F.col("event_type") == "error")
        p = self.table("part").select("p_partkey", "p_name", "p_type", "p_brand")
        j = e.join(p, p.p_partkey == e.user_id)
        bucket = F.floor(j.value / 30).cast("int")
        g = j.groupBy(j.user_id.alias("uid"), bucket.alias("bkt")).agg(
            F.min("p_type").alias("min_type"), F.min("p_name").alias("min_name"),
            F.min("p_brand").alias("min_brand"), F.count(F.lit(1)).alias("occurrence_count"),
            F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"))
        return g.select(
            F.concat(F.lit("err-"), g.uid.cast("string"), F.lit("-b"), g.bkt.cast("string")).alias("pattern_key"),
            F.lower("min_type").alias("category"),
            F.concat(F.lit("failure near "), g.min_name).alias("description"),
            F.lower("min_brand").alias("related_skill"),
            "occurrence_count",
            (g.uid % 5 == 0).alias("resolved"),
            (g.uid % 7 == 0).alias("addressed"),
            "first_seen", "last_seen",
        )

    # -- learning items ----------------------------------------------------
    @cached_property
    def learning_items(self) -> DataFrame:
        """A row per document; some error items name a pattern key and some
        session items a session file, as the items of earlier runs do."""
        d = self.table("documents").select("doc_id", "text", "source")
        open_flag = d.doc_id % 4 == 0
        created = F.expr("TIMESTAMP_NTZ'2023-12-02 00:00:00' + make_dt_interval(0, 0, cast(doc_id * 7919 % 86400 as int))")
        lesson = (F.when(d.doc_id % 9 == 0, F.concat(
            F.lit("Recurring problem: err-"), F.expr("(doc_id div 9) % 150").cast("string"), F.lit("-b"),
            F.expr("(doc_id div 27) % 2").cast("string"), F.lit(" - "), d.text))
            .when(d.doc_id % 15 == 1, F.concat(F.lit("Session session-"), F.expr("doc_id div 15").cast("string"),
                                               F.lit(".md: "), d.text)).otherwise(d.text))
        return d.select(
            d.doc_id.alias("id"),
            F.when(d.doc_id % 3 == 0, "error").when(d.doc_id % 3 == 1, "session")
             .otherwise("rag_miss").alias("source"),
            lesson.alias("lesson"),
            d.source.alias("applicable_to"),
            (1 + d.doc_id % 7).cast("int").alias("occurrence_count"),
            open_flag.alias("applied"),
            F.when(open_flag, created).alias("applied_at"),
            created.alias("created_at"),
        )

    @cached_property
    def learning_items_tagged(self) -> DataFrame:
        li = self.learning_items
        prefix = (F.when(li.id % 6 == 0, "deploy ").when(li.id % 6 == 1, "login ")
                  .when(li.id % 6 == 2, "sql ").when(li.id % 6 == 3, "e2e ")
                  .when(li.id % 6 == 4, "vault ").otherwise(""))
        return li.withColumn("lesson", F.concat(prefix, li.lesson))

    # -- skills ------------------------------------------------------------
    @cached_property
    def skill_metrics(self) -> DataFrame:
        e = self.table("events")
        p = self.table("part").select("p_partkey", "p_brand")
        j = e.join(p, p.p_partkey == e.user_id)
        return j.select(
            j.event_id.alias("id"), F.lower(j.p_brand).alias("skill_name"),
            (j.event_type != "view").alias("invoked"), (j.event_type != "error").alias("success"),
            j.value.cast("decimal(8,2)").alias("duration_minutes"), j.ts.alias("created_at"))

    @cached_property
    def skill_proposals(self) -> DataFrame:
        e = self.table("events").filter(F.col("event_type") == "signup")
        return e.select(
            e.event_id.alias("id"),
            F.concat(F.lit("dreaming:"), _pattern_key(e.user_id, e.value)).alias("target_skill"),
            F.when(e.event_id % 3 == 0, "pending").when(e.event_id % 3 == 1, "rejected")
             .otherwise("auto_merged").alias("status"),
            (1 + e.event_id % 5).cast("int").alias("recurrence_count"),
            e.ts.alias("created_at"))

    @cached_property
    def skill_decisions(self) -> DataFrame:
        e = self.table("events").filter(F.col("event_type") == "purchase")
        p = self.table("part").select("p_partkey", "p_brand")
        j = e.join(p, p.p_partkey == e.user_id)
        return j.select(
            j.event_id.alias("id"), F.lower(j.p_brand).alias("skill_name"),
            F.when(j.event_id % 3 == 0, "autonomous").otherwise("manual").alias("decision_type"),
            F.when(j.value < 50, "accept").otherwise("reject").alias("judge_decision"),
            (j.value < 50).alias("was_applied"), j.ts.alias("created_at"))

    # -- tasks and commits ---------------------------------------------------
    @cached_property
    def tasks(self) -> DataFrame:
        o = self.table("orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", "o_orderdate")
        li = self.table("lineitem").select("l_orderkey", "l_partkey")
        p = self.table("part").select("p_partkey", "p_name")
        j = o.join(li, li.l_orderkey == o.o_orderkey).join(p, p.p_partkey == li.l_partkey)
        g = j.groupBy("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", "o_orderdate").agg(
            F.min("p_name").alias("pmin"), F.max("p_name").alias("pmax"))
        return g.select(
            g.o_orderkey.alias("id"),
            F.concat(F.lit("repo-"), (g.o_custkey % 20).cast("string")).alias("target_repo"),
            F.when(g.o_orderpriority == "1-URGENT", "bug").when(g.o_orderpriority == "2-HIGH", "security")
             .when(g.o_orderpriority == "3-MEDIUM", "ops").otherwise("feature").alias("category"),
            F.when(g.o_orderstatus == "F", "completed").otherwise("open").alias("status"),
            F.concat(F.lit("Fix "), g.pmin, F.lit(" in "), g.pmax).alias("prompt"),
            g.o_orderdate.alias("completed_at"),
            F.lit(None).cast("string").alias("outcome"))

    @cached_property
    def commits(self) -> DataFrame:
        o = self.table("orders")
        return o.select(
            F.concat(F.lit("repo-"), (o.o_custkey % 20).cast("string")).alias("repo"),
            o.o_orderkey.alias("sha"),
            F.concat(F.lit("change "), o.o_orderpriority).alias("subject"),
            o.o_orderdate.alias("committed_at"),
            (o.o_orderstatus == "P").alias("is_merge"))

    # -- text line tables ----------------------------------------------------
    @cached_property
    def session_lines(self) -> DataFrame:
        """A file per conversation: a title, then the whole text of every turn,
        split into its lines; user turns start as a fix or as a result section."""
        c = self.table("conversations")
        head = F.when(c.turn == 0, F.concat(F.lit("# Session "), c.conv_id.cast("string"), F.lit("\n"))).otherwise("")
        mark = F.when((c.role == "user") & (c.conv_id % 3 != 0), "- Fix: ").when(c.role == "user", "## Result\n").otherwise("")
        body = F.concat(head, mark, F.coalesce(c.text, F.lit("")))
        lines = c.select("conv_id", "turn", F.posexplode(F.split(body, "\n")).alias("pos", "line"))
        return lines.select(
            lines.conv_id.alias("session_id"),
            F.concat(F.lit("session-"), lines.conv_id.cast("string"), F.lit(".md")).alias("file_name"),
            F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, 0, cast(conv_id * 7919 % 43200 as int))")
             .alias("modified_at"),
            (lines.turn.cast("long") * 100000 + lines.pos).alias("line_no"), "line")

    @cached_property
    def findings(self) -> DataFrame:
        e = self.table("events")
        line = (
            F.when(e.event_type == "error",
                   F.concat(F.lit("PATTERN|"), _pattern_key(e.user_id, e.value), F.lit("|cause "), e.props,
                            F.lit("|try a | b")))
            .when(e.event_type == "view", F.concat(F.lit("APPLY|"), (e.event_id % 1000).cast("string"), F.lit("|where|how")))
            .when(e.event_type == "click", F.concat(F.lit("PLAYBOOK|Slow Page "), e.user_id.cast("string"), F.lit("|diag|fix")))
            .when(e.event_type == "purchase", F.concat(F.lit("VAULTGAP|topic "), e.user_id.cast("string"), F.lit("|")))
            .otherwise(F.lit("free text without a type")))
        return e.select(e.event_id.alias("line_no"), line.alias("line"))

    # -- documents with embeddings ---------------------------------------------
    @cached_property
    def kb_docs(self) -> DataFrame:
        """The vectors, and for each recent document a twin (same vector, id +
        10^9), which is its nearest neighbour."""
        v = self.table("embeddings")
        docs = v.select(v.vec_id.alias("doc_id"), "embedding", "label", (v.vec_id % 25 == 0).alias("is_recent"))
        twins = docs.where("is_recent").select((F.col("doc_id") + 1000000000).alias("doc_id"), "embedding", "label",
                                               F.lit(False).alias("is_recent"))
        return docs.unionByName(twins)

    @cached_property
    def kb_links(self) -> DataFrame:
        """Links, among them those of half the recent documents to their twins."""
        v = self.table("embeddings")
        even = v.filter(v.vec_id % 2 == 0).select(v.vec_id.alias("src"), (v.vec_id + 1).alias("dst"))
        return even.unionByName(v.filter(v.vec_id % 50 == 0).select(
            v.vec_id.alias("src"), (v.vec_id + 1000000000).alias("dst")))

    @cached_property
    def kb_texts(self) -> DataFrame:
        """The documents with ``[[links]]`` at the end of every fifth; a quarter of
        the recent ones mention their twin."""
        d = self.table("documents").select("doc_id", "text")
        own = F.when(d.doc_id % 100 == 25, F.concat(F.lit("\n[["), (d.doc_id + 1000000000).cast("string"), F.lit("]]")))
        some = F.when(d.doc_id % 5 == 0, F.concat(F.lit("\nSee [[note-"), (d.doc_id % 7).cast("string"), F.lit("]] and [["),
                                                  (d.doc_id + 1).cast("string"), F.lit("]].")))
        return d.select("doc_id", F.concat("text", F.coalesce(some, F.lit("")), F.coalesce(own, F.lit(""))).alias("text"))

    @cached_property
    def miss_vectors(self) -> DataFrame:
        """Vectors of failed searches: those of the table, turned round for odd ids."""
        m = self.rag_misses.select("id", (F.col("id") % 500).alias("vec_id"))
        v = self.table("embeddings").select("vec_id", "embedding")
        sign = F.when(F.col("id") % 2 == 0, F.lit(1.0)).otherwise(F.lit(-1.0))
        return m.join(v, "vec_id").select("id", F.transform("embedding", lambda x: x.cast("double") * sign).alias("embedding"))

    # -- phases of multi-phase runs ---------------------------------------------
    @cached_property
    def phase_runs(self) -> DataFrame:
        li = self.table("lineitem")
        return li.select(
            li.l_orderkey.alias("run_id"), li.l_linenumber.alias("phase"),
            (F.floor(li.l_extendedprice).cast("decimal(12,0)") * F.lit(0.01).cast("decimal(3,2)"))
            .cast("decimal(12,2)").alias("cost_usd"),
            li.l_quantity.cast("int").alias("duration_s"),
            (li.l_returnflag != "R").alias("gate_ok"),
            F.lit(800).cast("decimal(12,2)").alias("max_budget_usd"))

    # -- terms to look up per document language -----------------------------------
    @cached_property
    def doc_terms(self) -> DataFrame:
        """The words of the benchmark items, as terms of one language each."""
        b = self.table("benchmark")
        app = F.get(F.array(F.lit("en"), F.lit("de"), F.lit("fr"), F.lit("es")), (b.item_id % 4).cast("int"))
        return b.select(app.alias("app"), F.explode(F.regexp_extract_all(
            F.lower("text"), F.lit("[a-z0-9_]+"), 0)).alias("term")).distinct()

    @cached_property
    def documents(self) -> DataFrame:
        return self.table("documents")

    # -- code trees and their documents (a part is a file, a brand an app) -----------
    @cached_property
    def code_apps(self) -> DataFrame:
        app = F.lower(F.regexp_replace("p_brand", "#", "-"))
        return self.table("part").select(app.alias("app")).distinct().select(
            "app", F.concat(F.lit("/r/"), F.col("app")).alias("repo"),
            F.concat(F.lit("docs/"), F.col("app"), F.lit(".md")).alias("doc"))

    @cached_property
    def code_files(self) -> DataFrame:
        p = self.table("part")
        name = lambda sep: F.regexp_replace(p.p_name, " ", sep)
        path = (F.when(p.p_partkey % 4 == 0, F.concat(F.lit("src/app/api/"), name("-"), F.lit("/route.ts")))
                .when(p.p_partkey % 4 == 1, F.concat(F.lit("src/lib/q"), p.p_partkey.cast("string"), F.lit(".ts")))
                .when(p.p_partkey % 4 == 2, F.concat(F.lit("vendor/q"), p.p_partkey.cast("string"), F.lit(".ts")))
                .otherwise(F.lit("app/api/health/route.js")))
        content = F.concat(F.lit("SELECT a FROM "), name("_"), F.lit(" JOIN created_at; UPDATE \""),
                           F.lower(p.p_type), F.lit("_stock\" SET x"))
        return p.select(F.lower(F.regexp_replace("p_brand", "#", "-")).alias("app"), path.alias("rel_path"),
                        content.alias("content"))

    @cached_property
    def code_docs(self) -> DataFrame:
        """Documents of the apps with an even number, naming a part of the terms."""
        p = self.table("part").where("p_partkey % 3 = 0")
        app = F.lower(F.regexp_replace("p_brand", "#", "-"))
        lines = F.array_sort(F.collect_set(F.concat(F.lit("Table "), F.regexp_replace("p_name", " ", "_"), F.lit(", area "),
                                                    F.regexp_replace("p_name", " ", "-"), F.lit("."))))
        return (p.where("cast(substring(p_brand, 7) as int) % 2 = 0").groupBy(app.alias("app"))
                .agg(F.array_join(lines, "\n").alias("content"))
                .select(F.concat(F.lit("docs/"), F.col("app"), F.lit(".md")).alias("path"), "content"))

    # -- replies and logs, a row per line or per text --------------------------------
    @cached_property
    def reply_lines(self) -> DataFrame:
        """Classification replies: id|action|description, some of them invalid."""
        d = self.table("documents")
        action = F.get(F.array(*[F.lit(x) for x in ("guard", " Memory ", "VAULT", "config", "skip", "other")]),
                       (d.doc_id % 6).cast("int"))
        return d.select(d.doc_id.alias("line_no"), F.concat(
            F.when(d.doc_id % 11 == 0, "none").otherwise(F.concat(F.lit("#"), d.doc_id.cast("string"))), F.lit("|"),
            action, F.lit("|about "), d.source, F.when(d.doc_id % 2 == 0, "|").otherwise("")).alias("line"))

    @cached_property
    def stub_replies(self) -> DataFrame:
        """A reply per repeated query; some lack the folder."""
        m = self.rag_misses.where("not resolved").groupBy("query").agg(F.min("id").alias("n")).select(
            F.col("query").alias("query_prefix"), "n")
        return m.select("query_prefix", F.concat(
            F.lit("FOLDER: "), F.when(F.col("n") % 4 == 0, "").otherwise("guides"), F.lit("\nFILE: "),
            F.regexp_replace("query_prefix", " ", "_"), F.lit(".md\nCONTENT:\nAbout "), F.col("query_prefix"),
            F.lit(".\nMore.")).alias("reply"))

    @cached_property
    def skill_learning_lines(self) -> DataFrame:
        """A learnings file per brand, a dated block per part."""
        p = self.table("part")
        block = F.array(
            F.concat(F.lit("## 2024-01-"), F.lpad((1 + p.p_partkey % 28).cast("string"), 2, "0"), F.lit(": "), p.p_name),
            F.concat(F.lit("Score: "), (p.p_partkey % 6).cast("string"), F.lit(" Runs: "), (p.p_partkey % 5).cast("string")),
            F.when(p.p_partkey % 7 == 0, "CRYSTALLIZED").otherwise("open"))
        lines = p.select(F.lower("p_brand").alias("skill"), "p_partkey", F.posexplode(block).alias("pos", "line"))
        return lines.select("skill", (F.col("p_partkey") * 10 + F.col("pos")).alias("line_no"), "line")

    @cached_property
    def task_lines(self) -> DataFrame:
        """A task document per order: front matter (absent in some), then phases."""
        o = self.table("orders")
        matter = F.array(F.lit("---"), F.concat(F.lit('title: "Task '), o.o_orderkey.cast("string"), F.lit('"')),
                         F.concat(F.lit("max_budget_usd: "), F.when(o.o_orderkey % 3 == 0, "").otherwise(
                             (1 + o.o_orderkey % 20).cast("string"))), F.lit("---"))
        phases = F.flatten(F.transform(F.sequence(F.lit(1), (1 + o.o_orderkey % 3).cast("int")), lambda i: F.array(
            F.concat(F.lit("## Phase "), (i * 2).cast("string"), F.lit(": do")), F.concat(F.lit("step "), i.cast("string")),
            F.when(i % 2 == 0, "## Notes").otherwise("more"))))
        lines = F.concat(F.when(o.o_orderkey % 5 == 0, F.array().cast("array<string>")).otherwise(matter), phases)
        return o.select(F.concat(F.lit("tasks/"), o.o_orderkey.cast("string"), F.lit(".md")).alias("path"),
                        F.posexplode(lines).alias("line_no", "line"))
