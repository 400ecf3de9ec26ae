"""Drift between code and documentation.

Code trees are tables ``(app, path, content)`` with the path relative to the
app's repository (``sources.files.scan_code`` + a prefix strip). Extraction
is ``regexp_extract_all`` + ``explode`` inside the scanning task; only
distinct (app, name) pairs reach a shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalmine.functions.constants import NOT_TABLES, SKIP_DIRS, TABLE_REF, TRIVIAL_ROUTE_GROUPS
from signalmine.operators.joins import undocumented_terms

CODE_PARTS = ["src", "lib", "app"]


def relative_paths(code: DataFrame, repos: DataFrame) -> DataFrame:
    """Attach the app and the path relative to its repository root.

    Every ancestor directory of a path is a candidate root (one row per
    level), so matching a file to its repository is an equi-join on the
    directory, not a ``startswith`` condition evaluated for every pair."""
    parts = F.split(F.col("path"), "/")
    ancestors = F.transform(F.sequence(F.lit(1), F.size(parts) - 1),
                            lambda i: F.array_join(F.slice(parts, 1, i), "/"))
    cand = code.select("path", "content", F.explode(ancestors).alias("repo"))
    j = cand.join(repos.select("app", F.regexp_replace("repo", "/+$", "").alias("repo")), "repo")
    return j.select("app", F.expr("substring(path, length(repo) + 2)").alias("rel_path"), "content")


def table_refs(code: DataFrame, path_col: str = "rel_path", only_code_parts: bool = True) -> DataFrame:
    """Distinct (app, table) named after FROM/INTO/UPDATE/JOIN/DELETE FROM
    (upper-case keywords only), holding '_' and not in the exclusion list."""
    src = code
    if only_code_parts:  # a code tree: only src/lib/app, never hidden directories
        src = src.filter(F.split(F.col(path_col), "/").getItem(0).isin(CODE_PARTS)
                         & ~F.col(path_col).rlike(r"(^|/)\.[^/]+/"))
    names = src.select("app", F.explode(F.regexp_extract_all("content", F.lit(TABLE_REF), 1)).alias("name"))
    return (names.filter(F.col("name").contains("_") & ~F.col("name").isin(NOT_TABLES))
            .distinct())


def route_groups(code: DataFrame, path_col: str = "rel_path") -> DataFrame:
    """Distinct (app, group): first folder under ``src/app/api`` or
    ``app/api`` whose subtree holds a route.ts/js/tsx; bracketed (dynamic)
    and trivial groups are skipped, and skipped directories are not entered."""
    m = F.regexp_extract(F.col(path_col), r"^(?:src/)?app/api/([^/]+)/(?:.*/)?route\.(?:ts|js|tsx)$", 1)
    segs = F.split(F.col(path_col), "/")
    in_skipped = F.exists(segs, lambda s: s.isin(SKIP_DIRS))
    g = code.select("app", F.lower(m).alias("route_group"), in_skipped.alias("_skip"))
    return (g.filter((F.col("route_group") != "") & ~F.col("_skip")
                     & ~F.col("route_group").startswith("[")
                     & ~F.col("route_group").isin(TRIVIAL_ROUTE_GROUPS))
            .select("app", "route_group").distinct())


def drift_report(apps: DataFrame, code: DataFrame, docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Routes and tables missing from each app's document.

    ``apps`` (app, repo, doc); ``code`` (app, rel_path, content); ``docs``
    (path, content) of the documents that exist. Returns (missing rows
    (app, kind, term), totals of each app that has a document, apps without
    document). ``drift_totals`` adds the term lists and the grand total.
    """
    present = apps.join(docs.select(F.col("path").alias("doc"), "content"), "doc")
    no_doc = apps.join(docs.select(F.col("path").alias("doc")), "doc", "left_anti").select("app", "doc")
    routes = route_groups(code).select("app", F.col("route_group").alias("term"), F.lit("route").alias("kind"))
    tables = table_refs(code).select("app", F.col("name").alias("term"), F.lit("table").alias("kind"))
    terms = routes.unionByName(tables).join(present.select("app"), "app", "left_semi")
    open_ = undocumented_terms(terms, present.select("app", F.col("content").alias("text")))
    missing = terms.join(open_, ["app", "term"], "left_semi").select("app", "kind", "term")
    counts = missing.groupBy("app").agg(
        F.count_if(F.col("kind") == "route").alias("missing_routes"),
        F.count_if(F.col("kind") == "table").alias("missing_tables"),
        F.count(F.lit(1)).alias("missing_total"))
    totals = present.select("app").distinct().join(counts, "app", "left").na.fill(0)
    return missing, totals, no_doc


def drift_totals(apps: DataFrame, missing: DataFrame, no_doc: DataFrame) -> DataFrame:
    """One row per app with a document (app, doc, routes, tables: sorted lists
    of what is missing; missing_total), and the grand total as app null."""
    pick = lambda kind: F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.col("term"))))
    lists = missing.groupBy("app").agg(pick("route").alias("routes"), pick("table").alias("tables"),
                                       F.count(F.lit(1)).alias("missing_total"))
    empty = F.array().cast("array<string>")
    per = (apps.join(no_doc.select("app"), "app", "left_anti").select("app", "doc").join(lists, "app", "left")
           .select("app", "doc", F.coalesce("routes", empty).alias("routes"), F.coalesce("tables", empty).alias("tables"),
                   F.coalesce("missing_total", F.lit(0)).alias("missing_total")))
    total = missing.agg(F.lit(None).cast("string").alias("app"), F.lit(None).cast("string").alias("doc"),
                        empty.alias("routes"), empty.alias("tables"), F.count(F.lit(1)).alias("missing_total"))
    return per.unionByName(total)


def drift_markdown(totals: DataFrame, no_doc: DataFrame) -> DataFrame:
    """The report as lines (section, line_no, line): a section per app with gaps,
    one for the total (first) and one for apps without document (last)."""
    def section(order: str, name, lines) -> list:
        return [F.lit(order).alias("part"), name.alias("section"), F.posexplode(lines).alias("line_no", "line")]

    bullets = lambda title, items, form: F.when(
        F.size(items) > 0, F.concat(F.array(F.concat(F.lit(f"Missing {title} ("), F.size(items).cast("string"), F.lit("):")),
                                            F.lit("")), F.transform(items, form), F.array(F.lit("")))
    ).otherwise(F.array().cast("array<string>"))
    tick = lambda left, x, right: F.concat(F.lit(left), x, F.lit(right))
    grand = totals.where("app is null").select(*section("0", F.lit(""), F.array(
        F.lit("# Drift Between Code and Documentation"), F.lit(""),
        tick("**Missing entries total: ", F.col("missing_total").cast("string"), "**"), F.lit(""))))
    per = totals.where("app is not null and missing_total > 0").select(*section("1", F.col("app"), F.concat(
        F.array(tick("## ", F.col("app"), ""), F.lit(""), tick("Document: `", F.col("doc"), "`"), F.lit("")),
        bullets("API areas", F.col("routes"), lambda r: tick("- `/api/", r, "/`")),
        bullets("tables", F.col("tables"), lambda t: tick("- `", t, "`")))))
    absent = no_doc.select(*section("2", F.col("app"), F.array(
        F.concat(F.lit("- "), F.col("app"), F.lit(": `"), F.col("doc"), F.lit("` missing")))))
    return grand.unionByName(per).unionByName(absent)
