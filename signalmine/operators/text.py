"""Text extraction over line tables and whole documents.

Documents are line tables ``(file, line_no, line)``; "first n matching lines
per file" is a filter plus a per-file ``row_number`` (WindowGroupLimit), and
ordered text assembly is ``array_sort`` of ``(line_no, text)`` structs, never a
bare ``collect_list`` whose order a shuffle could change. Sections are a
running sum of heading flags over one file's lines, in two levels (within chunks
of lines, and over the chunks' totals), so a very long file is many tasks' work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalmine.functions.constants import (
    CLASSIFY_ACTIONS, GAP_STUB_TEXT, PLAYBOOK_TEXT, STUB_TEXT, CRYSTALLIZE_MIN_RUNS, CRYSTALLIZE_MIN_SCORE, FALLBACK_HEADING, FINDING_TYPES,
    HEADLINE, LESSON_BULLET, SESSION_ITEM_PREFIX, SUMMARY_LINE,
)
from signalmine.functions.text import digits_only, left, slugify
from signalmine.operators.joins import sessions_without_item
from signalmine.operators.ranking import top_per_group


def ordered_text(line_no: str, text: str, sep: str = "\n") -> Column:
    """Aggregate: lines joined in ``line_no`` order (shuffle-safe)."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(line_no), F.col(text)))),
                                    lambda x: x[text]), sep)


# ---- session logs ------------------------------------------------------------------

def session_headline(lines: DataFrame, file_col: str = "file_name", max_len: int | None = None) -> DataFrame:
    """First line with RESULT/result/Result/'## ' per file."""
    hits = lines.filter(F.col("line").rlike(HEADLINE))
    return hits.groupBy(file_col).agg(left(F.min_by("line", "line_no"), max_len).alias("headline"))


def summary_counts(lines: DataFrame, file_col: str = "file_name") -> DataFrame:
    """Number of summary lines per file, without building their text."""
    return (lines.filter(F.col("line").rlike(SUMMARY_LINE)).groupBy(file_col)
            .agg(F.count(F.lit(1)).alias("summary_lines")))


def session_summary(lines: DataFrame, file_col: str = "file_name", n: int | None = None) -> DataFrame:
    """The summary lines of each file (the first ``n`` if given), joined, and how many there are."""
    hits = lines.filter(F.col("line").rlike(SUMMARY_LINE))
    if n is not None:
        hits = top_per_group(hits, [file_col], [F.col("line_no")], n)
    return hits.groupBy(file_col).agg(ordered_text("line_no", "line").alias("summary"),
                                      F.count(F.lit(1)).alias("summary_lines"))


def strip_bullet(col: Column) -> Column:
    return F.regexp_replace(col, r"^\s*[-*]\s*", "")


def session_lessons(lines: DataFrame, file_col: str = "file_name", n: int | None = None) -> DataFrame:
    """Bullet lines holding a lesson key word (case-insensitive), ranked per file; the first ``n`` if given."""
    hits = lines.filter(F.col("line").rlike("(?i)" + LESSON_BULLET))
    return top_per_group(hits, [file_col], [F.col("line_no")], n, "lesson_rank")


CHUNK_LINES = 10_000  # lines of a file that one window holds


def section_ids(lines: DataFrame, file_col: str, heading: Column, chunk_lines: int = CHUNK_LINES) -> DataFrame:
    """``lines`` with _is_head and section: the headings of the file up to the line
    (0 before the first). A line without text is no heading."""
    chunk = F.floor(F.col("line_no") / chunk_lines)
    flagged = lines.withColumn("_is_head", F.coalesce(heading, F.lit(False))).withColumn("_chunk", chunk)
    earlier = Window.partitionBy(file_col).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = (flagged.groupBy(file_col, "_chunk").agg(F.count_if("_is_head").alias("_n"))
              .select(file_col, "_chunk", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
              .filter(F.col("_before") > 0))
    # the earlier headings as a first row of the chunk: a join could broadcast all lines, whose size no plan knows
    marked = flagged.withColumn("_before", F.lit(None).cast("long")).unionByName(before, allowMissingColumns=True)
    within = (Window.partitionBy(file_col, "_chunk").orderBy(F.col("_before").desc_nulls_last(), "line_no")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    counted = marked.withColumn("section", F.sum(F.coalesce("_before", F.col("_is_head").cast("long"))).over(within))
    return counted.filter(F.col("_before").isNull()).drop("_chunk", "_before")


def session_lessons_fallback(lines: DataFrame, file_col: str = "file_name", n: int | None = None) -> DataFrame:
    """Headings result/insight/... (case-insensitive) followed by body text
    before the next '##' heading; a body line has a letter, is not a quote
    and not blank. Ranked per file; the first ``n`` if given."""
    any_head = F.col("line").startswith("##")
    s = section_ids(lines, file_col, any_head)
    body = (~F.col("_is_head") & ~F.col("line").startswith(">") & F.col("line").rlike(r"\p{L}"))
    sect = s.groupBy(file_col, "section").agg(
        F.min_by(F.when(F.col("_is_head"), F.col("line")), F.when(F.col("_is_head"), F.col("line_no"))).alias("heading"),
        F.min(F.when(F.col("_is_head"), F.col("line_no"))).alias("line_no"),
        F.max(body.cast("int")).alias("has_body"))
    good = sect.filter(F.col("heading").rlike("(?i)" + FALLBACK_HEADING) & (F.col("has_body") == 1))
    return top_per_group(good.select(file_col, "line_no", F.col("heading").alias("line")),
                         [file_col], [F.col("line_no")], n, "lesson_rank")


def first_lessons(lines: DataFrame, file_col: str = "file_name") -> DataFrame:
    """Per file the first lesson: a bullet lesson, or else the fallback heading."""
    bullets = session_lessons(lines, file_col, 1) \
        .select(file_col, F.col("line").alias("raw"), F.lit(1).alias("prio"))
    heads = session_lessons_fallback(lines, file_col, 1) \
        .select(file_col, F.col("line").alias("raw"), F.lit(2).alias("prio"))
    both = bullets.unionByName(heads)
    best = both.groupBy(file_col).agg(F.min_by("raw", "prio").alias("raw"))
    return best.select(file_col, strip_bullet(F.col("raw")).alias("lesson"))


def session_items(lines: DataFrame, items: DataFrame, file_col: str = "file_name") -> DataFrame:
    """New 'session' items: first lesson of every file not yet named in a session item."""
    files = lines.select(file_col).distinct()
    todo = sessions_without_item(files, items, file_col)
    lessons = first_lessons(lines.join(todo, file_col, "left_semi"), file_col)
    return lessons.select(
        F.lit("session").alias("source"),
        F.concat(F.lit(SESSION_ITEM_PREFIX), F.col(file_col), F.lit(": "), F.col("lesson")).alias("lesson"),
        F.lit(None).cast("string").alias("applicable_to"),
        F.lit(1).alias("occurrence_count"))


def combine_sessions(lines: DataFrame, file_col: str = "file_name", max_lines: int | None = None) -> DataFrame:
    """(file, block): one '--- SESSION: <file> ---' block per file with its lines
    (the first ``max_lines`` if given). The whole digest is these blocks in file
    order; a reader that needs it as one text takes as many as fit."""
    heads = lines if max_lines is None else top_per_group(lines, [file_col], [F.col("line_no")], max_lines)
    per_file = heads.groupBy(file_col).agg(ordered_text("line_no", "line").alias("content"))
    return per_file.select(file_col, F.concat(F.lit("\n\n--- SESSION: "), F.col(file_col), F.lit(" ---\n"),
                                              F.col("content")).alias("block"))


def bullet_lines(lines: DataFrame, text_col: str = "line") -> DataFrame:
    """Numbered, bullet and '##' lines (the intended ``^[0-9]+\\.`` form)."""
    return lines.filter(F.col(text_col).rlike(r"^[0-9]+\.|^-|^##"))


# ---- pipe-separated replies -------------------------------------------------------------

def _read_field(col: Column) -> Column:
    """Last field of shell ``read``: one trailing delimiter is dropped when the
    remainder holds no other delimiter."""
    return F.when(col.rlike(r"^[^|]*\|$"), F.regexp_replace(col, r"\|$", "")).otherwise(col)


def parse_findings(findings: DataFrame) -> DataFrame:
    """``TYPE|a|b|c`` lines -> (line_no, type, key, b, c); VAULTGAP has
    (topic, path). Untyped lines get type NULL. Fields like shell ``read``:
    the last field keeps any extra pipes."""
    four = F.split(F.col("line"), r"\|", 4)
    three = F.split(F.col("line"), r"\|", 3)
    typ = F.element_at(four, 1)
    is_gap = typ == "VAULTGAP"
    a = F.when(is_gap, F.get(three, 1)).otherwise(F.get(four, 1))
    b = F.when(is_gap, _read_field(F.get(three, 2))).otherwise(F.get(four, 2))
    c = F.when(is_gap, F.lit(None)).otherwise(_read_field(F.get(four, 3)))
    return findings.select(
        "line_no", F.when(typ.isin(FINDING_TYPES), typ).alias("type"),
        F.coalesce(a, F.lit("")).alias("key"), F.coalesce(b, F.lit("")).alias("b"), c.alias("c"))


def typed_findings(findings: DataFrame, kind: str) -> DataFrame:
    """Findings of one type with a non-blank key."""
    return parse_findings(findings).filter((F.col("type") == kind) & (F.col("key") != ""))


def playbooks_from_findings(findings: DataFrame, folder: str = "playbooks") -> DataFrame:
    """PLAYBOOK|symptom|diagnosis|fix -> (path, slug, symptom, diagnosis, fix);
    the first finding per slug wins."""
    f = typed_findings(findings, "PLAYBOOK").withColumn("slug", slugify("key"))
    first = top_per_group(f, ["slug"], [F.col("line_no")], 1, "_r").drop("_r")
    return first.select(F.concat(F.lit(folder + "/"), F.col("slug"), F.lit(".md")).alias("path"), "slug",
                        F.col("key").alias("symptom"), F.col("b").alias("diagnosis"), F.col("c").alias("fix"),
                        "line_no")


def playbook_content(pb: DataFrame, day: str, run_id: str | int) -> DataFrame:
    """Playbooks as documents (path, content)."""
    body = F.format_string(
        PLAYBOOK_TEXT, F.col("symptom"), F.lit(day), F.lit(str(run_id)), F.col("symptom"), F.col("symptom"),
        F.col("diagnosis"), F.col("fix"), F.lit(day), F.lit(str(run_id)))
    return pb.select("path", body.alias("content"))


def stub_content(stubs: DataFrame, day: str, run_id: str | int) -> DataFrame:
    """Stubs of ``stubs_from_findings`` as documents (path, content)."""
    body = F.format_string(STUB_TEXT, F.col("topic"), F.lit(day), F.col("topic"), F.lit(str(run_id)), F.lit(day))
    return stubs.select("path", body.alias("content"))


def gap_stub_content(stubs: DataFrame, day: str, query_col: str = "query_prefix",
                     creator: str = "gap-filler") -> DataFrame:
    """Parsed replies (folder, file, content, the query) as stub documents: front
    matter, a note naming the query, the reply's content."""
    title = F.regexp_replace(F.regexp_replace("file", r"\.md$", ""), "_", " ")
    body = F.format_string(GAP_STUB_TEXT, title, F.lit(day), F.lit(creator), F.col(query_col), title, F.col(query_col),
                           F.col("content"), F.lit(day), F.lit(creator), F.col(query_col))
    return stubs.select(query_col, F.concat_ws("/", "folder", "file").alias("path"), body.alias("content"))


def stubs_from_findings(findings: DataFrame) -> DataFrame:
    """VAULTGAP|topic|path -> (path, topic); default path from the topic; first per path."""
    f = typed_findings(findings, "VAULTGAP")
    default = F.concat(F.lit("known-issues/STUB_"), F.regexp_replace("key", " ", "_"), F.lit(".md"))
    f = f.withColumn("path", F.coalesce(F.nullif(F.col("b"), F.lit("")), default))
    first = top_per_group(f, ["path"], [F.col("line_no")], 1, "_r").drop("_r")
    return first.select("path", F.col("key").alias("topic"), "line_no")


def applied_ids(findings: DataFrame) -> DataFrame:
    """Item ids named by APPLY findings (digits only)."""
    return (typed_findings(findings, "APPLY").select(digits_only("key").alias("id"))
            .filter(F.col("id").isNotNull()).distinct())


def pattern_findings(findings: DataFrame) -> DataFrame:
    """PATTERN findings with the key trimmed and inner blanks collapsed (``xargs``)."""
    f = typed_findings(findings, "PATTERN")
    return f.withColumn("key", F.regexp_replace(F.trim("key"), r"\s+", " ")).filter(F.col("key") != "")


def parse_classifications(lines: DataFrame) -> DataFrame:
    """``id|action|description``: id digits only, action lower-cased without
    blanks and one of the five actions; everything else is ignored."""
    parts = F.split(F.col("line"), r"\|", 3)
    action = F.regexp_replace(F.lower(F.get(parts, 1)), r"\s", "")
    out = lines.select("line_no", digits_only(F.get(parts, 0)).alias("id"), action.alias("action"),
                       _read_field(F.coalesce(F.get(parts, 2), F.lit(""))).alias("description"))
    return out.filter(F.col("id").isNotNull() & F.col("action").isin(CLASSIFY_ACTIONS))


def parse_stub_reply(replies: DataFrame, text_col: str = "reply") -> DataFrame:
    """FOLDER:, FILE: and CONTENT: fields of a reply; dropped without folder or file."""
    t = F.col(text_col)
    out = replies.withColumn("folder", F.trim(F.regexp_extract(t, r"(?m)^FOLDER:[ \t]*(.*)$", 1))) \
        .withColumn("file", F.trim(F.regexp_extract(t, r"(?m)^FILE:[ \t]*(.*)$", 1))) \
        .withColumn("content", F.regexp_extract(t, r"(?s)CONTENT:\s*(.*)$", 1))
    return out.filter((F.col("folder") != "") & (F.col("file") != ""))


# ---- skills, tasks ----------------------------------------------------------------------------

def crystallization_candidates(lines: DataFrame, skill_col: str = "skill",
                               min_score: int = CRYSTALLIZE_MIN_SCORE, min_runs: int = CRYSTALLIZE_MIN_RUNS) -> DataFrame:
    """Dated '## <date>: title' blocks of learnings without CRYSTALLIZED whose
    first Score >= 4 and first Runs >= 3."""
    s = section_ids(lines, skill_col, F.col("line").startswith("## "))
    score = F.regexp_extract("line", r"Score:\s*([0-9]+)", 1)
    runs = F.regexp_extract("line", r"Runs:\s*([0-9]+)", 1)
    s = s.withColumn("_score", F.when(score != "", score.cast("int"))) \
         .withColumn("_runs", F.when(runs != "", runs.cast("int")))
    blocks = s.filter(F.col("section") > 0).groupBy(skill_col, "section").agg(
        F.min_by(F.when(F.col("_is_head"), F.col("line")), F.when(F.col("_is_head"), F.col("line_no"))).alias("heading"),
        F.max(F.col("line").rlike("(?i)CRYSTALLIZED").cast("int")).alias("done"),
        F.min_by("_score", F.when(F.col("_score").isNotNull(), F.col("line_no"))).alias("score"),
        F.min_by("_runs", F.when(F.col("_runs").isNotNull(), F.col("line_no"))).alias("runs"))
    return (blocks.filter(F.col("heading").rlike("^## [0-9]") & (F.col("done") == 0)
                          & (F.col("score") >= min_score) & (F.col("runs") >= min_runs))
            .select(skill_col, F.regexp_replace("heading", r"^## [0-9-]*: ", "").alias("title"), "score", "runs"))


FRONT_MATTER_KEYS = ["title", "app", "repo", "branch", "max_budget_usd", "max_hours", "verification"]


def task_front_matter(lines: DataFrame, file_col: str = "path", default_budget: float = 10.0,
                      default_hours: float = 8) -> DataFrame:
    """Front-matter keys of task documents (lines between the first two '---')."""
    dashes = top_per_group(lines.filter(F.col("line") == "---").select(file_col, "line_no"), [file_col],
                           [F.col("line_no")], 2, "_r")
    bounds = dashes.groupBy(F.col(file_col).alias("_file")).agg(
        F.min(F.when(F.col("_r") == 1, F.col("line_no"))).alias("_from"),
        F.min(F.when(F.col("_r") == 2, F.col("line_no"))).alias("_to"))
    keyed = lines.filter(F.col("line").rlike("^(" + "|".join(FRONT_MATTER_KEYS) + "):"))
    inside = keyed.join(bounds, F.col(file_col) == F.col("_file")).filter(
        (F.col("line_no") > F.col("_from")) & (F.col("_to").isNull() | (F.col("line_no") < F.col("_to"))))
    kv = inside.select(file_col, "line_no", F.regexp_extract("line", r"^([A-Za-z_]+):", 1).alias("k"),
                       F.regexp_replace(F.regexp_replace("line", r"^[A-Za-z_]+: *", ""), '"', "").alias("v"))
    kv = kv.filter(F.col("k").isin(FRONT_MATTER_KEYS))
    firsts = kv.groupBy(file_col).pivot("k", FRONT_MATTER_KEYS).agg(F.min_by("v", "line_no"))
    firsts = lines.select(file_col).distinct().join(firsts, file_col, "left")  # none of the keys: the defaults
    return (firsts.withColumn("max_budget_usd", F.coalesce(F.nullif("max_budget_usd", F.lit("")),
                                                           F.lit(str(default_budget))).cast("decimal(12,2)"))
            .withColumn("max_hours", F.coalesce(F.nullif("max_hours", F.lit("")),
                                                F.lit(str(default_hours))).cast("double"))
            .withColumn("verification", F.coalesce(F.nullif("verification", F.lit("")), F.lit("full"))))


def task_phases(lines: DataFrame, file_col: str = "path") -> DataFrame:
    """'## Phase N: ...' sections renumbered 1..n; another '## ' heading ends one."""
    is_phase = F.col("line").rlike(r"^## Phase [0-9]+:")
    is_head = F.col("line").startswith("## ")
    s = section_ids(lines, file_col, is_head)
    sect = s.groupBy(file_col, "section").agg(
        F.max(F.when(F.col("_is_head"), is_phase.cast("int"))).alias("is_phase"),
        F.min(F.when(F.col("_is_head"), F.col("line_no"))).alias("start"),
        ordered_text("line_no", "line").alias("prompt"))
    phases = sect.filter(F.col("is_phase") == 1)
    w = Window.partitionBy(file_col).orderBy("start")
    return phases.select(file_col, F.row_number().over(w).alias("phase"), "prompt")


def doc_query_text(lines: DataFrame, file_col: str = "file_name", head: int | None = None,
                   take: int | None = None) -> DataFrame:
    """Lines joined by a space without '---' and blank ones (of the first ``head``
    lines, the first ``take`` left, if given)."""
    first = lines if head is None else top_per_group(lines, [file_col], [F.col("line_no")], head, "_r")
    kept = first.filter((F.col("line") != "---") & (F.trim(F.col("line")) != ""))
    picked = kept if take is None else top_per_group(kept, [file_col], [F.col("line_no")], take, "_r2")
    return picked.groupBy(file_col).agg(ordered_text("line_no", "line", " ").alias("query_text"))


def wiki_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every ``[[target]]`` occurrence as an edge (src, dst, position)."""
    found = F.regexp_extract_all(F.col(text_col), F.lit(r"\[\[([^\]]+)\]\]"), 1)
    return docs.select(F.col(id_col).alias("src"), F.posexplode(found).alias("pos", "dst"))


def digest(rows: DataFrame, fmt: str, cols: list[str], sort_cols: list[str], sep: str = "\n") -> DataFrame:
    """Rows rendered through ``format_string`` into one text (one row), in
    ascending ``sort_cols`` order. Meant for top-k results (prompt sections),
    so the single group holds at most k rows."""
    line = F.format_string(fmt, *[F.col(c) for c in cols])
    items = F.array_sort(F.collect_list(F.struct(*[F.col(c) for c in sort_cols], line.alias("_l"))))
    return rows.agg(F.array_join(F.transform(items, lambda x: x["_l"]), sep).alias("digest"),
                    F.count(F.lit(1)).alias("rows"))


def apply_classifications(items: DataFrame, classified: DataFrame, as_of) -> tuple[DataFrame, DataFrame]:
    """'skip' closes the item (when still open); other actions become the
    action list. Returns (new items, counts per action)."""
    from signalmine.operators.updates import mark_applied

    skips = classified.filter(F.col("action") == "skip").select("id")
    new_items = mark_applied(items, skips, as_of)
    counts = classified.groupBy("action").agg(F.count(F.lit(1)).alias("items"))
    return new_items, counts
