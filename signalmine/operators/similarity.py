"""Similarity and linking: links between documents that are near
neighbours (``knn``), and searches that now find a document."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalmine.operators.joins import unlinked_neighbours
from signalmine.operators.knn import nearest_documents
from signalmine.operators.ranking import global_link_cap
from signalmine.session import materialize


def propose_links(docs: DataFrame, links: DataFrame, k: int = 5, cap: int | None = None,
                  texts: DataFrame | None = None) -> DataFrame:
    """Neighbours of recent documents that are not linked yet (nor, with
    ``texts``, mentioned by the document); with ``cap`` at most so many, in
    (source, rank) order."""
    nn = nearest_documents(docs, docs.filter(F.col("is_recent")), k)
    cands = unlinked_neighbours(nn, links, docs, texts)
    return cands if cap is None else global_link_cap(cands, cap)


def apply_links(texts: DataFrame, pairs: DataFrame, day: str, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Append a 'See also' section (when missing) and one list item per new link."""
    items = pairs.groupBy(F.col("src").alias(id_col)).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "dst"))),
                                 lambda x: F.concat(F.lit("- [["), x["dst"].cast("string"),
                                                    F.lit(f"]] - Related topic (auto-synapse {day})"))), "\n")
        .alias("_add"))
    j = texts.join(items, id_col, "left")
    has_section = F.col(text_col).contains("## See also")
    new_text = F.when(F.col("_add").isNull(), F.col(text_col)).otherwise(
        F.concat(F.col(text_col), F.when(has_section, F.lit("\n")).otherwise(F.lit("\n\n## See also\n\n")),
                 F.col("_add")))
    return j.withColumn(text_col, new_text).withColumn("changed", F.col("_add").isNotNull()).drop("_add")


def resolve_found_misses(misses: DataFrame, vectors: DataFrame, docs: DataFrame, threshold: float = 0.6,
                         by: str = "rag-filler-found") -> DataFrame:
    """``misses`` with the unresolved ones resolved whose search now hits: the
    best document's score for the miss's vector (``vectors``: id, embedding) is
    above the threshold. Adds found_score (null without a vector) and changed."""
    open_ = misses.filter(F.col("resolved") == F.lit(False)).select("id")
    queries = vectors.join(open_, "id", "left_semi").select(F.col("id").alias("doc_id"), "embedding")
    best = nearest_documents(docs, queries, k=1, exclude_self=False).select(
        F.col("src").alias("_miss"), F.col("score").alias("found_score"))
    best = materialize(best)  # what follows may read the misses several times
    # no plan knows how many rows best has: merged, never broadcast
    j = misses.join(best.hint("merge"), F.col("id") == F.col("_miss"), "left").drop("_miss")
    j = j.withColumn("changed", (F.col("resolved") == F.lit(False)) & (F.coalesce("found_score", F.lit(-1.0)) > threshold))
    old = F.col("resolved_by") if "resolved_by" in misses.columns else F.lit(None).cast("string")
    return (j.withColumn("resolved_by", F.when(F.col("changed"), F.lit(by)).otherwise(old))
            .withColumn("resolved", F.col("resolved") | F.col("changed")))
