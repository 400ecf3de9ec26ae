"""From raw documents to packed training sequences, in five stages.

Each stage is a function (spark, docs, sf_dir) -> DataFrame; it works on all
that the one before kept, and all but the last return the columns of documents.
``run`` writes each stage's result under the shared folder and reads it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from signalmine.llm.common import stored, table
from signalmine.llm.mixing import mixed_documents
from signalmine.llm.ngram_join import deduplicated
from signalmine.llm.packing import pack
from signalmine.llm.quality_rules import kept_documents
from signalmine.llm.suffix_dedup import without_repeats


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go; the others stay as they are."""
    return kept_documents(docs, table(spark, sf_dir, "labels"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return deduplicated(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more stay at one place only; n_chars follows."""
    return without_repeats(docs)


def pareto_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mixture takes it."""
    return mixed_documents(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their bins and offsets."""
    return pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("suffix-array dedup", suffix_array_dedup),
    ("mixing sources to target weights", pareto_mixing),
    ("best-fit packing", best_fit_packing),
]

#: SQL can't express the hashes, suffix sorting and best fit; tests/llm has brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
