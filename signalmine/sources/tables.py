"""Table loaders and the schemas of the knowledge-base tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Tables produced by the driver (one parquet file or directory each).
DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

_NTZ = T.TimestampNTZType()


def _fields(*spec: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in spec])


S, L, I, B = T.StringType(), T.LongType(), T.IntegerType(), T.BooleanType()

# Schemas of the knowledge-base tables (the reference keeps them in PostgreSQL).
SCHEMAS: dict[str, T.StructType] = {
    "learning_items": _fields(
        ("id", L, False), ("source", S, False), ("lesson", S, False), ("applicable_to", S, True),
        ("occurrence_count", I, True), ("applied", B, True), ("applied_at", _NTZ, True),
        ("created_at", _NTZ, True), ("updated_at", _NTZ, True)),
    "error_patterns": _fields(
        ("id", L, True), ("pattern_key", S, False), ("category", S, True), ("description", S, True),
        ("root_cause", S, True), ("mitigation", S, True), ("related_skill", S, True),
        ("occurrence_count", I, True), ("resolved", B, True), ("resolved_at", _NTZ, True),
        ("addressed", B, True), ("severity", S, True), ("first_seen", _NTZ, True),
        ("last_seen", _NTZ, True), ("created_at", _NTZ, True), ("updated_at", _NTZ, True)),
    "rag_misses": _fields(
        ("id", L, False), ("query", S, False), ("best_score", T.DecimalType(5, 4), True),
        ("result_count", I, True), ("session_context", S, True), ("resolved", B, True),
        ("resolved_by", S, True), ("created_at", _NTZ, True)),
    "dreaming_runs": _fields(
        ("id", L, True), ("run_date", T.DateType(), False), ("status", S, True),
        ("sessions_analyzed", I, True), ("learnings_applied", I, True), ("patterns_updated", I, True),
        ("playbooks_created", I, True), ("skill_proposals_created", I, True),
        ("rag_gaps_filled", I, True), ("memory_updates", I, True), ("vault_report_path", S, True),
        ("duration_seconds", I, True), ("cost_usd", T.DecimalType(8, 4), True),
        ("error_message", S, True), ("created_at", _NTZ, True), ("updated_at", _NTZ, True)),
    "skill_proposals": _fields(
        ("id", L, False), ("source_sessions", T.ArrayType(S), True), ("proposal_type", S, False),
        ("target_skill", S, True), ("target_section", S, True), ("proposal_content", S, True),
        ("evidence", T.ArrayType(S), True), ("recurrence_count", I, True), ("confidence", I, True),
        ("status", S, True), ("pr_url", S, True), ("created_at", _NTZ, True), ("updated_at", _NTZ, True)),
    "skill_decisions": _fields(
        ("id", L, False), ("skill_name", S, True), ("decision_type", S, True),
        ("judge_decision", S, True), ("was_applied", B, True), ("created_at", _NTZ, True)),
    "skill_metrics": _fields(
        ("id", L, False), ("skill_name", S, False), ("invoked", B, True), ("success", B, True),
        ("duration_minutes", T.DecimalType(8, 2), True), ("created_at", _NTZ, True)),
    "tasks": _fields(
        ("id", L, False), ("target_repo", S, True), ("prompt", S, True), ("category", S, True),
        ("status", S, True), ("outcome", S, True), ("outcome_reason", S, True),
        ("completed_at", _NTZ, True), ("outcome_evaluated_at", _NTZ, True)),
    "apps": _fields(("app", S, False), ("repo", S, True), ("doc", S, True)),
    "lines": _fields(("path", S, False), ("modified_at", _NTZ, True), ("line_no", I, False), ("line", S, True)),
}


def load_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Read one table stored as parquet under ``base``.

    Knowledge-base tables are read with their declared schema (no footer
    inference, stable types across files); driver tables are self-describing.
    """
    path = f"{base.rstrip('/')}/{name}.parquet"
    if name in SCHEMAS:
        return spark.read.schema(SCHEMAS[name]).parquet(path)
    return spark.read.parquet(path)


def empty(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], SCHEMAS[name])


def conform(df: DataFrame, name: str) -> DataFrame:
    """Project ``df`` onto the declared schema, adding absent columns as typed NULLs."""
    from pyspark.sql import functions as F

    cols = []
    present = set(df.columns)
    for f in SCHEMAS[name].fields:
        c = F.col(f.name) if f.name in present else F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)
