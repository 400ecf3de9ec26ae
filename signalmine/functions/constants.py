"""Fixed values that must equal the reference's for equal results.

All of these are plain data: regex patterns, word lists and templates, in the
order the reference states them.
"""

# --- fixed values: topic rules (name, case-insensitive unanchored pattern, skill area)
TOPIC_RULES = [
    ("deployment", "(deploy|container|docker|traefik|502|restart)", "infrastructure, deployment"),
    ("auth", "(auth|login|rls|password|token|session|jwt)", "security, debugging"),
    ("database", "(postgres|supabase|migration|schema|query|index|sql)", "debugging, infrastructure"),
    ("testing", "(test|e2e|playwright|nightly|cypress|jest)", "quality-gate"),
    ("rag", "(rag|vault|embedding|ollama|chunk|semantic|search)", "knowledge-update"),
]

# --- fixed values: words ignored by the word-cluster count
STOP_WORDS = ["session", "recurring", "problem", "completed", "status",
              "changes", "created", "updated", "version", "added"]

# --- fixed values: session lesson extraction
LESSON_BULLET = (r"^\s*[-*]\s.*(open|lesson|insight|decision|fix|workaround|problem|solution|cause"
                 r"|error|change|recommendation|important|critical)")
FALLBACK_HEADING = r"^##.*(result|insight|conclusion|summary|change|completed)"
HEADLINE = r"RESULT|result|Result|## "
SUMMARY_LINE = r"^#|Root Cause|Result|Fix:|Commit:"

# --- fixed values: generated texts
MISS_ITEM_PREFIX = "Knowledge base has no good coverage for: "
ERROR_ITEM_PREFIX = "Recurring problem: "
SESSION_ITEM_PREFIX = "Session "
REGRESSION_REASON = "Possible regression: new bugfix {id} for same repo/symptom"
PROPOSAL_TEXT = ('Dreaming proposal: Pattern "%s" occurs %sx (previously: %sx). %s. '
                 "Recommendation: Create guard or skill for prevention.")

# --- fixed values: generated documents (Java format strings)
PLAYBOOK_TEXT = ("---\ntitle: Playbook - %s\ntype: playbook\ncreated: %s\nsource: dreaming-run-%s\n---\n\n"
                 "# Playbook: %s\n\n## Symptom\n%s\n\n## Diagnosis\n%s\n\n## Fix\n%s\n\n## History\n"
                 "- %s: Created by Dreaming Run #%s\n")
STUB_TEXT = ("---\ntitle: %s\ntype: stub\ncreated: %s\nsource: dreaming-rag-miss\nstatus: todo\n---\n\n# %s\n\n"
             "> This document was automatically created because knowledge base searches\n"
             "> for this topic returned no results. Please fill with content.\n\n"
             "## Context\nCreated by Dreaming Run #%s on %s.\n")
GAP_STUB_TEXT = ('---\ntitle: %s\ndate: %s\nstatus: stub\ncreated_by: %s\ntrigger_query: "%s"\n---\n\n# %s\n\n'
                 '> **STUB** - Automatically created because the search query "%s" returned no results.\n'
                 "> Please fill with actual content.\n\n%s\n\n---\n*Created: %s by %s*\n"
                 '*Trigger: RAG miss "%s"*\n')

# --- fixed values: finding types and classification actions
FINDING_TYPES = ["PLAYBOOK", "APPLY", "PATTERN", "VAULTGAP"]
CLASSIFY_ACTIONS = ["guard", "memory", "vault", "config", "skip"]

# --- fixed values: drift check
TABLE_REF = r"""(?:FROM|INTO|UPDATE|JOIN|DELETE\s+FROM)\s+["`']?([a-z][a-z0-9_]+)["`']?"""
NOT_TABLES = [
    "created_at", "updated_at", "deleted_at", "started_at", "ended_at", "expires_at",
    "published_at", "sent_at", "read_at", "last_login", "last_seen", "is_active", "is_admin",
    "is_deleted", "is_verified", "full_name", "first_name", "last_name", "display_name",
    "file_path", "file_name", "file_type", "file_size", "content_type", "mime_type",
    "status_code", "error_message", "row_number", "date_trunc", "json_build_object",
    "json_agg", "array_agg", "string_agg", "generate_series", "information_schema",
]
TRIVIAL_ROUTE_GROUPS = ["health", "auth", "cron", "webhook", "storage", "upload", "api"]
SKIP_DIRS = ["node_modules", ".next", ".git", "dist", "build", "coverage", ".turbo", ".cache"]
CODE_EXTENSIONS = [".ts", ".tsx", ".js", ".jsx", ".mjs", ".sql"]

# --- fixed values: limits
MAX_LINKS = 10
MAX_AUTO_FIXES_PER_DAY = 3
RUN_BUDGET_USD = 10.00
RUN_MAX_HOURS = 8
SIMILARITY_HIT = 0.6
CRYSTALLIZE_MIN_SCORE = 4
CRYSTALLIZE_MIN_RUNS = 3
