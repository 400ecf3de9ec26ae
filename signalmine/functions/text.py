"""Column-level text idioms (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def left(col: Column | str, n: int | None) -> Column:
    """First ``n`` characters (not bytes); the whole text when None."""
    return _c(col) if n is None else F.left(_c(col), F.lit(n))


def slugify(col: Column | str, n: int | None = None) -> Column:
    """lower, spaces to '-', keep ``[a-z0-9-]``, first ``n`` characters if given."""
    s = F.regexp_replace(F.lower(_c(col)), " ", "-")
    return left(F.regexp_replace(s, "[^a-z0-9-]", ""), n)


def keep_chars(col: Column | str, allowed: str) -> Column:
    """Drop every character outside the bracket class ``allowed``."""
    return F.regexp_replace(_c(col), f"[^{allowed}]", "")


def digits_only(col: Column | str) -> Column:
    """``tr -cd 0-9`` followed by a safe cast to BIGINT (NULL when empty)."""
    return F.regexp_replace(_c(col), "[^0-9]", "").try_cast("bigint")


def basename(col: Column | str) -> Column:
    return F.element_at(F.split(_c(col), "/"), -1)


def parent_name(col: Column | str) -> Column:
    return F.element_at(F.split(_c(col), "/"), -2)


def front_matter_value(content: Column | str, key: str) -> Column:
    """Value of a ``key: value`` line (multi-line mode), '' when absent."""
    return F.regexp_extract(_c(content), rf"(?m)^{key}: *(.*)$", 1)


def icontains_any(col: Column | str, pattern: str) -> Column:
    """Unanchored case-insensitive regex match (PostgreSQL ``~*``)."""
    return _c(col).rlike(f"(?i){pattern}")
