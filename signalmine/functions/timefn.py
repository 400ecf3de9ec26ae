"""Time helpers. Every operator takes ``as_of``; nothing reads the wall clock.

Inputs carry TIMESTAMP_NTZ, so bounds are NTZ literals too: ``lit(datetime)``
would be a zoned timestamp that shifts with the session time zone.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

AsOf = datetime | str


def to_datetime(as_of: AsOf) -> datetime:
    if isinstance(as_of, datetime):
        return as_of
    if isinstance(as_of, date):
        return datetime(as_of.year, as_of.month, as_of.day)
    return datetime.fromisoformat(str(as_of))


def ts_ntz(value: AsOf) -> Column:
    """An NTZ timestamp literal."""
    return F.lit(to_datetime(value).strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def before(as_of: AsOf, days: float = 0, hours: float = 0) -> Column:
    """Literal ``as_of - (days, hours)``; folded to a constant by Catalyst."""
    return ts_ntz(to_datetime(as_of) - timedelta(days=days, hours=hours))


def recent(col: Column | str, as_of: AsOf, days: float = 0, hours: float = 0) -> Column:
    """Strict ``ts > as_of - d`` ("within the last d")."""
    c = F.col(col) if isinstance(col, str) else col
    return c > before(as_of, days, hours)


def older_than(col: Column | str, as_of: AsOf, days: float = 0, hours: float = 0) -> Column:
    """Strict ``ts < as_of - d``."""
    c = F.col(col) if isinstance(col, str) else col
    return c < before(as_of, days, hours)


def as_of_date(as_of: AsOf) -> Column:
    return F.lit(to_datetime(as_of).date())
