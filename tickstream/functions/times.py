"""Timestamp expressions. Bad input gives NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ISO-8601 date-time with seconds, optional fraction and a mandatory offset.
ISO_INSTANT = (
    r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,9})?(Z|[+-]\d{2}:\d{2})$"
)


def iso_instant(text: Column) -> Column:
    """The instant an ISO string names; NULL when it is not one."""
    return F.try_to_timestamp(F.when(text.rlike(ISO_INSTANT), text))


def lenient_timestamp(text: Column) -> Column:
    """Any timestamp form Spark can cast; NULL otherwise."""
    return F.try_to_timestamp(text)


def iso_string(ts: Column, micros: bool = False) -> Column:
    """Render an instant as ISO with a numeric offset (``+00:00`` in UTC)."""
    fraction = ".SSSSSS" if micros else ""
    return F.date_format(ts, f"yyyy-MM-dd'T'HH:mm:ss{fraction}xxx")


def stamp(as_of: Column | None = None) -> Column:
    """Processing time: the query's start, or a given instant."""
    return F.current_timestamp() if as_of is None else as_of


def lookback_start(as_of: Column, hours: int) -> Column:
    """Midnight of the day that lies ``hours`` before ``as_of``."""
    return F.date_trunc("day", as_of - F.expr(f"INTERVAL {int(hours)} HOURS"))
