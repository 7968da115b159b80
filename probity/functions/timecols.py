"""F1/F2 time predicates and X4-X6 timestamp helpers.

``as_of`` replaces the wall clock: pass a timestamp Column (e.g. a scalar
subquery ``df.select(max(ts)).scalar()``), a ``datetime`` or an ISO string.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(as_of) -> Column:
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, dt.datetime):
        as_of = as_of.isoformat(sep=" ")
    return F.lit(str(as_of)).cast("timestamp_ntz")


def interval(spec: str) -> Column:
    """``interval("2 hours")`` -> an interval literal."""
    return F.expr(f"INTERVAL {spec}")


def recent(df, ts: str, as_of, lookback: str = "2 hours"):
    """rows with ``ts >= as_of - lookback``."""
    return df.filter(F.col(ts) >= as_column(as_of) - interval(lookback))


def older_than(df, ts: str, as_of, age: str = "48 hours"):
    """rows with ``ts < as_of - age`` (timestamp literal, not a string)."""
    return df.filter(F.col(ts) < as_column(as_of) - interval(age))


def bucket_start(ts: Column | str, minutes: int) -> Column:
    """Start of the ``minutes``-wide bin holding ``ts`` (epoch aligned)."""
    return F.window(ts, f"{minutes} minutes")["start"]


def parse_iso(c: Column | str) -> Column:
    """ISO-8601 text (``Z`` or an offset allowed) -> timestamp; null when
    unparsable (never an error, so one bad message cannot stop a stream)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.try_to_timestamp(F.regexp_replace(col, "Z$", "+00:00"))


def micros_between(a: Column | str, b: Column | str) -> Column:
    """|a - b| in whole microseconds (exact, integer; no time-zone
    conversion, so the session time zone and DST never matter)."""
    ca = F.col(a) if isinstance(a, str) else a
    cb = F.col(b) if isinstance(b, str) else b
    return F.abs(F.timestamp_diff("MICROSECOND", cb, ca))


def seconds_between(a: Column | str, b: Column | str) -> Column:
    """|a - b| in seconds (microsecond precision)."""
    return micros_between(a, b) / 1e6
