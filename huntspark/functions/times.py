"""Epoch columns as text, relative and absolute time bounds."""

from __future__ import annotations

import re
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from huntspark.functions.names import DERIVED, derived, q

ISO = "%Y-%m-%dT%H:%M:%SZ"
_JAVA = {"%Y": "yyyy", "%m": "MM", "%d": "dd", "%H": "HH", "%M": "mm", "%S": "ss", "%%": "%"}
_UNITS = {"s": "seconds", "m": "minutes", "h": "hours", "d": "days", "w": "weeks"}


def java_pattern(format_: str) -> str:
    """A strftime format as a Spark date pattern; other directives than those of plain dates and times are refused."""
    out = []
    for token in re.findall(r"%.|[^%]+", format_):
        if token.startswith("%"):
            if token not in _JAVA:
                raise ValueError(f"directive {token} has no Spark pattern")
            out.append(_JAVA[token])
        else:
            out.append(re.sub(r"[A-Za-z]+", lambda m: f"'{m.group()}'", token.replace("'", "''")))
    return "".join(out)


# Where the parts of a time stand in its text.
_PLACE = {"%Y": (1, 4), "%m": (6, 2), "%d": (9, 2), "%H": (12, 2), "%M": (15, 2), "%S": (18, 2)}


def _as_text(seconds: Column, format_: str) -> Column:
    """UTC in any session time zone: a time without a zone is counted from 1970 and its parts are put together."""
    java_pattern(format_)  # refuses other directives
    text = (F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)).cast("string")
    parts = [
        F.substring(text, *_PLACE[t]) if t in _PLACE else F.lit("%" if t == "%%" else t) for t in re.findall(r"%.|[^%]+", format_)
    ]
    return F.coalesce(F.when(seconds.isNotNull(), F.concat(*parts)), F.lit("N/A"))


def _convert(df: DataFrame, names: list[str], to_seconds, format_: str) -> DataFrame:
    return df.withColumns({derived(c): _as_text(to_seconds(q(c).cast("bigint")), format_) for c in names})


def convert_alert_timestamps(df: DataFrame, format_: str = ISO) -> DataFrame:
    """Text form of every epoch-second column ``*.seconds``; a missing time reads ``N/A``."""
    names = [c for c in df.columns if c.endswith(".seconds") and not c.startswith(DERIVED)]
    return _convert(df, names, lambda c: c.cast("decimal(18,6)"), format_) if names else df


def convert_event_timestamps(df: DataFrame, format_: str = ISO) -> DataFrame:
    """Text form of every epoch-microsecond column ``*_time_usec`` or ``*mod_time_us``."""
    names = [c for c in df.columns if c.endswith(("_time_usec", "mod_time_us")) and not c.startswith(DERIVED)]
    return _convert(df, names, lambda c: (c / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(18,6)"), format_) if names else df


def parse_bound(text: str, now: datetime | None = None) -> datetime:
    """``-7d``, ``12h`` (a plain amount also looks back) or an absolute ISO time, as a UTC time."""
    match = re.fullmatch(r"-?(\d+)([smhdw])", text.strip())
    if match:
        now = now or datetime.now(timezone.utc)
        return now - timedelta(**{_UNITS[match.group(2)]: int(match.group(1))})
    value = datetime.fromisoformat(text.strip().strip("'").replace("Z", "+00:00"))
    return value if value.tzinfo else value.replace(tzinfo=timezone.utc)


def time_range(
    df: DataFrame,
    column: str,
    earliest: str | None = None,
    latest: str | None = None,
    now: datetime | None = None,
) -> DataFrame:
    """Rows from ``earliest`` to ``latest``, both included.

    The bounds become literals of the column's own type (timestamp, epoch seconds ``*seconds`` or microseconds), so
    they reach the parquet scan as pushed filters.
    """
    dtype = df.schema[column].dataType

    def bound(text: str) -> Column:
        when = parse_bound(text, now).astimezone(timezone.utc)
        if isinstance(dtype, T.IntegralType):
            micros = round(when.timestamp() * 1_000_000)
            return F.lit(micros // 1_000_000 if column.endswith("seconds") else micros)
        text = when.strftime("%Y-%m-%d %H:%M:%S.%f")
        return F.lit(text).cast(dtype) if isinstance(dtype, T.TimestampNTZType) else F.lit(text + "+00:00").cast("timestamp")

    if earliest:
        df = df.where(q(column) >= bound(earliest))
    if latest:
        df = df.where(q(column) <= bound(latest))
    return df


def day_bounds(day: Column) -> tuple[Column, Column]:
    """First and last second of a ``yyyyMMdd`` day in UTC."""
    start = F.to_timestamp(F.concat(day, F.lit(" +00:00")), "yyyyMMdd xxx")
    return start, start + F.expr("interval 86399 seconds")
