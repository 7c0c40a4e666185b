"""Hour keys: parse, format, generate ranges (native expressions)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Hour keys: "file" 2025-11-10_21 (landing files), "api" 20251110T21 (export API), "space" 2025-11-10 21.
# The default fetch window.
DEFAULT_LAG_HOURS = 12
DEFAULT_LOOKBACK_DAYS = 1


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz_lit(v) -> Column:
    """A ``timestamp_ntz`` literal from a naive datetime or a string.

    Passed as wall-clock text: ``F.lit(datetime)`` would read a naive value
    in the Python process's time zone, which need not be the session's.
    """
    if isinstance(v, Column):
        return v.cast("timestamp_ntz")
    if isinstance(v, _dt.datetime):
        v = v.isoformat(sep=" ")
    return F.lit(v).cast("timestamp_ntz")


def trunc_hour(t) -> Column:
    """The hour of a ``timestamp_ntz``, by subtraction.

    ``date_trunc`` and ``date_format`` read a wall-clock time in the session
    time zone, where some hours do not exist; subtracting the minutes and
    seconds does not.
    """
    c = _col(t)
    return c - F.make_dt_interval(F.lit(0), F.lit(0), F.extract(F.lit("MINUTE"), c),
                                  F.extract(F.lit("SECOND"), c).cast("decimal(8,6)"))


def trunc_minute(t) -> Column:
    """The minute of a ``timestamp_ntz`` (see :func:`trunc_hour`)."""
    c = _col(t)
    return c - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                                  F.extract(F.lit("SECOND"), c).cast("decimal(8,6)"))


def parse_hour(c) -> Column:
    """Parse any of the three hour-key styles to ``timestamp_ntz``.

    A single-digit hour (``2025-11-11_6``) is accepted; text that matches no
    style, or no real hour, gives NULL.
    """
    s = F.trim(_col(c))
    dashed, packed = r"^(\d{4}-\d{2}-\d{2})[_ ](\d{1,2})$", r"^(\d{4})(\d{2})(\d{2})T(\d{1,2})$"
    day = F.when(s.rlike(dashed), F.regexp_extract(s, dashed, 1)).when(s.rlike(packed), F.concat_ws(
        "-", F.regexp_extract(s, packed, 1), F.regexp_extract(s, packed, 2), F.regexp_extract(s, packed, 3)))
    hour = F.when(s.rlike(dashed), F.regexp_extract(s, dashed, 2)).otherwise(F.regexp_extract(s, packed, 4))
    return F.concat(day, F.lit(" "), F.lpad(hour, 2, "0"), F.lit(":00:00")).try_cast("timestamp_ntz")


def format_hour(c, style: str = "file") -> Column:
    """Hour key of a ``timestamp_ntz``, from its text (no time zone involved)."""
    text = F.substring(_col(c).cast("timestamp_ntz").cast("string"), 1, 13)
    if style == "file":
        return F.translate(text, " ", "_")
    if style == "space":
        return text
    if style == "api":
        return F.translate(F.translate(text, "-", ""), " ", "T")
    raise ValueError(f"unknown style {style!r}")


def hour_key_from_name(name) -> Column:
    """Archive member name -> hour key ``YYYY-MM-DD_HH``.

    Strips folders, the ``.json.gz`` suffix, a ``#...`` hash suffix and a
    leading numeric project id, then zero-pads the hour.
    """
    n = _col(name)
    base = F.regexp_extract(n, r"([^/]*)$", 1)
    base = F.regexp_replace(base, r"\.json\.gz", "")
    base = F.regexp_extract(base, r"^([^#]*)", 1)
    base = F.regexp_replace(base, r"^\d+_", "")
    date_part = F.regexp_extract(base, r"^(.*)_[^_]*$", 1)
    hour_part = F.regexp_extract(base, r"_([^_]*)$", 1)
    return F.concat(date_part, F.lit("_"), F.lpad(hour_part, 2, "0"))


def hour_range(start, end) -> Column:
    """Inclusive array of hours from ``start`` to ``end`` (both truncated)."""
    s, e = trunc_hour(_col(start).cast("timestamp_ntz")), trunc_hour(_col(end).cast("timestamp_ntz"))
    return F.when(s <= e, F.sequence(s, e, F.expr("INTERVAL 1 HOUR"))).otherwise(
        F.array().cast("array<timestamp_ntz>"))


def default_window(now: _dt.datetime, lag_hours: int = DEFAULT_LAG_HOURS,
                   lookback_days: int = DEFAULT_LOOKBACK_DAYS) -> tuple[_dt.datetime, _dt.datetime]:
    """Default fetch window: end = now - lag, start = end - lookback, on hours."""
    end = (now - _dt.timedelta(hours=lag_hours)).replace(minute=0, second=0, microsecond=0)
    start = end - _dt.timedelta(days=lookback_days)
    return start, end


def default_window_cols(now, lag_hours: int = DEFAULT_LAG_HOURS,
                        lookback_days: int = DEFAULT_LOOKBACK_DAYS) -> tuple[Column, Column]:
    """Column form of :func:`default_window` for a ``now`` column."""
    n = _col(now).cast("timestamp_ntz")
    end = trunc_hour(n - F.make_dt_interval(F.lit(0), F.lit(lag_hours)))
    start = end - F.make_dt_interval(F.lit(lookback_days))
    return start, end
