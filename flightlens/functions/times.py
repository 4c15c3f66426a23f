"""Column expressions for the time handling of the pipeline.

All are built-in Spark functions, so they stay inside whole-stage codegen.
Texts that may be malformed go through ``try_`` parsers: a bad time gives
NULL rather than failing the job (SURVEY T8, E5).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the dashboard's time axis: seconds since this epoch origin,
# in units of this many seconds.
AXIS_ORIGIN_EPOCH_SECONDS = 1771000000
AXIS_UNIT_SECONDS = 10

WALL_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_time(c) -> Column:
    """ISO-8601 text, offset honoured, to TIMESTAMP; NULL if unparsable."""
    return F.try_to_timestamp(_c(c))


def epoch_seconds(ts) -> Column:
    """Whole seconds since the epoch of a timestamp (fraction dropped)."""
    return F.unix_timestamp(_c(ts))


def minutes_between(later_ts, earlier_ts) -> Column:
    """Signed minutes from ``earlier_ts`` to ``later_ts`` as DOUBLE."""
    return (epoch_seconds(later_ts) - epoch_seconds(earlier_ts)) / 60


def shift_minutes(ts, minutes) -> Column:
    """``ts`` moved by a (fractional) number of minutes; whole-second base."""
    return F.timestamp_seconds(epoch_seconds(ts) + _c(minutes) * 60)


def calendar_parts(ts) -> dict[str, Column]:
    """Hour, day of week (1 = Sunday) and month of a timestamp, session zone."""
    ts = _c(ts)
    return {
        "scheduled_hour": F.hour(ts),
        "scheduled_day_of_week": F.dayofweek(ts),
        "scheduled_month": F.month(ts),
    }


def wall_time_text(c) -> Column:
    """``2026-02-13T16:26:40+00:00`` -> ``2026-02-13 16:26:40``.

    Replaces the ``T`` with a space and keeps the text before ``+``. Only a
    ``+hh:mm`` offset is cut; other suffixes stay and make the text unparsable
    as wall time. Out-of-range parts give NULL (``get``), never an error.
    """
    parts = F.split(_c(c), "T")
    joined = F.concat(F.get(parts, 0), F.lit(" "), F.get(parts, 1))
    return F.get(F.split(joined, "\\+"), 0)


def whole_seconds_text(c) -> Column:
    """Text of a time up to the first ``.``: drops fractional seconds."""
    return F.get(F.split(_c(c).cast("string"), "\\."), 0)


def axis_number(text) -> Column:
    """Dashboard axis value of a ``yyyy-MM-dd HH:mm:ss`` text; NULL if unparsable."""
    seconds = F.unix_timestamp(F.try_to_timestamp(_c(text), F.lit(WALL_TIME_FORMAT)))
    return (seconds - F.lit(AXIS_ORIGIN_EPOCH_SECONDS)) / F.lit(AXIS_UNIT_SECONDS)
