"""Training and scoring frames.

One function per side, sharing the calendar and default logic, so training
and scoring derive the features the same way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.times import calendar_parts, minutes_between, parse_time

CATEGORICAL_COLUMNS = ["airline_name", "departure_airport", "arrival_airport",
                       "departure_country", "arrival_country"]
NUMERIC_COLUMNS = ["delay_time", "scheduled_hour", "scheduled_day_of_week", "scheduled_month"]
DEPARTURE_LABEL = "departure_delay_minutes"
ARRIVAL_LABEL = "arrival_delay_minutes"

_TIME_TEXTS_ORDERED = ["departure_scheduled_time", "departure_actual_time",
                       "arrival_scheduled_time", "arrival_actual_time"]


def with_delay_default(df: DataFrame, column: str = "delay_time") -> DataFrame:
    """NULL delay -> 0; a frame without the column gets a constant 0."""
    if column in df.columns:
        return df.withColumn(column, F.coalesce(F.col(column), F.lit(0)))
    return df.withColumn(column, F.lit(0))


def has_training_times() -> Column:
    """F1 and T8 as one predicate: all four time texts present and parseable.

    True exactly for the rows ``training_frame`` keeps (with ``drop_unparsable``).
    """
    parsed = [parse_time(text).isNotNull() for text in _TIME_TEXTS_ORDERED]
    return parsed[0] & parsed[1] & parsed[2] & parsed[3]


def training_frame(flights: DataFrame, drop_unparsable: bool = True) -> DataFrame:
    """Landed flights -> labels in minutes and calendar features.

    F1: all four time texts must be present. Texts that do not parse give
    NULL timestamps; with ``drop_unparsable`` those rows are dropped too (a
    label is NULL exactly when one of its two timestamps is, and GBT rejects
    NULL labels). A parsed time is non-NULL only when its text is, so then
    one test on the four parsed times is F1 and T8 together; a second test on
    the texts would be pushed down as well and evaluated on every row.
    Filtering on the parsed timestamps, not on the labels, keeps the optimizer
    from re-deriving the labels inside the filter.
    """
    stamps = ["departure_scheduled_ts", "departure_actual_ts", "arrival_scheduled_ts", "arrival_actual_ts"]
    df = flights.withColumns({ts: parse_time(text) for ts, text in zip(stamps, _TIME_TEXTS_ORDERED)})
    if drop_unparsable:
        df = df.where(F.col(stamps[0]).isNotNull() & F.col(stamps[1]).isNotNull()
                      & F.col(stamps[2]).isNotNull() & F.col(stamps[3]).isNotNull())
    else:
        df = df.where(F.col(_TIME_TEXTS_ORDERED[0]).isNotNull() & F.col(_TIME_TEXTS_ORDERED[1]).isNotNull()
                      & F.col(_TIME_TEXTS_ORDERED[2]).isNotNull() & F.col(_TIME_TEXTS_ORDERED[3]).isNotNull())
    df = df.withColumns({
        DEPARTURE_LABEL: minutes_between("departure_actual_ts", "departure_scheduled_ts"),
        ARRIVAL_LABEL: minutes_between("arrival_actual_ts", "arrival_scheduled_ts"),
        **calendar_parts("departure_scheduled_ts"),
    })
    return with_delay_default(df)


def scoring_frame(scheduled: DataFrame) -> DataFrame:
    """Scheduled flights -> the same calendar features; delay 0 when absent."""
    df = scheduled.withColumns({
        "departure_scheduled_ts": parse_time("departure_scheduled_time"),
        "arrival_scheduled_ts": parse_time("arrival_scheduled_time"),
    })
    df = df.withColumns(calendar_parts("departure_scheduled_ts"))
    return with_delay_default(df)
