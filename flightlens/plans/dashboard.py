"""The dashboard query (P11) and the post-merge verification sample."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.times import axis_number, wall_time_text, whole_seconds_text

PASS_THROUGH = ["id", "flight_date", "airline_name", "departure_airport", "departure_country",
                "departure_timezone", "arrival_airport", "arrival_country", "arrival_timezone"]

VERIFY_COLUMNS = ["id", "airline_name", "departure_airport", "arrival_airport",
                  "departure_scheduled_time", "departure_estimated_time",
                  "arrival_scheduled_time", "arrival_estimated_time"]


def dashboard(scheduled: DataFrame) -> DataFrame:
    """Scheduled against estimated times, as wall-time text and axis numbers.

    17 columns: nine passed through, four times as ``yyyy-MM-dd HH:mm:ss`` text
    and four ``..._number`` doubles (seconds from the axis origin / unit). A
    NULL or unparsable time gives NULL text or number, never an error. A pure
    projection: no shuffle, pruned to the columns it reads.
    """
    for name in ("departure_estimated_time", "arrival_estimated_time"):
        if name not in scheduled.columns:  # table not merged into yet
            scheduled = scheduled.withColumn(name, F.lit(None).cast("timestamp"))
    texts = {
        "departure_scheduled_time": wall_time_text("departure_scheduled_time"),
        "departure_estimated_time": whole_seconds_text("departure_estimated_time"),
        "arrival_scheduled_time": wall_time_text("arrival_scheduled_time"),
        "arrival_estimated_time": whole_seconds_text("arrival_estimated_time"),
    }
    base = scheduled.select(*PASS_THROUGH, *[t.alias(n) for n, t in texts.items()])
    order = []
    for name in texts:
        order += [F.col(name), axis_number(F.col(name)).alias(f"{name}_number")]
    return base.select(*PASS_THROUGH, *order)


def verify_sample(scheduled: DataFrame, n: int = 10) -> DataFrame:
    """First ``n`` rows by id of the merged table (a top-k, not a full sort)."""
    return scheduled.select(*VERIFY_COLUMNS).orderBy("id").limit(n)
