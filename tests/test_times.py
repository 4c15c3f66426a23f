"""Dashboard time texts and axis numbers (P11, E2-E9); time arithmetic."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from flightlens.functions import times

CASES = [
    ("2026-02-13T16:26:40+00:00", "2026-02-13 16:26:40", 0.0),
    ("2026-02-13T16:26:40-06:00", "2026-02-13 16:26:40-06:00", None),
    ("2026-02-13T16:26:40Z", "2026-02-13 16:26:40Z", None),
    ("2026-02-13T16:26:40.5+00:00", "2026-02-13 16:26:40.5", None),
    ("2026-02-13 16:26:40", None, None),
    (None, None, None),
]


@pytest.mark.parametrize("text,expected_text,expected_number", CASES)
def test_wall_time_text_and_number(spark, text, expected_text, expected_number):
    df = spark.createDataFrame([(text,)], "x string")
    row = df.select(times.wall_time_text("x").alias("t")).select(
        "t", times.axis_number("t").alias("n")).first()
    assert row.t == expected_text
    assert row.n == expected_number


def test_estimated_time_text(spark):
    df = spark.createDataFrame([("2026-02-13 16:26:50.123456",)], "s string").withColumn(
        "ts", F.col("s").cast("timestamp"))
    row = df.select(times.whole_seconds_text("ts").alias("a"), times.whole_seconds_text("s").alias("b")).first()
    assert row.a == row.b == "2026-02-13 16:26:50"
    assert df.select(times.axis_number(times.whole_seconds_text("ts"))).first()[0] == 1.0


def test_minutes_and_shift(spark):
    df = spark.createDataFrame([("2026-02-13T16:00:00+00:00", "2026-02-13T15:30:00-01:00")], "a string, b string")
    r = df.select(times.minutes_between(times.parse_time("b"), times.parse_time("a")).alias("m"),
                  times.shift_minutes(times.parse_time("a"), F.lit(1.5)).alias("s")).first()
    assert r.m == 30.0
    assert r.s == dt.datetime(2026, 2, 13, 16, 1, 30)


def test_calendar_parts_sunday_is_one(spark):
    df = spark.createDataFrame([("2026-02-15T23:10:00+00:00",)], "a string")  # a Sunday
    r = df.select(*[c.alias(n) for n, c in times.calendar_parts(times.parse_time("a")).items()]).first()
    assert (r.scheduled_hour, r.scheduled_day_of_week, r.scheduled_month) == (23, 1, 2)


def test_bad_time_text_gives_null_not_error(spark):
    df = spark.createDataFrame([("garbage",)], "a string")
    assert df.select(times.parse_time("a")).first()[0] is None


def test_training_predicate_keeps_what_training_frame_keeps(spark):
    from flightlens.operators import features
    from flightlens.schemas import FLIGHTS

    good = "2026-02-13T16:26:40+00:00"
    texts = [good, None, "not a time", "2026-02-13T16:26:40-06:00"]
    rows = []
    for i, t in enumerate(texts):
        for j in range(4):
            times4 = [good] * 4
            times4[j] = t
            rows.append((f"f{i}-{j}", *times4))
    df = spark.createDataFrame(rows, "id string, departure_scheduled_time string, "
                                     "departure_actual_time string, arrival_scheduled_time string, "
                                     "arrival_actual_time string")
    flights = df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType)
                          .alias(f.name) for f in FLIGHTS.fields])
    kept = {r.id for r in features.training_frame(flights).select("id").collect()}
    flagged = {r.id for r in flights.where(features.has_training_times()).select("id").collect()}
    assert kept == flagged
    assert len(kept) == 8  # the good and the offset rows; none with a missing or bad text
