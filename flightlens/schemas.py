"""Table schemas of the pipeline (all fields nullable).

The reference writes with explicit schemas; here they are applied by name with
``DataFrame.to(schema)``, never by position.
"""

from pyspark.sql.types import (DoubleType, IntegerType, StringType, StructField,
                               StructType, TimestampType)


def _strings(*names):
    return [StructField(n, StringType(), True) for n in names]


AIRPORTS = StructType(_strings("id", "airport_name", "country_name"))

FLIGHTS = StructType(
    _strings("id", "flight_date", "airline_name",
             "departure_airport", "departure_country", "departure_timezone",
             "departure_scheduled_time", "departure_actual_time",
             "arrival_airport", "arrival_country", "arrival_timezone",
             "arrival_scheduled_time", "arrival_actual_time")
    + [StructField("delay_time", IntegerType(), True)])

# As loaded by the scheduled-flights job: no actual times, no delay.
SCHEDULED_FLIGHTS = StructType(
    _strings("id", "flight_date", "airline_name",
             "departure_airport", "departure_country", "departure_timezone",
             "departure_scheduled_time",
             "arrival_airport", "arrival_country", "arrival_timezone",
             "arrival_scheduled_time"))

# The two columns the model job merges into scheduled_flights. The reference
# never declares them; they are timestamps here.
ESTIMATED_TIME_FIELDS = [
    StructField("departure_estimated_time", TimestampType(), True),
    StructField("arrival_estimated_time", TimestampType(), True),
]

SCHEDULED_FLIGHTS_WITH_ESTIMATES = StructType(SCHEDULED_FLIGHTS.fields + ESTIMATED_TIME_FIELDS)

PREDICTIONS = StructType(
    _strings("id", "flight_date", "airline_name", "departure_airport", "arrival_airport",
             "departure_scheduled_time", "arrival_scheduled_time")
    + ESTIMATED_TIME_FIELDS
    + [StructField("predicted_departure_delay", DoubleType(), True),
       StructField("predicted_arrival_delay", DoubleType(), True)])

# Landed API pages: one file per page; request, limit and offset come from the
# Hive-style path so that a page with an unreadable body can still be attributed.
PAGE_FILES = StructType(
    [StructField("value", StringType(), True)]
    + _strings("dataset", "batch_id", "request_id")
    + [StructField("limit", IntegerType(), True), StructField("offset", IntegerType(), True)])
