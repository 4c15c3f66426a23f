"""Shuffle-join fallback: same rows as the broadcast path, with one hot airport."""

from pyspark.sql import functions as F

from flightlens.operators.dims import airport_dimension
from flightlens.operators.enrich import with_countries
from flightlens.sources import testbed

from conftest import SF_SMALL


def _rows(df):
    return sorted(tuple(r) for r in df.select("id", "departure_country", "arrival_country").collect())


def test_fallback_join_equals_broadcast_join_on_hot_key(spark):
    flights = testbed.flight_records(spark, SF_SMALL)
    # a third of all flights depart from one hub airport
    hot = flights.withColumn("dep_icao", F.when(F.col("l_orderkey") % 3 == 0, F.lit("S1"))
                             .otherwise(F.col("dep_icao")))
    dim = airport_dimension(testbed.airports_raw(spark, SF_SMALL))
    broadcast = with_countries(hot, dim)
    shuffled = with_countries(hot, dim, max_broadcast_bytes=0)
    plan = shuffled._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin [dep_icao" in plan and "ShuffledHashJoin [arr_icao" in plan
    assert "BroadcastHashJoin [dep_icao" not in plan
    assert _rows(broadcast) == _rows(shuffled)
    assert broadcast.where(F.col("dep_icao") == "S1").count() > hot.count() / 4


def test_hot_airport_is_split_in_the_shuffled_join(spark):
    """The partition of the hub airport is read by several tasks: the run's plan marks the join as skewed."""
    settings = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
                "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        hot = testbed.flight_records(spark, SF_SMALL).withColumn(
            "dep_icao", F.when(F.col("l_orderkey") % 3 == 0, F.lit("S1")).otherwise(F.col("dep_icao")))
        hot = hot.repartition(8, "l_orderkey", "l_linenumber")   # many map tasks, as a split needs
        dim = airport_dimension(testbed.airports_raw(spark, SF_SMALL))
        shuffled = with_countries(hot, dim, max_broadcast_bytes=0).select("id", "departure_country", "arrival_country")
        rows = shuffled.collect()
        plan = shuffled._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "skew=true" in plan
    assert len(rows) == with_countries(hot, dim).count()
