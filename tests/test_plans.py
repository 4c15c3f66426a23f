"""Physical-plan shape: broadcast enrichment, pruned scans, no Python in the hot path."""

from flightlens.operators.dims import broadcast_if_small
from flightlens.plans import contract, dashboard
from flightlens.sources import testbed

from conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_enrichment_broadcasts_the_measured_dimension(spark):
    plan = _plan(contract.flights_enriched(spark, SF_SMALL))
    assert plan.count("BroadcastHashJoin") >= 2
    for python_node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
        assert python_node not in plan


def test_oversized_dimension_is_not_broadcast(spark):
    dim = testbed.airports_dim(spark, SF_SMALL)
    _, hinted = broadcast_if_small(dim, max_bytes=10)
    assert not hinted
    _, hinted = broadcast_if_small(dim)
    assert hinted


def test_filters_and_columns_reach_the_scan(spark):
    df = contract.flights_enriched(spark, SF_SMALL)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(l_linestatus,F)" in text
    assert "l_comment" not in text and "l_tax" not in text


def test_dashboard_is_a_projection(spark):
    sched = testbed.scheduled_flights(spark, SF_SMALL)
    base = _plan(sched).count("Exchange")
    assert _plan(dashboard.dashboard(sched)).count("Exchange") == base


def test_lines_join_orders_by_shuffle(spark):
    """Orders grow with lineitem: never broadcast, whatever the file sizes."""
    plan = _plan(testbed.flight_lines(spark, SF_SMALL))
    assert "SortMergeJoin" in plan
    assert plan.count("BroadcastHashJoin") == 1  # customer only


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().executedPlan().toString()


def test_verify_sample_shows_a_broken_merge(spark, monkeypatch):
    """The sample reads the table after the real MERGE: without the update it shows no estimate."""
    shown = contract.verify_sample(spark, SF_SMALL)
    assert shown.where("departure_estimated_time is not null").count() > 0
    monkeypatch.setattr(contract.store.TableStore, "_merge", lambda self, source, table, key, columns: self.spark.sql(
        f"ALTER TABLE {self.name(table)} ADD COLUMNS (departure_estimated_time timestamp, arrival_estimated_time timestamp)"))
    broken = contract.verify_sample(spark, SF_SMALL)
    assert broken.where("departure_estimated_time is not null").count() == 0
