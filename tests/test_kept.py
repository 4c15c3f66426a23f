"""What outlives a job: models kept for other sessions, flights laid out by batch, request parameters."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from flightlens.operators import features, model, predict
from flightlens.operators.store import TableStore
from flightlens.plans import jobs
from flightlens.sources import landing, testbed
from pages import airport, flight, page, write_page

from conftest import SF_SMALL


@pytest.fixture()
def store(spark, tmp_dir):
    out = TableStore(spark, f"kept_{uuid.uuid4().hex[:8]}", f"{tmp_dir}/warehouse")
    yield out
    out.drop_database()


@pytest.mark.parametrize("encoding", [model.ONEHOT, model.CATEGORICAL])
def test_kept_models_score_as_the_fitted_ones(spark, tmp_dir, encoding):
    training = features.training_frame(testbed.landed_flights(spark, SF_SMALL))
    bins = 32 if encoding == model.ONEHOT else 512
    fitted = model.fit_delay_models(training, max_iter=3, max_depth=3, encoding=encoding, max_bins=bins)
    model.save_models(fitted, f"{tmp_dir}/models")
    kept = model.read_models(spark, f"{tmp_dir}/models")
    assert (kept.encoding, kept.include_delay_time, set(kept.regressors)) == (encoding, True, {"departure", "arrival"})
    frame = features.scoring_frame(testbed.scheduled_flights(spark, SF_SMALL))
    columns = ["id", predict.DEPARTURE_PREDICTION, predict.ARRIVAL_PREDICTION]
    one, two = model.score(fitted, frame).select(*columns), model.score(kept, frame).select(*columns)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))


def test_job_scores_with_the_newest_finished_version(spark, tmp_dir, store, monkeypatch):
    landed = testbed.landed_flights(spark, SF_SMALL)
    store.append(landed, "flights")
    store.append(testbed.scheduled_flights(spark, SF_SMALL), "scheduled_flights")
    with pytest.raises(Exception):
        jobs.kept_models(store)
    first = jobs.train_and_predict(spark, store, max_iter=1, max_depth=1, model_root=f"{tmp_dir}/models")
    want = {r.id: r.departure_estimated_time for r in store.read("scheduled_flights").collect()}
    store.merge(store.read("scheduled_flights").select("id", *[F.lit(None).cast("timestamp").alias(c) for c in jobs.ESTIMATE_COLUMNS]),
                "scheduled_flights", "id", jobs.ESTIMATE_COLUMNS)
    assert store.read("scheduled_flights").where("departure_estimated_time IS NOT NULL").isEmpty()

    write = model.GBTRegressionModel.write

    def dies(self):
        raise RuntimeError("killed")

    monkeypatch.setattr(model.GBTRegressionModel, "write", dies)
    with pytest.raises(RuntimeError):
        jobs.keep_models(store, first.models, first.metrics, f"{tmp_dir}/models")
    monkeypatch.setattr(model.GBTRegressionModel, "write", write)
    assert len(os.listdir(f"{tmp_dir}/models")) == 2           # the version cut short is there but not listed
    assert store.read(jobs.MODELS_TABLE).select("version").distinct().count() == 1
    jobs.predict_with_kept_models(spark, store)
    assert {r.id: r.departure_estimated_time for r in store.read("scheduled_flights").collect()} == want
    version = jobs.keep_models(store, first.models, first.metrics, f"{tmp_dir}/models")
    assert set(jobs.kept_models(store, version).regressors) == {"departure", "arrival"}
    with pytest.raises(ValueError):
        jobs.kept_models(store, "no such version")


def _land(root, batch, codes, status="landed", dep="HUBA", arr="FARB"):
    rows = [{**flight(dep, arr, code=c), "flight_status": status} for c in codes]
    write_page(root, "flights", batch, f"{dep}-{arr}-{status}", 100, 0, page(rows, len(rows)))


def _airports(spark, root, store):
    write_page(root, "airports", "d0", "all", 900, 0, page(
        [airport("HUBA", "Hub Airport", "Country H"), airport("FARB", "Far Airport", "Country F"),
         airport("HUBB", "Second Hub", "Country H")], 3))
    jobs.load_airports(spark, root, store, batch_id="d0")


def test_retry_reads_the_partition_of_its_batch_only(spark, tmp_dir, store):
    root = f"{tmp_dir}/landing"
    _airports(spark, root, store)
    for day in ("d1", "d2", "d3"):
        _land(root, day, [f"{day}-a", f"{day}-b"])
        jobs.load_flights(spark, root, store, batch_id=day)
    assert store.partition_columns("flights") == [jobs.BATCH_PARTITION]
    ids = jobs._loaded_ids(store, "flights", "d2")
    plan = ids._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch_id" in plan and "(batch_id#" in plan and " = d2)" in plan
    assert ids.count() == 2


def test_retry_of_a_table_that_is_not_laid_out_by_batch(spark, tmp_dir, store):
    """A flights table written before: the batch column is added, a retry looks at all of it."""
    root = f"{tmp_dir}/landing"
    _airports(spark, root, store)
    store.append(testbed.landed_flights(spark, SF_SMALL).limit(5), "flights")
    _land(root, "d1", ["a", "b"])
    jobs.load_flights(spark, root, store, batch_id="d1")
    assert store.read("flights").count() == 7
    assert store.partition_columns("flights") == []
    assert jobs._loaded_ids(store, "flights", "d1").count() == 7


def test_hubs_and_status_are_job_parameters(spark, tmp_dir, store):
    root = f"{tmp_dir}/landing"
    _airports(spark, root, store)
    _land(root, "d1", ["out"], dep="HUBA", arr="FARB")
    _land(root, "d1", ["in"], dep="FARB", arr="HUBA")
    _land(root, "d1", ["both"], dep="HUBA", arr="HUBB")
    _land(root, "d1", ["neither"], dep="FARB", arr="FARB")
    _land(root, "d1", ["tomorrow"], dep="HUBA", arr="FARB", status="scheduled")
    write_page(root, "flights", "d1", "odd", 100, 0, page([flight("HUBA", "FARB"), None, "text", {"flight_status": "landed"}], 4))
    result = jobs.load_flights(spark, root, store, batch_id="d1", hubs=("HUBA", "HUBB"), status="landed")
    assert result.counts == {"extracted": 4, "transformed": 4}
    rows = store.read("flights")
    assert rows.select("id").distinct().count() == 4           # "both" answers two requests
    assert rows.where("departure_country = 'Country H' AND arrival_country = 'Country H'").count() == 2
    pages = landing.records(landing.read_pages(spark, root, "flights", "d1"))
    assert landing.answers(pages, landing.ALL).count() == 9
    assert landing.answers(pages, landing.Wanted((), "scheduled")).count() == 1
    assert landing.answers(pages, landing.Wanted(("HUBB",))).count() == 1
    assert landing.answers(pages, landing.Wanted(("huba",))).count() == 0    # codes match exactly
