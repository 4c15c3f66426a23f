"""The stream that finds complete requests: any order of pages, restarts, requests that never end."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from flightlens.operators.store import TableStore
from flightlens.plans import jobs
from flightlens.schemas import PAGE_FILES
from flightlens.sources import landing
from flightlens.streaming import request_gate
from pages import airport, flight, page, write_page


def _store(spark, tmp_dir):
    return TableStore(spark, f"gate_{uuid.uuid4().hex[:8]}", f"{tmp_dir}/warehouse")


def _flights(*codes):
    return [flight("HUBA", "FARB", code=c) for c in codes]


def _land(root, request, offset, codes, total, batch="d1", limit=2):
    write_page(root, "flights", batch, request, limit, offset, page(_flights(*codes), total))


def _run(spark, root, store, tmp_dir, **options):
    request_gate.start(spark, root, store, checkpoint_location=f"{tmp_dir}/gate", **options).awaitTermination(300)


@pytest.fixture()
def landed(spark, tmp_dir):
    root, store = f"{tmp_dir}/landing", _store(spark, tmp_dir)
    write_page(root, "airports", "d1", "all", 900, 0, page(
        [airport("HUBA", "Hub Airport", "Country H"), airport("FARB", "Far Airport", "Country F")], 2))
    yield root, store
    store.drop_database()


def test_pages_in_any_order_over_restarts_load_once(spark, tmp_dir, landed):
    root, store = landed
    _land(root, "late", 2, ["c", "d"], 5)          # the middle page first
    _land(root, "whole", 0, ["x"], 1)
    write_page(root, "flights", "d1", "broken", 2, 0, "<html>502</html>")
    _run(spark, root, store, tmp_dir)
    assert store.read("flights").count() == 1
    _land(root, "late", 4, ["e"], 5)               # then the last
    _run(spark, root, store, tmp_dir)
    assert store.read("flights").count() == 1
    _land(root, "late", 0, ["a", "b"], 5)          # the first completes it
    _land(root, "late", 6, ["never"], 5)           # after its end: not part of it
    _run(spark, root, store, tmp_dir)
    assert store.read("flights").count() == 6
    _run(spark, root, store, tmp_dir)
    assert store.read("flights").count() == 6
    assert jobs.load_flights(spark, root, store, batch_id="d1").skipped   # the ledger knows them
    ids = store.read("flights").select("id")
    assert ids.distinct().count() == 6
    whole = landing.records(landing.read_pages(spark, root, "flights", "d1")).select(F.col("record_id").alias("id"))
    assert ids.exceptAll(whole).isEmpty() and whole.exceptAll(ids).isEmpty()


def test_request_that_never_ends_is_given_up_and_can_still_be_loaded(spark, tmp_dir, landed):
    root, store = landed
    _land(root, "open", 0, ["a", "b"], 4)
    _run(spark, root, store, tmp_dir, give_up_after="1 hour")
    # The next page lands three hours later by its time; the one after that finds the watermark past the open request.
    for n, hours in enumerate((3, 6)):
        _land(root, f"next{n}", 0, [f"n{n}"], 1)
        path = f"{root}/dataset=flights/batch_id=d1/request_id=next{n}/limit=2/offset=0/page.json"
        later = os.stat(path).st_mtime + hours * 3600
        os.utime(path, (later, later))
        _run(spark, root, store, tmp_dir, give_up_after="1 hour")
    assert store.read("flights").count() == 2
    given_up = store.read(request_gate.GIVEN_UP_TABLE).collect()
    assert [(r.request_id, r.readable_pages) for r in given_up] == [("open", 1)]
    _land(root, "open", 2, ["c", "d"], 4)
    jobs.load_flights(spark, root, store, batch_id="d1")
    assert store.read("flights").count() == 6


def test_trigger_that_fails_after_its_append_loads_nothing_twice(spark, tmp_dir, landed, monkeypatch):
    root, store = landed
    _land(root, "r", 0, ["a", "b"], 2)
    record = jobs._record

    def crash(store_, requests, state):
        if state == "loaded" and store_.exists("flights"):
            raise RuntimeError("lost")
        record(store_, requests, state)

    monkeypatch.setattr(jobs, "_record", crash)
    with pytest.raises(Exception):
        _run(spark, root, store, tmp_dir)
    assert store.read("flights").count() == 2
    monkeypatch.undo()
    _run(spark, root, store, tmp_dir)
    assert store.read("flights").count() == 2
    assert store.read("airports").count() == 2


@pytest.mark.parametrize("seed", [1, 2])
def test_gate_agrees_with_the_batch_rule(spark, tmp_dir, seed):
    """Random requests with gaps, broken pages, odd offsets and early ends: the stream and the aggregation agree."""
    rng = __import__("random").Random(seed)
    rows = []
    for r in range(40):
        limit = rng.choice([1, 2, 3])
        total = rng.randint(0, 8)
        for offset in range(0, total + 2 * limit, limit):
            kind = rng.random()
            if kind < 0.12:
                continue
            own = total if kind < 0.9 else rng.randint(0, 8)
            body = "<html>" if kind < 0.2 else f'{{"pagination": {{"total": {own}}}, "data": []}}'
            rows.append((body, "flights", "b", f"r{r}", limit, offset + (1 if kind > 0.97 else 0)))
    rng.shuffle(rows)
    path = f"{tmp_dir}/pages"
    for start in range(0, len(rows), len(rows) // 3):
        spark.createDataFrame(rows[start:start + len(rows) // 3], PAGE_FILES).write.mode("append").parquet(path)
        stream = spark.readStream.schema(PAGE_FILES).parquet(path).select(
            "*", F.col("_metadata.file_modification_time").alias(request_gate.LANDED_AT))
        (request_gate.outcomes(stream).writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
         .option("checkpointLocation", f"{tmp_dir}/state").start(f"{tmp_dir}/out").awaitTermination())
    found = {(r.request_id, r.limit): r.stop for r in spark.read.parquet(f"{tmp_dir}/out").collect()}
    status = landing.request_status(landing.parse_pages(spark.read.schema(PAGE_FILES).parquet(path))).where("complete")
    assert found == {(r.request_id, r.limit): r.stop for r in status.collect()}
    assert spark.read.parquet(f"{tmp_dir}/out").count() == len(found) > 5


def _judged(spark, path, tmp_dir, rows):
    """Outcomes after another part with ``rows`` (request, offset, total, hours), and the rows of Spark's state."""
    data = [('{"pagination": {"total": %d}, "data": []}' % total, "flights", None, r, 2, offset, hours) for r, offset, total, hours in rows]
    frame = spark.createDataFrame(data, "value string, dataset string, batch_id string, request_id string, limit int, offset int, hours int")
    frame.withColumn(request_gate.LANDED_AT, F.timestamp_seconds(F.col("hours") * 3600 + 1_000_000)).drop("hours").write.mode("append").parquet(path)
    stream = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    query = (request_gate.outcomes(stream, "1 hour").writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
             .option("checkpointLocation", f"{tmp_dir}/state").start(f"{tmp_dir}/out"))
    query.awaitTermination(300)
    states = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    return {(r.request_id, r.outcome, r.stop, r.readable_pages) for r in spark.read.parquet(f"{tmp_dir}/out").collect()}, states


def test_requests_share_state_and_time_out_on_their_own(spark, tmp_dir, monkeypatch):
    """Many requests are one row of state, one call; in a bucket with new pages the stale requests go, others stay."""
    monkeypatch.setattr(request_gate, "BUCKETS", 1, raising=False)
    path, whole, gone = f"{tmp_dir}/pages", request_gate.COMPLETE, request_gate.GIVEN_UP
    many = {(f"m{i}", whole, 0, 1) for i in range(50)}
    found, states = _judged(spark, path, tmp_dir, [("old", 0, 4, 0), *((f"m{i}", 0, 1, 0) for i in range(50))])
    assert found == many and states[-1] == 1
    _judged(spark, path, tmp_dir, [("new", 0, 4, 3), (None, 0, 9, 3)])
    found, states = _judged(spark, path, tmp_dir, [("new", 2, 4, 4), ("next", 0, 4, 4)])
    assert found == many | {("old", gone, None, 1), ("new", whole, 2, 2)} and states[-1] == 1
    for request in ("late", "later"):
        found, _ = _judged(spark, path, tmp_dir, [(request, 0, 1, 9)])
    assert found == many | {("old", gone, None, 1), ("new", whole, 2, 2), ("next", gone, None, 1), (None, gone, None, 1),
                            ("late", whole, 0, 1), ("later", whole, 0, 1)}


def test_only_folders_of_the_requests_are_read(spark, tmp_dir):
    root = f"{tmp_dir}/landing"
    for r in range(6):
        _land(root, f"r{r}", 0, [f"f{r}"], 1)
    pages = landing.read_pages(spark, root, "flights", "d1")
    status = landing.request_status(landing.parse_pages(pages)).where("request_id = 'r3'").checkpoint(eager=True)
    recs = landing.records(pages, status=status)
    assert [r.request_id for r in recs.collect()] == ["r3"]
    plan = recs._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
