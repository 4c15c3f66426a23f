"""Queries of the driver contract, one per operator group of SURVEY §2.

Each takes ``(spark, sf_dir)``, reads the test tables through the adapter in
``flightlens.sources.testbed`` and returns a lazy DataFrame whose columns are
named exactly as in the matching SQL of ``flightlens.plans.oracle``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import enrich, features, model, predict, store
from ..operators.dims import broadcast_if_small
from ..plans import dashboard as dash
from ..plans import jobs
from ..schemas import FLIGHTS, PAGE_FILES, SCHEDULED_FLIGHTS
from ..session import apply_defaults, scratch_location, stored
from ..sources import landing, testbed
from ..streaming import request_gate

# Fixed values of the contract queries (the oracle SQL uses the same ones).
HUB_COUNTRY = "NATION_7"
LOOKUP_ICAO = "S1"

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def query(name: str):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_defaults(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        _REGISTRY[name] = run
        return run
    return register


def registry() -> dict[str, Query]:
    return dict(_REGISTRY)


@query("airports_dim")
def airports_dim(spark, sf_dir):
    """The appended airports table reduced to one row per id."""
    return testbed.airports_dim(spark, sf_dir).select("id", "airport_name", "country_name")


@query("flights_enriched")
def flights_enriched(spark, sf_dir):
    """Landed flights with both countries, 14 columns."""
    return testbed.landed_flights(spark, sf_dir)


@query("scheduled_enriched")
def scheduled_enriched(spark, sf_dir):
    """Scheduled flights, 11 columns."""
    return testbed.scheduled_flights(spark, sf_dir)


@query("hub_union")
def hub_union(spark, sf_dir):
    """Arrivals at and departures from the hub, bag union (duplicates kept).

    One pass: each flight is tagged with every hub request it answers and
    exploded, so a flight with both ends at the hub appears twice, as in the
    union of the two requests, without scanning the flights twice.
    """
    landed = testbed.landed_flights(spark, sf_dir)
    requests = F.array(F.when(F.col("arrival_country") == HUB_COUNTRY, F.lit("arr")),
                       F.when(F.col("departure_country") == HUB_COUNTRY, F.lit("dep")))
    cols = ["id", "flight_date", "airline_name", "departure_country", "arrival_country"]
    return (landed.where((F.col("arrival_country") == HUB_COUNTRY)
                         | (F.col("departure_country") == HUB_COUNTRY))
            .select(F.explode(requests).alias("request_id"), *cols)
            .where(F.col("request_id").isNotNull()))


@query("training_labels")
def training_labels(spark, sf_dir):
    """Delay labels in minutes for every landed flight."""
    frame = features.training_frame(testbed.landed_flights(spark, sf_dir))
    return frame.select("id", features.DEPARTURE_LABEL, features.ARRIVAL_LABEL, "delay_time")


@query("calendar_features")
def calendar_features(spark, sf_dir):
    """Hour, day of week, month of departure; delay 0 when absent."""
    frame = features.scoring_frame(testbed.scheduled_flights(spark, sf_dir))
    return frame.select("id", "scheduled_hour", "scheduled_day_of_week", "scheduled_month",
                        "delay_time")


@query("delay_default")
def delay_default(spark, sf_dir):
    """A NULL delay in a landed record is stored as 0."""
    flights = testbed.enriched_flights(spark, sf_dir).where(F.col("status") == testbed.LANDED)
    return flights.select("id", "delay_time",
                          F.col("delay").isNull().cast("int").alias("delay_defaulted"))


@query("time_text_labels")
def time_text_labels(spark, sf_dir):
    """Labels and calendar of landed flights whose times come with ``Z``, an offset, a fraction, no
    time at all or NULL; flights without an actual arrival do not train."""
    flights = testbed.with_time_texts(testbed.enriched_flights(spark, sf_dir), "departure_scheduled_time")
    gone = F.when(F.col("l_orderkey") % testbed.NO_ACTUAL_MOD != 0, F.col("arrival_actual_time"))
    landed = flights.where(F.col("status") == testbed.LANDED).withColumn("arrival_actual_time", gone).to(FLIGHTS)
    return features.training_frame(landed).select(
        "id", features.DEPARTURE_LABEL, features.ARRIVAL_LABEL, "scheduled_hour", "scheduled_day_of_week", "scheduled_month")


@query("time_text_dashboard")
def time_text_dashboard(spark, sf_dir):
    """The dashboard's texts and numbers of scheduled times in all those forms."""
    flights = testbed.with_time_texts(testbed.enriched_flights(spark, sf_dir), "departure_scheduled_time",
                                      "arrival_scheduled_time")
    shown = dash.dashboard(flights.where(F.col("status") == testbed.SCHEDULED).to(SCHEDULED_FLIGHTS))
    return shown.select("id", "departure_scheduled_time", "departure_scheduled_time_number",
                        "arrival_scheduled_time", "arrival_scheduled_time_number")


@query("rejected_rows")
def rejected_rows(spark, sf_dir):
    """Every record the load leaves out, with its reason, as the load job wrote it to its second table."""
    root, tables = scratch_location(spark, "landing"), _fresh_store(spark)
    testbed.land_airport_pages(spark, sf_dir, root)
    testbed.land_yearly_pages(spark, sf_dir, root)
    jobs.load_airports(spark, root, tables, batch_id=testbed.LOAD_BATCH_ID)
    jobs.load_flights(spark, root, tables, batch_id=testbed.LOAD_BATCH_ID, rejects_table="rejected_flights")
    return tables.read("rejected_flights").select(
        "request_id", F.get_json_object("record", "$.flight.icao").alias("flight_code"), "reject_reason")


@query("country_lookup")
def country_lookup(spark, sf_dir):
    """point lookup of one airport's country."""
    return enrich.lookup_country(testbed.airports_dim(spark, sf_dir), LOOKUP_ICAO)


# --- fixed predictor -------------------------------------------------------
# The GBT predictions cannot be checked row by row against SQL, so the queries
# that test what happens *after* prediction (estimated times, merge, dashboard)
# use a predictor SQL can state too: the mean training label per airline. The
# GBT path itself is checked by the ``gbt_*`` queries (row counts only) and by
# the ML tests.

def airline_means(training: DataFrame) -> DataFrame:
    """The fixed predictor: mean departure and arrival label per airline.

    One row per airline; aggregated map-side, then broadcast only when its
    measured size is within the limit.
    """
    means = training.groupBy("airline_name").agg(
        F.avg(features.DEPARTURE_LABEL).alias(predict.DEPARTURE_PREDICTION),
        F.avg(features.ARRIVAL_LABEL).alias(predict.ARRIVAL_PREDICTION))
    means, _ = broadcast_if_small(stored(means, "airline-means"), persist=False)
    return means


def group_mean_scored(spark, sf_dir, scheduled: DataFrame | None = None) -> DataFrame:
    """Scheduled flights (all, or the given ones) scored by the per-airline
    mean delays of landed flights."""
    means = airline_means(features.training_frame(testbed.landed_flights(spark, sf_dir)))
    if scheduled is None:
        scheduled = testbed.scheduled_flights(spark, sf_dir)
    return features.scoring_frame(scheduled).join(means, on="airline_name", how="inner")


ESTIMATES = ["departure_estimated_time", "arrival_estimated_time"]


def _fresh_store(spark) -> store.TableStore:
    return store.TableStore(spark, f"flightlens_{uuid.uuid4().hex[:12]}", scratch_location(spark, "store"))


def merged_schedule(spark, sf_dir) -> DataFrame:
    """Today's table after ``TableStore.merge`` wrote the estimates into it (K6 on a catalog table)."""
    tables = _fresh_store(spark)
    tables.append(testbed.scheduled_flights(spark, sf_dir), "scheduled_flights", SCHEDULED_FLIGHTS)
    estimates = predict.prediction_table(group_mean_scored(spark, sf_dir, tables.read("scheduled_flights")))
    tables.merge(estimates.select("id", *ESTIMATES), "scheduled_flights", "id", ESTIMATES)
    return tables.read("scheduled_flights")


@query("estimated_times")
def estimated_times(spark, sf_dir):
    """The 11-column prediction table."""
    return predict.prediction_table(group_mean_scored(spark, sf_dir))


@query("combine_predictions")
def combine_predictions(spark, sf_dir):
    """Departure and arrival predictions scored apart, joined on id."""
    # Both sides come from one scored frame, which is computed once.
    scored = (group_mean_scored(spark, sf_dir).select("id", predict.DEPARTURE_PREDICTION, predict.ARRIVAL_PREDICTION)
              .persist(StorageLevel.MEMORY_AND_DISK))
    arrivals = scored.drop(predict.DEPARTURE_PREDICTION)
    departures = scored.drop(predict.ARRIVAL_PREDICTION)
    return predict.combine_predictions(arrivals, departures).select(
        "id", predict.DEPARTURE_PREDICTION, predict.ARRIVAL_PREDICTION)


@query("merge_estimates")
def merge_estimates(spark, sf_dir):
    """Scheduled table after MERGE ... WHEN MATCHED THEN UPDATE SET."""
    return merged_schedule(spark, sf_dir)


@query("dashboard")
def dashboard_query(spark, sf_dir):
    """The dashboard's projection of the merged table."""
    return dash.dashboard(merged_schedule(spark, sf_dir))


# Fixed value: the verification query shows ten rows.
VERIFY_ROWS = 10


@query("verify_sample")
def verify_sample(spark, sf_dir):
    """First ten rows by id of the table after the MERGE, to show that it worked."""
    return dash.verify_sample(merged_schedule(spark, sf_dir), VERIFY_ROWS)


@query("regression_metrics")
def regression_metrics(spark, sf_dir):
    """RMSE and MAE of the fixed predictor on the landed flights."""
    training = features.training_frame(testbed.landed_flights(spark, sf_dir))
    scored = training.join(airline_means(training), on="airline_name", how="inner")
    metrics = predict.metrics_per_model(scored, {
        "departure": (features.DEPARTURE_LABEL, predict.DEPARTURE_PREDICTION),
        "arrival": (features.ARRIVAL_LABEL, predict.ARRIVAL_PREDICTION)})
    return metrics.select("model", F.round("rmse", 6).alias("rmse"), F.round("mae", 6).alias("mae"))


@query("batch_counts")
def batch_counts(spark, sf_dir):
    """Rows per stage: extracted, loaded, training, predicted.

    Two aggregations instead of one pass per stage: the API records are
    counted before enrichment; every later stage is a subset of the enriched
    flights, so one pass over them counts all of those with ``count_if``
    (training rows: landed with four parseable times; predicted rows:
    scheduled with an airline the predictor knows).
    """
    landed, scheduled = F.col("status") == testbed.LANDED, F.col("status") == testbed.SCHEDULED
    means = airline_means(features.training_frame(testbed.landed_flights(spark, sf_dir)))
    known = means.select("airline_name", F.lit(True).alias("_predicted"))
    enriched = testbed.enriched_flights(spark, sf_dir).join(known, on="airline_name", how="left")
    wide = [
        testbed.flight_records(spark, sf_dir).agg(
            F.count_if(landed).alias("flights_extracted"),
            F.count_if(scheduled).alias("scheduled_extracted")),
        enriched.agg(
            F.count_if(landed).alias("flights_loaded"),
            F.count_if(scheduled).alias("scheduled_loaded"),
            F.count_if(landed & features.has_training_times()).alias("training_rows"),
            F.count_if(scheduled & F.col("_predicted")).alias("predicted_rows")),
    ]
    rows = None
    for frame in wide:
        stacked = frame.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("stage"), F.col(c).alias("row_count")) for c in frame.columns])))
        rows = stacked if rows is None else rows.unionByName(stacked)
    return rows


@query("complete_requests")
def complete_requests(spark, sf_dir):
    """Records of requests whose pages all landed readable.

    The gate reads the pages twice (page metadata, then the bodies of kept
    pages), as it would re-read landed files. Here the pages are derived from
    lineitem by a shuffle, so they are stored once, as landed files are.
    """
    pages = stored(testbed.api_pages(spark, sf_dir), "api-pages")
    complete = landing.stored_status(pages).where("complete")
    return _request_records(landing.records(pages, status=complete))


def _request_records(recs: DataFrame) -> DataFrame:
    recs = recs.withColumn("flight_code", F.try_variant_get(F.col("record"), "$.flight.icao", "string"))
    return landing.flight_fields(recs).select(
        "request_id", F.col("offset").alias("page_offset"), "pos", "record_id", "flight_code",
        "flight_date", "airline_name", "dep_icao", "arr_icao", "departure_scheduled_time",
        "delay_time")


@query("streamed_requests")
def streamed_requests(spark, sf_dir):
    """The rows of ``complete_requests``, their requests found by the stream that keeps state per request.

    The pages land in parts that hold the pages of a request apart; after each
    part the stream is started again, goes on from its checkpoint, and stops.
    """
    root = scratch_location(spark, "page-parts")
    for part in testbed.page_parts(spark, sf_dir):
        part.write.mode("append").parquet(f"{root}/pages")
        stream = spark.readStream.schema(PAGE_FILES).parquet(f"{root}/pages").select(
            "*", F.col("_metadata.file_modification_time").alias(request_gate.LANDED_AT))
        (request_gate.outcomes(stream).writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
         .option("checkpointLocation", f"{root}/state").start(f"{root}/outcomes").awaitTermination())
    found = spark.read.parquet(f"{root}/outcomes").where(F.col("outcome") == request_gate.COMPLETE)
    pages = spark.read.schema(PAGE_FILES).parquet(f"{root}/pages")
    return _request_records(landing.records(pages, status=found))


@query("requested_flights")
def requested_flights(spark, sf_dir):
    """Flights loaded from pages of all flights by the job's parameters, hub airports and status.

    A flight from one hub to another is there twice.
    """
    root, tables = scratch_location(spark, "landing"), _fresh_store(spark)
    testbed.land_airport_pages(spark, sf_dir, root)
    testbed.land_yearly_pages(spark, sf_dir, root, every_status=True)
    jobs.load_airports(spark, root, tables, batch_id=testbed.LOAD_BATCH_ID)
    jobs.load_flights(spark, root, tables, batch_id=testbed.LOAD_BATCH_ID, hubs=testbed.HUB_CODES, status="landed")
    return tables.read("flights").select(
        "flight_date", "airline_name", "departure_country", "departure_scheduled_time", "departure_actual_time",
        "arrival_country", "arrival_scheduled_time", "arrival_actual_time", "delay_time")


@query("load_counts")
def load_counts(spark, sf_dir):
    """The counts the load jobs themselves report, observed in the pass that writes the tables."""
    root, tables = scratch_location(spark, "landing"), _fresh_store(spark)
    testbed.land_airport_pages(spark, sf_dir, root)
    testbed.land_yearly_pages(spark, sf_dir, root)
    loads = [jobs.load_airports(spark, root, tables, batch_id=testbed.LOAD_BATCH_ID),
             jobs.load_flights(spark, root, tables, batch_id=testbed.LOAD_BATCH_ID)]
    return spark.createDataFrame([(load.table, stage, n) for load in loads for stage, n in load.counts.items()],
                                 "table_name string, stage string, row_count long")


# --- models -------------------------------------------------------------------

def _landed_training(spark, sf_dir) -> DataFrame:
    return features.training_frame(testbed.landed_flights(spark, sf_dir))


def _category_input(spark, sf_dir) -> DataFrame:
    """The five category columns of the training rows, persisted: read by the
    vocabulary check, the indexer fit and the transform."""
    return (_landed_training(spark, sf_dir).select(*features.CATEGORICAL_COLUMNS)
            .persist(StorageLevel.MEMORY_AND_DISK))


@query("landed_load")
def landed_load(spark, sf_dir):
    """Page files landed, both load jobs run, the flights table read back.

    The pages are written below the checkpoint storage. The id (a hash of the
    record's place in its pages) is left out: SQL does not state it.
    """
    root, tables = scratch_location(spark, "landing"), _fresh_store(spark)
    testbed.land_hub_pages(spark, sf_dir, root, HUB_COUNTRY)
    jobs.load_airports(spark, root, tables, batch_id=testbed.LOAD_BATCH_ID)
    jobs.load_flights(spark, root, tables, batch_id=testbed.LOAD_BATCH_ID)
    return tables.read("flights").drop("id", jobs.BATCH_PARTITION)


@query("category_index")
def category_index(spark, sf_dir):
    """Each category's index (frequency descending, then value ascending)."""
    training = _category_input(spark, sf_dir)
    indexer = model.feature_pipeline().getStages()[0].fit(training)
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value"),
                 F.col(model.index_col(c)).cast("int").alias("category_index"))
        for c in features.CATEGORICAL_COLUMNS]))
    return (indexer.transform(training).select(pairs.alias("p")).select("p.*")
            .where(F.col("value").isNotNull()).distinct())


@query("one_hot_slots")
def one_hot_slots(spark, sf_dir):
    """M2: active one-hot slot per category of each scheduled flight; NULL when unseen.

    Fits indexers and encoder on the landed flights and reads the slot from the
    vector that the encoder makes of each scheduled flight. The encoder drops
    its last slot, which is the "unseen" index.
    """
    training = _category_input(spark, sf_dir)
    fitted = model.feature_pipeline(encoding=model.ONEHOT).fit(
        training.withColumns({c: F.lit(0) for c in features.NUMERIC_COLUMNS}))
    encoded = fitted.stages[1].transform(fitted.stages[0].transform(
        features.scoring_frame(testbed.scheduled_flights(spark, sf_dir))))

    def slot(c):
        # A sparse vector with one active index, or none where the category was not seen.
        return F.get(F.unwrap_udt(model.encoded_col(c))["indices"], 0).cast("int").alias(f"{c}_slot")

    return encoded.select("id", *[slot(c) for c in features.CATEGORICAL_COLUMNS])


def _gbt_predictions(spark, sf_dir, target):
    fitted = model.fit_delay_models(_landed_training(spark, sf_dir), targets=(target,))
    scored = model.score(fitted, features.scoring_frame(testbed.scheduled_flights(spark, sf_dir)))
    return scored.select("id", model.TARGETS[target][1])


@query("gbt_departure")
def gbt_departure(spark, sf_dir):
    """Departure-delay GBT (50 rounds, depth 5) scored on the scheduled flights."""
    return _gbt_predictions(spark, sf_dir, "departure")


@query("gbt_arrival")
def gbt_arrival(spark, sf_dir):
    """M5, M7: arrival-delay GBT scored on the scheduled flights."""
    return _gbt_predictions(spark, sf_dir, "arrival")


@query("evaluate_models")
def evaluate_models(spark, sf_dir):
    """M8, M9: both models fitted on 80 %, RMSE and MAE on the other 20 %."""
    _, metrics = model.train_and_evaluate(testbed.landed_flights(spark, sf_dir), mode="holdout")
    return metrics


# A fit of one round and one split is one that SQL can state: the split of largest gain over all candidates, and the
# mean label on either side. Bins enough for a threshold between any two delays.
STUMP = {"max_iter": 1, "max_depth": 1, "max_bins": 64}


@query("evaluation_split")
def evaluation_split(spark, sf_dir):
    """M8: which landed flights train and which are evaluated on."""
    return _landed_training(spark, sf_dir).select("id", model.in_training_part().cast("int").alias("trains"))


@query("gbt_stump_departure")
def gbt_stump_departure(spark, sf_dir):
    """M3-M7: departure fit of one round and one split, without the delay feature, scored on the scheduled flights."""
    fitted = model.fit_delay_models(_landed_training(spark, sf_dir), targets=("departure",), include_delay_time=False, **STUMP)
    scored = model.score(fitted, features.scoring_frame(testbed.scheduled_flights(spark, sf_dir)))
    return scored.select("id", F.round(predict.DEPARTURE_PREDICTION, 6).alias(predict.DEPARTURE_PREDICTION))


@query("gbt_stump_arrival")
def gbt_stump_arrival(spark, sf_dir):
    """M5, M7, M8: arrival fit of one round and one split on the training part, scored on the other part."""
    train, test = model.split(stored(model.training_rows(_landed_training(spark, sf_dir)), "training"))
    fitted = model.fit_delay_models(train, targets=("arrival",), **STUMP)
    return model.score(fitted, test).select("id", F.round(predict.ARRIVAL_PREDICTION, 6).alias(predict.ARRIVAL_PREDICTION))


@query("evaluate_stumps")
def evaluate_stumps(spark, sf_dir):
    """Both one-split fits on 80 %, RMSE and MAE on the other 20 %."""
    _, metrics = model.train_and_evaluate(testbed.landed_flights(spark, sf_dir), mode="holdout", **STUMP)
    return metrics.select("model", F.round("rmse", 6).alias("rmse"), F.round("mae", 6).alias("mae"), "rows")


@query("prediction_job")
def prediction_job(spark, sf_dir):
    """The prediction job over stored tables, with one-split fits; today's table after it."""
    tables = _fresh_store(spark)
    tables.append(testbed.landed_flights(spark, sf_dir), "flights")
    tables.append(testbed.scheduled_flights(spark, sf_dir), "scheduled_flights", SCHEDULED_FLIGHTS)
    jobs.train_and_predict(spark, tables, **STUMP)
    return tables.read("scheduled_flights")


@query("kept_models")
def kept_models(spark, sf_dir):
    """The departure fit of one split, kept in a folder, read again and scored on the scheduled flights."""
    fitted = model.fit_delay_models(_landed_training(spark, sf_dir), targets=("departure",), include_delay_time=False, **STUMP)
    folder = scratch_location(spark, "models")
    model.save_models(fitted, folder)
    scored = model.score(model.read_models(spark, folder), features.scoring_frame(testbed.scheduled_flights(spark, sf_dir)))
    return scored.select("id", F.round(predict.DEPARTURE_PREDICTION, 6).alias(predict.DEPARTURE_PREDICTION))


# --- table maintenance ----------------------------------------------------------

# Fixed value: the scheduled flights are loaded as two daily pulls, split here.
RESET_SPLIT_DATE = "1998-01-01"


@query("scheduled_reload")
def scheduled_reload(spark, sf_dir):
    """today's table after a pull, after a pull that failed, and after another pull.

    The pages of each pull are landed and loaded by the job; the failed pull
    (all its pages are error bodies) leaves the rows of the first.
    """
    root, tables = scratch_location(spark, "landing"), _fresh_store(spark)
    testbed.land_airport_pages(spark, sf_dir, root)
    jobs.load_airports(spark, root, tables, batch_id=testbed.LOAD_BATCH_ID)
    after = None
    for batch_id, side, year, broken in testbed.PULLS:
        testbed.land_scheduled_pull(spark, sf_dir, root, HUB_COUNTRY, batch_id, side, year, broken)
        jobs.load_scheduled(spark, root, tables, batch_id=batch_id)
        seen = tables.read("scheduled_flights").drop("id").withColumn("after_pull", F.lit(batch_id)).checkpoint(eager=True)
        after = seen if after is None else after.unionByName(seen)
    return after


@query("reset_then_load")
def reset_then_load(spark, sf_dir):
    """Load a day, empty the table, load the next day -> only the last load.

    Writes real catalog tables into a fresh database under the session's
    checkpoint storage, then returns the table as read back.
    """
    store_ = _fresh_store(spark)
    scheduled = testbed.scheduled_flights(spark, sf_dir)
    first = scheduled.where(F.col("flight_date") < RESET_SPLIT_DATE)
    second = scheduled.where(F.col("flight_date") >= RESET_SPLIT_DATE)
    store_.append(first, "scheduled_flights", SCHEDULED_FLIGHTS)
    store_.reset("scheduled_flights")
    store_.append(second, "scheduled_flights", SCHEDULED_FLIGHTS)
    return store_.read("scheduled_flights")
