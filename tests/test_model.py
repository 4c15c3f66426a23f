"""Feature pipeline and delay models."""

import math

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from flightlens.operators import features, model, predict
from flightlens.sources import testbed

from conftest import SF_SMALL


def _frame(spark, rows):
    cols = ("id airline_name departure_airport arrival_airport departure_country arrival_country "
            "delay_time scheduled_hour scheduled_day_of_week scheduled_month").split()
    schema = ", ".join(f"{c} {'int' if c in features.NUMERIC_COLUMNS else 'string'}" for c in cols)
    return spark.createDataFrame(rows, schema)


ROWS = [
    ("1", "B", "P1", "Q1", "X", "Y", 1, 10, 2, 3),
    ("2", "A", "P1", "Q2", "X", "Y", 2, 11, 3, 3),
    ("3", "B", "P2", "Q1", "Z", "Y", 3, 12, 4, 3),
    ("4", "A", "P1", "Q1", "X", "Y", 4, 13, 5, 4),
    ("5", "C", "P2", "Q2", "Z", "W", 5, 14, 6, 4),
]


def test_index_order_frequency_then_value(spark):
    fitted = model.feature_pipeline().fit(_frame(spark, ROWS))
    labels = dict(zip(features.CATEGORICAL_COLUMNS, fitted.stages[0].labelsArray))
    assert labels["airline_name"] == ["A", "B", "C"]          # ties A/B by value, C last
    assert labels["departure_airport"] == ["P1", "P2"]
    assert labels["arrival_country"] == ["Y", "W"]


def test_vector_width_and_unseen_zero_block(spark):
    fitted = model.feature_pipeline().fit(_frame(spark, ROWS))
    sizes = {c: len(l) for c, l in zip(features.CATEGORICAL_COLUMNS, fitted.stages[0].labelsArray)}
    unseen = _frame(spark, [("9", "NEW", "P1", "Q1", "X", "Y", 0, 1, 1, 1)])
    vec = fitted.transform(unseen).select(vector_to_array("features").alias("v")).first().v
    assert len(vec) == sum(sizes.values()) + len(features.NUMERIC_COLUMNS)
    assert vec[:sizes["airline_name"]] == [0.0] * sizes["airline_name"]
    # the active slot of a seen category is its index
    seen = fitted.transform(_frame(spark, [ROWS[2]])).select(vector_to_array("features").alias("v")).first().v
    assert seen[1] == 1.0  # airline B has index 1


def test_null_numeric_feature_row_is_skipped(spark):
    fitted = model.feature_pipeline().fit(_frame(spark, ROWS))
    with_null = _frame(spark, [("7", "A", "P1", "Q1", "X", "Y", None, 1, 1, 1), ROWS[0]])
    assert fitted.transform(with_null).count() == 1


@pytest.fixture(scope="module")
def landed(spark):
    return testbed.landed_flights(spark, SF_SMALL).cache()


def test_gbt_learns_signal_and_refit_is_deterministic(spark, landed):
    training = features.training_frame(landed).cache()
    train, test = model.split(training)
    m1 = model.fit_delay_models(train, max_iter=5, max_depth=3)
    metrics = {r.model: r for r in model.evaluation(m1, test).collect()}
    stats = test.agg(F.stddev(features.DEPARTURE_LABEL).alias("d"),
                     F.stddev(features.ARRIVAL_LABEL).alias("a")).first()
    assert metrics["departure"].rmse < 0.8 * stats.d
    assert metrics["arrival"].rmse < 0.8 * stats.a
    m2 = model.fit_delay_models(train, max_iter=5, max_depth=3)
    p1 = model.score(m1, test).select("id", predict.DEPARTURE_PREDICTION).orderBy("id").collect()
    p2 = model.score(m2, test).select("id", predict.DEPARTURE_PREDICTION).orderBy("id").collect()
    assert p1 == p2


def test_estimated_minus_scheduled_equals_prediction(spark, landed):
    m = model.fit_delay_models(features.training_frame(landed), max_iter=2, max_depth=2)
    sched = testbed.scheduled_flights(spark, SF_SMALL)
    preds = model.predict_scheduled(m, sched)
    diffs = preds.select(
        ((F.unix_micros("departure_estimated_time") - F.unix_micros(F.try_to_timestamp("departure_scheduled_time"))) / 1e6
         - F.col(predict.DEPARTURE_PREDICTION) * 60).alias("d")).agg(F.max(F.abs("d"))).first()[0]
    assert diffs < 1e-5
    assert preds.count() == sched.count()
    assert set(preds.columns) == set(predict.PREDICTION_COLUMNS)


def test_metrics_match_regression_evaluator(spark, landed):
    from pyspark.ml.evaluation import RegressionEvaluator

    m = model.fit_delay_models(features.training_frame(landed), targets=("departure",), max_iter=2, max_depth=2)
    scored = model.score(m, features.training_frame(landed))
    ours = predict.regression_metrics(scored, features.DEPARTURE_LABEL, predict.DEPARTURE_PREDICTION).first()
    for metric in ("rmse", "mae"):
        ev = RegressionEvaluator(metricName=metric, labelCol=features.DEPARTURE_LABEL,
                                 predictionCol=predict.DEPARTURE_PREDICTION).evaluate(scored)
        assert math.isclose(ev, ours[metric], rel_tol=1e-9)
