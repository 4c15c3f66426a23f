"""From predicted delays to estimated times and the prediction table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.times import shift_minutes

DEPARTURE_PREDICTION = "predicted_departure_delay"
ARRIVAL_PREDICTION = "predicted_arrival_delay"

PREDICTION_COLUMNS = ["id", "flight_date", "airline_name", "departure_airport", "arrival_airport",
                      "departure_scheduled_time", "arrival_scheduled_time",
                      "departure_estimated_time", "arrival_estimated_time",
                      DEPARTURE_PREDICTION, ARRIVAL_PREDICTION]


def with_estimated_times(scored: DataFrame) -> DataFrame:
    """Scheduled time + predicted minutes -> estimated time.

    ``scored`` needs ``departure_scheduled_ts``/``arrival_scheduled_ts`` (from
    ``scoring_frame``) and both prediction columns. The base is whole seconds,
    the predicted minutes keep their fraction.
    """
    return scored.withColumns({
        "departure_estimated_time": shift_minutes("departure_scheduled_ts", F.col(DEPARTURE_PREDICTION)),
        "arrival_estimated_time": shift_minutes("arrival_scheduled_ts", F.col(ARRIVAL_PREDICTION)),
    })


def prediction_table(scored: DataFrame) -> DataFrame:
    """The 11-column prediction output (P10)."""
    return with_estimated_times(scored).select(*PREDICTION_COLUMNS)


def combine_predictions(arrival_scored: DataFrame, departure_scored: DataFrame,
                        key: str = "id") -> DataFrame:
    """Join two separately scored frames on ``key``.

    Only needed when the two predictions come from different frames; the
    model path in ``operators.model`` scores both on one frame, no join.
    """
    return arrival_scored.drop(DEPARTURE_PREDICTION).join(departure_scored.select(key, DEPARTURE_PREDICTION), on=key)


def regression_metrics(predictions: DataFrame, label: str, prediction: str) -> DataFrame:
    """RMSE and MAE as one aggregate row (same definitions as RegressionEvaluator).

    Rows with a NULL label or prediction are ignored, as ``avg`` ignores them.
    """
    return metrics_per_model(predictions, {"": (label, prediction)}).drop("model")


def metrics_per_model(predictions: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """RMSE, MAE and row count of each ``model -> (label, prediction)`` pair.

    All pairs are aggregated in one pass over ``predictions`` (one partial
    aggregate per task, one tiny final row), then turned into one row per model.
    """
    aggs, rows = [], []
    for i, (name, (label, prediction)) in enumerate(pairs.items()):
        err = F.col(prediction) - F.col(label)
        aggs += [F.avg(err * err).alias(f"_mse{i}"), F.avg(F.abs(err)).alias(f"_mae{i}"),
                 F.count(err).alias(f"_rows{i}")]
        rows.append(F.struct(F.lit(name).alias("model"), F.sqrt(f"_mse{i}").alias("rmse"),
                             F.col(f"_mae{i}").alias("mae"), F.col(f"_rows{i}").alias("rows")))
    return predictions.agg(*aggs).select(F.inline(F.array(*rows)))
