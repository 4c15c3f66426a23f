"""The one-hot learner against Spark's own and at its edges."""

import random

import pytest
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from conftest import SF_SMALL
from flightlens import session
from flightlens.operators import boosting, features, model, predict
from flightlens.plans import contract
from flightlens.sources import testbed

SCHEMA = ("id long, airline_name string, departure_airport string, arrival_airport string, departure_country string, "
          "arrival_country string, delay_time int, scheduled_hour int, scheduled_day_of_week int, scheduled_month int, "
          "departure_delay_minutes double, arrival_delay_minutes double")


def _rows(n, seed):
    """Flights with a hub, rare airports, missing names and labels without equal gains."""
    draw = random.Random(seed)

    def name(prefix, most):
        return draw.choice([None, f"{prefix}0", f"{prefix}0", f"{prefix}{int(most * draw.random() ** 2)}"])

    for i in range(n):
        dep, arr, delay, hour = name("D", 40), name("A", 90), draw.randrange(60), draw.randrange(24)
        base = 30.0 * (dep == "D0") + 12.0 * (arr == "A3") + 0.7 * delay + 3.0 * (hour > 17)
        yield (i, name("L", 4), dep, arr, name("C", 12), name("C", 9), delay, hour, 1 + draw.randrange(7), 1 + draw.randrange(12),
               base + draw.gauss(0, 9), base / 2 + draw.gauss(0, 9))


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(list(_rows(900, 7)), SCHEMA).cache()


@pytest.mark.parametrize("depth, rounds, of_training", [(2, 12, False), (4, 4, True)])
def test_trees_of_sparks_learner(spark, rows, monkeypatch, depth, rounds, of_training):
    """Same predictions as Spark's one-hot fit, beyond the rounds that are settled, with rare categories in two blocks.

    Small nodes have many splits of equal gain that part the training rows alike and others not.
    """
    monkeypatch.setattr(boosting, "FREQUENT", 30)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 300)
    ours = model.fit_delay_models(rows, max_iter=rounds, max_depth=depth)
    assert ours.features is None                         # no list of categories in the model
    stage = model.feature_pipeline().fit(rows)
    assert list(ours.category_sizes().values()) == [len(l) for l in stage.stages[0].labelsArray]
    unseen = F.when(F.col("id") % 9 > 0, F.col("arrival_airport")).otherwise("unseen")
    frame = rows if of_training else spark.createDataFrame(list(_rows(300, 8)), SCHEMA).withColumn("arrival_airport", unseen)
    got = {r.id: r for r in model.score(ours, frame).collect()}
    vectors = stage.transform(rows).cache()
    for label, column in model.TARGETS.values():
        spark_fit = GBTRegressor(featuresCol="features", labelCol=label, predictionCol="p", maxIter=rounds, maxDepth=depth).fit(vectors)
        want = {r.id: r.p for r in spark_fit.transform(stage.transform(frame)).collect()}
        assert want.keys() == got.keys()
        assert max(abs(got[i][column] - p) for i, p in want.items()) < 1e-9


def test_rare_categories_are_found(spark, monkeypatch):
    """The one category that matters is in a block of rare ones; the stump names it."""
    data = [(i, "L", f"D{i % 50}", f"A{i % 300}", "C", "C", 0, i % 5, 1, 1, 100.0 if i % 300 == 77 else float(i % 2), 0.5) for i in range(900)]
    fitted = model.fit_delay_models(spark.createDataFrame(data, SCHEMA), targets=("departure",), max_iter=1, max_depth=1)
    root = fitted.regressors["departure"].trees[0][0]
    assert (root.column, root.value, root.rows) == (2, "A77", 900)


def test_rows_that_cannot_train_or_score(spark, rows):
    with pytest.raises(Exception, match="departure_delay_minutes"):
        model.fit_delay_models(rows.withColumn(features.DEPARTURE_LABEL, F.lit(None).cast("double")), max_iter=1)
    with pytest.raises(ValueError, match="no rows"):
        model.fit_delay_models(rows.where("false"), max_iter=1)
    same = model.fit_delay_models(rows.withColumn(features.ARRIVAL_LABEL, F.lit(3.0)), targets=("arrival",), max_iter=3)
    assert all(len(tree) == 1 for tree in same.regressors["arrival"].trees)
    gone = rows.withColumn("scheduled_hour", F.when(F.col("id") > 4, F.col("scheduled_hour")))
    scored = model.score(same, gone)
    assert scored.count() == 895 and scored.select(predict.ARRIVAL_PREDICTION).distinct().count() == 1


def test_rows_are_written_once_without_a_join(spark, rows, monkeypatch):
    """No list of categories is joined (or sent to the driver) for the blocks; rows that lack a number count in sizes."""
    plans = []

    def stored(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return session.stored(df, name)

    monkeypatch.setattr(boosting, "stored", stored)
    monkeypatch.setattr(boosting, "FREQUENT", 30)
    gone = rows.withColumn("scheduled_hour", F.when(F.col("id") > 400, F.col("scheduled_hour")))
    plan_rows = spark.createDataFrame(gone.collect(), gone.schema)
    fitted = model.fit_delay_models(plan_rows, targets=("arrival",), max_iter=1, max_depth=2)
    assert len(plans) == 1 and "Join" not in plans[0]
    want = plan_rows.agg(*[F.count_distinct(c) for c in features.CATEGORICAL_COLUMNS]).first()
    assert list(fitted.category_sizes().values()) == list(want)
    assert fitted.regressors["arrival"].trees[0][0].rows == 499


def _same_trees(want, got):
    """The same splits; predictions but for the order in which rows were added up."""
    for one, two in zip(want, got, strict=True):
        assert {k: (n.column, n.value, n.cut, n.rows) for k, n in one.items()} == {k: (n.column, n.value, n.cut, n.rows) for k, n in two.items()}
        assert all(abs(one[k].prediction - two[k].prediction) < 1e-9 for k in one)


def test_labels_share_a_job_for_each_level(spark, rows):
    """Both labels of a level are one pass over the blocks."""
    labels = [label for label, _ in model.TARGETS.values()]
    blocks = boosting.make_blocks(rows, features.CATEGORICAL_COLUMNS, features.NUMERIC_COLUMNS, labels, 32)
    tracker, group = spark.sparkContext.statusTracker(), "levels"
    spark.sparkContext.setJobGroup(group, group)
    try:
        both = boosting.fit(blocks, 2, 2)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        blocks.done()
    assert len(tracker.getJobIdsForGroup(group)) == 1 + 2 * 2       # the sums of all rows, and a job a level
    for target, (label, _) in model.TARGETS.items():
        alone = model.fit_delay_models(rows, targets=(target,), max_iter=2, max_depth=2)
        _same_trees(alone.regressors[target].trees, both[label].trees)


def test_tasks_hold_small_blocks_of_whole_categories(spark, rows, monkeypatch):
    """What a task holds at once does not grow with its rows; a category is in one block."""
    monkeypatch.setattr(boosting, "FREQUENT", 30)
    monkeypatch.setattr(boosting, "CHUNK_ROWS", 64, raising=False)
    blocks = boosting.make_blocks(rows, features.CATEGORICAL_COLUMNS, features.NUMERIC_COLUMNS, [features.ARRIVAL_LABEL], 32)
    held = blocks.frame.collect()
    assert sum(r.n for r in held if r.part < 0) == 900 and max(r.n for r in held) < 2 * (64 + 900 // 30)
    assert sum(1 for r in held if r.part < 0) > 10
    for c in blocks.layout.rare:
        names = [x for r in held if r.part == c for x in boosting._names(r.names).to_pylist()]
        assert len(names) == len(set(names)) == blocks.sizes[c] - len(blocks.frequent[c])


def test_lost_blocks_are_made_again(spark, rows, monkeypatch):
    want = model.fit_delay_models(rows, targets=("arrival",), max_iter=9, max_depth=2).regressors["arrival"]
    settle, lost = boosting._Fit._settle, []

    def loses(self, asks):
        out = settle(self, asks)
        if not lost:
            lost.append(1)
            self._release(self.frame)
        return out

    monkeypatch.setattr(boosting._Fit, "_settle", loses)
    got = model.fit_delay_models(rows, targets=("arrival",), max_iter=9, max_depth=2).regressors["arrival"]
    assert lost
    _same_trees(want.trees, got.trees)


def test_arrival_stump_reads_its_flights_once(spark, monkeypatch):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(value):
        read.add(1)
        return value

    flights = testbed.landed_flights(spark, SF_SMALL).withColumn("airline_name", counted("airline_name"))
    monkeypatch.setattr(contract.testbed, "landed_flights", lambda *_: flights)
    assert contract.registry()["gbt_stump_arrival"](spark, SF_SMALL).count() > 0
    assert read.value == testbed.enriched_flights(spark, SF_SMALL).where("status = 'F'").count()
