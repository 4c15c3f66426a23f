"""Delay models: category indexing, one-hot, assembly, two GBT regressors.

The reference fits two full pipelines, each refitting its own indexers and
encoders on a training frame that is never cached, then scores the scheduled
flights twice and self-joins the results on ``id``. Here:

* the training rows are prepared and persisted once and both regressors train
  on them;
* scoring chains both models on one frame, so no join is needed (J3 is kept
  as ``predict.combine_predictions`` for frames scored apart).

The reference's one-hot layout is fitted by ``operators.boosting``, which does
not grow with the number of airports: what reaches the driver is the trees and
a few hundred sums a node. Spark ML's indexer, encoder, assembler and learner
serve the categorical layout and the queries on indices and slots; there the
category vocabularies reach the driver.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml import regression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stored
from . import boosting, features, predict
from .boosting import GBTRegressionModel

# Reference hyper-parameters (fixed values): 50 boosting rounds of depth-5 trees,
# an 80/20 evaluation split with seed 42, 32 bins.
MAX_ITER = 50
MAX_DEPTH = 5
TRAIN_SHARE = 0.8
SPLIT_SEED = 42
MAX_BINS = 32

TARGETS = {
    "departure": (features.DEPARTURE_LABEL, predict.DEPARTURE_PREDICTION),
    "arrival": (features.ARRIVAL_LABEL, predict.ARRIVAL_PREDICTION),
}


def index_col(c: str) -> str:
    return f"{c}_index"


def encoded_col(c: str) -> str:
    return f"{c}_encoded"


ONEHOT, CATEGORICAL = "onehot", "categorical"


def feature_columns(include_delay_time: bool = True, encoding: str = ONEHOT) -> list[str]:
    numeric = [c for c in features.NUMERIC_COLUMNS if include_delay_time or c != "delay_time"]
    block = encoded_col if encoding == ONEHOT else index_col
    return [block(c) for c in features.CATEGORICAL_COLUMNS] + numeric


def feature_pipeline(include_delay_time: bool = True, encoding: str = ONEHOT) -> Pipeline:
    """M1-M3: StringIndexer(keep) -> [OneHotEncoder(dropLast)] -> VectorAssembler(skip).

    Category order is frequency descending, then value ascending; NULL and
    unseen values go to the extra "keep" index. Rows with a NULL numeric
    feature are skipped at assembly, in training and in scoring alike (F6).

    ``encoding="onehot"`` is the reference's layout: one slot per seen
    category, the "keep" index is the dropped slot, so unseen encodes as all
    zeros. ``encoding="categorical"`` assembles the five indices themselves;
    the indexer's nominal metadata marks them categorical, so the trees split
    on sets of categories and the vector stays nine wide however many
    airports exist (the tree learner bins every feature of every row, so a
    one-hot block as wide as the airport list costs that much per row).
    """
    cats = features.CATEGORICAL_COLUMNS
    indexer = StringIndexer(inputCols=cats, outputCols=[index_col(c) for c in cats],
                            handleInvalid="keep")
    assembler = VectorAssembler(inputCols=feature_columns(include_delay_time, encoding),
                                outputCol="features", handleInvalid="skip")
    if encoding == CATEGORICAL:
        return Pipeline(stages=[indexer, assembler])
    encoder = OneHotEncoder(inputCols=[index_col(c) for c in cats],
                            outputCols=[encoded_col(c) for c in cats])
    return Pipeline(stages=[indexer, encoder, assembler])


_SETTINGS = "targets array<string>, include_delay_time boolean, encoding string, sizes array<int>"


@dataclass
class DelayModels:
    """Fitted models. ``features`` is Spark ML's feature stage, or none where the trees name the categories themselves."""
    features: PipelineModel | None
    regressors: dict[str, GBTRegressionModel | regression.GBTRegressionModel]
    include_delay_time: bool = True
    encoding: str = ONEHOT
    sizes: list[int] | None = None

    def category_sizes(self) -> dict[str, int]:
        """Seen categories per column (the width of its one-hot block)."""
        if self.features is None:
            return dict(zip(features.CATEGORICAL_COLUMNS, self.sizes))
        indexer = self.features.stages[0]
        return {c: len(labels) for c, labels in zip(features.CATEGORICAL_COLUMNS, indexer.labelsArray)}


def save_models(models: DelayModels, path: str) -> None:
    """Keep fitted models in a folder: the feature stage if any, a regressor per target, and what they were fitted with.

    Written by Spark, so any session that reaches the folder can score with them. The
    settings come last: a folder without them is a save that did not finish, which ``read_models`` refuses.
    """
    path = path.rstrip("/")
    if models.features is not None:
        models.features.write().overwrite().save(f"{path}/features")
    else:
        columns = [(c,) for c in features.CATEGORICAL_COLUMNS + _numbers(models.include_delay_time)]
        SparkSession.active().createDataFrame(columns, "name string").coalesce(1).write.mode("overwrite").json(f"{path}/columns")
    for target, fitted in models.regressors.items():
        writer = fitted.write()
        (writer.mode("overwrite") if models.features is None else writer.overwrite()).save(f"{path}/{target}")
    settings = SparkSession.active().createDataFrame(
        [(list(models.regressors), models.include_delay_time, models.encoding, models.sizes)], _SETTINGS)
    settings.coalesce(1).write.mode("overwrite").json(f"{path}/settings")


def read_models(spark: SparkSession, path: str) -> DelayModels:
    """The models ``save_models`` kept in ``path``; they score as the fitted ones do, row by row."""
    path = path.rstrip("/")
    kept = spark.read.schema(_SETTINGS).json(f"{path}/settings").first()
    if kept is None:
        raise ValueError(f"no finished models in {path}")
    own = kept["sizes"] is not None  # without: kept with Spark ML's feature stage
    learner = GBTRegressionModel if own else regression.GBTRegressionModel
    regressors = {t: learner.load(f"{path}/{t}") for t in kept["targets"]}
    stage = None if own else PipelineModel.load(f"{path}/features")
    return DelayModels(stage, regressors, kept["include_delay_time"], kept["encoding"], kept["sizes"])


def _helper_columns() -> list[str]:
    cats = features.CATEGORICAL_COLUMNS
    return [index_col(c) for c in cats] + [encoded_col(c) for c in cats] + ["features"]


def fit_delay_models(training: DataFrame, targets=("departure", "arrival"),
                     max_iter: int = MAX_ITER, max_depth: int = MAX_DEPTH,
                     include_delay_time: bool = True, encoding: str = ONEHOT,
                     max_bins: int = MAX_BINS) -> DelayModels:
    """M4-M6: prepare the rows once, then one GBT per target.

    The default is the reference's layout, one-hot categories and 32 bins
    (see ``boosting``). ``encoding=CATEGORICAL`` is Spark ML's learner on
    category indices, whose trees split on sets of categories, so its
    predictions differ.

    ``training`` is the output of ``features.training_frame``. The rows are
    persisted once for all fits (each GBT round reads them several times).
    With categorical encoding ``maxBins`` is raised to the largest category
    count (the learner needs one bin per category); continuous features keep
    at most that many candidate thresholds.
    """
    labels = [TARGETS[t][0] for t in targets]
    if encoding == ONEHOT:
        return _fit_onehot(training, targets, labels, max_iter, max_depth, include_delay_time, max_bins)
    # The input is read by the indexer fit and the vector transform; keep
    # one narrow copy for both.
    training = (training.select(*features.CATEGORICAL_COLUMNS, *features.NUMERIC_COLUMNS, *labels)
                .persist(StorageLevel.MEMORY_AND_DISK))
    try:
        return _fit(training, targets, labels, max_iter, max_depth, include_delay_time, encoding, max_bins)
    finally:
        training.unpersist()


def _numbers(include_delay_time: bool) -> list[str]:
    return [c for c in features.NUMERIC_COLUMNS if include_delay_time or c != "delay_time"]


def _fit_onehot(training, targets, labels, max_iter, max_depth, include_delay_time, max_bins):
    blocks = boosting.make_blocks(training, features.CATEGORICAL_COLUMNS, _numbers(include_delay_time), labels, max_bins)
    try:
        fitted = boosting.fit(blocks, max_iter, max_depth)
    finally:
        blocks.done()
    return DelayModels(None, {t: fitted[label] for t, label in zip(targets, labels)}, include_delay_time, ONEHOT, blocks.sizes)


def _fit(training, targets, labels, max_iter, max_depth, include_delay_time, encoding, max_bins):
    feature_model = feature_pipeline(include_delay_time, encoding).fit(training)
    # labels + the "keep" index
    max_bins = max([max_bins] + [len(l) + 1 for l in feature_model.stages[0].labelsArray])
    vectors = (feature_model.transform(training).select("features", *labels)
               .persist(StorageLevel.MEMORY_AND_DISK))

    def fit_one(target: str) -> regression.GBTRegressionModel:
        label, prediction = TARGETS[target]
        gbt = regression.GBTRegressor(featuresCol="features", labelCol=label, predictionCol=prediction,
                                      maxIter=max_iter, maxDepth=max_depth, maxBins=max_bins)
        return gbt.fit(vectors)

    try:
        # Boosting runs many small jobs one after the other; fitting the two
        # targets from two threads lets their jobs share the executors.
        with ThreadPoolExecutor(max_workers=len(targets)) as pool:
            fitted = list(pool.map(fit_one, targets))
    finally:
        vectors.unpersist()
    regressors = dict(zip(targets, fitted))
    return DelayModels(feature_model, regressors, include_delay_time, encoding)


def score(models: DelayModels, frame: DataFrame) -> DataFrame:
    """M7: add one prediction column per fitted target; rows failing F6 drop out."""
    if models.features is None:
        numbers = _numbers(models.include_delay_time)
        for c in numbers:
            frame = frame.where(F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")))
        return frame.withColumns({TARGETS[t][1]: m.prediction(features.CATEGORICAL_COLUMNS, numbers)
                                  for t, m in models.regressors.items()})
    out = models.features.transform(frame)
    for t, model in models.regressors.items():
        out = model.transform(out)
    return out.drop(*[c for c in _helper_columns() if c in out.columns])


def in_training_part(key: str = "id", seed: int = SPLIT_SEED, share: float = TRAIN_SHARE) -> Column:
    """Whether a row is of the training part: by a hash of its id, whatever the partitioning of the table.

    The first 32 bits of sha-256 of ``<seed>:<id>`` lie below the share. A row without an id trains.
    """
    draw = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")), 256), 1, 8), 16, 10)
    return F.coalesce(draw.cast("long") < int(share * 2 ** 32), F.lit(True))


def training_rows(training: DataFrame) -> DataFrame:
    """What split, fits and evaluation read of ``features.training_frame``."""
    return training.select("id", *features.CATEGORICAL_COLUMNS, *features.NUMERIC_COLUMNS,
                           *[label for label, _ in TARGETS.values()])


def split(training: DataFrame, seed: int = SPLIT_SEED) -> tuple[DataFrame, DataFrame]:
    """M8: 80/20 split by a hash of the flight's id."""
    part = in_training_part(seed=seed)
    return training.where(part), training.where(~part)


def tree_nodes(models: DelayModels) -> DataFrame:
    """Every node of every tree as a row: target, tree, node, depth, feature, threshold (null at leaves or for
    categories), gain, prediction, rows. Trees are small models; their number is the number of rounds.
    Where the trees name the categories, feature is the number of the column, the categories' columns first."""
    rows = []
    for target, fitted in models.regressors.items():
        if models.features is None:
            rows += [(target, t, k, (k + 1).bit_length() - 1, column, cut, gain, prediction, n)
                     for t, k, column, _, cut, gain, prediction, n, _ in fitted.node_rows()]
            continue
        for t, tree in enumerate(fitted.trees):
            stack, number = [(tree._call_java("rootNode"), 0)], 0
            while stack:
                node, depth = stack.pop()
                inner = node.subtreeDepth() > 0
                feature = int(node.split().featureIndex()) if inner else None
                threshold = (float(node.split().threshold())
                             if inner and node.split().getClass().getSimpleName() == "ContinuousSplit" else None)
                rows.append((target, t, number, depth, feature, threshold, float(node.gain()) if inner else None,
                             float(node.prediction()), int(node.impurityStats().count())))
                number += 1
                if inner:
                    stack += [(node.rightChild(), depth + 1), (node.leftChild(), depth + 1)]
    return SparkSession.active().createDataFrame(
        rows, "target string, tree int, node int, depth int, feature int, threshold double, gain double, "
              "prediction double, rows long")


def evaluation(models: DelayModels, test: DataFrame) -> DataFrame:
    """RMSE and MAE per model on ``test`` (one row per model)."""
    return predict.metrics_per_model(score(models, test), {t: TARGETS[t] for t in models.regressors})


def train_and_evaluate(flights: DataFrame, mode: str = "in_sample",
                       max_iter: int = MAX_ITER, max_depth: int = MAX_DEPTH,
                       include_delay_time: bool = True,
                       targets=("departure", "arrival"),
                       encoding: str = ONEHOT, max_bins: int = MAX_BINS) -> tuple[DelayModels, DataFrame]:
    """Prepare, fit and evaluate (M8, M9, SURVEY T5).

    ``mode="in_sample"`` reproduces the reference: fit on all rows, report on
    a 20 % split of those same rows. ``mode="holdout"`` fits on the 80 % and
    reports on the unseen 20 %. The training frame is stored once, so
    the fit and the evaluation read fixed rows and survive executor loss.
    """
    training = stored(training_rows(features.training_frame(flights)), "training")
    train, test = split(training)
    fit_rows = training if mode == "in_sample" else train
    models = fit_delay_models(fit_rows, targets, max_iter, max_depth, include_delay_time, encoding, max_bins)
    return models, evaluation(models, test)


def predict_scheduled(models: DelayModels, scheduled: DataFrame) -> DataFrame:
    """Scheduled flights -> 11-column prediction table with estimated times."""
    return predict.prediction_table(score(models, features.scoring_frame(scheduled)))
