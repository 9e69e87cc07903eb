"""Forecasting on tables with pyspark.ml (ML-1 to ML-8)."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.ml import Model, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arterial.functions.temporal import temporal_features
from arterial.operators.clean import feature_columns, fill_missing
from arterial.operators.features import lag_features, spatial_features, traffic_features
from arterial.operators.metrics import error_metrics
from arterial.operators.normalize import apply_normalizer, fit_normalizer
from arterial.operators.ordering import ROWS_PER_TASK
from arterial.operators.sequences import at_or_after, chronological_split, rows_at
from arterial.session import pin

HORIZONS = (15, 30, 60)
# trees keep their rows in memory, about 1 KB each, and a task reads all rows of its part in every round
TREE_ROWS = 250_000
ENSEMBLE_WEIGHTS = {"lstm": 0.3, "cnn_lstm": 0.5, "gnn": 0.2}  # fixed values


def feature_table(
    df: DataFrame,
    by: str = "sensor_id",
    ts: str = "timestamp",
    tiebreak: str = "event_id",
    target: str = "speed",
    lags: Sequence[int] = (),
    exclude_current: bool = True,
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """ML-1, first half: calendar, spatial, traffic and lag features of every reading.

    With ``exclude_current`` the rolling columns end one row before the reading.
    """
    df = spatial_features(temporal_features(df, ts))
    df = traffic_features(df, by, ts, tiebreak, exclude_current, rows_per_task)
    if lags:
        df = lag_features(df, [target], lags, by, ts, tiebreak, rows_per_task)
    return df


def training_set(
    df: DataFrame,
    target: str = "speed",
    by: str = "sensor_id",
    ts: str = "timestamp",
    tiebreak: str = "event_id",
    method: str = "min_max",
    lags: Sequence[int] = (),
    leaky: Sequence[str] = ("speed_ratio", "density", "is_congested"),
    exclude_current: bool = True,
    rows_per_task: int | None = ROWS_PER_TASK,
    holdout: float = 0.0,
) -> tuple[DataFrame, list[str], DataFrame]:
    """ML-1: (rows with filled and scaled features and the target, feature names, statistics).

    ``leaky`` columns are computed from the target of the same row and are left out. With a ``holdout`` the rows are split
    in time first (column ``split``) and the statistics come from the training part only.
    """
    # both the statistics and the scaling read the features: compute the windows once
    table = pin(feature_table(df, by, ts, tiebreak, target, lags, exclude_current, rows_per_task))
    names = feature_columns(table, target, exclude=[tiebreak, *leaky])
    if holdout:
        table = chronological_split(table, holdout, ts, tiebreak)
    stats = fit_normalizer(table.filter("split = 'train'") if holdout else table, names, method)
    scaled = apply_normalizer(table, stats)
    return fill_missing(scaled, [*names, target]), names, stats


# columns of the models; a table's own columns keep their names
_COLUMNS = {"featuresCol": "_features", "labelCol": "_label", "predictionCol": "_prediction"}


def assemble(df: DataFrame, features: Sequence[str], target: str = "speed") -> DataFrame:
    ready = df.withColumn("_label", F.col(target).cast("double"))
    return VectorAssembler(inputCols=list(features), outputCol="_features").transform(ready)


def dealt(df: DataFrame, rows_per_task: int) -> DataFrame:
    """``df`` with its rows dealt evenly to more tasks if its parts hold more rows than one task should."""
    rows = df.count()
    return df if rows <= rows_per_task * df.rdd.getNumPartitions() else df.repartition(-(-rows // rows_per_task))


def train(
    df: DataFrame, features: Sequence[str], target: str = "speed", kind: str = "linear", regularization: float = 1e-4
) -> Model:
    """ML-2: fit on the rows of ``df`` (take the 'train' part of a chronological split)."""
    if kind == "linear":
        estimator = LinearRegression(**_COLUMNS, regParam=regularization, solver="auto")
    elif kind == "gbt":
        estimator = GBTRegressor(**_COLUMNS, maxIter=20, maxDepth=5, seed=42)
    else:
        raise ValueError(f"unknown kind {kind!r}")
    ready = assemble(df, features, target)
    return estimator.fit(dealt(ready.select("_features", "_label"), TREE_ROWS) if kind == "gbt" else ready)


def predict(
    model: Model, df: DataFrame, features: Sequence[str], name: str = "prediction"
) -> DataFrame:
    """ML-5: batch prediction as a column."""
    vectors = VectorAssembler(inputCols=list(features), outputCol="_features").transform(df)
    return model.transform(vectors).drop(name, "_features").withColumnRenamed("_prediction", name)


def score_with(
    df: DataFrame, features: Sequence[str], load: Callable[[], Callable], name: str = "prediction"
) -> DataFrame:
    """ML-5 for outside models: ``load()`` runs once per task and returns a function that maps a
    pandas frame of features to a sequence of numbers."""
    features = list(features)
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.DoubleType())])

    def score(batches: Iterator) -> Iterator:
        model = load()
        for batch in batches:
            yield batch.assign(**{name: model(batch[features])})

    return df.mapInPandas(score, schema)


def ensemble(df: DataFrame, weights: dict[str, float], name: str = "prediction") -> DataFrame:
    """ML-3: weighted average of prediction columns; missing predictions drop out of it."""
    total = F.lit(0.0)
    weight = F.lit(0.0)
    for column, w in weights.items():
        there = F.col(column).isNotNull()
        total = total + F.when(there, F.col(column) * w).otherwise(0.0)
        weight = weight + F.when(there, F.lit(float(w))).otherwise(0.0)
    return df.withColumn(name, F.try_divide(total, weight))


def equal_weights(columns: Sequence[str]) -> dict[str, float]:
    return {c: 1.0 / len(columns) for c in columns}


def majority_vote(df: DataFrame, columns: Sequence[str], name: str = "vote") -> DataFrame:
    """ML-8: the most frequent label of several columns; the first column wins ties."""
    votes = F.array(*[F.col(c) for c in columns])

    def tally(label, position):
        count = F.size(F.filter(votes, lambda other: other == label))
        return F.struct(count.alias("n"), (-position).alias("p"), label.alias("label"))

    return df.withColumn(name, F.array_max(F.transform(votes, tally))["label"])


def accuracy(df: DataFrame, truth: str, guess: str) -> DataFrame:
    """ML-8: share of equal labels."""
    same = F.when(F.col(truth).isNotNull() & F.col(guess).isNotNull(), (F.col(truth) == F.col(guess)).cast("double"))
    return df.agg(F.avg(same).alias("accuracy"))


def evaluate(df: DataFrame, target: str = "speed", prediction: str = "prediction", by: Sequence[str] | str = ()) -> DataFrame:
    """ML-4."""
    return error_metrics(df, target, prediction, by)


def horizon_targets(
    df: DataFrame,
    horizons: Sequence[int] = HORIZONS,
    by: str = "sensor_id",
    ts: str = "timestamp",
    value: str = "speed",
    grid: str = "5 minutes",
) -> DataFrame:
    """ML-6: targets ``<value>_in_<h>`` = mean of the bucket ``h`` minutes after the row's bucket.

    One row per key and occupied bucket. Buckets meet their later selves in a single aggregation:
    each contributes its value to its own bucket and, shifted back, to those it is the target of.
    """
    step = df.sparkSession.range(1).select(F.unix_micros(F.timestamp_micros(F.lit(0)) + F.expr(f"interval {grid}"))).first()[0]
    off = [h for h in horizons if h * 60_000_000 % step]
    if off:
        raise ValueError(f"horizons {off} are no multiples of the grid of {grid}")
    means = df.groupBy(by, F.window(ts, grid)["start"].alias(ts)).agg(F.avg(value).alias(value))
    shifts = F.array(*[F.lit(h) for h in (0, *horizons)])
    spread = means.select(by, value, ts, F.explode(shifts).alias("_h")).withColumn(
        ts, F.timestamp_micros(F.unix_micros(ts) - F.col("_h").cast("long") * 60_000_000)
    )
    columns = [F.max(F.when(F.col("_h") == 0, F.col(value))).alias(value)]
    columns += [F.max(F.when(F.col("_h") == h, F.col(value))).alias(f"{value}_in_{h}") for h in horizons]
    present = F.max(F.col("_h") == 0).alias("_present")
    return spread.groupBy(by, ts).agg(*columns, present).filter("_present").drop("_present")


def train_horizons(
    df: DataFrame, features: Sequence[str], horizons: Sequence[int] = HORIZONS, value: str = "speed", kind: str = "linear",
    regularization: float = 1e-4,
) -> dict[int, Model]:
    """ML-6: one model per horizon, each on the rows that have its target."""
    return {
        h: train(df.dropna(subset=[f"{value}_in_{h}"]), features, f"{value}_in_{h}", kind, regularization) for h in horizons
    }


def predict_horizons(
    models: dict[int, Model], df: DataFrame, features: Sequence[str], value: str = "speed"
) -> DataFrame:
    """ML-6: a prediction column per horizon."""
    for h, model in models.items():
        df = predict(model, df, features, f"predicted_in_{h}")
    return df


def save_model(model: Model, path: str) -> None:
    """ML-7."""
    PipelineModel([model]).write().overwrite().save(path)


def load_model(path: str) -> Model:
    return PipelineModel.load(path)


def time_folds(
    df: DataFrame, folds: int = 5, ts: str = "timestamp", tiebreak: str = "event_id", name: str = "fold"
) -> DataFrame:
    """ML-8: consecutive, equally large folds in time; their borders are found by rank."""
    total = df.filter(F.col(ts).isNotNull()).count()
    ranks = sorted({i * total // folds for i in range(1, folds)} - {0})
    borders = rows_at(df, ranks, ts, tiebreak) if ranks else {}
    fold = F.lit(0)
    for i in range(1, folds):
        if i * total // folds in borders:
            moment, tie = borders[i * total // folds]
            later = at_or_after([("_micros", moment), (tiebreak, tie)])
            fold = fold + F.coalesce(later.cast("int"), F.lit(0))
    return df.withColumn("_micros", F.unix_micros(ts)).withColumn(name, fold).drop("_micros")


def cross_validate(
    df: DataFrame, features: Sequence[str], target: str = "speed", folds: int = 5, fold: str = "fold",
    regularizations: Sequence[float] = (1e-4, 1e-2),
) -> CrossValidatorModel:
    """ML-8: k-fold cross validation of the linear forecaster over given folds."""
    estimator = LinearRegression(**_COLUMNS)
    grid = ParamGridBuilder().addGrid(estimator.regParam, list(regularizations)).build()
    evaluator = RegressionEvaluator(labelCol="_label", predictionCol="_prediction", metricName="rmse")
    validator = CrossValidator(
        estimator=estimator, estimatorParamMaps=grid, evaluator=evaluator, numFolds=folds, foldCol=fold
    )
    return validator.fit(assemble(df, features, target))
