"""Training the three classifiers, and their predictions."""

from __future__ import annotations

import logging
import pickle
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardstat.operators import trees as grown
from wardstat.operators.scaling import apply_scaler, fit_scaler
from wardstat.operators.small import settle
from wardstat.operators.split import class_balance, weighted
from wardstat.sources.schemas import MODEL_INPUTS, TARGET
from wardstat.sources.tables import path_exists, read_table, write_table

# Fixed short and full names of the models, in training order.
MODEL_NAMES = {"lr": "Logistic Regression", "rf": "Random Forest", "gbt": "Gradient-Boosted Trees"}

_SCALED = "_scaled"

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class TrainingSettings:
    """Hyperparameters; the defaults are the fixed published ones."""

    lr_c: float = 0.1
    lr_iterations: int = 1000
    rf_trees: int = 300
    rf_depth: int = 8
    rf_min_leaf: int = 20
    # Inputs that a node of the forest looks at; the root of their number if None.
    rf_inputs: int | None = None
    rf_bootstrap: bool = True
    gbt_rounds: int = 400
    gbt_depth: int = 5
    gbt_step: float = 0.05
    gbt_rows: float = 0.8
    gbt_columns: float = 0.8
    gbt_penalty: float = 1.0
    gbt_min_child: float = 1.0
    seed: int = 42
    # A bin per value for whole numbers below 256; train_models reports inputs with more values.
    max_bins: int = 256


@dataclass(frozen=True)
class TrainedModel:
    """A fitted model over the model inputs: coefficients with the scaler they belong to, or trees."""

    short: str
    scaler: DataFrame | None = None
    coefficients: tuple[float, ...] = ()
    intercept: float = 0.0
    trees: grown.Trees | None = None

    @property
    def name(self) -> str:
        return MODEL_NAMES[self.short]


#: Training rows of one partition.
ROWS_PER_PARTITION = 50_000


def _training_frame(train: DataFrame, target: str, key: str) -> DataFrame:
    """Inputs, label, weights and a hash of the key, spread evenly by key.

    Training passes over the frame hundreds of times, in step with its biggest partition; one shuffle
    of these narrow rows buys even partitions whatever the files look like. Classes are counted before it, and the
    count says how many partitions there are: one per core at least.
    """
    spark = train.sparkSession
    rows = class_balance(train, target).collect()
    balance = spark.createDataFrame(rows, train.select(target, F.lit(0).cast("long").alias("n")).schema)
    parts = max(spark.sparkContext.defaultParallelism, -(-sum(row["n"] for row in rows) // ROWS_PER_PARTITION))
    both = {"weight": "balanced", "positive_weight": "positive"}
    frame = weighted(train.select(key, *MODEL_INPUTS, target).repartition(parts, key), balance, target, both)
    return frame.select(
        *MODEL_INPUTS, F.col(target).cast("double").alias("label"), "weight", "positive_weight", F.xxhash64(key).alias("_key")
    )


def coarse_inputs(frame: DataFrame, max_bins: int) -> dict[str, int]:
    """Inputs with more distinct values than bins, and about how many they have: trees see these in bins."""
    counts = frame.agg(*[F.hll_sketch_estimate(F.hll_sketch_agg(F.col(name).cast("string"), F.lit(12))).alias(name) for name in MODEL_INPUTS]).first()
    return {name: counts[name] for name in MODEL_INPUTS if counts[name] > max_bins}


def _linear(names: Sequence[str], coefficients: Sequence[float], intercept: float):
    return sum((F.col(name) * F.lit(float(b)) for name, b in zip(names, coefficients)), F.lit(float(intercept)))


#: Rows that a pass of the regression works on at once.
LOSS_ROWS = 1 << 15


def loss_blocks(frame: DataFrame, names: Sequence[str], weight: str) -> DataFrame:
    """The rows as blocks of packed columns (names, weight, label): rows leave the JVM once, however many passes follow."""

    def packed(x: np.ndarray) -> np.ndarray:
        """The same numbers in the smallest kind of whole numbers that holds them, or as they are."""
        for kind in (np.int8, np.int16, np.int32):
            if np.iinfo(kind).min <= x.min() and x.max() <= np.iinfo(kind).max:
                whole = x.astype(kind)
                return whole if np.array_equal(whole, x) else x
        return x

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def block() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).combine_chunks()
            columns = [packed(column.cast(pa.float64()).to_numpy()) for column in rows.columns]
            return pa.RecordBatch.from_arrays([pa.array([pickle.dumps(columns)], pa.binary())], ["block"])

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(b.num_rows for b in held) + batch.num_rows > LOSS_ROWS:
                yield block()
                held = []
        if held:
            yield block()

    # A pass is short, so it has no more tasks than run at once; the bytes of a task don't matter, it works block by block.
    rows = frame.select(*names, weight, "label").coalesce(frame.sparkSession.sparkContext.defaultParallelism)
    return rows.mapInArrow(run, "block binary")


def newton(
    frame: DataFrame, names: Sequence[str], weight: str, c: float, most: int = 1000, flat: float = 1e-10, scaler: DataFrame | None = None
) -> tuple[list[float], float, int]:
    """Coefficients, intercept and passes of the logistic regression that minimises the summed weighted log loss plus
    half the squared coefficients over ``c``; of the scaled columns if a ``scaler`` is given.

    A pass over the rows sums the loss, its gradient and its second derivatives, which fit into one row, and solves for
    the next point. It ends where the gradient is ``flat`` relative to the sum of weights; a step that makes the
    objective worse is halved.
    """
    k = len(names)
    point, step, best = np.zeros(k + 1), np.zeros(k + 1), np.inf
    ridge = np.append(np.full(k, 1.0 / c), 0.0)
    scale = np.array([np.zeros(k), np.ones(k)])
    if scaler is not None:
        fitted = {row["feature"]: (row["mean"], row["scale"]) for row in scaler.collect()}
        scale = np.array([fitted[name] for name in names]).T
    blocks = loss_blocks(frame, names, weight).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for passes in range(1, most + 1):
            loss, total, gradient, second = loss_sums(blocks, k, point, scale)
            objective = loss + 0.5 * float(ridge @ point**2)
            if objective > best * (1 + 1e-12):
                step = step / 2
                point = point + step
                continue
            best = objective
            gradient = gradient + ridge * point
            if np.abs(gradient).max() <= flat * total:
                break
            step = np.linalg.lstsq(second + np.diag(ridge), gradient, rcond=None)[0]
            point = point - step
    finally:
        blocks.unpersist()
    return point[:k].tolist(), float(point[k]), passes


def loss_sums(blocks: DataFrame, n: int, point: np.ndarray, scale: np.ndarray) -> tuple[float, float, np.ndarray, np.ndarray]:
    """The weighted log loss of ``n`` columns, less the means and over the deviations of ``scale``, at a point (coefficients,
    then the intercept), the sum of weights, and the loss's first and second derivatives. Each partition makes one row of
    sums; Spark adds them up."""
    k = n + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(2 + k + k * k)
        for batch in batches:
            for held in batch.column("block"):
                *columns, w, y = (x.astype(np.float64) for x in pickle.loads(held.as_py()))
                x = np.stack([*((c - mean) / by for c, mean, by in zip(columns, *scale)), np.ones(len(w))], axis=1)
                z = x @ point
                p = 1.0 / (1.0 + np.exp(-z))
                loss = w * (np.maximum(z, 0.0) + np.log1p(np.exp(-np.abs(z))) - y * z)
                second = x.T @ (x * (w * p * (1.0 - p))[:, None])
                sums += np.concatenate([[loss.sum(), w.sum()], x.T @ (w * (p - y)), second.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sums))), pa.array(sums)], ["place", "value"])

    rows = blocks.mapInArrow(run, "place long, value double")
    found = {r["place"]: r["value"] for r in rows.groupBy("place").agg(F.sum("value").alias("value")).collect()}
    sums = np.array([found[i] for i in range(2 + k + k * k)])
    return float(sums[0]), float(sums[1]), sums[2 : 2 + k], sums[2 + k :].reshape(k, k)


def train_lr(frame: DataFrame, settings: TrainingSettings = TrainingSettings()) -> TrainedModel:
    """Logistic regression on scaled inputs with balanced class weights."""
    params = fit_scaler(frame)
    scaler = frame.sparkSession.createDataFrame(params.collect(), params.schema)
    coefficients, intercept, passes = newton(frame, MODEL_INPUTS, "weight", settings.lr_c, settings.lr_iterations, scaler=scaler)
    log.info("logistic regression took %s passes", passes)
    return TrainedModel("lr", scaler, tuple(coefficients), intercept)


def _cuts(frame: DataFrame, settings: TrainingSettings) -> list[np.ndarray]:
    coarse = coarse_inputs(frame, settings.max_bins)
    if coarse:
        log.warning("inputs with more values than %s bins: %s", settings.max_bins, coarse)
    return grown.bin_cuts(frame, MODEL_INPUTS, coarse, settings.max_bins)


def train_rf(frame: DataFrame, settings: TrainingSettings = TrainingSettings()) -> TrainedModel:
    """Random forest with balanced class weights."""
    s = grown.ForestSettings(
        settings.rf_trees, settings.rf_depth, settings.rf_min_leaf, settings.rf_inputs, settings.rf_bootstrap, settings.seed
    )
    return TrainedModel("rf", trees=grown.forest(frame, MODEL_INPUTS, "weight", _cuts(frame, settings), s))


def train_gbt(frame: DataFrame, settings: TrainingSettings = TrainingSettings()) -> TrainedModel:
    """Boosted trees; positives weigh as much as all negatives."""
    s = grown.BoostSettings(
        settings.gbt_rounds, settings.gbt_depth, settings.gbt_step, settings.gbt_rows, settings.gbt_columns,
        settings.gbt_penalty, settings.gbt_min_child, settings.seed,
    )
    return TrainedModel("gbt", trees=grown.boost(frame, MODEL_INPUTS, "positive_weight", _cuts(frame, settings), s))


TRAINERS = {"lr": train_lr, "rf": train_rf, "gbt": train_gbt}


def train_models(
    train: DataFrame,
    shorts: Iterable[str] = tuple(MODEL_NAMES),
    settings: TrainingSettings = TrainingSettings(),
    target: str = TARGET,
    key: str = "encounter_id",
) -> list[TrainedModel]:
    """Fit the named models on one cached frame, which is released afterwards."""
    frame = _training_frame(train, target, key).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return [TRAINERS[short](frame, settings) for short in shorts]
    finally:
        frame.unpersist()


def with_probability(df: DataFrame, model: TrainedModel) -> DataFrame:
    """Rows with ``<short>_proba``, the probability of class 1, and ``<short>_label``, 1 above one half."""
    name = f"{model.short}_proba"
    if model.trees is not None:
        scored = grown.with_tree_probability(df, model.trees, MODEL_INPUTS, name, model.short == "gbt")
    else:
        ready = apply_scaler(df, model.scaler, _SCALED)
        z = _linear([c + _SCALED for c in MODEL_INPUTS], model.coefficients, model.intercept)
        scored = ready.select(*[f"`{c}`" for c in df.columns], (1.0 / (1.0 + F.exp(-z))).alias(name))
    return scored.withColumn(f"{model.short}_label", (F.col(name) > 0.5).cast("int"))


def predict(models: Sequence[TrainedModel], df: DataFrame, key: str = "encounter_id", target: str = TARGET) -> DataFrame:
    """Predictions of all models as one long frame, from one pass over ``df``."""
    scored = df.select(key, *MODEL_INPUTS, target)
    for model in models:
        scored = with_probability(scored, model)
    rows = F.array(
        *[
            F.struct(
                F.lit(model.name).alias("model_name"),
                F.col(f"{model.short}_proba").alias("predicted_proba"),
                F.col(f"{model.short}_label").alias("predicted_label"),
            )
            for model in models
        ]
    )
    return scored.select(key, F.inline(rows), F.col(target).cast("int").alias("actual_label"))


def split_ledger(spark: SparkSession, model: TrainedModel) -> DataFrame:
    """Every node of a tree model: its split with what it gains, its rows, their weight, and its value."""
    return grown.ledger(spark, model.trees, MODEL_INPUTS)


def feature_importance(spark: SparkSession, model: TrainedModel, k: int = 15) -> DataFrame:
    """The ``k`` most important inputs of a tree model, from its ledger; importances of all inputs sum to 1.

    For the forest the share of an input in the gains of each tree, averaged over the trees; for boosted trees its average
    gain per split, as a share of all inputs' averages.
    """
    splits = split_ledger(spark, model).where("feature is not null")
    if model.short == "rf":
        own = splits.groupBy("tree", "feature").agg(F.sum("gain").alias("gain"))
        totals = splits.groupBy("tree").agg(F.sum("gain").alias("total"))
        raw = own.join(totals, "tree").groupBy("feature").agg(F.sum(F.col("gain") / F.col("total")).alias("raw"))
    else:
        raw = splits.groupBy("feature").agg(F.avg("gain").alias("raw"))
    inputs = spark.createDataFrame([(name,) for name in MODEL_INPUTS], "feature string")
    # One row per input: the window sees no more.
    shares = raw.select("feature", (F.col("raw") / F.sum("raw").over(Window.partitionBy(F.lit(0)))).alias("importance"))
    rows = inputs.join(settle(shares), "feature", "left").withColumn("importance", F.coalesce("importance", F.lit(0.0)))
    return rows.select(F.lit(model.name).alias("model_name"), "feature", "importance").orderBy(F.desc("importance"), "feature").limit(k)


_COEFFICIENTS = "feature string, coefficient double"


def save_model(model: TrainedModel, folder: str) -> None:
    """Replace the stored model of this short name: the ledger of its trees, or its coefficients and scaler."""
    if model.trees is not None:
        spark = SparkSession.active()
        write_table(split_ledger(spark, model).coalesce(1), f"{folder}/{model.short}")
        return
    rows = [*zip(MODEL_INPUTS, model.coefficients), (None, model.intercept)]
    write_table(model.scaler.coalesce(1), f"{folder}/{model.short}_scaler")
    write_table(model.scaler.sparkSession.createDataFrame(rows, _COEFFICIENTS).coalesce(1), f"{folder}/{model.short}")


def load_model(spark: SparkSession, folder: str, short: str = "gbt") -> TrainedModel:
    """The stored model; says which path is missing if it was not trained yet."""
    if short not in MODEL_NAMES:
        raise ValueError(f"unknown model {short!r}, expected one of {list(MODEL_NAMES)}")
    path = f"{folder}/{short}"
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no model at {path}: train the models first")
    if short != "lr":
        return TrainedModel(short, trees=grown.from_ledger(read_table(spark, path), MODEL_INPUTS))
    found = {r["feature"]: r["coefficient"] for r in read_table(spark, path).collect()}
    return TrainedModel(short, read_table(spark, f"{path}_scaler"), tuple(found[name] for name in MODEL_INPUTS), found[None])
