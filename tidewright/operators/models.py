"""Forecasters on pyspark.ml, and ensembles of them. Every forecaster fits and predicts Spark frames."""

from __future__ import annotations

import json
import pickle
import statistics
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.common import _py2java
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GBTRegressor, GeneralizedLinearRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

MISSING = -1.0
#: Parts of a Newton step that are tried, and the gain, as a share of the loss, below which the fit ends.
_PARTS, _GAIN = 0.5 ** np.arange(12), 1e-9
#: Bounds of the log link's predictor.
_FAR = 500.0


@dataclass
class ModelConfig:
    """objective: squared (boosted trees; pass row weights for the scaled-error surrogate) or tweedie
    (generalised linear, log link, on standardised features)."""

    objective: str = "squared"
    variance_power: float = 1.5
    trees: int = 30
    depth: int = 5
    learning_rate: float = 0.1
    row_share: float = 0.7
    feature_share: float = 0.8
    tolerance: float = 0.01
    max_bins: int = 64
    regularisation: float = 0.1
    seed: int = 42


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(at, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def _read_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()[0]


def _tweedie_parts(x: np.ndarray, y: np.ndarray, w: np.ndarray, power: float, at: np.ndarray, step: np.ndarray | None):
    """The loss at `at` plus each part of a step, or, without one, the loss, its gradient and its curvature."""

    def loss(eta: np.ndarray) -> float:
        a = -y * eta if power == 1 else y * np.exp((1 - power) * eta) / (power - 1)
        b = eta if power == 2 else np.exp((2 - power) * eta) / (2 - power)
        return float((w * (a + b)).sum())

    eta = x @ at
    with np.errstate(over="ignore"):
        if step is not None:
            by = x @ step
            # a predictor out of bounds is no step to take
            return np.array([loss(e) if np.abs(e).max(initial=0.0) < _FAR else np.inf for e in (eta + t * by for t in _PARTS)])
        a, b = y * np.exp((1 - power) * eta), np.exp((2 - power) * eta)
        bend = w * ((power - 1) * a + (2 - power) * b)
        return loss(eta), x.T @ (w * (b - a)), (x * bend[:, None]).T @ x


def tweedie_glm(df: DataFrame, power: float, regularisation: float, most_steps: int = 50) -> GeneralizedLinearRegressionModel:
    """The Tweedie model with a log link of df (x: array of standardised features, y, w: weight), by damped
    Newton steps over all rows. For powers from 1 to 2 the loss is convex, so a step that lowers it leads on to
    the optimum; pyspark.ml's fit takes whole reweighted steps, which run off on skewed features and mostly
    zero targets. The penalty is regularisation / 2 times the squared coefficients, on the mean row of a model
    that has the intercept alone. Two passes a step; only sums reach the driver, one set for each partition."""
    if not 1 <= power <= 2:
        raise ValueError(f"variance_power is {power}, the fit takes 1 to 2")
    rows = df.persist(StorageLevel.DISK_ONLY)

    def summed(at: np.ndarray | None, step: np.ndarray | None = None) -> list:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                if not batch.num_rows:
                    continue
                y, w = (batch.column(k).to_numpy(zero_copy_only=False) for k in (1, 2))
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(len(y), -1)
                x = np.hstack([x, np.ones((len(y), 1))])
                if at is None:
                    found = [(w * y).sum(), w.sum(), float(min(y.min(), w.min()) < 0)]
                else:
                    found = [_tweedie_parts(x, y, w, power, at, step)] if step is not None else [*_tweedie_parts(x, y, w, power, at, None)]
                total = found if total is None else [a + b for a, b in zip(total, found)]
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(total)], pa.binary())], ["data"])

        found = [pickle.loads(r.data) for r in rows.mapInArrow(run, "data binary").collect()]
        if not found:
            raise ValueError("no rows to fit the Tweedie model on")
        return [sum(f[k] for f in found) for k in range(len(found[0]))]

    try:
        y, w, negative = summed(None)
        if negative or not w > 0:
            raise ValueError("the Tweedie model takes targets and weights from 0 up, not all of weight 0")
        at = np.zeros(len(rows.first().x) + 1)
        # without any sales the best intercept is minus infinity
        at[-1] = np.log(max(y / w, 1e-6))
        penalty = np.full(len(at), regularisation * w * np.exp((2 - power) * at[-1]))
        penalty[-1] = 0.0
        for _ in range(most_steps if y > 0 else 0):
            value, slope, bend = summed(at)
            value, slope, bend = value + (penalty * at**2).sum() / 2, slope + penalty * at, bend + np.diag(penalty)
            # features that are constant or follow from others have no bend of their own
            step = -np.linalg.lstsq(bend, slope, rcond=1e-12)[0]
            tried = summed(at, step)[0] + np.array([(penalty * (at + t * step) ** 2).sum() / 2 for t in _PARTS])
            best = int(np.argmin(tried))
            if not tried[best] < value:
                break
            at = at + _PARTS[best] * step
            if value - tried[best] <= _GAIN * max(1e-12, abs(value)):
                break
    finally:
        rows.unpersist()
    jvm = df.sparkSession._jvm
    made = jvm.org.apache.spark.ml.regression.GeneralizedLinearRegressionModel(f"tweedie_{len(at) - 1}", _py2java(df.sparkSession.sparkContext, Vectors.dense(at[:-1])), float(at[-1]))
    for name, value in {"family": "tweedie", "variancePower": power, "linkPower": 0.0, "featuresCol": "_scaled", "labelCol": "_y", "predictionCol": "prediction", "regParam": regularisation}.items():
        made.set(made.getParam(name), value)
    return GeneralizedLinearRegressionModel(made)


class Forecaster:
    """Strings are indexed, nulls get a sentinel and a flag of their own (trees here reject NaN), and all is
    assembled into one vector. Predictions are never negative."""

    def __init__(self, config: ModelConfig | None = None):
        self.config = config or ModelConfig()
        self.features: list[str] = []
        self.strings: list[str] = []
        self.nullable: list[str] = []
        self.model: PipelineModel | None = None

    def clone(self) -> Forecaster:
        return Forecaster(ModelConfig(**asdict(self.config)))

    def params(self) -> dict:
        return asdict(self.config)

    def _ready(self, df: DataFrame) -> DataFrame:
        missing = [c for c in self.features if c not in df.columns]
        df = df.withColumns({c: F.lit(None).cast("string" if c in self.strings else "double") for c in missing})
        numeric = [c for c in self.features if c not in self.strings]
        columns = {f"_x_{c}": F.coalesce(F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")), F.lit(MISSING)) for c in numeric}
        columns |= {f"_n_{c}": F.col(c).isNull().cast("double") for c in self.nullable if c in numeric}
        return df.withColumns(columns | {f"_s_{c}": F.coalesce(F.col(c), F.lit("")) for c in self.strings})

    def fit(self, df: DataFrame, features: Sequence[str], target: str = "sales", weight: str | None = None, validation: str | None = None) -> Forecaster:
        """validation: a boolean column; its rows stop the boosting early and are not learned from. The rows
        are put in a fixed order of partitions first, so that a seed gives the same model again."""
        kinds = dict(df.dtypes)
        self.features, self.strings = list(features), [c for c in features if kinds[c] == "string"]
        numeric = [c for c in features if c not in self.strings]
        counts = df.agg(*(F.count_if(F.col(c).isNull()).alias(f"n{k}") for k, c in enumerate(numeric))).first() if numeric else ()
        self.nullable = [c for k, c in enumerate(numeric) if counts[k]]
        indexers = [StringIndexer(inputCol=f"_s_{c}", outputCol=f"_i_{c}", handleInvalid="keep", stringOrderType="alphabetAsc") for c in self.strings]
        inputs = [f"_x_{c}" for c in numeric] + [f"_n_{c}" for c in self.nullable] + [f"_i_{c}" for c in self.strings]
        ready = self._ready(df).withColumn("_y", F.col(target).cast("double"))
        order = F.xxhash64(*(c for c in ready.columns if c[:3] in ("_x_", "_n_", "_s_")), "_y")
        ready = ready.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), order).sortWithinPartitions(order)
        indexed = [i.fit(ready) for i in indexers]
        widest = max((len(i.labels) + 1 for i in indexed), default=2)
        assembler = VectorAssembler(inputCols=inputs, outputCol="_features")
        c = self.config
        scaling = []
        if c.objective == "tweedie":
            # the log link's predictor stays within bounds only where features are of like size
            scaling = [StandardScaler(inputCol="_features", outputCol="_scaled", withMean=True, withStd=True)]
            ready = ready.where(f"not {validation}") if validation else ready
        else:
            last = GBTRegressor(featuresCol="_features", labelCol="_y", predictionCol="prediction", maxIter=c.trees, maxDepth=c.depth, stepSize=c.learning_rate, subsamplingRate=c.row_share, featureSubsetStrategy=str(c.feature_share), maxBins=max(c.max_bins, widest), validationTol=c.tolerance, seed=c.seed)
            last = last.setWeightCol(weight) if weight else last
            last = last.setValidationIndicatorCol(validation) if validation else last
        for stage in (*indexed, assembler):
            ready = stage.transform(ready)
        scaled = [x.fit(ready) for x in scaling]
        for stage in scaled:
            ready = stage.transform(ready)
        if scaled:
            last = tweedie_glm(ready.select(vector_to_array("_scaled").alias("x"), F.col("_y").alias("y"), F.col(weight).cast("double").alias("w") if weight else F.lit(1.0).alias("w")), c.variance_power, c.regularisation)
        else:
            last = last.fit(ready.select("_features", "_y", *([weight] if weight else []), *([validation] if validation else [])))
        self.model = PipelineModel([*indexed, assembler, *scaled, last])
        return self

    def predict(self, df: DataFrame) -> DataFrame:
        if self.model is None:
            raise RuntimeError("fit the model first")
        made = self.model.transform(self._ready(df)).withColumn("prediction", F.greatest(F.lit(0.0), F.col("prediction")))
        return made.select(*df.columns, "prediction")

    def importance(self, spark: SparkSession) -> DataFrame:
        """feature, importance, importance_normalized, cumulative_importance, most important first."""
        model, assembler = self.model.stages[-1], next(x for x in self.model.stages if isinstance(x, VectorAssembler))
        values = model.featureImportances.toArray() if hasattr(model, "featureImportances") else np.abs(model.coefficients.toArray())
        total: dict[str, float] = {}
        for c, v in zip(assembler.getInputCols(), values):
            total[c[3:]] = total.get(c[3:], 0.0) + float(v)
        return normalised(spark.createDataFrame([*total.items()], "feature string, importance double"))

    def save(self, path: str, spark: SparkSession) -> None:
        self.model.write().overwrite().save(f"{path}/model")
        _write_text(spark, f"{path}/metadata.json", json.dumps({"config": self.params(), "features": self.features, "strings": self.strings, "nullable": self.nullable}))

    @classmethod
    def load(cls, path: str, spark: SparkSession) -> Forecaster:
        record = json.loads(_read_text(spark, f"{path}/metadata.json"))
        out = cls(ModelConfig(**record["config"]))
        out.features, out.strings, out.nullable = record["features"], record["strings"], record["nullable"]
        out.model = PipelineModel.load(f"{path}/model")
        return out


def normalised(importance: DataFrame) -> DataFrame:
    """Shares of all importance and their running sum, most important first. A row for each feature, so the
    window's single partition is as long as the feature list."""
    whole, running = Window.partitionBy(), Window.orderBy(F.desc("importance"), "feature").rowsBetween(Window.unboundedPreceding, 0)
    share = F.coalesce(F.try_divide(F.col("importance"), F.sum("importance").over(whole)), F.lit(0.0))
    return importance.withColumn("importance_normalized", share).withColumn("cumulative_importance", F.sum("importance_normalized").over(running)).orderBy(F.desc("importance"), "feature")


def interval(prediction: str = "prediction", confidence: float = 0.9, relative: float = 0.2) -> dict[str, Column]:
    """A heuristic interval: the prediction plus and minus z times a share of itself, from 0 up."""
    z = statistics.NormalDist().inv_cdf((1 + confidence) / 2)
    spread = F.col(prediction) * (z * relative)
    return {"lower_bound": F.greatest(F.lit(0.0), F.col(prediction) - spread), "upper_bound": F.col(prediction) + spread}


# --- ensembles -------------------------------------------------------------------------------------------


def combined(members: dict[str, Column], weights: dict[str, float], method: str = "weighted") -> dict[str, Column]:
    """prediction and prediction_std (population) of member predictions; any method but median is the
    weighted mean."""
    n = len(members)
    total = sum(weights.get(k, 1.0) for k in members)
    mean = sum((c for c in members.values()), F.lit(0.0)) / n
    std = F.sqrt(sum((F.pow(c - mean, 2) for c in members.values()), F.lit(0.0)) / n)
    if method == "median":
        ordered = F.sort_array(F.array(*members.values()))
        value = (F.element_at(ordered, (n + 1) // 2) + F.element_at(ordered, n // 2 + 1)) / 2
    else:
        value = sum((c * (weights.get(k, 1.0) / total) for k, c in members.items()), F.lit(0.0))
    return {"prediction": F.greatest(F.lit(0.0), value), "prediction_std": std}


def contributions(members: dict[str, Column], weights: dict[str, float]) -> dict[str, Column]:
    return {f"{k}_contribution": c * weights.get(k, 1.0) for k, c in members.items()}


def _on_simplex(w: np.ndarray) -> np.ndarray:
    """The nearest point with non-negative parts that sum to 1."""
    u = np.sort(w)[::-1]
    c = (np.cumsum(u) - 1) / np.arange(1, len(w) + 1)
    return np.maximum(0, w - c[np.flatnonzero(u > c)[-1]])


def best_weights(df: DataFrame, members: Sequence[str], target: str = "sales", metric: str = "rmse", steps: int = 2000) -> dict[str, float] | None:
    """Weights on the simplex that minimise the error. rmse: one pass gathers the products' means (a matrix
    as small as the members), the rest is a quadratic program on the driver. mae: a subgradient pass for
    each step. None if nothing can be fitted."""
    k = len(members)
    if metric == "mae":
        w, best = np.full(k, 1 / k), (np.inf, np.full(k, 1 / k))
        df = df.select(target, *members).persist()
        for t in range(1, 31):
            e = sum((F.col(m) * float(x) for m, x in zip(members, w)), F.lit(0.0)) - F.col(target)
            row = df.agg(F.avg(F.abs(e)), *(F.avg(F.signum(e) * F.col(m)) for m in members)).first()
            if row[0] is None:
                return None
            if row[0] < best[0]:
                best = (row[0], w)
            g = np.array(row[1:], float)
            w = _on_simplex(w - g / (np.linalg.norm(g) + 1e-12) * 0.3 / t**0.5)
        df.unpersist()
        return dict(zip(members, map(float, best[1])))
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    row = df.agg(*(F.avg(F.col(members[i]) * F.col(members[j])) for i, j in pairs), *(F.avg(F.col(m) * F.col(target)) for m in members)).first()
    if any(x is None for x in row):
        return None
    gram = np.zeros((k, k))
    for (i, j), v in zip(pairs, row):
        gram[i, j] = gram[j, i] = v
    cross = np.array(row[len(pairs) :], float)
    w, step = np.full(k, 1 / k), 1 / max(1e-12, float(np.linalg.eigvalsh(gram)[-1]))
    for _ in range(steps):
        w = _on_simplex(w - step * (gram @ w - cross))
    return dict(zip(members, map(float, w)))


@dataclass
class Ensemble:
    """method: weighted or median."""

    method: str = "weighted"
    metric: str = "rmse"
    members: dict[str, Forecaster] = field(default_factory=dict)
    weights: dict[str, float] = field(default_factory=dict)

    def add(self, name: str, model: Forecaster, weight: float = 1.0) -> Ensemble:
        if model.model is None:
            raise ValueError(f"Model '{name}' is not fitted")
        self.members[name], self.weights[name] = model, weight
        self._even()
        return self

    def remove(self, name: str) -> Ensemble:
        self.members.pop(name)
        self.weights.pop(name)
        self._even()
        return self

    def _even(self) -> None:
        total = sum(self.weights.values())
        if total > 0:
            self.weights = {k: v / total for k, v in self.weights.items()}

    def _each(self, df: DataFrame) -> DataFrame:
        names = list(df.columns)
        for k, m in self.members.items():
            df = m.predict(df).withColumnRenamed("prediction", f"_p_{k}")
        return df.select(*names, *(f"_p_{k}" for k in self.members))

    def predict(self, df: DataFrame, with_members: bool = False) -> DataFrame:
        if not self.members:
            raise ValueError("the ensemble has no members")
        cols = {k: F.col(f"_p_{k}") for k in self.members}
        made = self._each(df).withColumns(combined(cols, self.weights, self.method))
        return made.select(*df.columns, "prediction", "prediction_std", *((c.alias(f"{k}_prediction") for k, c in cols.items()) if with_members else ()))

    def contributions(self, df: DataFrame) -> DataFrame:
        cols = {k: F.col(f"_p_{k}") for k in self.members}
        return self._each(df).withColumns(contributions(cols, self.weights)).select(*df.columns, *(f"{k}_contribution" for k in self.members))

    def optimise(self, valid: DataFrame, target: str = "sales") -> Ensemble:
        names = list(self.members)
        found = best_weights(self._each(valid).withColumnsRenamed({f"_p_{k}": f"p{i}" for i, k in enumerate(names)}), [f"p{i}" for i in range(len(names))], target, self.metric)
        if found:
            self.weights = {k: found[f"p{i}"] for i, k in enumerate(names)}
        return self

    def importance(self, spark: SparkSession, how: str = "mean") -> DataFrame:
        """Members' normalised importances by mean, max or weighted sum; any other word is the mean."""
        whole = None
        for k, m in self.members.items():
            one = m.importance(spark).select("feature", F.col("importance_normalized").alias("v"), F.lit(self.weights[k]).alias("w"))
            whole = one if whole is None else whole.unionByName(one)
        value = {"max": F.max("v"), "weighted": F.sum(F.col("v") * F.col("w"))}.get(how, F.avg("v"))
        return whole.groupBy("feature").agg(value.alias("importance")).orderBy(F.desc("importance"), "feature")

    def save(self, path: str, spark: SparkSession) -> None:
        for k, m in self.members.items():
            m.save(f"{path}/{k}", spark)
        _write_text(spark, f"{path}/ensemble_config.json", json.dumps({"method": self.method, "metric": self.metric, "weights": self.weights, "members": list(self.members)}))

    @classmethod
    def load(cls, path: str, spark: SparkSession) -> Ensemble:
        record = json.loads(_read_text(spark, f"{path}/ensemble_config.json"))
        return cls(record["method"], record["metric"], {k: Forecaster.load(f"{path}/{k}", spark) for k in record["members"]}, record["weights"])
