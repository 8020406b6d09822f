"""Baselines, folds and the rolling-origin backtest."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.operators import metrics
from tidewright.operators.prepare import Engineer, hide_after, reattach


def seasonal_naive(train: DataFrame, test: DataFrame, target: str = "sales") -> DataFrame:
    """test with prediction: the series' sales on the same weekday of the last week of train, else 0."""
    last = train.agg(F.max("date")).first()[0]
    week = train.where(F.col("date") > F.date_sub(F.lit(last), 7)).groupBy("id", F.weekday("date").alias("_dow")).agg(F.first(target).alias("_old"))
    joined = test.withColumn("_dow", F.weekday("date")).join(week, ["id", "_dow"], "left")
    return joined.withColumn("prediction", F.coalesce("_old", F.lit(0.0))).drop("_dow", "_old")


def moving_average(train: DataFrame, test: DataFrame, days: int = 28, target: str = "sales") -> DataFrame:
    """test with prediction: the series' mean over the last days of train, else 0."""
    last = train.agg(F.max("date")).first()[0]
    mean = train.where(F.col("date") > F.date_sub(F.lit(last), days)).groupBy("id").agg(F.avg(target).alias("_mean"))
    return test.join(mean, "id", "left").withColumn("prediction", F.coalesce("_mean", F.lit(0.0))).drop("_mean")


@dataclass(frozen=True)
class Fold:
    train_start: date
    train_end: date
    test_start: date
    test_end: date


@dataclass(frozen=True)
class Plan:
    n_folds: int = 3
    test_days: int = 28
    gap_days: int = 0
    expanding: bool = True
    min_train_days: int = 365
    validation_days: int = 28

    def folds(self, first: date, last: date) -> list[Fold]:
        """Folds that end k test lengths before the last day, oldest first; those with too little history
        are left out."""
        out = []
        for k in range(self.n_folds):
            test_end = last - timedelta(k * self.test_days)
            test_start = test_end - timedelta(self.test_days - 1)
            train_end = test_start - timedelta(self.gap_days + 1)
            start = first if self.expanding else train_end - timedelta(self.min_train_days - 1)
            if start >= first and (train_end - start).days >= self.validation_days:
                out.append(Fold(start, train_end, test_start, test_end))
        return out[::-1]


def horizon(test_start, day: str = "date"):
    return (F.datediff(F.col(day), F.lit(test_start)) + 1).cast("int")


@dataclass
class FoldScore:
    fold: int
    dates: Fold
    rmse: float
    mae: float
    smape: float
    mape: float | None
    n_samples: int
    wrmsse: float | None
    mean_actual: float | None = None
    std_actual: float | None = None
    mean_prediction: float | None = None
    std_prediction: float | None = None


@dataclass
class Backtest:
    """predictions stay persisted until release()."""

    scores: list[FoldScore] = field(default_factory=list)
    predictions: DataFrame | None = None
    held: list[DataFrame] = field(default_factory=list)

    def release(self) -> None:
        while self.held:
            self.held.pop().unpersist()

    @property
    def mean_wrmsse(self) -> float | None:
        known = [s.wrmsse for s in self.scores if s.wrmsse is not None]
        return sum(known) / len(known) if known else None

    def weighted_mean(self, name: str) -> float:
        """By the number of test rows of each fold."""
        return sum(getattr(s, name) * s.n_samples for s in self.scores) / sum(s.n_samples for s in self.scores)

    def aggregate(self) -> dict:
        """Errors weighted by test rows; mape, wrmsse and the means and deviations as plain means of folds."""
        mapes = [s.mape for s in self.scores if s.mape is not None]
        plain = {n: sum(getattr(s, n) for s in self.scores) / len(self.scores) for n in ("mean_actual", "std_actual", "mean_prediction", "std_prediction")}
        return {n: self.weighted_mean(n) for n in ("rmse", "mae", "smape")} | {"mape": sum(mapes) / len(mapes) if mapes else None, "wrmsse": self.mean_wrmsse} | plain

    def summary(self, spark) -> DataFrame:
        rows = [(s.fold, s.dates.train_start, s.dates.train_end, s.dates.test_start, s.dates.test_end, s.rmse, s.mae, s.smape, s.wrmsse, s.n_samples) for s in self.scores]
        return spark.createDataFrame(rows, "fold int, train_start date, train_end date, test_start date, test_end date, rmse double, mae double, smape double, wrmsse double, n_samples long")

    def by_horizon(self) -> DataFrame:
        return metrics.by_group(self.predictions, "horizon", y="sales")


def run(panel: DataFrame, forecast: Callable[..., DataFrame], plan: Plan = Plan(), callbacks: Sequence[Callable[[FoldScore], None]] = ()) -> Backtest:
    """forecast(history, future) gives id, date and prediction. history: the fold's training days; future: all
    days after them up to the last test day, those of the gap too, without the target. A forecast with the
    attribute reads_earlier also gets the rows before a sliding fold's training days. The loop over folds is on
    the driver; each fold is one plan, and only scores come back."""
    ends = panel.agg(F.min("date").alias("a"), F.max("date").alias("b")).first()
    folds = plan.folds(ends.a, ends.b) if ends.a else []
    if not folds:
        raise ValueError("not enough history for a fold")
    least = getattr(forecast, "min_lag", None)
    if least is not None and plan.gap_days + plan.test_days > least:
        warnings.warn(f"the gap and the test days together ({plan.gap_days + plan.test_days}) are longer than the least lag ({least}): the last test days have no lags", stacklevel=2)
    result = Backtest()
    for k, f in enumerate(folds, 1):
        d = F.col("date")
        history = panel.where(d.between(F.lit(f.train_start), F.lit(f.train_end)))
        future = panel.where((d > F.lit(f.train_end)) & (d <= F.lit(f.test_end))).drop("sales")
        actual = panel.where(d.between(F.lit(f.test_start), F.lit(f.test_end)))
        earlier = (panel.where(d < F.lit(f.train_start)),) if getattr(forecast, "reads_earlier", False) else ()
        made = forecast(history, future, *earlier).select("id", "date", F.greatest(F.lit(0.0), F.col("prediction")).alias("prediction"))
        made = reattach(actual, made, "prediction").withColumns({"fold": F.lit(k), "horizon": horizon(f.test_start)})
        made = made.persist()
        result.held.append(made)
        point = metrics.pooled(made, "sales").first()
        try:
            wrmsse = metrics.overall(metrics.hierarchical_wrmsse(history, made), len(metrics.usable_levels(made)))
        except ValueError:
            wrmsse = None
        result.scores.append(FoldScore(k, f, point.rmse, point.mae, point.smape, point.mape, point.n_samples, wrmsse, point.mean_actual, point.std_actual, point.mean_prediction, point.std_prediction))
        for frame in getattr(forecast, "held", ()):  # what the forecast persisted for this fold
            frame.unpersist()
        rows = made.select("id", "date", "sales", "prediction", "fold", "horizon")
        result.predictions = rows if result.predictions is None else result.predictions.unionByName(rows)
        for c in callbacks:
            c(result.scores[-1])
    return result


def model_forecast(model, horizon_days: int = 28, validation_days: int = 28) -> Callable[..., DataFrame]:
    """A forecast function that builds features over all rows up to the last test day, with the target hidden
    after the training days, fits a clone on all but the last of those, stops early on these, and predicts.
    Row weights of the scaled error are passed to the fit."""

    def forecast(history: DataFrame, future: DataFrame, earlier: DataFrame | None = None) -> DataFrame:
        ends = history.agg(F.min("date").alias("a"), F.max("date").alias("b")).first()
        rows = history if earlier is None else earlier.unionByName(history)
        whole = hide_after(rows.unionByName(future.withColumn("sales", F.lit(None).cast("double")), allowMissingColumns=True), ends.b)
        engineer = Engineer(horizon=horizon_days)
        made = engineer.fit_transform(whole).persist()
        forecast.held[:] = [made]
        start = ends.b - timedelta(validation_days - 1)
        train = made.where(F.col("date").between(F.lit(ends.a), F.lit(ends.b)) & F.col("sales").isNotNull()).withColumn("is_validation", F.col("date") >= F.lit(start))
        weight = None
        if model.config.objective == "squared":
            weights = metrics.row_weights(history).select("id", "date", F.col("row_weight"))
            train, weight = train.join(weights, ["id", "date"], "left").fillna(0.0, ["row_weight"]), "row_weight"
        own = model.clone().fit(train, engineer.names, weight=weight, validation="is_validation")
        return own.predict(made.where(F.col("date") > F.lit(ends.b))).select("id", "date", "prediction")

    forecast.held, forecast.min_lag, forecast.reads_earlier = [], horizon_days, True
    return forecast
