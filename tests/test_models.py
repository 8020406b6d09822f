import math
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewright.operators import models, scoring


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(800).withColumns({"x1": F.rand(1), "x2": F.when(F.col("id") % 9 != 0, F.rand(2)), "store": F.when(F.col("id") % 2 == 0, "a").otherwise("b")})
    y = F.exp(1 + F.col("x1") + F.when(F.col("store") == "a", 1.0).otherwise(0.0))
    return df.withColumns({"sales": F.floor(y + F.rand(3)).cast("double"), "v": F.col("id") >= 600}).persist()


@pytest.fixture(scope="module")
def fitted(rows):
    make = lambda kind: models.Forecaster(models.ModelConfig(objective=kind, trees=10, depth=3)).fit(rows, ["x1", "x2", "store"], validation="v")
    return {"boosted": make("squared"), "linear": make("tweedie")}


def error(df):
    return df.agg(F.sqrt(F.avg(F.pow(F.col("prediction") - F.col("sales"), 2)))).first()[0]


@pytest.mark.parametrize("kind", ["boosted", "linear"])
def test_models_beat_the_mean_and_reload(spark, rows, fitted, kind, tmp_path):
    made = fitted[kind].predict(rows)
    assert error(made) < rows.agg(F.stddev("sales")).first()[0] * 0.8 and made.where("prediction < 0").isEmpty()
    fitted[kind].save(str(tmp_path), spark)
    again = models.Forecaster.load(str(tmp_path), spark).predict(rows.drop("x2"))
    assert again.count() == 800
    same = models.Forecaster.load(str(tmp_path), spark).predict(rows)
    assert same.select("id", "prediction").exceptAll(made.select("id", "prediction")).isEmpty()
    top = fitted[kind].importance(spark).collect()
    assert math.isclose(top[-1].cumulative_importance, 1.0) and {r.feature for r in top} == {"x1", "x2", "store"}


def test_unfitted_models_refuse(rows):
    with pytest.raises(RuntimeError):
        models.Forecaster().predict(rows)
    with pytest.raises(ValueError):
        models.Ensemble().add("m", models.Forecaster())


def test_ensembles(spark, rows, fitted, tmp_path):
    e = models.Ensemble()
    for k, m in fitted.items():
        e.add(k, m)
    assert e.weights == {"boosted": 0.5, "linear": 0.5}
    made = e.predict(rows, with_members=True).first()
    assert math.isclose(made.prediction, (made.boosted_prediction + made.linear_prediction) / 2) and math.isclose(made.prediction_std, abs(made.boosted_prediction - made.linear_prediction) / 2)
    before = error(e.predict(rows))
    e.optimise(rows)
    assert math.isclose(sum(e.weights.values()), 1.0) and error(e.predict(rows)) <= before + 1e-9
    e.save(str(tmp_path), spark)
    assert models.Ensemble.load(str(tmp_path), spark).weights == e.weights
    assert e.importance(spark, "max").count() == 3 and "linear_contribution" in e.contributions(rows).columns
    assert list(e.remove("linear").weights.values()) == [1.0]


def test_weights_by_either_error(spark):
    df = spark.createDataFrame([(float(k), float(k) + 1, float(k) - 1, 0.0) for k in range(1, 40)], "sales double, a double, b double, c double")
    for metric in ("rmse", "mae"):
        w = models.best_weights(df, ["a", "b", "c"], metric=metric)
        assert abs(w["a"] - 0.5) < 0.1 and abs(w["b"] - 0.5) < 0.1


def test_interval(spark):
    row = spark.createDataFrame([(10.0,)], "prediction double").withColumns(models.interval(confidence=0.95)).first()
    assert math.isclose(row.upper_bound, 10 + 1.959963984540054 * 2) and math.isclose(row.lower_bound, 10 - 1.959963984540054 * 2)


def test_scoring_service(spark, rows):
    train = rows.select("sales", F.col("store").alias("store_id"), (F.col("id") % 7).cast("int").alias("day_of_week"), F.col("x1").alias("sell_price"), F.col("x2").alias("sales_lag_28"))
    service = scoring.Service(models.Forecaster(models.ModelConfig(trees=3, depth=2)).fit(train, ["store_id", "day_of_week", "sell_price", "sales_lag_28"]))
    asked = spark.createDataFrame([("i", "a", date(2024, 1, 1) + timedelta(k), 0.5) for k in range(3)], "item_id string, store_id string, forecast_date date, price double")
    got = service.predict(asked).collect()
    assert len(got) == 3 and all(0 <= r.lower_bound <= r.prediction <= r.upper_bound for r in got)
    days = service.horizon(asked.select("item_id", "store_id", F.col("forecast_date").alias("start_date")).limit(1), 5).collect()
    assert sorted(r.forecast_date for r in days) == [date(2024, 1, 1) + timedelta(k) for k in range(5)]
    with pytest.raises(ValueError):
        service.horizon(asked, 91)
    with pytest.raises(ValueError):
        service.predict(asked, most=2)
    assert service.stats()["errors"] == 1 and service.health()["status"] == "healthy" and service.info()["n_features"] == 4


def test_tweedie_fits_features_of_any_size(spark):
    """Unscaled lags and prices in the thousands, mostly zero sales: the log link stays within bounds."""
    df = spark.range(1500).withColumns({"lag": F.pow(F.rand(4), 6) * 50_000, "price": F.rand(5) * 9000, "flat": F.lit(7.0)})
    df = df.withColumn("sales", F.when(F.rand(6) < 0.8, 0.0).otherwise(F.floor(F.col("lag") / 300)))
    model = models.Forecaster(models.ModelConfig(objective="tweedie")).fit(df, ["lag", "price", "flat"])
    made = model.predict(df)
    assert made.where("isnan(prediction) or prediction is null or prediction < 0").isEmpty()
    assert error(made) < df.agg(F.stddev("sales")).first()[0] * 1.5


def test_one_seed_gives_one_model(rows):
    make = lambda df: models.Forecaster(models.ModelConfig(trees=4, depth=3)).fit(df, ["x1", "x2", "store"]).predict(rows.limit(50)).select("prediction").collect()
    assert make(rows) == make(rows.repartition(3).orderBy(F.desc("x1")))


def test_tweedie_finds_the_optimum_on_skewed_rows(spark):
    """Rows that whole reweighted steps run off on: the weighted slope of the loss ends at nothing, penalty included."""
    rng = np.random.default_rng(8)
    x = np.stack([rng.pareto(1.2, 800), rng.normal(0, 1, 800), np.ones(800)], axis=1)
    y = np.where(rng.random(800) < 0.85, 0.0, np.floor(rng.pareto(1.1, 800) * 5))
    w = rng.integers(1, 4, 800).astype(float)
    df = spark.createDataFrame([(a.tolist(), float(b), float(c)) for a, b, c in zip(x, y, w)], "x array<double>, y double, w double")
    model = models.tweedie_glm(df, 1.5, 0.1)
    b = model.coefficients.toArray()
    mean = np.exp(x @ b + model.intercept)
    slope = x.T @ (w * (y - mean) * mean**-0.5) - 0.1 * w.sum() * np.sqrt((w * y).sum() / w.sum()) * b
    assert np.abs(slope).max() < 1e-4 * (w * y).sum() and abs((w * (y - mean) * mean**-0.5).sum()) < 1e-4 * (w * y).sum()


def test_tweedie_without_sales_predicts_next_to_nothing(spark):
    df = spark.range(50).selectExpr("array(cast(id as double)) as x", "0D as y", "1D as w")
    model = models.tweedie_glm(df, 1.5, 0.1)
    assert model.coefficients.toArray().tolist() == [0.0] and math.exp(model.intercept) < 1e-5
    with pytest.raises(ValueError):
        models.tweedie_glm(df.where("y > 0"), 1.5, 0.1)
    with pytest.raises(ValueError):
        models.tweedie_glm(df.selectExpr("x", "-1D as y", "w"), 1.5, 0.1)
