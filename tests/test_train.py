"""The training run over a small panel: files, scores, checks."""

import json
import math

import pytest
from pyspark.sql import functions as F

from tidewright.operators.models import Forecaster
from tidewright.plans import train
from tidewright.plans.config import load_config
from tidewright.sources.synthetic import Synthetic


@pytest.fixture(scope="module")
def done(spark, tmp_path_factory):
    config = load_config(env={})
    config.train.out, config.model.trees, config.model.depth = str(tmp_path_factory.mktemp("run")), 5, 3
    panel = Synthetic(n_items=3, n_stores=2, n_days=430).panel(spark).persist()
    return config, panel, train.run(spark, config, panel)


def test_run_writes_what_it_scored(spark, done):
    config, panel, out = done
    at = config.train.out
    with open(f"{at}/metrics.json") as f:
        assert json.load(f) == json.loads(json.dumps(out, default=str))
    with open(f"{at}/run_config.json") as f:
        assert json.load(f)["model"]["trees"] == 5
    rows = spark.read.option("header", True).csv(f"{at}/predictions.csv")
    assert rows.columns == ["id", "date", "actual", "prediction", "seasonal_naive_7d", "moving_average_28d"] and rows.count() == 6 * 28
    assert spark.read.option("header", True).csv(f"{at}/feature_importance.csv").count() == out["n_features"]
    assert set(out["holdout"]) == {"model", "seasonal_naive_7d", "moving_average_28d"}
    assert all(len(s["wrmsse_by_level"]) == 12 and not math.isnan(s["wrmsse"]) for s in out["holdout"].values())
    assert Forecaster.load(f"{at}/model", spark).params()["trees"] == 5


def test_invalid_panels_are_refused(spark, done):
    config, panel, _ = done
    with pytest.raises(ValueError, match="negative"):
        train.run(spark, config, panel.withColumn("sales", F.lit(-1.0)))


def test_only_the_failed_check_is_named(spark, done):
    from datetime import timedelta

    from tidewright.operators.prepare import Engineer, hide_after

    config, panel, out = done
    origin = panel.agg(F.max("date")).first()[0] - timedelta(28)
    engineer = Engineer(horizon=28)
    features = engineer.fit_transform(hide_after(panel, origin)).persist()
    model = Forecaster.load(f"{config.train.out}/model", spark)
    made = panel.where(F.col("date") > F.lit(origin)).join(model.predict(features).select("id", "date", "prediction"), ["id", "date"])
    engineer.names = ["sales_lag_28"]
    with pytest.raises(train.CheckError, match=r"failed: \['model_beats_best_naive_baseline'\]$"):
        train.run_checks(spark, panel, origin, engineer, made, dict(out["holdout"], model={"wrmsse": 9.0}), model, f"{config.train.out}/model", features)
    features.unpersist()
