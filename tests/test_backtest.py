from datetime import timedelta

from pyspark.sql import functions as F

from tidewright.operators import backtest, metrics
from tidewright.operators.models import ModelConfig
from tidewright.sources.synthetic import Synthetic


class Recorder:
    config, seen = ModelConfig(objective="squared"), []

    def clone(self):
        return self

    def fit(self, train, names, weight=None, validation=None):
        assert weight == "row_weight"
        self.seen += train.select("id", "date", weight).collect()
        return self

    def predict(self, df):
        return df.withColumn("prediction", F.lit(0.0))


def test_folds_fit_with_row_weights(spark):
    panel = Synthetic(n_items=2, n_stores=1, n_days=120).panel(spark).persist()
    last = panel.agg(F.max("date")).first()[0] - timedelta(28)
    history, test = panel.where(F.col("date") <= F.lit(last)), panel.where(F.col("date") > F.lit(last)).drop("sales")
    model = Recorder()
    backtest.model_forecast(model)(history, test)
    want = {(r.id, r.date): r.row_weight for r in metrics.row_weights(history).collect()}
    assert model.seen and all(abs(r.row_weight - want[r.id, r.date]) < 1e-9 for r in model.seen)


def test_a_gap_leaves_features_as_on_the_whole_panel(spark):
    """Features of the test days are those of the whole panel with sales hidden after the training days."""
    from tidewright.operators.features import Temporal, temporal_features
    from tidewright.operators.prepare import hide_after

    panel = Synthetic(n_items=1, n_stores=1, n_days=200).panel(spark).withColumn("sales", F.datediff("date", F.lit("2011-01-01")).cast("double")).persist()
    last, seen = panel.agg(F.max("date")).first()[0], {}
    t = Temporal(lags=(28, 35), windows=(7,), statistics=("mean",), countries=())

    def forecast(history, future):
        ends = history.agg(F.max("date")).first()[0]
        made = temporal_features(hide_after(history.unionByName(future.withColumn("sales", F.lit(None).cast("double"))), ends), t)
        rows = made.where(F.col("date") > F.lit(ends)).select("id", "date", "sales_lag_28", "sales_lag_35", "sales_roll_mean_7").collect()
        seen.update({r.date: tuple(r)[2:] for r in rows})
        return future.withColumn("prediction", F.lit(0.0))

    found = backtest.run(panel, forecast, backtest.Plan(n_folds=1, test_days=10, gap_days=3))
    whole = temporal_features(hide_after(panel, last - timedelta(13)), t).where(F.col("date") > F.lit(last - timedelta(13)))
    assert seen == {r.date: (r.sales_lag_28, r.sales_lag_35, r.sales_roll_mean_7) for r in whole.collect()} and len(seen) == 13
    assert found.predictions.count() == 10 and {"mean_actual", "std_prediction"} <= set(found.aggregate())
    found.release()


def test_a_short_lag_is_warned_of(spark):
    import pytest

    panel = Synthetic(n_items=1, n_stores=1, n_days=90).panel(spark)
    naive = lambda history, future: backtest.seasonal_naive(history, future)
    naive.min_lag = 28
    with pytest.warns(UserWarning, match="least lag"):
        backtest.run(panel, naive, backtest.Plan(n_folds=1, test_days=28, gap_days=3))
