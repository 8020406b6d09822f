import math
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tidewright.operators import backtest, metrics as M

DAY = date(2024, 1, 1)


def pairs(spark, y, p):
    return spark.createDataFrame([(k, float(a), float(b)) for k, (a, b) in enumerate(zip(y, p))], "k int, actual double, prediction double")


def history(spark, rows):
    return spark.createDataFrame([(f"s{i}", DAY + timedelta(t), None if v is None else float(v)) for i, r in enumerate(rows) for t, v in enumerate(r)], "id string, date date, sales double")


def test_point_metrics(spark):
    df = pairs(spark, [10, 20, 30, 40, 50], [11, 22, 33, 44, 55])
    assert math.isclose(df.agg(M.mape()).first()[0], 10.0)
    assert math.isinf(pairs(spark, [0, 0], [1, 2]).agg(M.mape()).first()[0])
    assert pairs(spark, [0, 0], [0, 0]).agg(M.smape()).first()[0] == 0.0
    row = M.pooled(df, order=["k"]).first()
    assert row.directional_accuracy == 100.0 and row.n_samples == 5 and math.isclose(row.rmse, math.sqrt(11))


def test_scaled_error_of_one_series(spark):
    train = spark.createDataFrame([(k, float(10 + 2 * k)) for k in range(8)], "k int, actual double")
    scale = M.seasonal_scale(train, ["k"]).first().scale
    assert pairs(spark, [26, 28], [25, 29]).agg(M.mase(M.mae(), F.lit(scale))).first()[0] == 0.5


def test_scales_begin_at_the_first_sale(spark):
    got = {r.id: r.scale for r in M.scales(history(spark, [[0, 0, 1, 3, 2], [1, 1, 1, 1, 1], [0, None, 0, 0, 0]]), ["id"]).collect()}
    assert got == {"s0": 2.5, "s1": 0.0, "s2": 0.0}


def test_weighted_error(spark):
    rows = lambda *r: spark.createDataFrame(list(r), "weight double, scale double, mse double")
    assert math.isclose(M.weighted(rows((0.75, 4.0, 1.0), (0.25, 1.0, 2.0))).first().wrmsse, 0.75 * 0.5 + 0.25 * math.sqrt(2))
    assert M.weighted(rows((0.5, 4.0, 1.0), (0.5, 0.0, 9.0))).first().wrmsse == 0.5
    assert M.weighted(rows((0.0, 4.0, 1.0), (0.0, 1.0, 1.0))).first().wrmsse == 0.75
    assert math.isnan(M.weighted(rows((0.5, 4.0, None), (0.5, 1.0, 1.0))).first().wrmsse)


def test_hierarchical_score(spark):
    train = history(spark, [[1, 2, 3, 4, 3, 2, 5], [4, 1, 0, 2, 2, 3, 1]]).withColumns({"item_id": F.col("id"), "sell_price": F.lit(2.0)})
    test = train.withColumn("date", F.date_add("date", 7))
    perfect = M.hierarchical_wrmsse(train, test.withColumn("prediction", F.col("sales")))
    assert {r.level: r.wrmsse for r in perfect.collect()} == {"total": 0.0, "item": 0.0, "series": 0.0}
    assert M.overall(M.hierarchical_wrmsse(train, test.withColumn("prediction", F.lit(0.0)))) > 0.5
    with pytest.raises(ValueError):
        M.hierarchical_wrmsse(train, test.withColumn("prediction", F.lit(0.0)), levels=[("state", ("state_id",))])


def test_row_weights_average_one(spark):
    train = history(spark, [[1, 2, 3, 4], [4, 1, 0, 2], [5, 5, 5, 5]])
    rows = M.row_weights(train).collect()
    assert math.isclose(sum(r.row_weight for r in rows) / len(rows), 1.0) and all(r.row_weight == 0 for r in rows if r.id == "s2")


def test_comparison_ranks_ties(spark):
    df = pairs(spark, [1, 2], [1, 3]).withColumns({"a": F.col("prediction"), "b": F.col("prediction"), "c": F.lit(9.0)})
    got = {r.model: r.rmse_rank for r in M.compare(df, ["a", "b", "c"]).collect()}
    assert got == {"a": 1.5, "b": 1.5, "c": 3.0}


def test_baselines(spark):
    train = history(spark, [list(range(14)), [2] * 14])
    test = train.where(F.col("date") < F.lit(DAY + timedelta(3))).withColumn("date", F.date_add("date", 14)).unionByName(spark.createDataFrame([("new", DAY + timedelta(14), 1.0)], train.schema))
    naive = {(r.id, r.date): r.prediction for r in backtest.seasonal_naive(train, test).collect()}
    assert naive[("s0", DAY + timedelta(14))] == 7.0 and naive[("new", DAY + timedelta(14))] == 0.0
    mean = {r.id: r.prediction for r in backtest.moving_average(train, test, 2).collect()}
    assert mean == {"s0": 12.5, "s1": 2.0, "new": 0.0}


def test_folds():
    plan = backtest.Plan(n_folds=3, test_days=10, gap_days=2, min_train_days=40, validation_days=20)
    folds = plan.folds(DAY, DAY + timedelta(99))
    assert len(folds) == 3 and all(a.test_end < b.test_start for a, b in zip(folds, folds[1:])) and folds[-1].test_end == DAY + timedelta(99)
    assert all((f.test_start - f.train_end).days == 3 and f.train_start == DAY for f in folds)
    sliding = backtest.Plan(n_folds=3, test_days=10, expanding=False, min_train_days=75, validation_days=20).folds(DAY, DAY + timedelta(99))
    assert len(sliding) == 2 and {(f.train_end - f.train_start).days for f in sliding} == {74}


def test_backtest_with_a_naive_forecast(spark):
    panel = history(spark, [[k % 7 for k in range(100)], [(3 * k) % 5 for k in range(100)]])
    seen = []
    found = backtest.run(panel, backtest.seasonal_naive, backtest.Plan(n_folds=2, test_days=14), [seen.append])
    assert len(seen) == 2 and found.predictions.count() == 56 and found.mean_wrmsse > 0
    assert found.by_horizon().count() == 14 and found.summary(spark).count() == 2 and found.aggregate()["rmse"] > 0
    with pytest.raises(ValueError):
        backtest.run(panel.limit(0), backtest.seasonal_naive)


def test_days_that_a_series_lacks_count_as_zero(spark):
    rows = [[0, 2, 0, 0, 5, 1, 0], [3, 0, 0, 0, 0, 0, 0], [1, 1, 1, 1, 1, 1, 1], [0, 0, 4, 0, 0, 0, 2]]
    dense = history(spark, rows)
    want = {r.id: r.scale for r in M.scales(dense, ["id"]).collect()}
    got = {r.id: r.scale for r in M.scales(dense.where("sales > 0"), ["id"]).collect()}
    assert got.keys() == want.keys() and all(math.isclose(got[k], want[k]) for k in want)


def test_a_missing_test_day_makes_the_score_nan(spark):
    train = history(spark, [[1, 2, 3, 4, 3, 2, 5], [4, 1, 0, 2, 2, 3, 1]]).withColumns({"item_id": F.col("id"), "sell_price": F.lit(2.0)})
    test = train.withColumns({"date": F.date_add("date", 7), "prediction": F.lit(1.0)})
    got = {r.level: r.wrmsse for r in M.hierarchical_wrmsse(train, test.where(~((F.col("id") == "s0") & (F.dayofmonth("date") == 9)))).collect()}
    assert math.isnan(got["series"]) and math.isnan(got["item"]) and got["total"] > 0
    flat = train.withColumn("sales", F.lit(3.0))
    with pytest.raises(ValueError):
        M.overall(M.hierarchical_wrmsse(flat, test))
    with pytest.raises(ValueError):
        M.score(flat, test)


def test_record_has_both_scaled_errors(spark):
    train = history(spark, [[k % 7 + 1 for k in range(30)], [(3 * k) % 11 for k in range(30)]])
    test = train.where("day(date) <= 7").withColumns({"date": F.date_add("date", 30), "prediction": F.lit(2.0)})
    row = M.record(train, test).first()
    step = M.seasonal_scale(train, ["date"], ["id"], "sales", 7)
    assert row.n_samples == 14 and row.mase > 0 and step.count() == 2
    assert math.isclose(row.wrmsse, M.overall(M.hierarchical_wrmsse(train, test, levels=[("series", ("id",))])))
