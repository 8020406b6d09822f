import math
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tidewright.functions import calendar as cal
from tidewright.operators import features as X
from tidewright.operators import prepare

FIRST = date(2024, 1, 1)


def series(spark, values, prices=None, start=FIRST):
    rows = [("a", "i", "s", "c", start + timedelta(k), None if v is None else float(v), None if prices is None else prices[k]) for k, v in enumerate(values)]
    return spark.createDataFrame(rows, "id string, item_id string, store_id string, cat_id string, date date, sales double, sell_price double")


def column(df, *names):
    return [tuple(r[n] for n in names) if len(names) > 1 else r[names[0]] for r in df.orderBy("date").collect()]


def test_lags_and_differences(spark):
    t = X.Temporal(lags=(1, 2), min_lag=1)
    df = series(spark, range(10)).withColumns(X.lag_columns(t))
    assert column(df, "sales_lag_1")[:3] == [None, 0.0, 1.0]
    assert column(df, "sales_lag_1_diff_7")[9] == 7.0
    assert "sales_lag_1" not in X.lag_columns(X.Temporal(lags=(1, 28)))


def test_rolling_frames_end_at_the_lag(spark):
    t = X.Temporal(windows=(3,), min_lag=2)
    df = series(spark, range(10)).withColumns(X.rolling_columns(t) | X.expanding_columns(t))
    got = column(df, "sales_roll_mean_3", "sales_roll_min_3", "sales_roll_max_3", "sales_roll_std_3")
    assert got[3] == (None,) * 4 and got[4] == (1.0, 0.0, 2.0, 1.0)
    assert column(df, "sales_expanding_mean")[:4] == [None, None, 0.0, 0.5]
    assert column(df, "sales_zero_days_cum")[2:4] == [1, 1]


def test_a_null_empties_its_windows(spark):
    t = X.Temporal(windows=(2,), min_lag=1)
    df = series(spark, [1, None, 3, 4, 5]).withColumns(X.rolling_columns(t))
    assert column(df, "sales_roll_mean_2") == [None, None, None, None, 3.5]


def test_calendar(spark):
    df = cal.add_calendar(series(spark, [1, 2, 3], start=date(2024, 1, 5)))
    assert column(df, "day_of_week", "is_weekend") == [(4, 0), (5, 1), (6, 1)]
    assert math.isclose(column(df, "month_sin")[0], 0.5, abs_tol=1e-9)


def test_holidays(spark):
    df = cal.add_holidays(series(spark, range(5), start=date(2020, 12, 23)))
    assert column(df, "is_holiday_US", "days_to_holiday_US", "days_from_holiday_US")[:3] == [(0, 2, -1), (0, 1, -1), (1, 7, -1)]
    assert column(df, "is_holiday_UK")[2:4] == [1, 0] or column(df, "is_holiday_UK")[2:4] == [1, 1]
    assert [cal.easter(y) for y in (2000, 2011, 2024)] == [date(2000, 4, 23), date(2011, 4, 24), date(2024, 3, 31)]
    assert date(2021, 7, 5) in cal.us_holidays(2021) and date(2022, 12, 27) in cal.uk_holidays(2022) and date(2024, 11, 28) in cal.us_holidays(2024)


def test_promotion_after_a_price_cut(spark):
    df = series(spark, range(40), [10.0] * 35 + [5.0] * 5).withColumns(X.promotion_columns())
    assert column(df, "is_promotion")[39] == 1 and column(df, "is_promotion")[30] == 0 and column(df, "is_promotion")[3] is None


def test_price_changes_and_ranks(spark):
    df = series(spark, range(9), [1.0, 1.0, 2.0, 2.0, None, 3.0, 3.0, 3.0, 2.0])
    made = X.with_change_count(df).withColumns(X.price_position_columns() | X.price_change_columns(X.Price()))
    assert column(made, "price_change_cumcount") == [None, 0, 1, 1, None, None, 1, 1, 2]
    assert column(made, "price_percentile")[:5] == [1.5 / 9, 1.5 / 9, 4 / 9, 4 / 9, None]
    assert column(made, "price_lag_7", "price_decreased")[8] == (1.0, 0)


def test_price_columns_need_a_price(spark):
    df = series(spark, range(3)).drop("sell_price")
    assert X.price_features(df).columns == df.columns


def test_names_match_the_columns(spark):
    df = series(spark, range(6), [1.0] * 6)
    t = X.Temporal(countries=(), cyclical=False)
    assert set(X.temporal_names(t)) <= set(X.temporal_features(df, t).columns)
    assert set(X.price_names(X.Price(), df.columns)) <= set(X.price_features(df).columns)
    assert set(X.hierarchy_names(X.Hierarchy(), df.columns)) <= set(X.hierarchy_features(df).columns)


def test_features_do_not_see_hidden_sales(spark):
    from tidewright.operators.prepare import hide_after
    from tidewright.operators.validate import unchanged_by_future

    panel = series(spark, [(k * 7) % 5 for k in range(120)], [2.0] * 120)
    origin = FIRST + timedelta(91)
    build = lambda df: X.hierarchy_features(X.temporal_features(hide_after(df, origin), X.Temporal(windows=(7, 28), countries=())))
    assert unchanged_by_future(build, panel, origin, ["sales_lag_28", "sales_roll_mean_7", "item_agg_roll_mean_28", "share_of_store"])
    leak = lambda df: df.withColumn("leak", F.lag("sales", 1).over(X.by_day()))
    assert not unchanged_by_future(leak, panel, origin, ["leak"])


def test_engineer_learns_what_to_drop(spark):
    panel = series(spark, [(k * 7) % 5 for k in range(100)], [2.0 + k % 3 for k in range(100)])
    engineer = prepare.Engineer()
    with pytest.raises(RuntimeError):
        engineer.transform(panel)
    made = engineer.fit_transform(panel)
    assert "item_id" in engineer.dropped and "date" not in engineer.names and set(engineer.names) <= set(made.columns)
    assert engineer.transform(panel).columns == made.columns
    assert {t for c, t in made.dtypes if c in engineer.names} <= {"float", "int", "bigint", "string"}


def test_full_feature_count_on_a_retail_panel(spark):
    """117 inputs, less the two columns that are always null."""
    from tidewright.sources.synthetic import Synthetic

    panel = Synthetic(n_items=1, n_stores=1, n_days=30).panel(spark)
    made = prepare.Engineer().build(panel)
    assert len(prepare.candidates(made)) == 117
