"""Window features of a demand panel: lags, rolling statistics, prices, hierarchy levels.

Everything target-based reads rows at least `lag` rows back, through one shifted frame instead of a window
over a lag: shift(L).rolling(W) is the frame from L+W-1 to L rows back, null unless it holds W values. All
temporal and price windows share one partitioning and order, so the panel is shuffled and sorted once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EPS = 1e-8
LEVELS = ("item_id", "dept_id", "cat_id", "store_id", "state_id")


@dataclass(frozen=True)
class Temporal:
    lags: tuple[int, ...] = (7, 14, 21, 28, 35, 42, 49, 56)
    windows: tuple[int, ...] = (7, 14, 28, 56, 112)
    statistics: tuple[str, ...] = ("mean", "std", "min", "max")
    expanding: bool = True
    cyclical: bool = True
    countries: tuple[str, ...] = ("UK", "US")
    min_lag: int = 28

    @property
    def usable(self) -> tuple[int, ...]:
        return tuple(x for x in self.lags if x >= self.min_lag)


@dataclass(frozen=True)
class Price:
    windows: tuple[int, ...] = (7, 14, 28)
    change_lag: int = 7
    significant: float = 0.05
    category: bool = True
    store: bool = True


@dataclass(frozen=True)
class Hierarchy:
    levels: tuple[str, ...] = LEVELS
    window: int = 28
    min_lag: int = 28


_STATS = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}


def by_day(group: str = "id", date: str = "date") -> Window:
    return Window.partitionBy(group).orderBy(date)


def rolled(stat: str, value: str, width: int, lag: int, w) -> Column:
    """A statistic of `width` values that end `lag` rows back; null unless there are that many."""
    frame = w.rowsBetween(-(lag + width - 1), -lag)
    how = _STATS[stat](value) if stat in _STATS else F.percentile(value, F.lit(0.5))
    return F.when(F.count(value).over(frame) == width, how.over(frame))


def lag_columns(t: Temporal, target: str = "sales", w=None) -> dict[str, Column]:
    w = w or by_day()
    out = {}
    for k in t.usable:
        out[f"{target}_lag_{k}"] = F.lag(target, k).over(w)
        out[f"{target}_lag_{k}_diff_7"] = F.lag(target, k).over(w) - F.lag(target, k + 7).over(w)
    return out


def rolling_columns(t: Temporal, target: str = "sales", w=None) -> dict[str, Column]:
    w = w or by_day()
    out = {}
    for n in t.windows:
        for s in t.statistics:
            out[f"{target}_roll_{s}_{n}"] = rolled(s, target, n, t.min_lag, w)
        out[f"{target}_roll_cv_{n}"] = rolled("std", target, n, t.min_lag, w) / (rolled("mean", target, n, t.min_lag, w) + EPS)
    return out


def expanding_columns(t: Temporal, target: str = "sales", w=None) -> dict[str, Column]:
    w = w or by_day()
    frame = w.rowsBetween(Window.unboundedPreceding, -t.min_lag)
    there = F.lag(target, t.min_lag).over(w).isNotNull()
    return {
        f"{target}_expanding_mean": F.when(there, F.avg(target).over(frame)),
        f"{target}_zero_days_cum": F.when(there, F.sum((F.col(target) == 0).cast("long")).over(frame)),
    }


def time_index(w=None) -> Column:
    return F.row_number().over(w or by_day())


def temporal_names(t: Temporal, target: str = "sales") -> list[str]:
    """The names of all temporal feature columns."""
    out = [x for k in t.usable for x in (f"{target}_lag_{k}", f"{target}_lag_{k}_diff_7")]
    out += [f"{target}_roll_{s}_{n}" for n in t.windows for s in (*t.statistics, "cv")]
    out += [f"{target}_expanding_mean", f"{target}_zero_days_cum"] if t.expanding else []
    return [*out, "time_idx"]


def temporal_features(df: DataFrame, t: Temporal = Temporal(), target: str = "sales", group: str = "id", date: str = "date") -> DataFrame:
    """Lags, differences, rolling and expanding statistics, time index, calendar and holiday columns."""
    from tidewright.functions.calendar import add_calendar, add_holidays

    w = by_day(group, date)
    columns = lag_columns(t, target, w) | rolling_columns(t, target, w) | (expanding_columns(t, target, w) if t.expanding else {})
    df = df.withColumns(columns | {"time_idx": time_index(w)})
    return add_holidays(add_calendar(df, date, t.cyclical), t.countries, date)


# --- prices ----------------------------------------------------------------------------------------------


def price_change_columns(p: Price, price: str = "sell_price", w=None) -> dict[str, Column]:
    w = w or by_day()
    k, now, old = p.change_lag, F.col(price), F.lag(price, p.change_lag).over(w)
    return {
        f"price_lag_{k}": old, f"price_change_ratio_{k}": F.try_divide(now, old), f"price_change_abs_{k}": now - old,
        "price_decreased": (now < old).cast("int"), "price_changed_significant": (F.try_divide(F.abs(now - old), old) > p.significant).cast("int"),
    }


def price_momentum_columns(p: Price, price: str = "sell_price", w=None) -> dict[str, Column]:
    w = w or by_day()
    out = {}
    for n in p.windows:
        for name, stat in (("momentum", "mean"), ("vs_max", "max"), ("vs_min", "min")):
            out[f"price_{name}_{n}"] = F.try_divide(F.col(price), rolled(stat, price, n, 0, w))
        out[f"price_volatility_{n}"] = rolled("std", price, n, 0, w) / (rolled("mean", price, n, 0, w) + EPS)
    return out


def promotion_columns(price: str = "sell_price", w=None) -> dict[str, Column]:
    median = rolled("median", price, 28, 0, w or by_day())
    now = F.col(price)
    return {"price_vs_median_28": F.try_divide(now, median), "is_promotion": (now < 0.9 * median).cast("int"), "is_deep_discount": (now < 0.8 * median).cast("int")}


def with_change_count(df: DataFrame, price: str = "sell_price", w=None) -> DataFrame:
    """price_change_cumcount: how often the price has changed so far; null where a row or the row before has none."""
    w = w or by_day()
    changed = F.col("_changed")
    df = df.withColumn("_changed", F.col(price) != F.lag(price, 1).over(w))
    count = F.when(changed.isNotNull(), F.sum(changed.cast("long")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return df.withColumn("price_change_cumcount", count).drop("_changed")


def category_price_columns(price: str = "sell_price", category: str = "cat_id", date: str = "date") -> dict[str, Column]:
    mean = F.avg(price).over(Window.partitionBy(category, date))
    return {"category_avg_price": mean, "price_vs_category": F.try_divide(F.col(price), mean), "price_diff_category": F.col(price) - mean}


def store_price_columns(price: str = "sell_price", store: str = "store_id", date: str = "date") -> dict[str, Column]:
    mean = F.avg(price).over(Window.partitionBy(store, date))
    return {"store_avg_price": mean, "price_vs_store": F.try_divide(F.col(price), mean)}


def average_rank(value: str, *by: str) -> Column:
    """Rank of non-null values in a partition; equal values share the mean of their ranks."""
    over = Window.partitionBy(*by).orderBy(F.col(value).asc_nulls_last())
    ties = F.count(F.lit(1)).over(Window.partitionBy(*by, value))
    return F.when(F.col(value).isNotNull(), F.rank().over(over) + (ties - 1) / 2.0)


def price_position_columns(price: str = "sell_price", group: str = "id") -> dict[str, Column]:
    """Place and z-score of the price in the series' whole history, known in advance."""
    whole = Window.partitionBy(group)
    mean, sd = F.avg(price).over(whole), F.stddev_samp(price).over(whole)
    return {"price_percentile": average_rank(price, group) / F.count(F.lit(1)).over(whole), "price_zscore": (F.col(price) - mean) / (sd + EPS)}


def price_names(p: Price, columns: Sequence[str]) -> list[str]:
    k = p.change_lag
    out = [f"price_lag_{k}", f"price_change_ratio_{k}", f"price_change_abs_{k}", "price_decreased", "price_changed_significant"]
    out += [f"price_{x}_{n}" for n in p.windows for x in ("momentum", "vs_max", "vs_min", "volatility")]
    out += ["price_vs_median_28", "is_promotion", "is_deep_discount", "price_change_cumcount"]
    out += ["category_avg_price", "price_vs_category", "price_diff_category"] if p.category and "cat_id" in columns else []
    out += ["store_avg_price", "price_vs_store"] if p.store and "store_id" in columns else []
    return [*out, "price_percentile", "price_zscore"]


def price_features(df: DataFrame, p: Price = Price(), price: str = "sell_price", group: str = "id", date: str = "date") -> DataFrame:
    """All price columns; none without a price column, and no blocks whose key column is absent."""
    if price not in df.columns:
        return df
    w = by_day(group, date)
    df = df.withColumns(price_change_columns(p, price, w) | price_momentum_columns(p, price, w) | promotion_columns(price, w))
    df = with_change_count(df, price, w).withColumns(price_position_columns(price, group))
    if p.category and "cat_id" in df.columns:
        df = df.withColumns(category_price_columns(price, "cat_id", date))
    return df.withColumns(store_price_columns(price, "store_id", date)) if p.store and "store_id" in df.columns else df


# --- hierarchy -------------------------------------------------------------------------------------------


def level_totals(df: DataFrame, level: str, target: str = "sales", date: str = "date") -> DataFrame:
    """Daily totals of a level; null where all members are."""
    return df.groupBy(level, date).agg(F.sum(target).alias("_total"))


def level_features(df: DataFrame, level: str, h: Hierarchy = Hierarchy(), target: str = "sales", date: str = "date") -> DataFrame:
    """level, date and the lagged rolling mean and deviation of the level's daily totals."""
    name = level.removesuffix("_id")
    w = Window.partitionBy(level).orderBy(date)
    totals = level_totals(df, level, target, date)
    return totals.select(level, date, *(rolled(s, "_total", h.window, h.min_lag, w).alias(f"{name}_agg_roll_{s}_{h.window}") for s in ("mean", "std")))


def hierarchy_names(h: Hierarchy, columns: Sequence[str]) -> list[str]:
    return [x for c in h.levels if c in columns for n in [c.removesuffix("_id")] for x in (f"{n}_agg_roll_mean_{h.window}", f"{n}_agg_roll_std_{h.window}", f"share_of_{n}")]


def hierarchy_features(df: DataFrame, h: Hierarchy = Hierarchy(), target: str = "sales", date: str = "date", group: str = "id") -> DataFrame:
    """Each level's lagged statistics joined to the rows, and the series' share of each level. Only items see
    every row: the other levels are summed from rows that were summed over items."""
    small = [x for x in h.levels if x in df.columns and x != "item_id"]
    base, coarse = df, df.groupBy(*small, date).agg(F.sum(target).alias(target)) if len(small) > 1 else df
    df = df.withColumn("_own", rolled("mean", target, h.window, h.min_lag, by_day(group, date)))
    for level in [x for x in h.levels if x in df.columns]:
        name = level.removesuffix("_id")
        df = df.join(level_features(coarse if level in small else base, level, h, target, date), [level, date], "left")
        df = df.withColumn(f"share_of_{name}", F.col("_own") / (F.col(f"{name}_agg_roll_mean_{h.window}") + EPS))
    return df.drop("_own")


def bottom_up(forecasts: DataFrame, levels: Sequence[str] = LEVELS, value: str = "prediction", date: str = "date") -> DataFrame:
    """Forecast totals of each level and day beside each forecast; levels without a column are skipped."""
    for level in [x for x in levels if x in forecasts.columns]:
        totals = forecasts.groupBy(level, date).agg(F.coalesce(F.sum(value), F.lit(0.0)).alias(f"{level.removesuffix('_id')}_forecast"))
        forecasts = forecasts.join(totals, [level, date], "left")
    return forecasts
