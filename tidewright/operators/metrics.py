"""Forecast metrics as aggregates, up to the weighted scaled error over twelve hierarchy levels.

Levels stay in long form: a row is exploded once into its (level, key) pairs and aggregated once, never
pivoted, so the score costs one shuffle on (level, key, date) at any number of series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TINY = 1e-8
#: The levels of the hierarchy and their keys.
TWELVE_LEVELS: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("total", ()),
    ("state", ("state_id",)),
    ("store", ("store_id",)),
    ("category", ("cat_id",)),
    ("department", ("dept_id",)),
    ("state_category", ("state_id", "cat_id")),
    ("state_department", ("state_id", "dept_id")),
    ("store_category", ("store_id", "cat_id")),
    ("store_department", ("store_id", "dept_id")),
    ("item", ("item_id",)),
    ("item_state", ("item_id", "state_id")),
    ("series", ("id",)),
)


def _err(y: str, p: str) -> Column:
    return F.col(y) - F.col(p)


def rmse(y: str = "actual", p: str = "prediction") -> Column:
    return F.sqrt(F.avg(F.pow(_err(y, p), 2)))


def mae(y: str = "actual", p: str = "prediction") -> Column:
    return F.avg(F.abs(_err(y, p)))


def mape(y: str = "actual", p: str = "prediction", epsilon: float = TINY) -> Column:
    """In percent over rows with y above epsilon; infinity without any."""
    return F.coalesce(F.avg(F.when(F.col(y) > epsilon, F.abs(F.try_divide(_err(y, p), F.col(y))))) * 100, F.lit(float("inf")))


def smape(y: str = "actual", p: str = "prediction") -> Column:
    """In percent over rows where |y|+|p| > 0; 0 without any."""
    size = F.abs(F.col(y)) + F.abs(F.col(p))
    return F.coalesce(F.avg(F.when(size > 0, F.try_divide(2 * F.abs(_err(y, p)), size))) * 100, F.lit(0.0))


def coverage(y: str, low: str, high: str) -> Column:
    """Share of rows within the interval, ends included."""
    return F.avg(F.col(y).between(F.col(low), F.col(high)).cast("double"))


def seasonal_scale(train: DataFrame, order: Sequence[str], by: Sequence[str] = (), y: str = "actual", season: int = 1) -> DataFrame:
    """Mean absolute seasonal difference, in an explicit order, for each of `by` (or all rows)."""
    w = Window.partitionBy(*by).orderBy(*order) if by else Window.partitionBy(F.lit(1)).orderBy(*order)
    step = train.withColumn("_step", F.abs(F.col(y) - F.lag(y, season).over(w)))
    return step.groupBy(*by).agg(F.avg("_step").alias("scale"))


def mase(mean_error: Column, scale: Column) -> Column:
    return F.when(scale < TINY, F.lit(float("inf"))).otherwise(mean_error / scale)


def pooled(df: DataFrame, y: str = "actual", p: str = "prediction", order: Sequence[str] = ()) -> DataFrame:
    """One row: rmse, mae, mape (null without positive actuals), smape, mean and std (population) of actuals
    and predictions, n, and with an order the share of steps that go the same way."""
    aggs = [
        rmse(y, p).alias("rmse"), mae(y, p).alias("mae"), F.when(F.max(y) > 0, mape(y, p)).alias("mape"), smape(y, p).alias("smape"),
        F.avg(y).alias("mean_actual"), F.stddev_pop(y).alias("std_actual"), F.avg(p).alias("mean_prediction"), F.stddev_pop(p).alias("std_prediction"), F.count(F.lit(1)).alias("n_samples"),
    ]
    if order:
        *by, last = order
        w = Window.partitionBy(*by).orderBy(last) if by else Window.partitionBy(F.lit(1)).orderBy(last)
        same = F.signum(F.col(y) - F.lag(y).over(w)) == F.signum(F.col(p) - F.lag(p).over(w))
        df = df.withColumn("_same", same)
        aggs.append((F.avg(F.col("_same").cast("double")) * 100).alias("directional_accuracy"))
    return df.agg(*aggs)


def by_group(df: DataFrame, *by: str, y: str = "actual", p: str = "prediction") -> DataFrame:
    """The point metrics of each group, for example each series or each step of the horizon."""
    return df.groupBy(*by).agg(
        rmse(y, p).alias("rmse"), mae(y, p).alias("mae"), mape(y, p).alias("mape"), smape(y, p).alias("smape"),
        F.count(F.lit(1)).alias("n_samples"), F.avg(y).alias("mean_actual"), F.avg(p).alias("mean_prediction"),
    )


def compare(df: DataFrame, models: Sequence[str], y: str = "actual") -> DataFrame:
    """Metrics of each model's prediction column, and ranks in which equal values share their mean."""
    long = df.select(y, *models).unpivot([y], list(models), "model", "prediction")
    made = long.groupBy("model").agg(*(f(y).alias(n) for n, f in (("rmse", rmse), ("mae", mae), ("smape", smape), ("mape", mape))))
    # a row for each model: the ranks' single partition has as many rows as there are models
    for n in ("rmse", "mae", "smape", "mape"):
        low, same = F.rank().over(Window.orderBy(n)), F.count(F.lit(1)).over(Window.partitionBy(n))
        made = made.withColumn(f"{n}_rank", low + (same - 1) / 2.0)
    return made.orderBy("rmse", "model")


# --- scaled errors ---------------------------------------------------------------------------------------


def day_numbers(df: DataFrame, date: str = "date") -> DataFrame:
    """The distinct days of df and their numbers from 1: a row for each day of a calendar, whose size is fixed."""
    return df.select(date).distinct().withColumn("_day", F.row_number().over(Window.orderBy(date)))


def scales(df: DataFrame, by: Sequence[str], y: str = "sales", date: str = "date") -> DataFrame:
    """scale: the mean squared day-on-day difference from the first non-zero value on, over all days that df
    has; nulls and days that a series lacks are 0; 0 if there are fewer than two such values.

    Missing days are not filled in: a stretch of them between two rows is a step down to 0, steps of 0, and a
    step up again, and after the last row a step down.
    """
    days = day_numbers(df, date)
    w = Window.partitionBy(*by).orderBy("_day")
    rows = df.select(*by, date, F.coalesce(F.col(y), F.lit(0.0)).alias("_x")).join(F.broadcast(days), date).select(*by, "_x", "_day")
    rows = rows.withColumns({"_old": F.lag("_x").over(w), "_gap": F.col("_day") - F.lag("_day").over(w), "_begun": F.max((F.col("_x") != 0).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1))})
    step = F.when(F.col("_gap") == 1, F.pow(F.col("_x") - F.col("_old"), 2)).otherwise(F.pow("_old", 2) + F.pow("_x", 2))
    begun = F.col("_begun") == 1
    per = rows.groupBy(*by).agg(
        F.coalesce(F.sum(F.when(begun, step)), F.lit(0.0)).alias("_sum"), F.coalesce(F.sum(F.when(begun, F.col("_gap"))), F.lit(0)).alias("_n"),
        F.max("_day").alias("_last"), F.max_by("_x", "_day").alias("_end"), F.max((F.col("_x") != 0).cast("int")).alias("_any"),
    )
    short = days.agg(F.max("_day")).scalar() - F.col("_last")
    last = (short > 0) & (F.col("_any") == 1)
    total = F.col("_sum") + F.when(last, F.pow("_end", 2)).otherwise(0.0)
    return per.select(*by, F.coalesce(F.try_divide(total, F.col("_n") + F.when(last, short).otherwise(0)), F.lit(0.0)).alias("scale"))


def dollars(df: DataFrame, days: int, last, y: str = "sales", price: str = "sell_price", date: str = "date") -> Column:
    """A row's sales times price in the last days up to `last`, else 0."""
    value = F.coalesce(F.col(y), F.lit(0.0))
    if price in df.columns:
        value = value * F.coalesce(F.col(price), F.lit(0.0))
    return F.when(F.col(date) > F.date_sub(F.lit(last), days), value).otherwise(0.0)


def row_weights(train: DataFrame, days: int = 28, y: str = "sales", price: str = "sell_price", date: str = "date") -> DataFrame:
    """train with row_weight: the series' share of recent dollars over its scale, averaging 1 over rows. A
    series' share needs no total: it drops out of the average. Without any dollars all shares are equal."""
    last = train.agg(F.max(date)).scalar()
    per = train.groupBy("id").agg(F.sum(dollars(train, days, last, y, price, date)).alias("_w"), F.count(F.lit(1)).alias("_n")).join(scales(train, ["id"], y, date), "id")
    ratio = lambda w: F.when(F.col("scale") > 0, F.try_divide(w, F.col("scale"))).otherwise(0.0)
    per = per.select("id", "_n", "_w", ratio(F.col("_w")).alias("_r"), ratio(F.lit(1.0)).alias("_even"))
    mean = lambda c: F.try_divide(F.sum(F.col(c) * F.col("_n")), F.sum("_n"))
    whole = per.agg(F.struct((F.sum("_w") > 0).alias("paid"), mean("_r").alias("r"), mean("_even").alias("even"))).scalar()
    own, average = F.when(whole["paid"], F.col("_r")).otherwise(F.col("_even")), F.when(whole["paid"], whole["r"]).otherwise(whole["even"])
    weights = per.select("id", F.when(average > 0, own / average).otherwise(own).alias("row_weight"))
    return train.join(weights, "id", "left")


def weighted(series: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """wrmsse for each of `by` from rows (scale, mse, weight): series with scale 0 are out, weights are
    renormalised, equal if all are 0; a missing error makes the score NaN."""
    valid = series.where("scale > 0")
    term = F.col("weight") * F.sqrt(F.coalesce(F.col("mse"), F.lit(float("nan"))) / F.col("scale"))
    even = F.sqrt(F.coalesce(F.col("mse"), F.lit(float("nan"))) / F.col("scale"))
    score = F.when(F.sum("weight") > 0, F.try_divide(F.sum(term), F.sum("weight"))).otherwise(F.avg(even))
    return valid.groupBy(*by).agg(score.alias("wrmsse"), F.count(F.lit(1)).alias("n_series"))


def exploded(df: DataFrame, levels: Sequence[tuple[str, Sequence[str]]], *keep: str) -> DataFrame:
    """Each row once for each level: level, key and the kept columns."""
    pairs = F.array(*(F.struct(F.lit(n).alias("level"), (F.concat_ws("\x1f", *k) if k else F.lit("all")).alias("key")) for n, k in levels))
    return df.select(F.explode(pairs).alias("_at"), *keep).select("_at.level", "_at.key", *keep)


def usable_levels(df: DataFrame, levels: Sequence[tuple[str, Sequence[str]]] = TWELVE_LEVELS) -> list[tuple[str, Sequence[str]]]:
    """The levels whose key columns df has; ValueError without any."""
    usable = [(n, k) for n, k in levels if set(k) <= set(df.columns)]
    if not usable:
        raise ValueError("no level can be formed from the columns given")
    return usable


def by_level(df: DataFrame, levels: Sequence[tuple[str, Sequence[str]]], date: str, **sums: Column) -> DataFrame:
    """level, key, date and sums for each level whose key columns exist. Levels without items are summed from
    rows that were summed over items first, so that only the levels with items see every row."""
    usable = usable_levels(df, levels)
    fine = [(n, k) for n, k in usable if {"id", "item_id"} & set(k)]
    coarse = [(n, k) for n, k in usable if not {"id", "item_id"} & set(k)]
    add = lambda rows, *by: rows.groupBy(*by, "date").agg(*(F.sum(c).alias(c) for c in sums))
    out = None
    for some in (fine, coarse):
        if not some:
            continue
        keys = sorted({c for _, k in some for c in k})
        rows = df.select(*keys, F.col(date).alias("date"), *(c.alias(n) for n, c in sums.items()))
        rows = exploded(add(rows, *keys) if some is coarse else rows, some, "date", *sums)
        out = rows if out is None else out.unionByName(rows)
    return add(out, "level", "key")


def hierarchical_wrmsse(train: DataFrame, evaluation: DataFrame, days: int = 28, levels: Sequence[tuple[str, Sequence[str]]] = TWELVE_LEVELS, y: str = "sales", p: str = "prediction", price: str = "sell_price", date: str = "date") -> DataFrame:
    """level, wrmsse, n_series of each level that the columns allow. Evaluation keys without history are
    left out; a key that lacks a day of the evaluation, or all of whose values on a day are null, makes its
    level NaN. A level none of whose keys has a scale gives no row (overall() refuses that)."""
    last = train.agg(F.max(date)).scalar()
    # decimals make dollar sums exact in any order
    value = dollars(train, days, last, y, price, date).cast("decimal(38,10)")
    history = by_level(train, levels, date, y=F.col(y), v=value)
    per = scales(history, ["level", "key"], "y").join(history.groupBy("level", "key").agg(F.sum("v").cast("double").alias("weight")), ["level", "key"])
    cells = by_level(evaluation, levels, date, y=F.col(y), p=F.col(p))
    n_days = evaluation.agg(F.count_distinct(date)).scalar()
    square = F.pow(F.col("y") - F.col("p"), 2)
    errors = cells.groupBy("level", "key").agg(F.when(F.count(square) == n_days, F.avg(square)).alias("mse"))
    return weighted(per.join(errors, ["level", "key"], "left"), ["level"])


def overall(scores: DataFrame, levels: int | None = None) -> float:
    """The mean of the levels' scores; ValueError where no level, or not each of so many, has a score."""
    row = scores.agg(F.avg("wrmsse"), F.count(F.lit(1))).first()
    if not row[1] or (levels is not None and row[1] < levels):
        raise ValueError("a level has no series with a scale, so its scaled error is undefined")
    return float(row[0])


def record(train: DataFrame, evaluation: DataFrame, y: str = "sales", p: str = "prediction", season: int = 7, order: Sequence[str] = ("id", "date")) -> DataFrame:
    """One row: pooled() with mase (the mean absolute error over the mean seasonal step of all training series)
    and the series-level wrmsse."""
    *by, last = order
    step = train.withColumn("_step", F.abs(F.col(y) - F.lag(y, season).over(Window.partitionBy(*by).orderBy(last))))
    scale = step.agg(F.avg("_step")).scalar()
    error = hierarchical_wrmsse(train, evaluation, levels=[("series", ("id",))], y=y, p=p, date=last).select("wrmsse").scalar()
    return pooled(evaluation, y, p, order).withColumns({"mase": mase(F.col("mae"), scale), "wrmsse": error})


def score(train: DataFrame, evaluation: DataFrame, y: str = "sales", p: str = "prediction") -> dict:
    """12-level and series-level weighted scaled error, rmse, mae, and each level's score."""
    levels = {r.level: r.wrmsse for r in hierarchical_wrmsse(train, evaluation, y=y, p=p).collect()}
    if not levels:
        raise ValueError("no series has a scale, so the scaled error is undefined")
    point = evaluation.agg(rmse(y, p).alias("rmse"), mae(y, p).alias("mae")).first()
    return {"wrmsse": sum(levels.values()) / len(levels), "wrmsse_series_level": levels.get("series"), "rmse": point.rmse, "mae": point.mae, "wrmsse_by_level": {k: round(v, 6) for k, v in levels.items()}}
