"""Masks, splits, missing values, clipping, and the learned feature list."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.sources.panel import fill_forward

#: Columns that are never features.
NOT_FEATURES = ("d", "wm_yr_wk", "weekday", "wday")


def hide_after(df: DataFrame, origin: date, target: str = "sales", day: str = "date") -> DataFrame:
    """Null targets after the origin, so features can't see them."""
    return df.withColumn(target, F.when(F.col(day) > F.lit(origin), None).otherwise(F.col(target)))


def split_label(origin: date, validation_days: int, day: str = "date") -> Column:
    """fit, validation or test: before, within and after the validation days that end at the origin."""
    start = origin - timedelta(validation_days - 1)
    return F.when(F.col(day) < F.lit(start), "fit").when(F.col(day) <= F.lit(origin), "validation").when(F.col(day).isNotNull(), "test")


def split(df: DataFrame, origin: date, validation_days: int, day: str = "date") -> tuple[DataFrame, DataFrame, DataFrame]:
    start = origin - timedelta(validation_days - 1)
    d = F.col(day)
    return df.where(d < F.lit(start)), df.where(d.between(F.lit(start), F.lit(origin))), df.where(d > F.lit(origin))


def reattach(features: DataFrame, actuals: DataFrame, target: str = "sales", keys: Sequence[str] = ("id", "date")) -> DataFrame:
    """Features with the target taken from actuals."""
    return features.drop(target).join(actuals.select(*keys, target), list(keys), "left")


def fill_zero(value: str = "sales") -> Column:
    return F.coalesce(F.col(value), F.lit(0.0))


def clip(value: str, upper: float | Column) -> Column:
    """Between 0 and upper; null stays null."""
    upper = upper if isinstance(upper, Column) else F.lit(upper)
    return F.when(F.col(value).isNull(), None).otherwise(F.greatest(F.lit(0.0), F.least(F.col(value), upper)))


def nearest_quantile(df: DataFrame, value: str, q: float) -> float | None:
    """The value whose rank from 0 is nearest to q(n-1), halves up: an element, found by exact percentiles
    of ranks, which Spark keeps as counts of distinct values."""
    n = df.agg(F.count(value).alias("n")).first().n
    if not n:
        return None
    rank = int(q * (n - 1) + 0.5)
    # percentile_disc takes the least value with at least that share of values up to it
    return df.agg(F.expr(f"percentile_disc({min(1.0, (rank + 0.5) / n)!r}D) WITHIN GROUP (ORDER BY {value})").alias("x")).first().x


def shrunk(df: DataFrame) -> DataFrame:
    """Long columns in the least signed type that holds their values; doubles as floats."""
    longs = [c for c, t in df.dtypes if t == "bigint"]
    ends = df.agg(*(f(c).alias(f"{n}{k}") for k, c in enumerate(longs) for n, f in (("lo", F.min), ("hi", F.max)))).first() if longs else None
    kinds: dict[str, str] = {c: "float" for c, t in df.dtypes if t == "double"}
    for k, c in enumerate(longs):
        lo, hi = ends[f"lo{k}"], ends[f"hi{k}"]
        if lo is not None:
            kinds[c] = next((t for t, bits in (("tinyint", 7), ("smallint", 15), ("int", 31)) if -(1 << bits) <= lo and hi < 1 << bits), "bigint")
    return df.withColumns({c: F.col(c).cast(t) for c, t in kinds.items()})


def frame_size(df: DataFrame) -> dict[str, float]:
    """The optimiser's size estimate, rows, columns and bytes a row."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    rows = df.count()
    return {"total_mb": size / 2**20, "rows": rows, "columns": len(df.columns), "bytes_per_row": size / rows if rows else 0}


@dataclass
class Preprocessor:
    """fill: zero, forward_fill or none ('interpolate' changes nothing, as no rule for it exists)."""

    fill: str = "zero"
    clip_outliers: bool = True
    quantile: float = 0.99
    normalize_prices: bool = False
    learned: dict = field(default_factory=dict)

    def fit(self, df: DataFrame) -> Preprocessor:
        self.learned = {"caps": {}}
        if self.clip_outliers:
            self.learned["caps"] = {c: nearest_quantile(df, c, self.quantile) for c in ("sales", "sell_price") if c in df.columns}
        if self.normalize_prices and "sell_price" in df.columns:
            self.learned["price"] = tuple(df.agg(F.avg("sell_price"), F.stddev_samp("sell_price")).first())
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        if "sales" in df.columns and self.fill == "zero":
            df = df.withColumn("sales", fill_zero())
        elif "sales" in df.columns and self.fill == "forward_fill":
            df = df.withColumn("sales", fill_forward("sales", ["id"]))
        if "sell_price" in df.columns:
            df = df.withColumn("sell_price", fill_forward("sell_price", ["item_id", "store_id"]))
        df = df.withColumns({c: clip(c, cap) for c, cap in self.learned.get("caps", {}).items() if c in df.columns and cap is not None})
        mean, sd = self.learned.get("price", (None, None))
        if sd:
            df = df.withColumn("sell_price_normalized", (F.col("sell_price") - mean) / sd)
        return shrunk(df)


# --- learned feature list --------------------------------------------------------------------------------


def candidates(df: DataFrame, target: str = "sales", group: str = "id", day: str = "date") -> list[str]:
    return [c for c in df.columns if c not in {*NOT_FEATURES, target, group, day}]


def constant_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Columns with at most one distinct non-null value, by one pass of minima and maxima."""
    if not columns:
        return []
    ends = df.agg(*(f(F.col(c)).alias(f"{n}{k}") for k, c in enumerate(columns) for n, f in (("lo", F.min), ("hi", F.max)))).first()
    return [c for k, c in enumerate(columns) if ends[f"lo{k}"] is None or ends[f"lo{k}"] == ends[f"hi{k}"]]


def no_infinities(df: DataFrame, target: str = "sales") -> DataFrame:
    """NaN and infinities of floating columns, but the target's, as null."""
    bad = lambda c: F.isnan(c) | F.col(c).isin(float("inf"), float("-inf"))
    return df.withColumns({c: F.when(bad(c), None).otherwise(F.col(c)) for c, t in df.dtypes if t in ("double", "float") and c != target})


def as_floats(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("float") for c, t in df.dtypes if t == "double" and c not in keep})


def model_input(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The listed columns in order: strings as they are, all others as floats."""
    kinds = dict(df.dtypes)
    return df.select(*(F.col(c) if kinds[c] == "string" else F.col(c).cast("float").alias(c) for c in columns))


@dataclass
class Engineer:
    """Builds all feature groups; fit learns which columns are constant, transform drops the same ones."""

    horizon: int = 28
    fill_null: float | None = None
    float32: bool = True
    dropped: list[str] | None = None
    names: list[str] = field(default_factory=list)

    def build(self, df: DataFrame) -> DataFrame:
        from tidewright.operators import features as X

        df = X.temporal_features(df, X.Temporal(min_lag=self.horizon))
        df = X.hierarchy_features(X.price_features(df), X.Hierarchy(min_lag=self.horizon))
        df = no_infinities(df)
        if self.fill_null is not None:
            numeric = [c for c, t in df.dtypes if t in ("double", "float", "int", "bigint", "tinyint", "smallint") and c != "sales"]
            df = df.fillna(self.fill_null, numeric)
        return as_floats(df, keep=("sales",)) if self.float32 else df

    def fit_transform(self, df: DataFrame) -> DataFrame:
        made = self.build(df)
        self.dropped = constant_columns(made, candidates(made))
        made = made.drop(*self.dropped)
        self.names = candidates(made)
        return made

    def transform(self, df: DataFrame) -> DataFrame:
        if self.dropped is None:
            raise RuntimeError("fit the engineer first")
        return self.build(df).drop(*self.dropped)


def feature_groups(names: Sequence[str]) -> dict[str, list[str]]:
    """Feature names by kind, by their patterns."""
    out: dict[str, list[str]] = {k: [] for k in ("lag", "rolling", "price", "calendar", "hierarchy", "other")}
    for n in names:
        kind = (
            "hierarchy" if "_agg_" in n or n.startswith("share_of_")
            else "price" if "price" in n or n in ("is_promotion", "is_deep_discount")
            else "rolling" if "_roll_" in n or "expanding" in n or "zero_days" in n
            else "lag" if "_lag_" in n
            else "calendar" if n.startswith(("day_", "week_", "month", "quarter", "year", "is_", "days_", "event_", "snap"))
            else "other"
        )
        out[kind].append(n)
    return out
