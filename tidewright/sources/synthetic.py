"""A seeded synthetic retail panel: sales, calendar and prices that agree with each other.

Every value is a function of the seed and of the row's own key (hashes give the uniforms), so the same rows
come out however the work is split.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date, timedelta

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.functions.calendar import week_label
from tidewright.sources.loader import merge, write_files

#: The layout's states, categories and departments.
STATES = ("CA", "TX", "WI")
STORES = ("CA_1", "CA_2", "CA_3", "CA_4", "TX_1", "TX_2", "TX_3", "WI_1", "WI_2", "WI_3")
DEPARTMENTS = ("FOODS_1", "FOODS_2", "FOODS_3", "HOBBIES_1", "HOBBIES_2", "HOUSEHOLD_1", "HOUSEHOLD_2")
EVENTS = (("SuperBowl", "Sporting"), ("Easter", "Religious"), ("LaborDay", "National"), ("Halloween", "Cultural"))


def uniform(seed: int, what: str, *keys: str) -> Column:
    """A number in (0, 1) from the seed, a name and key columns."""
    return (F.pmod(F.xxhash64(F.lit(seed), F.lit(what), *keys), F.lit(1 << 40)) + 0.5) / float(1 << 40)


def normal(seed: int, what: str, *keys: str) -> Column:
    """A standard normal by Box and Muller."""
    return F.sqrt(-2 * F.ln(uniform(seed, what + "/r", *keys))) * F.cos(2 * math.pi * uniform(seed, what + "/a", *keys))


@dataclass(frozen=True)
class Synthetic:
    n_items: int = 21
    n_stores: int = 5
    n_days: int = 730
    seed: int = 42
    start: date = date(2011, 1, 29)
    promotions: float = 0.10
    discount: float = 0.20
    elasticity: float = 1.5

    def calendar(self, spark: SparkSession) -> DataFrame:
        """One row a day; about 5% have an event; snap days differ by state; second events are never set."""
        day = F.date_add(F.lit(self.start), F.col("id").cast("int"))
        df = spark.range(self.n_days).select(day.alias("date"), F.concat(F.lit("d_"), F.col("id") + 1).alias("d"))
        u, pick = uniform(self.seed, "event", "d"), F.pmod(F.xxhash64(F.lit(self.seed), "d"), F.lit(len(EVENTS)))
        name, kind = F.lit(None).cast("string"), F.lit(None).cast("string")
        for k, (n, t) in enumerate(EVENTS):
            name, kind = F.when((u < 0.05) & (pick == k), n).otherwise(name), F.when((u < 0.05) & (pick == k), t).otherwise(kind)
        none = F.lit(None).cast("string")
        df = df.withColumns({
            "wm_yr_wk": week_label("date"), "weekday": F.date_format("date", "EEEE"), "wday": (F.weekday("date") + 1).cast("long"), "month": F.month("date").cast("long"), "year": F.year("date").cast("long"),
            "event_name_1": name, "event_type_1": kind, "event_name_2": none, "event_type_2": none,
        })
        return df.withColumns({f"snap_{s}": (F.pmod(F.dayofmonth("date") + 3 * k, F.lit(3)) == 0).cast("long") * (F.dayofmonth("date") <= 15).cast("long") for k, s in enumerate(STATES)})

    def series(self, spark: SparkSession) -> DataFrame:
        n = min(self.n_stores, len(STORES))
        stores, departments = F.array(*map(F.lit, STORES[:n])), F.array(*map(F.lit, DEPARTMENTS))
        df = spark.range(self.n_items).select(F.col("id").alias("item"), F.element_at(departments, (F.pmod("id", F.lit(len(DEPARTMENTS))) + 1).cast("int")).alias("dept_id"), F.explode(stores).alias("store_id"))
        df = df.withColumns({"cat_id": F.split("dept_id", "_")[0], "item_id": F.concat_ws("_", "dept_id", F.lpad(F.col("item") + 1, 3, "0")), "state_id": F.split("store_id", "_")[0]})
        return df.select(F.concat_ws("_", "item_id", "store_id", F.lit("evaluation")).alias("id"), "item_id", "dept_id", "cat_id", "store_id", "state_id")

    def prices(self, spark: SparkSession) -> DataFrame:
        """Weekly prices: a regular one for each item and store, a discount in some weeks, a small wobble."""
        day = F.date_add(F.lit(self.start), F.col("day"))
        df = self.series(spark).select("store_id", "item_id", F.explode(F.sequence(F.lit(0), F.lit(self.n_days - 1), F.lit(7))).alias("day"))
        # every seventh day, and the last, name all weeks
        last = self.series(spark).select("store_id", "item_id", F.lit(self.n_days - 1).alias("day"))
        df = df.unionByName(last).withColumn("date", day).withColumn("wm_yr_wk", week_label("date")).select("store_id", "item_id", "wm_yr_wk").distinct()
        regular = F.greatest(F.lit(0.5), 5 + 2 * normal(self.seed, "regular", "item_id", "store_id"))
        cut = F.when(uniform(self.seed, "promotion", "item_id", "store_id", "wm_yr_wk") < self.promotions, 1 - self.discount).otherwise(1.0)
        wobble = 1 + 0.02 * (2 * uniform(self.seed, "wobble", "item_id", "store_id", "wm_yr_wk") - 1)
        return df.select("store_id", "item_id", "wm_yr_wk", F.round(regular * cut * wobble, 2).alias("sell_price"), regular.alias("_regular"))

    def sales(self, spark: SparkSession) -> DataFrame:
        """Poisson counts whose rate is base x season x weekday x event x snap x (price/regular)^-elasticity x
        noise; base and noise are gamma and log-normal."""
        days = self.series(spark).withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(self.n_days))))
        df = days.withColumn("d", F.concat(F.lit("d_"), "k")).drop("k").join(self.calendar(spark), "d").join(self.prices(spark), ["store_id", "item_id", "wm_yr_wk"], "left")
        season = 1 + 0.2 * F.sin(2 * math.pi * F.dayofyear("date") / 365.25)
        week = F.when(F.col("wday") >= 6, 1.3).otherwise(1.0)
        event = F.when(F.col("event_name_1").isNotNull(), 1.25).otherwise(1.0)
        own = sum((F.when((F.col("state_id") == s) & (F.col(f"snap_{s}") == 1) & (F.col("cat_id") == "FOODS"), 0.15).otherwise(0.0) for s in STATES), F.lit(1.0))
        price = F.pow(F.col("sell_price") / F.col("_regular"), -self.elasticity)
        noise = F.exp(0.1 * normal(self.seed, "noise", "id", "d"))
        key = F.xxhash64(F.lit(self.seed), "id")
        df = df.select("id", "item_id", "dept_id", "cat_id", "store_id", "state_id", "d", (season * week * event * own * price * noise).alias("rate"), key.alias("key"), F.xxhash64(F.lit(self.seed), "id", "d").alias("draw"))
        names = ["id", "item_id", "dept_id", "cat_id", "store_id", "state_id", "d", "sales"]

        def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            base: dict[int, float] = {}
            for batch in batches:
                rate, key, each = (batch.column(k).to_numpy() for k in (7, 8, 9))
                for k in np.unique(key):
                    if k not in base:
                        base[k] = float(np.random.default_rng(abs(int(k))).gamma(4.0, 0.25) * 4)
                lam = rate * np.array([base[k] for k in key])
                n = [int(np.random.default_rng(abs(int(s))).poisson(x)) for s, x in zip(each, lam)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:7], pa.array(n, pa.int64())], names)

        return df.mapInArrow(draw, ", ".join(f"{c} string" for c in names[:-1]) + ", sales long")

    def all(self, spark: SparkSession) -> tuple[DataFrame, DataFrame, DataFrame]:
        return self.sales(spark), self.calendar(spark), self.prices(spark).drop("_regular")

    def panel(self, spark: SparkSession) -> DataFrame:
        sales, calendar, prices = self.all(spark)
        return merge(sales.withColumn("sales", F.col("sales").cast("double")), calendar, prices)

    def write(self, spark: SparkSession, folder: str) -> None:
        write_files(*self.all(spark), folder)

    @property
    def last_day(self) -> date:
        return self.start + timedelta(self.n_days - 1)
