"""The demand panel: one row for each series and day, from the order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

IDS = ("id", "item_id", "dept_id", "cat_id", "store_id", "state_id")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def densify(rows: DataFrame, keys: list[str], date: str = "date") -> DataFrame:
    """Every day from the first to the last in rows, for each combination of keys. The days are a generated
    sequence for each series, not a join."""
    ends = rows.agg(F.min(date).alias("lo"), F.max(date).alias("hi")).first()
    series = rows.select(*keys).distinct()
    if ends.lo is None:
        return series.withColumn(date, F.lit(None).cast("date"))
    return series.withColumn(date, F.explode(F.sequence(F.lit(ends.lo), F.lit(ends.hi))))


def fill_forward(value: str, keys: list[str], date: str = "date") -> F.Column:
    """The last non-null value up to each row."""
    over = Window.partitionBy(*keys).orderBy(date).rowsBetween(Window.unboundedPreceding, 0)
    return F.last(value, ignorenulls=True).over(over)


def hierarchy(item: str = "item_id") -> dict[str, F.Column]:
    """Departments and categories of items: fixed buckets."""
    i = F.col(item)
    return {
        "dept_id": F.when(i.isin("SMALL", "MEDIUM"), "SIZED_1").when(i == "LARGE", "SIZED_2").when(i.isin("STANDARD", "ECONOMY"), "GENERAL_1").otherwise("GENERAL_2"),
        "cat_id": F.when(i.isin("SMALL", "MEDIUM", "LARGE"), "SIZED").otherwise("GENERAL"),
    }


def sold(spark: SparkSession, sf_dir: str, since: str | None = None) -> DataFrame:
    """item_id, store_id, state_id, date, qty, day_price of days with sales. Dates and columns are pruned in
    the scan; only the region and nation tables, whose sizes are fixed, are broadcast by hint."""
    day = F.col("l_shipdate").cast("date")
    lines = table(spark, sf_dir, "lineitem")
    if since is not None:
        lines = lines.where(F.col("l_shipdate") >= F.lit(since).cast("timestamp_ntz"))
    lines = lines.where(F.col("l_shipdate").isNotNull()).select("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", day.alias("date"))
    part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("item_id"))
    nation = table(spark, sf_dir, "nation").join(F.broadcast(table(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    nation = nation.select("n_nationkey", F.col("n_name").alias("store_id"), F.col("r_name").alias("state_id"))
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey").join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey"))
    joined = lines.join(part, F.col("l_partkey") == F.col("p_partkey")).join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    # decimal sums are exact in any order
    return joined.groupBy("item_id", "store_id", "state_id", "date").agg(
        F.sum("l_quantity").alias("qty"),
        (F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double") / F.sum("l_quantity")).alias("day_price"),
    )


def demand_panel(spark: SparkSession, sf_dir: str, since: str | None = None) -> DataFrame:
    """id, item_id, dept_id, cat_id, store_id, state_id, date, sales, sell_price: dense by day; sales 0
    without a line, the price carried forward from the last day with one. since: drop what was shipped before."""
    found = sold(spark, sf_dir, since)
    grid = densify(found, ["item_id", "store_id", "state_id"])
    rows = grid.join(found, ["item_id", "store_id", "state_id", "date"], "left")
    rows = rows.withColumns({
        "id": F.concat_ws("_", "item_id", "store_id"), "sales": F.coalesce("qty", F.lit(0.0)),
        "sell_price": fill_forward("day_price", ["item_id", "store_id"]), **hierarchy(),
    })
    return rows.select(*IDS, "date", "sales", "sell_price")
