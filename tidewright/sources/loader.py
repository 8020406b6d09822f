"""Reading, reshaping and writing retail sales, calendar and price files."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ID_COLUMNS = ("id", "item_id", "dept_id", "cat_id", "store_id", "state_id")
#: The columns of the calendar and price files and their types.
CALENDAR = "date string, wm_yr_wk long, weekday string, wday long, month long, year long, d string, event_name_1 string, event_type_1 string, event_name_2 string, event_type_2 string, snap_CA long, snap_TX long, snap_WI long"
PRICES = "store_id string, item_id string, wm_yr_wk long, sell_price double"


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def scan(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A lazy scan of a .parquet or .csv path. CSV files without a schema are read as strings."""
    if not _exists(spark, path):
        raise FileNotFoundError(f"{path} not found. Put the files there, or use --smoke for synthetic data.")
    if path.endswith(".parquet"):
        return spark.read.parquet(path)
    if path.endswith(".csv"):
        reader = spark.read.option("header", True)
        return reader.schema(schema).csv(path) if schema else reader.csv(path)
    raise ValueError(f"Unsupported file type: {path}")


def as_date(df: DataFrame, column: str = "date") -> DataFrame:
    """Texts yyyy-MM-dd, timestamps and dates as dates."""
    kind = dict(df.dtypes)[column]
    return df.withColumn(column, F.to_date(column, "yyyy-MM-dd") if kind == "string" else F.col(column).cast("date"))


def day_columns(df: DataFrame) -> list[str]:
    """Columns d_1, d_2, ... in the order of their numbers."""
    return sorted((c for c in df.columns if c.startswith("d_") and c[2:].isdigit()), key=lambda c: int(c[2:]))


def to_long(sales: DataFrame) -> DataFrame:
    """One row for each series and day; long input passes through. Sales become doubles, so they can be hidden."""
    days = day_columns(sales)
    if days and "d" not in sales.columns:
        ids = [c for c in sales.columns if c not in set(days)]
        sales = sales.unpivot(ids, [F.col(d).cast("double").alias(d) for d in days], "d", "sales")
    return sales.withColumn("sales", F.col("sales").cast("double"))


def to_wide(sales: DataFrame, days: Sequence[str] | None = None) -> DataFrame:
    """One column for each day, in the order of the days' numbers. Known days save a pass over the data."""
    if days is None:
        days = [r.d for r in sales.select("d").distinct().orderBy(F.substring("d", 3, 20).cast("int")).collect()]
    ids = [c for c in ID_COLUMNS if c in sales.columns]
    return sales.groupBy(*ids).pivot("d", list(days)).agg(F.first("sales"))


def own_snap(df: DataFrame, state: str = "state_id") -> DataFrame:
    """snap: the value of the column snap_XX of the row's own state, 0 without one; the snap_ columns go."""
    flags = [c for c in df.columns if c.startswith("snap_")]
    if not flags or state not in df.columns:
        return df
    value = F.lit(None).cast("int")
    for c in flags:
        value = F.when(F.col(state) == c.removeprefix("snap_"), F.col(c).cast("int")).otherwise(value)
    return df.withColumn("snap", F.coalesce(value, F.lit(0)).cast("tinyint")).drop(*flags)


def merge(sales: DataFrame, calendar: DataFrame, prices: DataFrame) -> DataFrame:
    """Sales with their calendar day and weekly price, by left joins. The calendar has one row a day; whether
    it is broadcast is left to its size."""
    return own_snap(as_date(sales.join(calendar, "d", "left").join(prices, ["store_id", "item_id", "wm_yr_wk"], "left")))


@dataclass
class Loader:
    """Files of one folder. stores: read only these, filtered in the scan."""

    spark: SparkSession
    folder: str
    sales_file: str = "sales_train_evaluation.csv"
    calendar_file: str = "calendar.csv"
    prices_file: str = "sell_prices.csv"

    def _of(self, df: DataFrame, stores: Sequence[str] | None) -> DataFrame:
        return df.where(F.col("store_id").isin(list(stores))) if stores else df

    def sales(self, stores: Sequence[str] | None = None) -> DataFrame:
        return to_long(self._of(scan(self.spark, f"{self.folder}/{self.sales_file}"), stores))

    def calendar(self) -> DataFrame:
        path = f"{self.folder}/{self.calendar_file}"
        found = scan(self.spark, path)
        kinds = dict(x.strip().split(" ") for x in CALENDAR.split(","))
        return as_date(found.select(*(F.col(c).cast(kinds.get(c, t)).alias(c) if t == "string" else c for c, t in found.dtypes)))

    def prices(self, stores: Sequence[str] | None = None) -> DataFrame:
        return self._of(scan(self.spark, f"{self.folder}/{self.prices_file}", PRICES), stores)

    def all(self, stores: Sequence[str] | None = None) -> DataFrame:
        sales = self.sales(stores)
        if sales.isEmpty():
            raise ValueError(f"No sales rows found for stores {list(stores) if stores else 'of any name'}")
        return merge(sales, self.calendar(), self.prices(stores))


def write_files(sales: DataFrame, calendar: DataFrame, prices: DataFrame, folder: str, loader: Loader | None = None) -> None:
    """Sales as one row a series, calendar and prices, as CSV with headers, in the loader's layout."""
    names = (loader or Loader(sales.sparkSession, folder))
    wide = to_wide(sales.withColumn("sales", F.col("sales").cast("int")))
    for df, name in ((wide, names.sales_file), (calendar, names.calendar_file), (prices, names.prices_file)):
        df.write.mode("overwrite").option("header", True).csv(f"{folder}/{name}")


def ingest(spark: SparkSession, data) -> DataFrame:
    """A Spark frame as it is; a pandas frame with NaN as null."""
    if isinstance(data, DataFrame):
        return data
    df = spark.createDataFrame(data)
    return df.withColumns({c: F.when(F.isnan(c), None).otherwise(F.col(c)) for c, t in df.dtypes if t in ("double", "float")})
