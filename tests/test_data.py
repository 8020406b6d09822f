from datetime import UTC, date, datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewright.operators import prepare, validate
from tidewright.operators.store import FeatureStore
from tidewright.plans.config import load_config
from tidewright.sources import loader
from tidewright.sources.synthetic import Synthetic

SMALL = Synthetic(n_items=3, n_stores=5, n_days=40, seed=7)


def test_synthetic_tables_agree(spark):
    sales, calendar, prices = SMALL.all(spark)
    assert sales.count() == 600 and calendar.count() == 40 and sales.agg(F.count_distinct("id")).first()[0] == 15
    assert prices.count() == 15 * calendar.select("wm_yr_wk").distinct().count()
    assert sorted(sales.collect()) == sorted(SMALL.sales(spark).repartition(5).collect())
    assert sorted(sales.collect()) != sorted(Synthetic(n_items=3, n_stores=5, n_days=40, seed=8).sales(spark).collect())
    panel = SMALL.panel(spark)
    assert panel.where("sell_price is null or date is null").isEmpty() and not [c for c in panel.columns if c.startswith("snap_")]


def test_demand_falls_with_price(spark):
    panel = Synthetic(n_items=14, n_stores=4, n_days=60, promotions=0.3, discount=0.4).panel(spark)
    per = panel.withColumn("full", F.max("sell_price").over(__import__("pyspark.sql", fromlist=["Window"]).Window.partitionBy("id")))
    got = {r.cut: r.m for r in per.groupBy((F.col("sell_price") < 0.8 * F.col("full")).alias("cut")).agg(F.avg("sales").alias("m")).collect()}
    assert got[True] > got[False]


def test_wide_and_long(spark):
    sales = SMALL.sales(spark)
    wide = loader.to_wide(sales)
    assert wide.columns[-1] == "d_40" and wide.columns[6] == "d_1"
    key = lambda df: sorted((r.id, r.d, float(r.sales)) for r in df.collect())
    assert key(loader.to_long(wide)) == key(sales) == key(loader.to_long(sales))


def test_files_round_trip(spark, tmp_path):
    SMALL.write(spark, str(tmp_path))
    files = loader.Loader(spark, str(tmp_path))
    key = lambda df: sorted((r.id, r.date, r.sales, r.snap, round(r.sell_price, 2)) for r in df.collect())
    assert key(files.all()) == key(SMALL.panel(spark))
    assert files.all(["TX_1"]).select("store_id").distinct().collect()[0][0] == "TX_1"
    with pytest.raises(ValueError, match="No sales rows found"):
        files.all(["XX_9"])
    with pytest.raises(FileNotFoundError, match="--smoke"):
        loader.Loader(spark, str(tmp_path / "none")).sales()
    with pytest.raises(ValueError):
        loader.scan(spark, __file__)


def test_own_state_snap(spark):
    df = spark.createDataFrame([("CA", 1, 0), ("TX", 1, 0), ("NY", 1, 1)], "state_id string, snap_CA long, snap_TX long")
    assert {r.state_id: r.snap for r in loader.own_snap(df).collect()} == {"CA": 1, "TX": 0, "NY": 0}


def test_ingest_turns_nan_into_null(spark):
    assert loader.ingest(spark, pd.DataFrame({"x": [1.0, float("nan")]})).where("x is null").count() == 1


def sales(spark, n=60, **columns):
    rows = [("a", "i", "s", date(2024, 1, 1) + timedelta(k), float(k % 5)) for k in range(n)]
    return spark.createDataFrame(rows, "id string, item_id string, store_id string, date date, sales double")


def test_validation(spark):
    assert validate.validate(sales(spark)).is_valid
    short = validate.validate(sales(spark, 10))
    assert any("Insufficient history: 9 days" in e for e in short.errors)
    bad = sales(spark).withColumn("sales", F.when(F.col("sales") == 0, -1.0).otherwise(F.col("sales")))
    found = validate.validate(bad)
    assert "Schema error in column 'sales': check" in found.errors and any("negative" in e for e in found.errors)
    again = sales(spark).union(sales(spark, 3))
    assert any("Found 3 duplicate id/date rows" in e for e in validate.validate(again).errors)
    assert "Missing required column 'item_id'" in validate.validate(sales(spark).drop("item_id")).errors
    nulls = validate.validate(sales(spark).withColumn("extra", F.lit(None).cast("double")))
    assert nulls.is_valid and any("extra" in w for w in nulls.warnings)
    with pytest.raises(ValueError):
        validate.validate(bad, raise_on_error=True)
    with pytest.raises(ValueError):
        validate.validate(bad, "other")


def test_feature_validation(spark):
    df = spark.createDataFrame([(1.0, 1.0, 2.0), (float("inf"), 1.0, 4.0), (2.0, 1.0, 6.0)], "a double, b double, c double").withColumn("d", F.col("c") * 2)
    found = validate.validate_features(df)
    assert not found.is_valid and any("'a' contains 1" in e for e in found.errors) and any("'b' has zero variance" in w for w in found.warnings) and any("'c' and 'd'" in w for w in found.warnings)


def test_preparation(spark):
    df = sales(spark).withColumns({"sell_price": F.when(F.dayofmonth("date") % 2 == 1, F.col("sales") + 1), "n": F.lit(300).cast("long")})
    made = prepare.Preprocessor(quantile=0.5, normalize_prices=True).fit(df).transform(df)
    assert dict(made.dtypes)["n"] == "smallint" and dict(made.dtypes)["sales"] == "float" and "sell_price_normalized" in made.columns
    assert made.agg(F.max("sales")).first()[0] == 2.0 and made.where("sell_price is null").count() == 0
    assert prepare.nearest_quantile(spark.createDataFrame([(float(x),) for x in range(1, 6)], "x double"), "x", 0.99) == 5.0
    assert prepare.frame_size(df)["rows"] == 60
    one = prepare.split(df, date(2024, 2, 9), 10)
    assert [x.count() for x in one] == [30, 10, 20]


def test_store(spark, tmp_path):
    store = FeatureStore(spark, str(tmp_path))
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 3.0)], "id string, x double")
    first = store.save("f", df, "v1")
    with pytest.raises(FileExistsError):
        store.save("f", df, "v1")
    second = store.save("f", df.withColumn("y", F.lit(1)), "v2", {"k": 1})
    assert first["rows"] == 3 and first["hash"] == FeatureStore.content_hash(df.orderBy(F.desc("id"))) != second["hash"]
    assert store.load("f").columns == ["id", "x", "y"] and store.load("f", "v1", ["x"]).columns == ["x"]
    assert store.load_as_of("f", datetime.fromisoformat(first["saved"]), ["a"]).count() == 1
    with pytest.raises(FileNotFoundError):
        store.load_as_of("f", datetime(2000, 1, 1, tzinfo=UTC))
    assert store.list() == {"f": ["v1", "v2"]} and store.metadata("f")["parameters"] == {"k": 1}
    store.delete("f", "v2")
    assert store.latest("f") == "v1"
    store.delete("f")
    with pytest.raises(FileNotFoundError):
        store.load("f")


def test_config(tmp_path):
    (tmp_path / "c.yaml").write_text("train: {horizon: 14}\n")
    (tmp_path / "prod.yaml").write_text("data: {folder: /x}\n")
    c = load_config(str(tmp_path / "c.yaml"), "prod", {"TIDEWRIGHT_MODEL__TREES": "7", "TIDEWRIGHT_TRAIN__SMOKE": "true"})
    assert (c.train.horizon, c.data.folder, c.model.trees, c.train.smoke, c.environment) == (14, "/x", 7, True, "prod")
    with pytest.raises(ValueError):
        load_config(env={"TIDEWRIGHT_MODEL__LEARNING_RATE": "2"})
    with pytest.raises(FileNotFoundError):
        load_config(str(tmp_path / "none.yaml"), env={})


def test_daily_demand_of_a_stream(spark, tmp_path):
    from tidewright.streaming.demand import daily_demand

    rows = [(datetime(2024, 1, 1, 5), "a", 1.0), (datetime(2024, 1, 1, 9), "a", 2.0), (datetime(2024, 1, 9), "b", 4.0)]
    spark.createDataFrame(rows, "ts timestamp, event_type string, value double").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("ts timestamp, event_type string, value double").parquet(f"{tmp_path}/in")
    q = daily_demand(stream).writeStream.outputMode("update").format("memory").queryName("demand").start()
    q.processAllAvailable()
    q.stop()
    assert sorted((r.event_type, r.n, r.total) for r in spark.table("demand").collect()) == [("a", 2, 3.0), ("b", 1, 4.0)]
