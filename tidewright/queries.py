"""Named queries over the driver's tables, and the SQL that each is checked against."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewright.functions import calendar as cal
from tidewright.operators import backtest, features as X, metrics as M, prepare, scoring, store, validate
from tidewright.sources import loader
from tidewright.sources.panel import demand_panel, fill_forward, table

#: Days held out, and the last day before them; the panel ends on the same day at every scale factor.
HORIZON = 28
KEYS = ["id", "date"]
PANEL_SQL = f"""panel AS (
WITH sold AS (
  SELECT p_type AS item_id, n_name AS store_id, r_name AS state_id, CAST(l_shipdate AS DATE) AS date, SUM(l_quantity) AS qty,
         CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / SUM(l_quantity) AS day_price
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  WHERE l_shipdate IS NOT NULL GROUP BY 1, 2, 3, 4),
days AS (SELECT CAST(UNNEST(GENERATE_SERIES(MIN(date), MAX(date), INTERVAL 1 DAY)) AS DATE) AS date FROM sold),
series AS (SELECT DISTINCT item_id, store_id, state_id FROM sold),
grid AS (SELECT s.item_id, s.store_id, s.state_id, d.date, COALESCE(x.qty, 0) AS sales, x.day_price
  FROM series s CROSS JOIN days d LEFT JOIN sold x ON x.item_id = s.item_id AND x.store_id = s.store_id AND x.date = d.date)
SELECT CONCAT(item_id, '_', store_id) AS id, item_id,
  CASE WHEN item_id IN ('SMALL','MEDIUM') THEN 'SIZED_1' WHEN item_id = 'LARGE' THEN 'SIZED_2' WHEN item_id IN ('STANDARD','ECONOMY') THEN 'GENERAL_1' ELSE 'GENERAL_2' END AS dept_id,
  CASE WHEN item_id IN ('SMALL','MEDIUM','LARGE') THEN 'SIZED' ELSE 'GENERAL' END AS cat_id, store_id, state_id, date, CAST(sales AS DOUBLE) AS sales,
  LAST_VALUE(day_price IGNORE NULLS) OVER (PARTITION BY item_id, store_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sell_price
FROM grid)"""
#: History, held-out days, and both naive forecasts.
SPLIT_SQL = f"""{PANEL_SQL}, origin AS (SELECT MAX(date) - {HORIZON} AS o FROM panel),
train AS (SELECT panel.* FROM panel, origin WHERE date <= o), test AS (SELECT panel.* FROM panel, origin WHERE date > o),
naive AS (SELECT test.*, COALESCE(w.sales, 0) AS prediction FROM test LEFT JOIN train w ON w.id = test.id AND w.date > (SELECT o FROM origin) - 7 AND ISODOW(w.date) = ISODOW(test.date)),
means AS (SELECT id, AVG(sales) AS m FROM train, origin WHERE date > o - 28 GROUP BY id),
average AS (SELECT test.*, COALESCE(m, 0) AS prediction FROM test LEFT JOIN means USING (id))"""

HALF = 0.50003

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with the SQL it is held against."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def r4(x: Column) -> Column:
    """Rounded to 4 decimals in a way that both engines do alike: sums in another order differ in the last bits,
    so the cut lies a little beside the half, where quotients of prices and quantities often are."""
    return F.floor(x * 10000 + HALF) / 10000


def s4(x: str) -> str:
    return f"FLOOR(({x}) * 10000 + {HALF}) / 10000"


def rounded(df: DataFrame, *keep: str) -> DataFrame:
    """All double columns but the kept ones by r4."""
    return df.select(*(r4(F.col(c)).alias(c) if t == "double" and c not in keep else F.col(c) for c, t in df.dtypes))


def flag(c: Column, name: str) -> Column:
    """Flags and counts that may be null as doubles, so that both engines' frames show them alike."""
    return (c.cast("double") if name.startswith(("is_", "price_decreased", "price_changed")) or name.endswith("_cum") else c).alias(name)


def parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, date]:
    """The panel, its history, its held-out days, and the origin between them."""
    panel = demand_panel(spark, sf_dir)
    origin = panel.agg(F.max("date")).first()[0] - timedelta(HORIZON)
    return panel, panel.where(F.col("date") <= F.lit(origin)), panel.where(F.col("date") > F.lit(origin)), origin


W = "(PARTITION BY id ORDER BY date"


def roll_sql(f: str, n: int, lag: int, x: str = "sales") -> str:
    frame = f"OVER {W} ROWS BETWEEN {lag + n - 1} PRECEDING AND {lag} PRECEDING)"
    call = {"mean": f"AVG({x})", "std": f"STDDEV_SAMP({x})", "min": f"MIN({x})", "max": f"MAX({x})", "median": f"QUANTILE_CONT({x}, 0.5)"}[f]
    return f"CASE WHEN COUNT({x}) {frame} = {n} THEN {call} {frame} END"


# --- panel, reading and reshaping ------------------------------------------------------------------------


@query(f"WITH {PANEL_SQL} SELECT * FROM panel")
def panel_build(spark, sf_dir):
    return demand_panel(spark, sf_dir)


@query("SELECT s_suppkey, s_name, s_acctbal FROM supplier WHERE s_nationkey IN (3, 7, 11)")
def store_filter_scan(spark, sf_dir):
    return table(spark, sf_dir, "supplier").where(F.col("s_nationkey").isin(3, 7, 11)).select("s_suppkey", "s_name", "s_acctbal")


#: Every day of the panel: a row for each series and 28 days, so that the number of columns is fixed.
_STRETCHES = "lo AS (SELECT MIN(date) AS lo FROM panel), stretches AS (SELECT id || '_' || (DATE_DIFF('day', lo, date) // 28) AS id, item_id, store_id, sales, 'd_' || (DATE_DIFF('day', lo, date) % 28 + 1) AS d FROM panel, lo)"


def _stretches(spark, sf_dir) -> DataFrame:
    panel = demand_panel(spark, sf_dir)
    day = F.datediff("date", F.lit(panel.agg(F.min("date")).first()[0]))
    return panel.select(F.concat_ws("_", "id", F.floor(day / 28)).alias("id"), "item_id", "store_id", F.concat(F.lit("d_"), day % 28 + 1).alias("d"), "sales")


_DAYS = [f"d_{k}" for k in range(1, 29)]


@query(f"WITH {PANEL_SQL}, {_STRETCHES} SELECT id, item_id, store_id, " + ", ".join(f"SUM(CASE WHEN d = '{d}' THEN sales END) AS {d}" for d in _DAYS) + " FROM stretches GROUP BY 1, 2, 3")
def long_to_wide(spark, sf_dir):
    return loader.to_wide(_stretches(spark, sf_dir), _DAYS)


@query(f"WITH {PANEL_SQL}, {_STRETCHES} SELECT id, item_id, store_id, d, sales FROM stretches")
def wide_to_long(spark, sf_dir):
    return loader.to_long(loader.to_wide(_stretches(spark, sf_dir), _DAYS)).where("sales is not null")  # days after the last


@query(f"""WITH {PANEL_SQL}, cal AS (SELECT 'd_' || ROW_NUMBER() OVER (ORDER BY date) AS d, date FROM (SELECT DISTINCT date FROM panel)),
snaps AS (SELECT d, date, ISOYEAR(date) * 100 + WEEKOFYEAR(date) AS week, DAY(date) % 2 AS asia, DAY(date) % 3 AS europe FROM cal),
prices AS (SELECT store_id, item_id, ISOYEAR(date) * 100 + WEEKOFYEAR(date) AS week, MAX(sell_price) AS week_price FROM panel WHERE DAY(date) % 7 <> 0 GROUP BY 1, 2, 3)
SELECT p.id, p.date, p.sales, CAST(CASE p.state_id WHEN 'ASIA' THEN asia WHEN 'EUROPE' THEN europe ELSE 0 END AS INT) AS snap, week_price AS sell_price
FROM panel p JOIN snaps s ON p.date = s.date LEFT JOIN prices w ON w.store_id = p.store_id AND w.item_id = p.item_id AND w.week = s.week""")
def own_state_snap(spark, sf_dir):
    """Sales joined to a calendar by day label and to weekly prices; each row gets its own state's flag."""
    panel = demand_panel(spark, sf_dir)
    lo = panel.agg(F.min("date")).first()[0]
    label = F.concat(F.lit("d_"), F.datediff("date", F.lit(lo)) + 1)
    week = cal.week_label("date")
    days = panel.select("date").distinct().select("date", label.alias("d"), week.alias("wm_yr_wk"), (F.dayofmonth("date") % 2).alias("snap_ASIA"), (F.dayofmonth("date") % 3).alias("snap_EUROPE"))
    prices = panel.where(F.dayofmonth("date") % 7 != 0).groupBy("store_id", "item_id", week.alias("wm_yr_wk")).agg(F.max("sell_price").alias("sell_price"))
    sales = panel.withColumn("d", label).drop("date", "sell_price")
    return loader.merge(sales, days, prices).select("id", "date", "sales", F.col("snap").cast("int"), "sell_price")


# --- masks and splits ------------------------------------------------------------------------------------


@query(f"WITH {SPLIT_SQL} SELECT id, date, CASE WHEN date > o THEN NULL ELSE sales END AS sales FROM panel, origin")
def mask_future(spark, sf_dir):
    panel, _, _, origin = parts(spark, sf_dir)
    return prepare.hide_after(panel, origin).select("id", "date", "sales")


@query(f"WITH {SPLIT_SQL} SELECT CASE WHEN date < o - 27 THEN 'fit' WHEN date <= o THEN 'validation' ELSE 'test' END AS part, COUNT(*) AS n, MIN(date) AS first_day, MAX(date) AS last_day, SUM(sales) AS sales FROM panel, origin GROUP BY 1")
def split_ranges(spark, sf_dir):
    panel, _, _, origin = parts(spark, sf_dir)
    return panel.groupBy(prepare.split_label(origin, 28).alias("part")).agg(F.count(F.lit(1)).alias("n"), F.min("date").alias("first_day"), F.max("date").alias("last_day"), F.sum("sales").alias("sales"))


@query(f"WITH {SPLIT_SQL} SELECT t.id, t.date, m.sell_price, t.sales FROM (SELECT id, date, sell_price FROM panel, origin WHERE date > o) m JOIN test t USING (id, date)")
def reattach_actuals(spark, sf_dir):
    panel, _, test, origin = parts(spark, sf_dir)
    hidden = prepare.hide_after(panel, origin).where(F.col("date") > F.lit(origin)).select("id", "date", "sell_price", "sales")
    return prepare.reattach(hidden, test)


# --- temporal windows ------------------------------------------------------------------------------------

_T = X.Temporal()
_lag = lambda k: f"LAG(sales, {k}) OVER {W})"


@query(f"WITH {PANEL_SQL} SELECT id, date, " + ", ".join(f"{_lag(k)} AS sales_lag_{k}, {_lag(k)} - {_lag(k + 7)} AS sales_lag_{k}_diff_7" for k in _T.usable) + " FROM panel")
def lag_features(spark, sf_dir):
    return demand_panel(spark, sf_dir).select(*KEYS, *(c.alias(n) for n, c in X.lag_columns(_T).items()))


def _rolling(stat: str, stats: tuple[str, ...] = ()):
    def run(spark, sf_dir):
        columns = X.rolling_columns(X.Temporal(statistics=stats or (stat,)))
        return rounded(demand_panel(spark, sf_dir).select(*KEYS, *(c.alias(n) for n, c in columns.items() if f"_{stat}_" in n)))

    run.__name__ = f"rolling_{stat}"
    cv = lambda n: f"({roll_sql('std', n, 28)}) / (({roll_sql('mean', n, 28)}) + 1e-8)"
    cells = ", ".join(f"{s4(cv(n) if stat == 'cv' else roll_sql(stat, n, 28))} AS sales_roll_{stat}_{n}" for n in _T.windows)
    query(f"WITH {PANEL_SQL} SELECT id, date, {cells} FROM panel")(run)


for _s in ("mean", "std", "min", "max", "cv"):
    _rolling(_s)

_UP = f"OVER {W} ROWS BETWEEN UNBOUNDED PRECEDING AND 28 PRECEDING)"


@query(f"WITH {PANEL_SQL} SELECT id, date, CASE WHEN {_lag(28)} IS NOT NULL THEN {s4(f'AVG(sales) {_UP}')} END AS sales_expanding_mean, CAST(CASE WHEN {_lag(28)} IS NOT NULL THEN SUM(CASE WHEN sales = 0 THEN 1 ELSE 0 END) {_UP} END AS DOUBLE) AS sales_zero_days_cum, CAST(ROW_NUMBER() OVER {W}) AS INT) AS time_idx FROM panel")
def expanding_features(spark, sf_dir):
    columns = X.expanding_columns(_T) | {"time_idx": X.time_index()}
    return rounded(demand_panel(spark, sf_dir).select(*KEYS, *(flag(c, n) for n, c in columns.items())))


# --- calendar --------------------------------------------------------------------------------------------

_DATES = "dates AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders)"


def _dates(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("date")).distinct()


@query(f"""WITH {_DATES} SELECT date, CAST(ISODOW(date) - 1 AS INT) AS day_of_week, CAST(DAY(date) AS INT) AS day_of_month, CAST(DAYOFYEAR(date) AS INT) AS day_of_year, CAST(WEEKOFYEAR(date) AS INT) AS week_of_year,
CAST(MONTH(date) AS INT) AS month, CAST(QUARTER(date) AS INT) AS quarter, CAST(YEAR(date) AS INT) AS year, CAST(ISODOW(date) >= 6 AS INT) AS is_weekend, CAST(DAY(date) = 1 AS INT) AS is_month_start,
CAST(DAY(date) <= 7 AS INT) AS is_month_first_week, CAST(DAY(date) >= 25 AS INT) AS is_month_end, CAST(ISOYEAR(date) * 100 + WEEKOFYEAR(date) AS BIGINT) AS wm_yr_wk FROM dates""")
def calendar_features(spark, sf_dir):
    return cal.add_calendar(_dates(spark, sf_dir), cyclical=False).withColumn("wm_yr_wk", cal.week_label("date"))


_CYC = (("day_of_week", "ISODOW(date) - 1", 7), ("day_of_month", "DAY(date)", 31), ("week_of_year", "WEEKOFYEAR(date)", 52), ("month", "MONTH(date)", 12))


@query(f"WITH {_DATES} SELECT date, " + ", ".join(f"{s4(f'{f}(2 * PI() * ({x}) / {n}.0)')} AS {c}_{f}" for c, x, n in _CYC for f in ("sin", "cos")) + " FROM dates")
def cyclical_features(spark, sf_dir):
    return rounded(_dates(spark, sf_dir).select("date", *(c.alias(n) for n, c in cal.cyclical_columns().items())))


_HOLIDAYS = ", ".join(f"('{c}', DATE '{d}')" for c in ("UK", "US") for d in cal.holidays(c, 1991, 2003))


def _holiday_sql(c: str) -> str:
    near = f"SELECT MIN(ABS(DATE_DIFF('day', dates.date, h.day))) FROM h WHERE country = '{c}'"
    return f"""CAST(EXISTS (SELECT 1 FROM h WHERE country = '{c}' AND h.day = dates.date) AS INT) AS is_holiday_{c},
CAST(COALESCE(({near} AND h.day > dates.date AND h.day <= dates.date + 14), -1) AS INT) AS days_to_holiday_{c},
CAST(COALESCE(({near} AND h.day < dates.date AND h.day >= dates.date - 14), -1) AS INT) AS days_from_holiday_{c}"""


@query(f"WITH {_DATES}, h AS (SELECT * FROM (VALUES {_HOLIDAYS}) AS t(country, day)) SELECT date, {_holiday_sql('UK')}, {_holiday_sql('US')} FROM dates")
def holiday_features(spark, sf_dir):
    return cal.add_holidays(_dates(spark, sf_dir))


# --- prices ----------------------------------------------------------------------------------------------

_P = X.Price()
_old = f"LAG(sell_price, 7) OVER {W})"


@query(f"WITH {PANEL_SQL}, x AS (SELECT *, {_old} AS old FROM panel) SELECT id, date, {s4('old')} AS price_lag_7, {s4('sell_price / NULLIF(old, 0)')} AS price_change_ratio_7, {s4('sell_price - old')} AS price_change_abs_7, CAST(CAST(sell_price < old AS INT) AS DOUBLE) AS price_decreased, CAST(CAST(ABS(sell_price - old) / NULLIF(old, 0) > 0.05 AS INT) AS DOUBLE) AS price_changed_significant FROM x")
def price_change(spark, sf_dir):
    return rounded(demand_panel(spark, sf_dir).select(*KEYS, *(flag(c, n) for n, c in X.price_change_columns(_P).items())))


def _price_sql(name: str, n: int) -> str:
    of = lambda f: f"({roll_sql(f, n, 0, 'sell_price')})"
    x = f"{of('std')} / ({of('mean')} + 1e-8)" if name == "volatility" else f"sell_price / NULLIF({of({'momentum': 'mean', 'vs_max': 'max', 'vs_min': 'min'}[name])}, 0)"
    return f"{s4(x)} AS price_{name}_{n}"


def _price_query(title: str, names: tuple[str, ...]):
    def run(spark, sf_dir):
        made = X.price_momentum_columns(_P)
        return rounded(demand_panel(spark, sf_dir).select(*KEYS, *(made[f"price_{x}_{n}"].alias(f"price_{x}_{n}") for x in names for n in _P.windows)))

    run.__name__ = title
    query(f"WITH {PANEL_SQL} SELECT id, date, " + ", ".join(_price_sql(x, n) for x in names for n in _P.windows) + " FROM panel")(run)


_price_query("price_momentum", ("momentum", "vs_max", "vs_min"))
_price_query("price_volatility", ("volatility",))


@query(f"WITH {PANEL_SQL}, x AS (SELECT *, {roll_sql('median', 28, 0, 'sell_price')} AS med FROM panel) SELECT id, date, {s4('sell_price / NULLIF(med, 0)')} AS price_vs_median_28, CAST(CAST(sell_price < 0.9 * med AS INT) AS DOUBLE) AS is_promotion, CAST(CAST(sell_price < 0.8 * med AS INT) AS DOUBLE) AS is_deep_discount FROM x")
def promotion_flags(spark, sf_dir):
    return rounded(demand_panel(spark, sf_dir).select(*KEYS, *(flag(c, n) for n, c in X.promotion_columns().items())))


@query(f"WITH {PANEL_SQL}, x AS (SELECT id, date, sell_price <> LAG(sell_price, 1) OVER {W}) AS chg FROM panel) SELECT id, date, CAST(CASE WHEN chg IS NOT NULL THEN SUM(CAST(chg AS INT)) OVER {W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS DOUBLE) AS price_change_cumcount FROM x")
def price_change_count(spark, sf_dir):
    return X.with_change_count(demand_panel(spark, sf_dir)).select(*KEYS, F.col("price_change_cumcount").cast("double"))


def _mean_price(title: str, key: str, names: tuple[str, ...], make):
    cells = {"avg": "m", "vs": "sell_price / NULLIF(m, 0)", "diff": "sell_price - m"}

    def run(spark, sf_dir):
        return rounded(demand_panel(spark, sf_dir).select(*KEYS, *(c.alias(n) for n, c in make().items())))

    run.__name__ = title
    query(f"WITH {PANEL_SQL}, x AS (SELECT *, AVG(sell_price) OVER (PARTITION BY {key}, date) AS m FROM panel) SELECT id, date, " + ", ".join(f"{s4(cells[k])} AS {n}" for n, k in zip(names, ("avg", "vs", "diff"))) + " FROM x")(run)


_mean_price("category_price", "cat_id", ("category_avg_price", "price_vs_category", "price_diff_category"), X.category_price_columns)
_mean_price("store_price", "store_id", ("store_avg_price", "price_vs_store"), X.store_price_columns)


@query(f"""WITH {PANEL_SQL}, x AS (SELECT *, RANK() OVER (PARTITION BY id ORDER BY sell_price ASC NULLS LAST) + (COUNT(*) OVER (PARTITION BY id, sell_price) - 1) / 2.0 AS rk, COUNT(*) OVER (PARTITION BY id) AS n,
AVG(sell_price) OVER (PARTITION BY id) AS m, STDDEV_SAMP(sell_price) OVER (PARTITION BY id) AS s FROM panel)
SELECT id, date, CASE WHEN sell_price IS NOT NULL THEN {s4('rk / n')} END AS price_percentile, {s4('(sell_price - m) / (s + 1e-8)')} AS price_zscore FROM x""")
def price_percentile_zscore(spark, sf_dir):
    return rounded(demand_panel(spark, sf_dir).select(*KEYS, *(c.alias(n) for n, c in X.price_position_columns().items())))


# --- hierarchy -------------------------------------------------------------------------------------------


def _level(level: str):
    name = level.removesuffix("_id")
    roll = lambda f: roll_sql(f, 28, 28, "total").replace("PARTITION BY id", f"PARTITION BY {level}")

    def run(spark, sf_dir):
        return rounded(X.level_features(demand_panel(spark, sf_dir), level))

    run.__name__ = f"hierarchy_roll_{name}"
    query(f"WITH {PANEL_SQL}, t AS (SELECT {level}, date, SUM(sales) AS total FROM panel GROUP BY 1, 2) SELECT {level}, date, {s4(roll('mean'))} AS {name}_agg_roll_mean_28, {s4(roll('std'))} AS {name}_agg_roll_std_28 FROM t")(run)
    return name, level, roll


_LEVELS = [_level(x) for x in X.LEVELS]
_own = roll_sql("mean", 28, 28)


@query(f"WITH {PANEL_SQL}, own AS (SELECT *, {_own} AS own FROM panel), " + ", ".join(f"t_{n} AS (SELECT {c}, date, {r('mean')} AS m FROM (SELECT {c}, date, SUM(sales) AS total FROM panel GROUP BY 1, 2))" for n, c, r in _LEVELS)
       + " SELECT own.id, own.date, " + ", ".join(f"{s4(f'own / (t_{n}.m + 1e-8)')} AS share_of_{n}" for n, _, _ in _LEVELS) + " FROM own " + " ".join(f"LEFT JOIN t_{n} ON own.{c} = t_{n}.{c} AND own.date = t_{n}.date" for n, c, _ in _LEVELS))
def hierarchy_share(spark, sf_dir):
    made = X.hierarchy_features(demand_panel(spark, sf_dir))
    return rounded(made.select(*KEYS, *(f"share_of_{n}" for n, _, _ in _LEVELS)))


@query(f"WITH {SPLIT_SQL} SELECT id, date, prediction, " + ", ".join(f"SUM(prediction) OVER (PARTITION BY {c}, date) AS {n}_forecast" for n, c, _ in _LEVELS) + " FROM naive")
def bottom_up_totals(spark, sf_dir):
    _, train, test, _ = parts(spark, sf_dir)
    made = X.bottom_up(backtest.seasonal_naive(train, test))
    return made.select(*KEYS, "prediction", *(f"{n}_forecast" for n, _, _ in _LEVELS))


# --- preparation -----------------------------------------------------------------------------------------

_ODD = "odd AS (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN CAST('NaN' AS DOUBLE) WHEN event_id % 11 = 0 THEN CAST('Infinity' AS DOUBLE) WHEN event_id % 13 = 0 THEN NULL ELSE value END AS x, value AS sales FROM events)"


def _odd(spark, sf_dir) -> DataFrame:
    k = F.col("event_id")
    x = F.when(k % 7 == 0, float("nan")).when(k % 11 == 0, float("inf")).when(k % 13 == 0, None).otherwise(F.col("value"))
    return table(spark, sf_dir, "events").select("event_id", x.alias("x"), F.col("value").alias("sales"))


@query(f"WITH {_ODD} SELECT event_id, CAST(CASE WHEN ISNAN(x) OR ISINF(x) THEN NULL ELSE x END AS FLOAT) AS x, sales FROM odd")
def postprocess_nulls(spark, sf_dir):
    return prepare.as_floats(prepare.no_infinities(_odd(spark, sf_dir)), keep=("sales",))


@query("SELECT 'flat' AS name UNION ALL SELECT 'empty' UNION ALL SELECT CASE WHEN (SELECT COUNT(DISTINCT n_regionkey) FROM nation) <= 1 THEN 'n_regionkey' ELSE 'none' END")
def constant_columns(spark, sf_dir):
    df = table(spark, sf_dir, "nation").withColumns({"flat": F.lit(7), "empty": F.lit(None).cast("double")})
    found = prepare.constant_columns(df, ["n_nationkey", "n_name", "n_regionkey", "flat", "empty"])
    return spark.createDataFrame([(x,) for x in [*found, *["none"] * (3 - len(found))]], "name string")


@query(f"WITH {PANEL_SQL}, gaps AS (SELECT id, item_id, store_id, date, CASE WHEN DAY(date) % 3 = 0 THEN NULL ELSE sell_price END AS p FROM panel) SELECT id, date, LAST_VALUE(p IGNORE NULLS) OVER (PARTITION BY item_id, store_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sell_price FROM gaps")
def ffill_price(spark, sf_dir):
    gaps = demand_panel(spark, sf_dir).withColumn("sell_price", F.when(F.dayofmonth("date") % 3 != 0, F.col("sell_price")))
    return gaps.select(*KEYS, fill_forward("sell_price", ["item_id", "store_id"]).alias("sell_price"))


@query(f"WITH {SPLIT_SQL}, hid AS (SELECT id, date, CASE WHEN date > o THEN NULL ELSE sales END AS sales FROM panel, origin) SELECT id, date, COALESCE(sales, 0) AS sales FROM hid")
def fill_zero(spark, sf_dir):
    panel, _, _, origin = parts(spark, sf_dir)
    return prepare.hide_after(panel, origin).select(*KEYS, prepare.fill_zero().alias("sales"))


@query(f"""WITH {PANEL_SQL}, r AS (SELECT sales, ROW_NUMBER() OVER (ORDER BY sales) - 1 AS k, COUNT(*) OVER () AS n FROM panel), cap AS (SELECT sales AS c FROM r WHERE k = CAST(FLOOR(0.99 * (n - 1) + 0.5) AS BIGINT))
SELECT id, date, CASE WHEN sales IS NULL THEN NULL ELSE GREATEST(0, LEAST(sales, c)) END AS sales FROM panel, cap""")
def clip_outliers(spark, sf_dir):
    panel = demand_panel(spark, sf_dir)
    return panel.select(*KEYS, prepare.clip("sales", prepare.nearest_quantile(panel, "sales", 0.99)).alias("sales"))


@query(f"WITH {PANEL_SQL}, s AS (SELECT AVG(sell_price) AS m, STDDEV_SAMP(sell_price) AS sd FROM panel) SELECT id, date, {s4('CAST(CAST((sell_price - m) / sd AS FLOAT) AS DOUBLE)')} AS sell_price_normalized FROM panel, s")
def normalize_price(spark, sf_dir):
    panel = demand_panel(spark, sf_dir)
    made = prepare.Preprocessor(clip_outliers=False, normalize_prices=True).fit(panel).transform(panel)
    return rounded(made.select(*KEYS, F.col("sell_price_normalized").cast("float").cast("double").alias("sell_price_normalized")))


@query(f"""WITH {SPLIT_SQL}, holes AS (SELECT id, item_id, store_id, date, CASE WHEN date > o THEN NULL ELSE sales END AS sales, CASE WHEN DAY(date) % 3 = 0 THEN NULL ELSE sell_price END AS sell_price FROM panel, origin),
r AS (SELECT sales, ROW_NUMBER() OVER (ORDER BY sales) - 1 AS k, COUNT(*) OVER () AS n FROM holes WHERE sales IS NOT NULL), cap AS (SELECT sales AS c FROM r WHERE k = CAST(FLOOR(0.99 * (n - 1) + 0.5) AS BIGINT)),
pr AS (SELECT sell_price, ROW_NUMBER() OVER (ORDER BY sell_price) - 1 AS k, COUNT(*) OVER () AS n FROM holes WHERE sell_price IS NOT NULL), pcap AS (SELECT sell_price AS pc FROM pr WHERE k = CAST(FLOOR(0.99 * (n - 1) + 0.5) AS BIGINT)),
filled AS (SELECT id, date, COALESCE(sales, 0) AS sales, LAST_VALUE(sell_price IGNORE NULLS) OVER (PARTITION BY item_id, store_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sell_price FROM holes)
SELECT id, date, CAST(CAST(GREATEST(0, LEAST(sales, c)) AS FLOAT) AS DOUBLE) AS sales, CAST(CAST(CASE WHEN sell_price IS NOT NULL THEN GREATEST(0, LEAST(sell_price, pc)) END AS FLOAT) AS DOUBLE) AS sell_price FROM filled, cap, pcap""")
def preprocess_panel(spark, sf_dir):
    """Preprocessor with its defaults over a panel with hidden sales and missing prices."""
    panel, _, _, origin = parts(spark, sf_dir)
    holes = prepare.hide_after(panel, origin).withColumn("sell_price", F.when(F.dayofmonth("date") % 3 != 0, F.col("sell_price")))
    made = prepare.Preprocessor().fit(holes).transform(holes)
    return made.select(*KEYS, *(F.col(c).cast("float").cast("double").alias(c) for c in ("sales", "sell_price")))


# --- baselines and metrics -------------------------------------------------------------------------------


@query(f"WITH {SPLIT_SQL} SELECT id, date, sales, prediction FROM naive")
def baseline_seasonal_naive(spark, sf_dir):
    _, train, test, _ = parts(spark, sf_dir)
    return backtest.seasonal_naive(train, test).select(*KEYS, "sales", "prediction")


@query(f"WITH {SPLIT_SQL} SELECT id, date, sales, prediction FROM average")
def baseline_moving_average(spark, sf_dir):
    _, train, test, _ = parts(spark, sf_dir)
    return backtest.moving_average(train, test).select(*KEYS, "sales", "prediction")


_POINT = {
    "rmse": "SQRT(AVG(POW(sales - prediction, 2)))", "mae": "AVG(ABS(sales - prediction))",
    "mape": "COALESCE(AVG(CASE WHEN sales > 1e-8 THEN ABS((sales - prediction) / sales) END) * 100, CAST('Infinity' AS DOUBLE))",
    "smape": "COALESCE(AVG(CASE WHEN ABS(sales) + ABS(prediction) > 0 THEN 2 * ABS(sales - prediction) / (ABS(sales) + ABS(prediction)) END) * 100, 0)",
}


def _naive(spark, sf_dir) -> DataFrame:
    _, train, test, _ = parts(spark, sf_dir)
    return backtest.seasonal_naive(train, test)


@query(f"""WITH {SPLIT_SQL}, d AS (SELECT *, CASE WHEN LAG(sales) OVER {W}) IS NULL THEN NULL ELSE CAST(SIGN(sales - LAG(sales) OVER {W})) = SIGN(prediction - LAG(prediction) OVER {W})) AS INT) END AS same FROM naive)
SELECT {', '.join(f'{s4(x)} AS {n}' for n, x in _POINT.items())}, {s4('AVG(sales)')} AS mean_actual, {s4('STDDEV_POP(sales)')} AS std_actual, {s4('AVG(prediction)')} AS mean_prediction, {s4('STDDEV_POP(prediction)')} AS std_prediction, COUNT(*) AS n_samples, {s4('AVG(same) * 100')} AS directional_accuracy FROM d""")
def metrics_pooled(spark, sf_dir):
    return rounded(M.pooled(_naive(spark, sf_dir), "sales", order=KEYS))


@query(f"WITH {SPLIT_SQL}, st AS (SELECT id, ABS(sales - LAG(sales, 7) OVER {W})) AS step FROM train), sc AS (SELECT id, AVG(step) AS scale FROM st GROUP BY id), e AS (SELECT id, AVG(ABS(sales - prediction)) AS e FROM naive GROUP BY id) SELECT id, CASE WHEN scale < 1e-8 THEN CAST('Infinity' AS DOUBLE) ELSE {s4('e / scale')} END AS mase FROM e JOIN sc USING (id)")
def metrics_mase(spark, sf_dir):
    _, train, test, _ = parts(spark, sf_dir)
    error = backtest.seasonal_naive(train, test).groupBy("id").agg(M.mae("sales").alias("e"))
    scale = M.seasonal_scale(train, ["date"], ["id"], "sales", 7)
    value = M.mase(F.col("e"), F.col("scale"))
    return error.join(scale, "id").select("id", F.when(value == float("inf"), value).otherwise(r4(value)).alias("mase"))


def _grouped(title: str, key: str, sql: str, column: Callable[[], Column]):
    cells = ", ".join(f"{s4(x)} AS {n}" if n != "mape" else f"CASE WHEN COUNT(CASE WHEN sales > 1e-8 THEN 1 END) = 0 THEN CAST('Infinity' AS DOUBLE) ELSE {s4(x)} END AS mape" for n, x in _POINT.items())

    def run(spark, sf_dir):
        made = M.by_group(_naive(spark, sf_dir).withColumn(key, column()), key, y="sales")
        return made.select(*(r4(F.col(c)).alias(c) if t == "double" and c != "mape" else F.when(F.col(c) == float("inf"), F.col(c)).otherwise(r4(F.col(c))).alias(c) if c == "mape" else F.col(c) for c, t in made.dtypes))

    run.__name__ = title
    query(f"WITH {SPLIT_SQL} SELECT {sql} AS {key}, {cells}, COUNT(*) AS n_samples, {s4('AVG(sales)')} AS mean_actual, {s4('AVG(prediction)')} AS mean_prediction FROM naive GROUP BY 1")(run)


_grouped("metrics_per_series", "id", "id", lambda: F.col("id"))
_grouped("metrics_by_weekday", "dow", "CAST(ISODOW(date) - 1 AS INT)", lambda: F.weekday("date"))


@query(f"WITH {SPLIT_SQL} SELECT CAST(DATE_DIFF('day', (SELECT o FROM origin), date) AS INT) AS horizon, {s4(_POINT['rmse'])} AS rmse, {s4(_POINT['mae'])} AS mae, COUNT(*) AS n_samples FROM naive GROUP BY 1")
def metrics_by_horizon(spark, sf_dir):
    _, train, test, origin = parts(spark, sf_dir)
    made = backtest.seasonal_naive(train, test).withColumn("horizon", backtest.horizon(origin + timedelta(1)))
    return rounded(M.by_group(made, "horizon", y="sales").select("horizon", "rmse", "mae", "n_samples"))


_RANKS = ", ".join(f"RANK() OVER (ORDER BY {n}) + (COUNT(*) OVER (PARTITION BY {n}) - 1) / 2.0 AS {n}_rank" for n in ("rmse", "mae", "smape", "mape"))


@query(f"WITH {SPLIT_SQL}, m AS (SELECT 'seasonal' AS model, {', '.join(f'{x} AS {n}' for n, x in _POINT.items())} FROM naive UNION ALL SELECT 'average', {', '.join(_POINT.values())} FROM average) SELECT model, {', '.join(f'{s4(n)} AS {n}' for n in _POINT)}, {_RANKS.replace('/ 2.0 AS', '/ CAST(2 AS DOUBLE) AS')} FROM m")
def compare_models(spark, sf_dir):
    _, train, test, _ = parts(spark, sf_dir)
    both = backtest.moving_average(train, backtest.seasonal_naive(train, test).withColumnRenamed("prediction", "seasonal")).withColumnRenamed("prediction", "average")
    return rounded(M.compare(both, ["seasonal", "average"], "sales"), "rmse_rank", "mae_rank", "smape_rank", "mape_rank")


@query(f"WITH {SPLIT_SQL} SELECT {s4('AVG(CAST(sales BETWEEN GREATEST(0, prediction - 2) AND prediction + 2 AS DOUBLE))')} AS coverage, COUNT(*) AS n FROM average")
def coverage(spark, sf_dir):
    _, train, test, _ = parts(spark, sf_dir)
    made = backtest.moving_average(train, test).withColumns({"lo": F.greatest(F.lit(0.0), F.col("prediction") - 2), "hi": F.col("prediction") + 2})
    return made.agg(r4(M.coverage("sales", "lo", "hi")).alias("coverage"), F.count(F.lit(1)).alias("n"))


_SCALE = lambda by, src: f"SELECT {by}, COALESCE(AVG(CASE WHEN begun THEN POW(y - prev, 2) END), 0) AS scale FROM (SELECT *, LAG(y) OVER (PARTITION BY {by} ORDER BY date) AS prev, COALESCE(BOOL_OR(y <> 0) OVER (PARTITION BY {by} ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), FALSE) AS begun FROM {src}) GROUP BY {by}"
_SERIES = f"{SPLIT_SQL}, ty AS (SELECT id, date, sales AS y FROM train), sc AS ({_SCALE('id', 'ty')}), wt AS (SELECT id, CAST(SUM(CASE WHEN date > o - 28 THEN COALESCE(sales * sell_price, 0) ELSE 0 END) AS DOUBLE) AS w FROM train, origin GROUP BY id)"


@query(f"WITH {_SERIES} SELECT id, {s4('scale')} AS scale FROM sc")
def series_scales(spark, sf_dir):
    _, train, _, _ = parts(spark, sf_dir)
    return rounded(M.scales(train, ["id"]))


@query(f"WITH {_SERIES}, ra AS (SELECT id, CASE WHEN scale > 0 THEN w / (SELECT SUM(w) FROM wt) / scale ELSE 0 END AS ratio FROM sc JOIN wt USING (id)), rows_ AS (SELECT train.id, date, ratio FROM train JOIN ra USING (id)) SELECT id, date, {s4('ratio / (SELECT AVG(ratio) FROM rows_)')} AS row_weight FROM rows_")
def row_weights(spark, sf_dir):
    _, train, _, _ = parts(spark, sf_dir)
    return rounded(M.row_weights(train).select(*KEYS, "row_weight"))


@query(f"WITH {_SERIES}, er AS (SELECT id, AVG(POW(sales - prediction, 2)) AS mse FROM naive GROUP BY id) SELECT {s4('SUM(w * SQRT(mse / scale)) / SUM(w)')} AS wrmsse, COUNT(*) AS n_series FROM sc JOIN wt USING (id) JOIN er USING (id) WHERE scale > 0")
def wrmsse_series(spark, sf_dir):
    _, train, test, _ = parts(spark, sf_dir)
    made = M.hierarchical_wrmsse(train, backtest.seasonal_naive(train, test), levels=[("series", ("id",))])
    return rounded(made.drop("level"))


def _level_union(src: str, *cells: str) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS level, {' || CHR(31) || '.join(k) if k else chr(39) + 'all' + chr(39)} AS key, {', '.join(cells)} FROM {src} GROUP BY 1, 2, date" for n, k in M.TWELVE_LEVELS)


@query(f"""WITH {SPLIT_SQL}, v AS (SELECT train.*, CASE WHEN date > o - 28 THEN CAST(COALESCE(sales * sell_price, 0) AS DECIMAL(38,10)) ELSE 0 END AS v FROM train, origin),
h AS ({_level_union('v', 'date', 'SUM(sales) AS y', 'SUM(v) AS v')}), hk AS (SELECT level || CHR(30) || key AS lk, * FROM h), sc AS ({_SCALE('lk', 'hk')}), wt AS (SELECT level, lk, CAST(SUM(v) AS DOUBLE) AS w FROM hk GROUP BY 1, 2),
e AS ({_level_union('naive', 'date', 'SUM(sales) AS y', 'SUM(prediction) AS p')}), er AS (SELECT level || CHR(30) || key AS lk, AVG(POW(y - p, 2)) AS mse FROM e GROUP BY 1)
SELECT level, {s4('SUM(w * SQRT(mse / scale)) / SUM(w)')} AS wrmsse, COUNT(*) AS n_series FROM wt JOIN sc USING (lk) JOIN er USING (lk) WHERE scale > 0 GROUP BY level""")
def hierarchical_wrmsse(spark, sf_dir):
    _, train, test, _ = parts(spark, sf_dir)
    return rounded(M.hierarchical_wrmsse(train, backtest.seasonal_naive(train, test)))


_NAIVE_ERROR = "SELECT id, AVG(POW(sales - prediction, 2)) AS mse FROM naive GROUP BY id"


@query(f"""WITH {_SERIES}, er AS ({_NAIVE_ERROR}), st AS (SELECT AVG(ABS(sales - old)) AS step FROM (SELECT sales, LAG(sales, 7) OVER {W}) AS old FROM train)), ws AS (SELECT SUM(w * SQRT(mse / scale)) / SUM(w) AS x FROM sc JOIN wt USING (id) JOIN er USING (id) WHERE scale > 0)
SELECT {s4('SQRT(AVG(POW(sales - prediction, 2)))')} AS rmse, {s4('AVG(ABS(sales - prediction))')} AS mae, {s4('AVG(ABS(sales - prediction)) / (SELECT step FROM st)')} AS mase, {s4('(SELECT x FROM ws)')} AS wrmsse, COUNT(*) AS n_samples FROM naive""")
def metrics_record(spark, sf_dir):
    """The pooled record with both scaled errors."""
    _, train, test, _ = parts(spark, sf_dir)
    return rounded(M.record(train, backtest.seasonal_naive(train, test)).select("rmse", "mae", "mase", "wrmsse", "n_samples"))


#: A panel with missing days: those of a month divisible by 5, in stores whose names begin with A to M.
_LACKS = "(DAY(date) % 5 = 0 AND store_id < 'N')"


def _lacking(df: DataFrame) -> DataFrame:
    return df.where(~((F.dayofmonth("date") % 5 == 0) & (F.col("store_id") < "N")))


_SPARSE = f"""{SPLIT_SQL}, had AS (SELECT train.* FROM train WHERE NOT {_LACKS}), hd AS (SELECT DISTINCT date FROM had),
hs AS (SELECT DISTINCT id, item_id, dept_id, cat_id, store_id, state_id FROM had), hv AS (SELECT hs.*, hd.date, COALESCE(had.sales, 0) AS sales, CASE WHEN hd.date > (SELECT MAX(date) FROM had) - 28 THEN CAST(COALESCE(had.sales * had.sell_price, 0) AS DECIMAL(38,10)) ELSE 0 END AS v
FROM hs CROSS JOIN hd LEFT JOIN had ON had.id = hs.id AND had.date = hd.date)"""


@query(f"WITH {_SPARSE}, sy AS (SELECT id, date, sales AS y FROM hv) SELECT id, {s4('scale')} AS scale FROM ({_SCALE('id', 'sy')})")
def sparse_scales(spark, sf_dir):
    """Scales of series that lack days which others have."""
    return rounded(M.scales(_lacking(parts(spark, sf_dir)[1]), ["id"]))


@query(f"""WITH {_SPARSE}, h AS ({_level_union('hv', 'date', 'SUM(sales) AS y', 'SUM(v) AS v')}), hk AS (SELECT level || CHR(30) || key AS lk, * FROM h), sc AS ({_SCALE('lk', 'hk')}), wt AS (SELECT level, lk, CAST(SUM(v) AS DOUBLE) AS w FROM hk GROUP BY 1, 2),
held AS (SELECT * FROM naive WHERE NOT {_LACKS}), ne AS (SELECT COUNT(DISTINCT date) AS n FROM held),
e AS ({_level_union('held', 'date', 'SUM(sales) AS y', 'SUM(prediction) AS p')}), er AS (SELECT level || CHR(30) || key AS lk, CASE WHEN COUNT(*) = (SELECT n FROM ne) THEN AVG(POW(y - p, 2)) ELSE CAST('NaN' AS DOUBLE) END AS mse FROM e GROUP BY 1),
f AS (SELECT level, SUM(w * SQRT(COALESCE(mse, CAST('NaN' AS DOUBLE)) / scale)) / SUM(w) AS x, COUNT(*) AS n_series FROM wt JOIN sc USING (lk) LEFT JOIN er USING (lk) WHERE scale > 0 GROUP BY level)
SELECT level, CASE WHEN ISNAN(x) THEN -1.0 ELSE {s4('x')} END AS wrmsse, n_series FROM f""")
def sparse_wrmsse(spark, sf_dir):
    """The twelve levels over missing days: a key that lacks a test day makes its level NaN (here -1)."""
    _, train, test, _ = parts(spark, sf_dir)
    made = M.hierarchical_wrmsse(_lacking(train), _lacking(backtest.seasonal_naive(train, test)))
    return made.select("level", F.when(F.isnan("wrmsse"), F.lit(-1.0)).otherwise(r4(F.col("wrmsse"))).alias("wrmsse"), "n_series")


_PLAN = backtest.Plan(n_folds=4, test_days=28, gap_days=3)


@query(f"""WITH {PANEL_SQL}, b AS (SELECT MIN(date) AS a, MAX(date) AS z FROM panel), k AS (SELECT UNNEST(RANGE(4)) AS k), f AS (SELECT k, a AS train_start, CAST(z - CAST(28 * k + 31 AS INT) AS DATE) AS train_end, CAST(z - CAST(28 * k + 27 AS INT) AS DATE) AS test_start, CAST(z - CAST(28 * k AS INT) AS DATE) AS test_end FROM k, b)
SELECT CAST(ROW_NUMBER() OVER (ORDER BY test_start) AS INT) AS fold, train_start, train_end, test_start, test_end FROM f WHERE DATE_DIFF('day', train_start, train_end) >= 28""")
def backtest_folds(spark, sf_dir):
    ends = demand_panel(spark, sf_dir).agg(F.min("date").alias("a"), F.max("date").alias("b")).first()
    rows = [(k, f.train_start, f.train_end, f.test_start, f.test_end) for k, f in enumerate(_PLAN.folds(ends.a, ends.b), 1)]
    return spark.createDataFrame(rows, "fold int, train_start date, train_end date, test_start date, test_end date")


@query(f"""WITH {PANEL_SQL}, b AS (SELECT MAX(date) AS z FROM panel), k AS (SELECT UNNEST(RANGE(2)) AS k), f AS (SELECT CAST(2 - k AS INT) AS fold, CAST(z - CAST(28 * k + 28 AS INT) AS DATE) AS train_end, CAST(z - CAST(28 * k AS INT) AS DATE) AS test_end FROM k, b),
p AS (SELECT fold, t.sales, COALESCE(w.sales, 0) AS prediction FROM f JOIN panel t ON t.date > train_end AND t.date <= test_end LEFT JOIN panel w ON w.id = t.id AND w.date > train_end - 7 AND w.date <= train_end AND ISODOW(w.date) = ISODOW(t.date))
SELECT fold, {s4(_POINT['rmse'])} AS rmse, {s4(_POINT['mae'])} AS mae, {s4(_POINT['smape'])} AS smape, COUNT(*) AS n_samples FROM p GROUP BY fold""")
def backtest_naive_scores(spark, sf_dir):
    panel = demand_panel(spark, sf_dir).persist()
    found = backtest.run(panel, backtest.seasonal_naive, backtest.Plan(n_folds=2, test_days=28))
    made = found.summary(spark).select("fold", "rmse", "mae", "smape", "n_samples")
    found.release()
    panel.unpersist()
    return rounded(made)


@query(f"""WITH {PANEL_SQL}, b AS (SELECT MAX(date) AS z FROM panel), k AS (SELECT UNNEST(RANGE(2)) AS k), f AS (SELECT CAST(2 - k AS INT) AS fold, CAST(z - CAST(28 * k + 31 AS INT) AS DATE) AS train_end, CAST(z - CAST(28 * k + 27 AS INT) AS DATE) AS test_start, CAST(z - CAST(28 * k AS INT) AS DATE) AS test_end FROM k, b),
x AS (SELECT fold, id, date, train_end, test_start, sales, CASE WHEN date <= train_end THEN sales END AS seen FROM panel, f WHERE date <= test_end),
y AS (SELECT *, LAG(seen, 35) OVER (PARTITION BY fold, id ORDER BY date) AS old FROM x)
SELECT fold, id, date, sales, COALESCE(old, 0) AS prediction FROM y WHERE date >= test_start""")
def backtest_gap_lags(spark, sf_dir):
    """Folds with a gap of three days: the forecast is the lag of 35 days that features see there."""
    lag = X.Temporal(lags=(35,), min_lag=31)

    def forecast(history: DataFrame, future: DataFrame) -> DataFrame:
        whole = history.unionByName(future.withColumn("sales", F.lit(None).cast("double")))
        return whole.select(*KEYS, F.coalesce(X.lag_columns(lag)["sales_lag_35"], F.lit(0.0)).alias("prediction"))

    found = backtest.run(demand_panel(spark, sf_dir), forecast, backtest.Plan(n_folds=2, test_days=28, gap_days=3))
    return found.predictions.select("fold", *KEYS, "sales", "prediction")


# --- validation, store, scoring --------------------------------------------------------------------------


@query(f"WITH {_ODD} SELECT {s4('AVG(CAST(x IS NULL OR ISNAN(x) AS DOUBLE))')} AS x, {s4('AVG(CAST(sales IS NULL OR ISNAN(sales) AS DOUBLE))')} AS sales FROM odd")
def validate_nulls(spark, sf_dir):
    df = _odd(spark, sf_dir)
    return df.agg(*(r4(validate.null_share(df, c)).alias(c) for c in ("x", "sales")))


@query("SELECT CAST(SUM(n - 1) AS BIGINT) AS n_duplicates FROM (SELECT COUNT(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)")
def validate_duplicates(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("date"))
    return spark.createDataFrame([(int(validate.duplicates(lines)[1]),)], "n_duplicates long")


@query("SELECT COUNT(*) FILTER (s_acctbal < 0) > 0 AS negative, COUNT(*) AS row_count, CAST(0 AS BIGINT) AS missing FROM supplier")
def validate_ranges(spark, sf_dir):
    df = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("id"), F.col("s_name").alias("item_id"), F.col("s_name").alias("store_id"), F.lit("2024-01-01").cast("date").alias("date"), F.col("s_acctbal").alias("sales"))
    found = validate.validate(df, "sales", min_history_days=0)
    return spark.createDataFrame([(any("negative" in e for e in found.errors), found.row_count, sum(e.startswith("Missing") for e in found.errors))], "negative boolean, row_count long, missing long")


@query(f"WITH s AS (SELECT AVG(value) AS m, STDDEV_SAMP(value) AS sd FROM events) SELECT {s4('AVG(CAST(ABS(value - m) > 2 * sd AS DOUBLE))')} AS outlier_share FROM events, s")
def validate_outliers(spark, sf_dir):
    return rounded(spark.createDataFrame([(validate.outlier_share(table(spark, sf_dir, "events"), "value", 2.0),)], "outlier_share double"))


@query(f"SELECT {s4('CORR(l_quantity, l_extendedprice)')} AS quantity_price, {s4('CORR(l_quantity, l_discount)')} AS quantity_discount, {s4('CORR(l_discount, l_tax)')} AS discount_tax FROM lineitem")
def validate_correlation(spark, sf_dir):
    pairs = (("l_quantity", "l_extendedprice", "quantity_price"), ("l_quantity", "l_discount", "quantity_discount"), ("l_discount", "l_tax", "discount_tax"))
    found = validate.correlations(table(spark, sf_dir, "lineitem"), [(a, b) for a, b, _ in pairs])
    return rounded(spark.createDataFrame([tuple(found[a, b] for a, b, _ in pairs)], ", ".join(f"{n} double" for _, _, n in pairs)))


@query("SELECT o_orderpriority AS name, ARG_MAX(o_orderkey, saved) AS version, MAX(saved) AS saved FROM (SELECT o_orderpriority, o_orderkey, CAST(o_orderdate AS DATE) * 1 AS saved FROM (SELECT o_orderpriority, o_orderkey, DATE_DIFF('day', DATE '1990-01-01', CAST(o_orderdate AS DATE)) * 1000000 + o_orderkey AS o_orderdate FROM orders WHERE o_orderdate <= TIMESTAMP '1998-06-30') q) GROUP BY 1".replace("CAST(o_orderdate AS DATE) * 1 AS saved", "o_orderdate AS saved"))
def store_as_of(spark, sf_dir):
    """The last version saved up to a day, with orders as versions of their priority."""
    saved = F.datediff(F.col("o_orderdate").cast("date"), F.lit(date(1990, 1, 1))).cast("long") * 1000000 + F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").where(F.col("o_orderdate") <= F.lit(datetime(1998, 6, 30)).cast("timestamp_ntz")).select(F.col("o_orderpriority").alias("name"), F.col("o_orderkey").alias("version"), saved.alias("saved"))
    return store.as_of(rows, 2**60, saved="saved")


@query("SELECT s_suppkey, s_name, s_acctbal, CASE WHEN s_suppkey % 2 = 0 THEN '000001' ELSE '000002' END AS version FROM supplier")
def store_versions(spark, sf_dir):
    """Two versions of a feature set: even rows as the first had them, odd ones from the latest."""
    from uuid import uuid4

    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    kept = store.FeatureStore(spark, f"{root}/feature-store-{uuid4().hex}", cache=False)
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    first = kept.save("supplier", rows)
    kept.save("supplier", rows.withColumn("s_acctbal", F.col("s_acctbal") + 0))
    old = kept.load_as_of("supplier", datetime.fromisoformat(first["saved"])).where("s_suppkey % 2 = 0").withColumn("version", F.lit(first["version"]))
    return old.unionByName(kept.load("supplier").where("s_suppkey % 2 = 1").withColumn("version", F.lit(kept.latest("supplier"))))


@query(f"""WITH r AS (SELECT s_name AS store_id, 'i' || s_suppkey AS item_id, DATE '2024-02-26' + CAST(k AS INT) AS forecast_date, s_acctbal FROM supplier, (SELECT UNNEST(RANGE(7)) AS k)),
p AS (SELECT *, GREATEST(0, 2 + 0.5 * (ISODOW(forecast_date) - 1) + 0.25 * DAY(forecast_date)) AS prediction FROM r)
SELECT item_id, store_id, CAST(forecast_date AS DATE) AS forecast_date, {s4('prediction')} AS prediction, {s4('GREATEST(0, prediction * (1 - 1.2815515655446008 * 0.2))')} AS lower_bound, {s4('prediction * (1 + 1.2815515655446008 * 0.2)')} AS upper_bound FROM p""")
def score_requests_horizon(spark, sf_dir):
    """A fixed linear model scored over seven days for each request, with its 80% interval."""
    from tidewright.operators.models import interval

    base = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("store_id"), F.concat(F.lit("i"), "s_suppkey").alias("item_id"), F.lit(date(2024, 2, 26)).alias("start_date"))
    rows = scoring.request_rows(scoring.horizon_requests(base, 7), ["day_of_week", "day_of_month", "sell_price"])
    scored = rows.withColumn("prediction", F.greatest(F.lit(0.0), 2 + 0.5 * F.col("day_of_week") + 0.25 * F.col("day_of_month")))
    return rounded(scored.withColumns(interval("prediction", 0.8)).select("item_id", "store_id", "forecast_date", "prediction", "lower_bound", "upper_bound"))


@query(f"WITH {SPLIT_SQL}, b AS (SELECT n.id, n.date, n.prediction AS a, v.prediction AS b FROM naive n JOIN average v USING (id, date)) SELECT id, date, {s4('0.25 * a + 0.75 * b')} AS weighted, {s4('(a + b) / 2')} AS median, {s4('ABS(a - b) / 2')} AS std FROM b")
def ensemble_combine(spark, sf_dir):
    """Weighted mean, median and deviation of both naive forecasts as ensemble members."""
    from tidewright.operators.models import combined

    _, train, test, _ = parts(spark, sf_dir)
    both = backtest.moving_average(train, backtest.seasonal_naive(train, test).withColumnRenamed("prediction", "a")).withColumnRenamed("prediction", "b")
    members = {"a": F.col("a"), "b": F.col("b")}
    w, m = combined(members, {"a": 1.0, "b": 3.0}), combined(members, {}, "median")
    return rounded(both.select(*KEYS, w["prediction"].alias("weighted"), m["prediction"].alias("median"), w["prediction_std"].alias("std")))


@query("SELECT CAST(ts AS DATE) AS date, event_type, COUNT(*) AS n, FLOOR(SUM(CAST(value AS DECIMAL(18,4))) * 100 + 0.5) / 100 AS total FROM events GROUP BY 1, 2")
def daily_event_demand(spark, sf_dir):
    """The streaming extension's aggregate, here over the whole table."""
    from tidewright.streaming.demand import daily_demand

    events = table(spark, sf_dir, "events").withColumn("value", F.col("value").cast("decimal(18,4)"))
    made = daily_demand(events)
    return made.withColumn("total", F.floor(F.col("total") * 100 + 0.5).cast("double") / 100)


# --- without SQL -----------------------------------------------------------------------------------------


@query()
def synthetic_panel(spark, sf_dir):
    from tidewright.sources.synthetic import Synthetic

    return Synthetic(n_items=7, n_stores=3, n_days=200).panel(spark)


def _modelled(spark, sf_dir, objective: str, until: int = 0) -> DataFrame:
    """The held-out days (or, `until` days earlier, as many before them) with a model's predictions, fitted on
    what was known before."""
    from tidewright.operators.models import Forecaster, ModelConfig

    panel, _, _, origin = parts(spark, sf_dir)
    origin -= timedelta(until)
    hidden = prepare.hide_after(panel, origin).where(F.col("date") <= F.lit(origin + timedelta(HORIZON)))
    t = X.Temporal(lags=(28, 35), windows=(28,), statistics=("mean", "std"), countries=())
    made = X.temporal_features(hidden, t)
    names = [*X.temporal_names(t), "day_of_week", "month", "sell_price", "item_id", "store_id"]
    train = made.where((F.col("date") <= F.lit(origin)) & F.col("sales").isNotNull())
    model = Forecaster(ModelConfig(objective=objective, trees=8, depth=4)).fit(train, names)
    actual = panel.where(F.col("date").between(F.lit(origin + timedelta(1)), F.lit(origin + timedelta(HORIZON))))
    return prepare.reattach(model.predict(made.where(F.col("date") > F.lit(origin))), actual).select(*KEYS, "sales", "prediction")


@query()
def gbt_forecast(spark, sf_dir):
    return _modelled(spark, sf_dir, "squared")


@query()
def tweedie_glm_forecast(spark, sf_dir):
    return _modelled(spark, sf_dir, "tweedie")


@query()
def ensemble_forecast(spark, sf_dir):
    """Weights fitted on the days before the origin, which neither member learned from, applied to the held-out days."""
    from tidewright.operators.models import best_weights, combined

    panel, _, _, origin = parts(spark, sf_dir)

    def both(until: int) -> DataFrame:
        one = _modelled(spark, sf_dir, "squared", until).withColumnRenamed("prediction", "a")
        return backtest.moving_average(panel.where(F.col("date") <= F.lit(origin - timedelta(until))), one).withColumnRenamed("prediction", "b")

    weights = best_weights(both(HORIZON), ["a", "b"])
    if weights is None:
        raise ValueError("no days before the origin to fit the weights on")
    return both(0).select(*KEYS, "sales", combined({"a": F.col("a"), "b": F.col("b")}, weights)["prediction"].alias("prediction"))
