"""Declared schemas, business rules and feature checks: an aggregate for all rules, two more for outliers and
one for repeated keys."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Required columns of each table, their types, and the rules of their values.
SCHEMAS: dict[str, dict[str, tuple[str, bool, str | None]]] = {
    "sales": {"id": ("string", False, None), "item_id": ("string", False, None), "store_id": ("string", False, None), "date": ("timestamp", False, None), "sales": ("double", True, "{} >= 0")},
    "calendar": {
        "d": ("string", False, None), "date": ("timestamp", False, None), "wm_yr_wk": ("bigint", False, "{} >= 0"), "weekday": ("string", False, None),
        "wday": ("bigint", False, "{} between 1 and 7"), "month": ("bigint", False, "{} between 1 and 12"), "year": ("bigint", False, "{} between 2000 and 2100"),
    },
    "prices": {"store_id": ("string", False, None), "item_id": ("string", False, None), "wm_yr_wk": ("bigint", False, "{} >= 0"), "sell_price": ("double", True, "{} > 0")},
}


@dataclass
class Validation:
    is_valid: bool
    errors: list[str] = field(default_factory=list)
    warnings: list[str] = field(default_factory=list)
    row_count: int = 0
    null_percentages: dict[str, float] = field(default_factory=dict)


def null_share(df: DataFrame, column: str):
    """Share of null (and NaN) values."""
    missing = F.col(column).isNull()
    if dict(df.dtypes)[column] in ("double", "float"):
        missing = missing | F.isnan(column)
    return F.avg(missing.cast("double"))


def outlier_share(df: DataFrame, column: str = "sales", times: float = 5.0) -> float | None:
    """Share of rows more than `times` sample deviations from the mean; nulls count as rows within."""
    s = df.agg(F.avg(column).alias("m"), F.stddev_samp(column).alias("s")).first()
    if not s.s or math.isnan(s.s):
        return None
    far = F.coalesce(F.abs(F.col(column) - s.m) > times * s.s, F.lit(False))
    return df.agg(F.avg(far.cast("double"))).first()[0]


def duplicates(df: DataFrame) -> tuple[list[str], int]:
    key = ["id", "date"] if {"id", "date"} <= set(df.columns) else ["id", "d"]
    if not set(key) <= set(df.columns):
        return key, 0
    return key, df.groupBy(*key).count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0))).first()[0]


def validate(df: DataFrame, schema: str = "sales", null_threshold: float = 0.05, min_history_days: int = 28, times: float = 5.0, raise_on_error: bool = False) -> Validation:
    """All rules of a table; errors, warnings, rows and null shares."""
    if schema not in SCHEMAS:
        raise ValueError(f"Unknown schema '{schema}'. Choose from {sorted(SCHEMAS)}")
    rules = SCHEMAS[schema]
    out = Validation(True)
    out.errors += [f"Missing required column '{c}'" for c in rules if c not in df.columns]
    there = [c for c in rules if c in df.columns]
    bad = {}
    for c in there:
        kind, nullable, rule = rules[c]
        value = f"try_cast(`{c}` as {kind})"
        bad[f"{c}|type"] = f"`{c}` is not null and {value} is null"
        if not nullable:
            bad[f"{c}|null"] = f"`{c}` is null"
        if rule:
            bad[f"{c}|check"] = f"not ({rule.format(value)})"
    aggs = [F.count_if(F.expr(x)).alias(f"bad{k}") for k, x in enumerate(bad.values())]
    aggs += [null_share(df, c).alias(f"null{k}") for k, c in enumerate(df.columns)]
    if "date" in df.columns:
        aggs.append(F.datediff(F.max(F.col("date").cast("date")), F.min(F.col("date").cast("date"))).alias("span"))
    if "sales" in df.columns:
        aggs.append(F.count_if(F.expr("try_cast(sales as double) < 0")).alias("negative"))
    row = df.agg(F.count(F.lit(1)).alias("n"), *aggs).first()
    out.row_count = row.n
    for k, name in enumerate(bad):
        if row[f"bad{k}"]:
            out.errors.append(f"Schema error in column '{name.split('|')[0]}': {name.split('|')[1]}")
    out.null_percentages = {c: row[f"null{k}"] for k, c in enumerate(df.columns)} if row.n else {}
    for c, share in out.null_percentages.items():
        if share > null_threshold:
            (out.errors if c in rules else out.warnings).append(f"Column '{c}' is {share:.1%} null (threshold {null_threshold:.1%})")
    if "sales" in df.columns and (far := outlier_share(df, "sales", times)) is not None and far > 0.01:
        out.warnings.append(f"'sales' has {far:.1%} values more than {times} standard deviations from the mean")
    if "date" in df.columns and row.n and row.span < min_history_days:
        out.errors.append(f"Insufficient history: {row.span} days, minimum {min_history_days}")
    key, again = duplicates(df)
    if again:
        out.errors.append(f"Found {again} duplicate {'/'.join(key)} rows")
    if "sales" in df.columns and row.negative:
        out.errors.append(f"Found {row.negative} negative sales values")
    out.is_valid = not out.errors
    if out.errors and raise_on_error:
        raise ValueError(f"Data validation failed: {out.errors}")
    return out


def _correlation(a: str, b: str):
    """Pearson's, over rows that have both; null where one is constant, on which corr() would fail."""
    sd = lambda x, y: F.stddev_samp(F.when(F.col(y).isNotNull(), F.col(x)))
    return F.try_divide(F.covar_samp(a, b), sd(a, b) * sd(b, a))


def correlations(df: DataFrame, pairs: list[tuple[str, str]]) -> dict[tuple[str, str], float | None]:
    """The correlation of each pair of columns, in one pass."""
    row = df.agg(F.lit(0), *(_correlation(a, b) for a, b in pairs)).first()
    return dict(zip(pairs, row[1:]))


def validate_features(df: DataFrame, target: str = "sales") -> Validation:
    """Infinite values (errors), constant columns and nearly equal pairs (warnings) of numeric columns."""
    numeric = [c for c, t in df.dtypes if t in ("double", "float", "int", "bigint", "smallint", "tinyint")]
    aggs = [F.count_if(F.abs(F.col(c).cast("double")) == float("inf")).alias(f"inf{k}") for k, c in enumerate(numeric)]
    aggs += [F.stddev_samp(F.when(F.abs(F.col(c).cast("double")) != float("inf"), F.col(c))).alias(f"sd{k}") for k, c in enumerate(numeric)]
    pairs = [(a, b) for i, a in enumerate(numeric) for b in numeric[i + 1 :]]
    aggs += [_correlation(a, b).alias(f"corr{k}") for k, (a, b) in enumerate(pairs)]
    row = df.agg(F.count(F.lit(1)).alias("n"), *aggs, *(null_share(df, c).alias(f"null{k}") for k, c in enumerate(df.columns))).first()
    out = Validation(True, row_count=row.n)
    for k, c in enumerate(numeric):
        if row[f"inf{k}"]:
            out.errors.append(f"Column '{c}' contains {row[f'inf{k}']} infinite values")
        if c != target and row[f"sd{k}"] == 0 and not row[f"inf{k}"]:
            out.warnings.append(f"Column '{c}' has zero variance")
    for k, (a, b) in enumerate(pairs):
        r = row[f"corr{k}"]
        if r is not None and not math.isnan(r) and abs(r) > 0.99:
            out.warnings.append(f"High correlation ({r:.3f}) between '{a}' and '{b}'")
    out.null_percentages = {c: row[f"null{k}"] for k, c in enumerate(df.columns)} if row.n else {}
    out.is_valid = not out.errors
    return out


def unchanged_by_future(build, panel: DataFrame, origin, columns: list[str]) -> bool:
    """Whether what build(panel) gives after the origin stays the same when the sales after it are scrambled:
    build has to hide them itself."""
    scrambled = panel.withColumn("sales", F.when(F.col("date") > F.lit(origin), F.pmod(F.xxhash64("id", "date"), F.lit(1000)).cast("double")).otherwise(F.col("sales")))
    one, two = (build(x).where(F.col("date") > F.lit(origin)).select("id", "date", *columns) for x in (panel, scrambled))
    return one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty()
