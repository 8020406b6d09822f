"""Calendar columns of a date, holiday dimension and distances to holidays."""

from __future__ import annotations

import math
from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HOLIDAY_DAYS = 14


def calendar_columns(day: str = "date") -> dict[str, Column]:
    d = F.col(day)
    dow, dom = F.weekday(d), F.dayofmonth(d)
    return {
        "day_of_week": dow, "day_of_month": dom, "day_of_year": F.dayofyear(d), "week_of_year": F.weekofyear(d), "month": F.month(d), "quarter": F.quarter(d), "year": F.year(d),
        "is_weekend": (dow >= 5).cast("int"), "is_month_start": (dom == 1).cast("int"), "is_month_first_week": (dom <= 7).cast("int"), "is_month_end": (dom >= 25).cast("int"),
    }


def cyclical_columns(day: str = "date") -> dict[str, Column]:
    """Sine and cosine of the place in the week, month, year and year's months."""
    d = F.col(day)
    out = {}
    for name, value, period in (("day_of_week", F.weekday(d), 7), ("day_of_month", F.dayofmonth(d), 31), ("week_of_year", F.weekofyear(d), 52), ("month", F.month(d), 12)):
        angle = F.lit(2 * math.pi) * value / period
        out |= {f"{name}_sin": F.sin(angle), f"{name}_cos": F.cos(angle)}
    return out


def add_calendar(df: DataFrame, day: str = "date", cyclical: bool = True) -> DataFrame:
    """Calendar columns; month and year of a calendar table are overwritten."""
    return df.withColumns(calendar_columns(day) | (cyclical_columns(day) if cyclical else {}))


def week_label(day: str = "date") -> Column:
    """ISO year times 100 plus ISO week."""
    return (F.expr(f"extract(YEAROFWEEK FROM {day})") * 100 + F.weekofyear(day)).cast("long")


def easter(year: int) -> date:
    """Gregorian Easter Sunday, by Gauss's rule as Meeus and Jones give it."""
    a, (b, c) = year % 19, divmod(year, 100)
    (d, e), g = divmod(b, 4), (8 * b + 13) // 25
    h = (19 * a + b - d - g + 15) % 30
    i, k = divmod(c, 4)
    m = (32 + 2 * e + 2 * i - h - k) % 7
    n = (a + 11 * h + 22 * m) // 451
    month, day = divmod(h + m - 7 * n + 114, 31)
    return date(year, month, day + 1)


def _nth(year: int, month: int, weekday: int, n: int) -> date:
    """The n-th weekday (0: Monday) of a month; n = -1: the last."""
    if n > 0:
        first = date(year, month, 1)
        return first + timedelta((weekday - first.weekday()) % 7 + 7 * (n - 1))
    last = date(year + month // 12, month % 12 + 1, 1) - timedelta(1)
    return last - timedelta((last.weekday() - weekday) % 7)


def us_holidays(year: int) -> set[date]:
    """Federal holidays, and the weekday on which those that fall on a weekend are kept."""
    fixed = [date(year, 1, 1), date(year, 7, 4), date(year, 11, 11), date(year, 12, 25)] + ([date(year, 6, 19)] if year >= 2021 else [])
    out = {_nth(year, 1, 0, 3), _nth(year, 2, 0, 3), _nth(year, 5, 0, -1), _nth(year, 9, 0, 1), _nth(year, 10, 0, 2), _nth(year, 11, 3, 4)}
    for d in fixed:
        out |= {d, d + timedelta({5: -1, 6: 1}.get(d.weekday(), 0))}
    return out


def uk_holidays(year: int) -> set[date]:
    """Bank holidays of England, with substitute days."""
    sunday = easter(year)
    out = {sunday - timedelta(2), sunday + timedelta(1), _nth(year, 5, 0, 1), _nth(year, 5, 0, -1), _nth(year, 8, 0, -1)}
    new_year, christmas, boxing = date(year, 1, 1), date(year, 12, 25), date(year, 12, 26)
    out |= {new_year, new_year + timedelta({5: 2, 6: 1}.get(new_year.weekday(), 0)), christmas, boxing}
    out |= {date(year, 12, {5: 27, 6: 27}.get(christmas.weekday(), 25)), date(year, 12, {5: 28, 6: 28}.get(boxing.weekday(), 26))}
    return out


COUNTRIES = {"UK": uk_holidays, "US": us_holidays}


def holidays(country: str, first_year: int, last_year: int) -> list[date]:
    return sorted({d for y in range(first_year, last_year + 1) for d in COUNTRIES[country](y)})


def distances(days: Sequence[date], country: str, first_year: int, last_year: int) -> list[tuple]:
    """For each day: whether it is a holiday, days to the next and from the last one within 14, else -1."""
    known = set(holidays(country, first_year - 1, last_year + 1))
    near = range(1, HOLIDAY_DAYS + 1)
    return [(d, int(d in known), next((k for k in near if d + timedelta(k) in known), -1), next((k for k in near if d - timedelta(k) in known), -1)) for d in days]


def holiday_dimension(spark: SparkSession, first: date, last: date, countries: Sequence[str] = ("UK", "US")) -> DataFrame:
    """One row a day from first to last with the columns of each country: as many rows as days."""
    days = [first + timedelta(k) for k in range((last - first).days + 1)]
    columns = [distances(days, c, first.year, last.year) for c in countries]
    rows = [(d, *(v for x in columns for v in x[k][1:])) for k, d in enumerate(days)]
    fields = ", ".join(f"is_holiday_{c} int, days_to_holiday_{c} int, days_from_holiday_{c} int" for c in countries)
    return spark.createDataFrame(rows, f"date date, {fields}")


def add_holidays(df: DataFrame, countries: Sequence[str] = ("UK", "US"), day: str = "date") -> DataFrame:
    """Holiday flags and distances. The dimension has a row for each day between the first and last date,
    so its size is bounded by the calendar and it is broadcast."""
    if not countries:
        return df
    ends = df.agg(F.min(day).alias("lo"), F.max(day).alias("hi")).first()
    if ends.lo is None:
        ends = type("Ends", (), {"lo": date(2000, 1, 1), "hi": date(2000, 1, 1)})
    dimension = holiday_dimension(df.sparkSession, ends.lo, ends.hi, countries)
    return df.join(F.broadcast(dimension.withColumnRenamed("date", day)), day, "left")
