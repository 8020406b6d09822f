"""Batch scoring of forecast requests."""

from __future__ import annotations

import time
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.functions.calendar import add_calendar
from tidewright.operators.models import interval

MOST_ITEMS, MOST_DAYS = 1000, 90
#: Columns a request may give itself.
PROVIDED = {"sell_price": "price", "snap": "snap_enabled", "event_name_1": "event_name"}


def request_rows(requests: DataFrame, features: list[str], strings: list[str] = (), date: str = "forecast_date") -> DataFrame:
    """A row of model features for each request (item_id, store_id, date and optional columns): calendar
    columns and what is given; anything else is null."""
    rows = add_calendar(requests.withColumn("date", F.col(date).cast("date")))
    given = {k: F.col(v).cast("string" if k in strings else "double") for k, v in PROVIDED.items() if v in requests.columns}
    rows = rows.withColumns(given)
    return rows.withColumns({c: F.lit(None).cast("string" if c in strings else "double") for c in features if c not in rows.columns})


def horizon_requests(requests: DataFrame, days: int, start: str = "start_date") -> DataFrame:
    """A request for each of `days` consecutive days from a start."""
    if not 1 <= days <= MOST_DAYS:
        raise ValueError(f"horizon_days must be between 1 and {MOST_DAYS}")
    first = F.col(start).cast("date")
    return requests.withColumn("forecast_date", F.explode(F.sequence(first, F.date_add(first, days - 1))))


def responses(scored: DataFrame, confidence: float = 0.9) -> DataFrame:
    """Predictions with their interval, rounded to 4 decimals."""
    made = scored.withColumns(interval("prediction", confidence))
    return made.select("item_id", "store_id", "forecast_date", *(F.round(c, 4).alias(c) for c in ("prediction", "lower_bound", "upper_bound")))


@dataclass
class Service:
    """Scores request frames with a fitted forecaster and keeps counts of what it did."""

    model: object
    version: str = "1"
    counts: dict = field(default_factory=lambda: {"requests": 0, "predictions": 0, "errors": 0, "seconds": 0.0})
    started: datetime = field(default_factory=lambda: datetime.now(UTC))

    def predict(self, requests: DataFrame, confidence: float = 0.9, most: int | None = None) -> DataFrame:
        began = time.time()
        self.counts["requests"] += 1
        try:
            n = requests.limit((most or MOST_ITEMS) + 1).count()
            if most is not None and n > most:
                raise ValueError(f"at most {most} items in a batch")
            rows = request_rows(requests, self.model.features, self.model.strings)
            out = responses(self.model.predict(rows), confidence)
            self.counts["predictions"] += n
            return out
        except Exception:
            self.counts["errors"] += 1
            raise
        finally:
            self.counts["seconds"] += time.time() - began

    def horizon(self, requests: DataFrame, days: int, confidence: float = 0.9) -> DataFrame:
        return self.predict(horizon_requests(requests, days), confidence)

    def stats(self) -> dict:
        n = self.counts["requests"]
        return self.counts | {"mean_seconds": self.counts["seconds"] / n if n else 0.0, "error_rate": self.counts["errors"] / n if n else 0.0}

    def health(self) -> dict:
        return {"status": "healthy" if self.model is not None else "unhealthy", "model_loaded": self.model is not None, "version": self.version, "uptime_s": (datetime.now(UTC) - self.started).total_seconds()}

    def info(self) -> dict:
        return {"version": self.version, "n_features": len(self.model.features), "features": list(self.model.features), "config": self.model.params()}
