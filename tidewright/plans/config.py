"""Configuration from YAML, overlaid with environment variables named TIDEWRIGHT_SECTION__NAME."""

from __future__ import annotations

import os
from dataclasses import asdict, dataclass, field, fields, is_dataclass
from pathlib import Path

from tidewright.operators.models import ModelConfig

PREFIX = "TIDEWRIGHT_"


@dataclass
class DataConfig:
    folder: str = "data"
    sales_file: str = "sales_train_evaluation.csv"
    calendar_file: str = "calendar.csv"
    prices_file: str = "sell_prices.csv"
    stores: list[str] = field(default_factory=list)


@dataclass
class TrainConfig:
    horizon: int = 28
    validation_days: int = 28
    n_folds: int = 0
    smoke: bool = False
    out: str = "artifacts"
    seed: int = 42


@dataclass
class Config:
    environment: str = "default"
    data: DataConfig = field(default_factory=DataConfig)
    model: ModelConfig = field(default_factory=ModelConfig)
    train: TrainConfig = field(default_factory=TrainConfig)

    def check(self) -> Config:
        if not 1 <= self.train.horizon <= 365 or self.train.validation_days < 1 or self.train.n_folds < 0:
            raise ValueError("horizon must be 1 to 365, validation_days positive, n_folds not negative")
        if not 1.0 <= self.model.variance_power <= 2.0 or not 0 < self.model.learning_rate <= 1 or self.model.trees < 1:
            raise ValueError("variance_power must be 1 to 2, learning_rate above 0 up to 1, trees positive")
        return self


def _overlay(target, values: dict) -> None:
    known = {f.name for f in fields(target)}
    for k, v in values.items():
        if k not in known:
            raise ValueError(f"unknown setting '{k}'")
        if is_dataclass(getattr(target, k)):
            _overlay(getattr(target, k), v or {})
        else:
            setattr(target, k, v)


def _typed(text: str, now):
    if isinstance(now, bool):
        return text.lower() in ("1", "true", "yes")
    if isinstance(now, list):
        return [x for x in text.split(",") if x]
    return type(now)(text) if now is not None else text


def load_config(path: str | None = None, environment: str | None = None, env: dict[str, str] | None = None) -> Config:
    """Defaults, then the file, then <environment>.yaml beside it, then environment variables."""
    import yaml

    config, env = Config(), dict(os.environ if env is None else env)
    environment = environment or env.get(f"{PREFIX}ENVIRONMENT")
    files = [Path(path)] if path else []
    if environment and path:
        files.append(Path(path).with_name(f"{environment}.yaml"))
    for f in files:
        if not f.exists():
            raise FileNotFoundError(f"{f} not found")
        _overlay(config, yaml.safe_load(f.read_text()) or {})
    if environment:
        config.environment = environment
    for name, text in env.items():
        section, _, key = name.removeprefix(PREFIX).lower().partition("__")
        if name.startswith(PREFIX) and key and hasattr(config, section) and hasattr(getattr(config, section), key):
            part = getattr(config, section)
            setattr(part, key, _typed(text, getattr(part, key)))
    return config.check()


def as_dict(config: Config) -> dict:
    return asdict(config)
