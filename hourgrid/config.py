"""Typed settings for features, models and quality gates."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import asdict, dataclass, field, fields, replace
from typing import Any

# Output names that feature consumers and stored models rely on.
FEATURE_PREFIXES = {
    "consumption_kwh": "consumption",
    "temperature_c": "temp",
    "solar_irradiance_ghi": "ghi",
}
AGGREGATE_SUFFIXES = {"avg": "avg", "stddev": "std", "min": "min", "max": "max"}

TIME_FEATURES = (
    "hour_of_day",
    "day_of_week",
    "day_of_month",
    "month_of_year",
    "is_weekend",
)
TRAINING_COLUMNS = (
    "building_id",
    "timestamp_hour",
    "consumption_kwh",
    "solar_kwh",
    "temperature_c",
    "solar_irradiance_ghi",
    "humidity",
    "is_holiday_flag",
    "hour_of_day",
    "day_of_week",
    "day_of_month",
    "month_of_year",
    "consumption_lag_24h",
    "temp_lag_24h",
    "consumption_roll_avg_24h",
    "consumption_roll_std_24h",
)
INFERENCE_COLUMNS = (
    "building_id",
    "timestamp_hour",
    "temperature_c",
    "hour_of_day",
    "day_of_week",
    "consumption_lag_24h",
    "solar_irradiance_ghi",
    "humidity",
    "is_holiday_flag",
)
TREE_FEATURES = (
    "temperature_c",
    "solar_irradiance_ghi",
    "humidity",
    "is_holiday_flag",
    "hour_of_day",
    "day_of_week",
    "day_of_month",
    "month_of_year",
    "consumption_lag_24h",
    "consumption_lag_168h",
    "consumption_roll_avg_24h",
)


@dataclass(frozen=True)
class Rolling:
    windows: tuple[int, ...]
    aggs: tuple[str, ...]


@dataclass(frozen=True)
class FeatureSpec:
    """Which calendar, lag and rolling features exist, and how hours are counted.

    ``mode="rows"`` counts panel rows (a missing hour shifts the lag);
    ``mode="hours"`` counts clock hours (a missing hour gives NULL).
    """

    target: str = "consumption_kwh"
    time: str = "timestamp_hour"
    key: str = "building_id"
    time_features: tuple[str, ...] = TIME_FEATURES
    lags: Mapping[str, tuple[int, ...]] = field(
        default_factory=lambda: {
            "consumption_kwh": (24, 48, 168),
            "temperature_c": (24, 48, 168),
            "solar_irradiance_ghi": (24,),
        }
    )
    rolling: Mapping[str, Rolling] = field(
        default_factory=lambda: {
            "consumption_kwh": Rolling((3, 24, 168), ("avg", "stddev", "min", "max")),
            "temperature_c": Rolling((24,), ("avg",)),
        }
    )
    interactions: Mapping[str, tuple[str, str]] = field(
        default_factory=lambda: {"temp_x_hour": ("temperature_c", "hour_of_day")}
    )
    imputation_value: float = 0.0
    mode: str = "rows"

    def __post_init__(self) -> None:
        if self.mode not in ("rows", "hours"):
            raise ValueError(f"mode must be 'rows' or 'hours', got {self.mode!r}")
        for rolling in self.rolling.values():
            unknown = set(rolling.aggs) - set(AGGREGATE_SUFFIXES)
            if unknown:
                raise ValueError(f"Unknown rolling aggregates: {sorted(unknown)}")

    @classmethod
    def from_mapping(cls, settings: Mapping[str, Any]) -> FeatureSpec:
        """Build from the plain mapping a configuration file holds."""
        spec = cls()
        renames = {
            "target_column": "target",
            "timestamp_column": "time",
            "building_id_column": "key",
        }
        changes: dict[str, Any] = {
            ours: settings[theirs]
            for theirs, ours in renames.items()
            if theirs in settings
        }
        if "time_features" in settings:
            changes["time_features"] = tuple(settings["time_features"])
        if "lag_features" in settings:
            changes["lags"] = {
                name: tuple(hours) for name, hours in settings["lag_features"].items()
            }
        if "rolling_window_features" in settings:
            changes["rolling"] = {
                name: Rolling(tuple(entry["windows"]), tuple(entry["aggs"]))
                for name, entry in settings["rolling_window_features"].items()
            }
        for name in ("imputation_value", "mode"):
            if name in settings:
                changes[name] = settings[name]
        return replace(spec, **changes)

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> FeatureSpec:
        kept = json.loads(text)
        kept["time_features"] = tuple(kept["time_features"])
        kept["lags"] = {name: tuple(hours) for name, hours in kept["lags"].items()}
        kept["rolling"] = {
            name: Rolling(tuple(entry["windows"]), tuple(entry["aggs"]))
            for name, entry in kept["rolling"].items()
        }
        kept["interactions"] = {name: tuple(pair) for name, pair in kept["interactions"].items()}
        return cls(**kept)


def lag_name(column: str, hours: int) -> str:
    return f"{FEATURE_PREFIXES.get(column, column)}_lag_{hours}h"


def rolling_name(column: str, hours: int, agg: str) -> str:
    prefix = FEATURE_PREFIXES.get(column, column)
    return f"{prefix}_roll_{AGGREGATE_SUFFIXES[agg]}_{hours}h"


class _Params:
    """Shared parsing for the model parameter classes."""

    prefix = ""

    @classmethod
    def from_mapping(cls, settings: Mapping[str, Any]):
        """Accept parameters with or without the model's prefix; reject unknown ones."""
        known = {f.name for f in fields(cls)}
        values: dict[str, Any] = {}
        for name, value in settings.items():
            short = name.removeprefix(cls.prefix)
            if short not in known:
                raise ValueError(f"Unknown parameter for {cls.__name__}: {name}")
            if short in values:
                raise ValueError(f"Parameter given twice: {short}")
            values[short] = tuple(value) if isinstance(value, list) else value
        return cls(**values)

    def as_strings(self) -> dict[str, str]:
        return {
            f"{self.prefix}{f.name}": str(getattr(self, f.name)) for f in fields(self)
        }


@dataclass(frozen=True)
class TrendSeasonalParams(_Params):
    changepoint_prior_scale: float = 0.05
    seasonality_prior_scale: float = 10.0
    holidays_prior_scale: float = 10.0
    daily_seasonality: bool | str = True
    weekly_seasonality: bool | str = True
    yearly_seasonality: bool | str = "auto"
    n_changepoints: int = 25
    changepoint_range: float = 0.8
    interval_width: float = 0.8
    regressors: tuple[str, ...] = ("is_holiday_flag",)

    prefix = "prophet_"

    def __post_init__(self) -> None:
        for name in ("daily", "weekly", "yearly"):
            if getattr(self, f"{name}_seasonality") not in (True, False, "auto"):
                raise ValueError(f"{name}_seasonality must be True, False or 'auto'")


@dataclass(frozen=True)
class BoostedTreeParams(_Params):
    eta: float = 0.1
    max_depth: int = 5
    num_boost_round: int = 100
    subsample: float = 0.7
    colsample_bytree: float = 0.7
    min_child_weight: int = 1
    gamma: float = 0.0
    reg_lambda: float = 1.0
    reg_alpha: float = 0.0
    seed: int = 0

    prefix = "xgb_"

    @classmethod
    def from_mapping(cls, settings: Mapping[str, Any]):
        renames = {"xgb_lambda": "reg_lambda", "xgb_alpha": "reg_alpha"}
        return super().from_mapping(
            {renames.get(name, name): value for name, value in settings.items()}
        )

    def __post_init__(self) -> None:
        for name in ("reg_lambda", "reg_alpha"):
            if getattr(self, name) < 0:
                raise ValueError(f"{name} must not be negative")


@dataclass(frozen=True)
class QualityThresholds:
    max_mape: float = 20.0
    max_rmse: float = 5.0


LOOKBACK_DAYS = 14
HORIZON_HOURS = 72
