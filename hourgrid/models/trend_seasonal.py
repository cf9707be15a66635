"""Additive trend + seasonality + regressors, one model per building.

The decomposition follows Taylor & Letham, "Forecasting at Scale" (2018): a
piecewise-linear trend, Fourier terms per season, and linear regressors. The fit is the
most probable one under the published priors: normal for seasons, regressors and the first
line, Laplace for the changes of slope, so most of these are zero. The interval is the
residual spread, and beyond the training range what future changes of slope would add.

The fit needs only the cross-products X'X, X'y and y'y, and those add up. Fitting is
two aggregations: cross-products per (building, block of hours), then their sum
and a small solve per building. No task ever holds a building's whole history.
Scoring is a join with the coefficients and a sum of built-in expressions.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass
from functools import reduce
from math import pi
from operator import add
from statistics import NormalDist

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourgrid.config import TrendSeasonalParams
from hourgrid.functions.clock import hour_index
from hourgrid.functions.numeric import or_zero
from hourgrid.models import ridge
from hourgrid.schemas import FORECAST_COLUMNS

# Published defaults of the additive model. Season = period in
# hours, Fourier order, and the hours of history 'auto' asks for.
SEASONS = {
    "daily": (24.0, 4, 2 * 24),
    "weekly": (168.0, 3, 14 * 24),
    "yearly": (8766.0, 10, 730 * 24),
}
TREND_PRIOR_SCALE = 5.0

BLOCK_HOURS = 4_096


@dataclass(frozen=True)
class Layout:
    """Position and penalty of every design column; shared by fit and scoring."""

    first_hour: int
    span_hours: int
    changepoints: tuple[float, ...]
    seasons: tuple[str, ...]
    regressors: tuple[str, ...]
    interval_width: float

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> Layout:
        return cls(
            **{k: tuple(v) if isinstance(v, list) else v for k, v in json.loads(text).items()}
        )

    def position(self) -> Column:
        """Position in the training range, 0 to 1; later hours lie beyond 1."""
        return (F.col("_hour") - self.first_hour) / F.lit(float(self.span_hours))

    def effects(self) -> list[Column]:
        """Seasons and regressors as expressions on ``_hour`` and the features."""
        waves = [
            wave(F.col("_hour") * F.lit(2.0 * pi * order / SEASONS[season][0]))
            for season in self.seasons
            for order in range(1, SEASONS[season][1] + 1)
            for wave in (F.sin, F.cos)
        ]
        return waves + [or_zero(name) for name in self.regressors]

    def prediction(self) -> Column:
        """Design row times coefficients.

        The trend is looked up as the line of its stretch instead of summed over
        all changepoints: with every term spelled out, the generated code outgrows
        what the JVM compiles, and scoring takes ten times as long.
        """
        t = self.position()
        last = len(self.changepoints)
        stretch = F.lit(0)
        if last:
            passed = F.floor(t / F.lit(self.changepoints[0]))
            stretch = F.least(F.greatest(passed, F.lit(0)), F.lit(last)).cast("int")
        trend = F.get("offsets", stretch) + F.get("slopes", stretch) * t
        beta = F.col("coefficients")
        effects = [
            effect * beta.getItem(2 + last + position)
            for position, effect in enumerate(self.effects())
        ]
        return reduce(add, effects, trend)

    def prior_scales(self, params: TrendSeasonalParams, trend: float) -> np.ndarray:
        waves = sum(2 * SEASONS[season][1] for season in self.seasons)
        return np.repeat(
            [
                trend,
                params.changepoint_prior_scale,
                params.seasonality_prior_scale,
                params.holidays_prior_scale,
            ],
            [2, len(self.changepoints), waves, len(self.regressors)],
        )

    def hours_needed(self, params: TrendSeasonalParams) -> np.ndarray:
        """History a building must have before each column takes part."""
        needed = [0] * (2 + len(self.changepoints))
        for season in self.seasons:
            _, order, minimum = SEASONS[season]
            auto = getattr(params, f"{season}_seasonality") == "auto"
            needed += [minimum if auto else 0] * (2 * order)
        return np.array(needed + [0] * len(self.regressors))


@dataclass(frozen=True)
class TrendSeasonalModel:
    coefficients: DataFrame
    layout: Layout

    def forecast(self, features: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """The five forecast columns; a building without a model gets NULLs.

        ``features`` needs the key columns and the model's regressors; its columns
        in ``keep`` are passed on.
        """
        half = NormalDist().inv_cdf((1 + self.layout.interval_width) / 2)
        scored = (
            features.withColumn("_hour", hour_index("timestamp_hour"))
            .join(self.coefficients, "building_id", "left")
            .withColumn("yhat", self.layout.prediction())
        )
        beyond = F.greatest(self.layout.position() - 1.0, F.lit(0.0))
        variance = F.col("sigma") * F.col("sigma") + F.col("drift") * beyond * beyond * beyond
        spread = F.sqrt(variance) * F.lit(half)
        return scored.withColumns(
            {
                "yhat_lower": F.col("yhat") - spread,
                "yhat_upper": F.col("yhat") + spread,
            }
        ).select(*FORECAST_COLUMNS, *keep)


def plan_layout(
    first_hour: int,
    last_hour: int,
    params: TrendSeasonalParams,
    regressors: Sequence[str],
) -> Layout:
    """Changepoints sit evenly in the first part of the training range.

    The first one is one spacing after the start, so it also gives the spacing.
    """
    n = params.n_changepoints
    points = (params.changepoint_range * (i + 1) / (n + 1) for i in range(n))
    return Layout(
        first_hour=first_hour,
        span_hours=max(last_hour - first_hour, 1),
        changepoints=tuple(points),
        seasons=tuple(s for s in SEASONS if getattr(params, f"{s}_seasonality")),
        regressors=tuple(regressors),
        interval_width=params.interval_width,
    )


def training_range(train: DataFrame, time: str = "timestamp_hour") -> tuple[int, int]:
    """First and last hour of the training rows: one aggregated row."""
    bounds = train.agg(F.min(time).alias("lo"), F.max(time).alias("hi"))
    row = bounds.select(hour_index("lo").alias("lo"), hour_index("hi").alias("hi")).first()
    if row.lo is None:
        raise ValueError("There are no rows to train on")
    return row.lo, row.hi


def fit_trend_seasonal(
    train: DataFrame,
    params: TrendSeasonalParams | None = None,
    target: str = "consumption_kwh",
    hours: tuple[int, int] | None = None,
    trend_prior_scale: float = TREND_PRIOR_SCALE,
) -> TrendSeasonalModel:
    """Fit every building of ``train``; ``hours`` saves the range query.

    With an infinite ``trend_prior_scale`` and nothing but a trend, the fit is the line of
    ordinary least squares.
    """
    params = params or TrendSeasonalParams()
    present = [name for name in params.regressors if name in train.columns]
    layout = plan_layout(*(hours or training_range(train)), params, present)
    hour = hour_index("timestamp_hour")
    rows = train.where(
        F.col(target).isNotNull() & ~F.isnan(target) & F.col("timestamp_hour").isNotNull()
    ).select(
        "building_id",
        F.floor(hour / F.lit(BLOCK_HOURS)).alias("_block"),
        hour.alias("_hour"),
        F.col(target).cast("double").alias("_y"),
        *present,
    )
    # Shuffle the narrow rows, widen them to the design afterwards; the grouping
    # below then finds its partitioning already in place.
    design = rows.repartition("building_id", "_block").select(
        "building_id",
        "_block",
        "_hour",
        layout.position().alias("_at"),
        F.array(*layout.effects(), F.col("_y")).alias("_row"),
    )
    changepoints = np.array(layout.changepoints)
    partial = design.groupBy("building_id", "_block").applyInArrow(
        ridge.cross_products(changepoints), ridge.PARTIAL_SCHEMA
    )
    solve = ridge.solver(
        layout.prior_scales(params, trend_prior_scale), layout.hours_needed(params), changepoints
    )
    coefficients = partial.groupBy("building_id").applyInPandas(
        solve, ridge.COEFFICIENT_SCHEMA
    )
    return TrendSeasonalModel(coefficients, layout)


def linear_trend(
    panel: DataFrame, origin_hour: int, target: str = "consumption_kwh"
) -> DataFrame:
    """Least-squares line per building over hours since ``origin_hour``."""
    hours = (hour_index("timestamp_hour") - origin_hour).cast("double")
    return panel.groupBy("building_id").agg(
        F.regr_slope(F.col(target), hours).alias("slope"),
        F.regr_intercept(F.col(target), hours).alias("intercept"),
        F.count(target).alias("n_obs"),
    )
