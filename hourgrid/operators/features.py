"""Calendar, lag, rolling and interaction features.

Training and inference both go through ``feature_table``, so they cannot drift
apart.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from itertools import zip_longest
from operator import add

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from hourgrid.config import (
    TRAINING_COLUMNS,
    FeatureSpec,
    lag_name,
    rolling_name,
)
from hourgrid.functions.clock import calendar_part, moment
from hourgrid.operators.hour_grid import Frame
from hourgrid.operators.panel import panel_range
from hourgrid.operators.windows import WindowColumn, trailing_columns

DAY = 24
_AGGREGATES = {
    "avg": F.avg,
    "stddev": F.stddev_samp,
    "min": F.min,
    "max": F.max,
    "sum": F.sum,
    "count": F.count,
    "mean": F.avg,
    "var_pop": F.var_pop,
}


@dataclass(frozen=True)
class WindowFeature:
    """A feature as window columns in up to two passes, and steps combining them."""

    reach: int
    first: Mapping[str, WindowColumn]
    second: Mapping[str, WindowColumn] = field(default_factory=dict)
    combine: Sequence[Callable[[], dict[str, Column]]] = ()
    frames: Mapping[str, Frame] = field(default_factory=dict)


def _lag(column: str, hours: int, mode: str) -> WindowColumn:
    def over(window: WindowSpec) -> Column:
        if mode == "rows":
            return F.lag(column, hours).over(window)
        # One row per hour: the frame holds the row exactly `hours` ago, or nothing.
        return F.max(column).over(window.rangeBetween(-hours, -hours))

    return over


def _trailing(column: str, rows: int, agg: str) -> WindowColumn:
    def over(window: WindowSpec) -> Column:
        return _AGGREGATES[agg](column).over(window.rowsBetween(1 - rows, 0))

    return over


# Per aggregate, the parts of a day that an aggregate over several days needs.
_DAY_PARTS = {
    "avg": ("sum", "count"),
    "stddev": ("sum", "count", "mean", "var_pop"),
    "min": ("min",),
    "max": ("max",),
}


def _rolling_days(name: str, column: str, rows: int, agg: str) -> WindowFeature:
    """A window of whole days, combined from trailing days.

    A sliding frame is re-aggregated for every row, so a week costs 168 steps per
    row. One frame of 24 rows plus six look-backs to it gives the same result.
    """
    parts = {part: f"_{column}_{part}_day" for part in _DAY_PARTS[agg]}
    lags = range(DAY, rows, DAY)
    n, mean = f"_{column}_n_{rows}", f"_{column}_mean_{rows}"

    def days(part: str) -> list[Column]:
        return [F.col(parts[part]), *[F.col(f"{parts[part]}_{k}") for k in lags]]

    def total(columns: list[Column]) -> Column:
        return reduce(add, [F.coalesce(c, F.lit(0)) for c in columns])

    def extreme() -> dict[str, Column]:
        pick = F.array_min if agg == "min" else F.array_max
        return {name: pick(F.array(*days(agg)))}

    def count() -> dict[str, Column]:
        return {n: total(days("count"))}

    def average() -> dict[str, Column]:
        column_name = name if agg == "avg" else mean
        return {column_name: F.when(F.col(n) > 0, total(days("sum")) / F.col(n))}

    def spread() -> dict[str, Column]:
        # Within the days plus between their means: nothing cancels.
        offsets = [F.col(f"{parts['mean']}_{k}") for k in lags]
        squares = total(
            [
                rows_of_day * (var + (day - F.col(mean)) * (day - F.col(mean)))
                for day, rows_of_day, var in zip(
                    [F.col(parts["mean"]), *offsets], days("count"), days("var_pop")
                )
            ]
        )
        return {name: F.when(F.col(n) > 1, F.sqrt(squares / (F.col(n) - 1)))}

    steps = {
        "avg": (count, average),
        "stddev": (count, average, spread),
        "min": (extreme,),
        "max": (extreme,),
    }
    return WindowFeature(
        rows - 1,
        {made: _trailing(column, DAY, part) for part, made in parts.items()},
        {f"{made}_{k}": _lag(made, k, "rows") for made in parts.values() for k in lags},
        steps[agg],
    )


def window_features(spec: FeatureSpec) -> dict[str, WindowFeature]:
    """Every lag and rolling feature of the spec."""
    features: dict[str, WindowFeature] = {}
    for column, lags in spec.lags.items():
        for hours in lags:
            name = lag_name(column, hours)
            features[name] = WindowFeature(hours, {name: _lag(column, hours, spec.mode)})
    for column, rolling in spec.rolling.items():
        for hours in rolling.windows:
            for agg in rolling.aggs:
                name = rolling_name(column, hours, agg)
                if spec.mode == "hours":
                    frames = {name: Frame(column, hours, agg)}
                    features[name] = WindowFeature(hours - 1, {}, frames=frames)
                    continue
                if hours % DAY == 0:
                    features[name] = _rolling_days(name, column, hours, agg)
                    continue
                make = _trailing(column, hours, agg)
                features[name] = WindowFeature(hours - 1, {name: make})
    return features


def add_calendar_features(
    panel: DataFrame, spec: FeatureSpec, wanted: Collection[str] | None = None
) -> DataFrame:
    names = [n for n in spec.time_features if wanted is None or n in wanted]
    return panel.withColumns({n: calendar_part(n, spec.time) for n in names})


def add_window_features(
    panel: DataFrame,
    spec: FeatureSpec,
    wanted: Collection[str] | None = None,
    block_rows: int | None = None,
) -> DataFrame:
    """Add the wanted lag and rolling columns (all of the spec by default)."""
    chosen = {
        name: feature
        for name, feature in window_features(spec).items()
        if wanted is None or name in wanted
    }
    first: dict[str, WindowColumn] = {}
    second: dict[str, WindowColumn] = {}
    frames: dict[str, Frame] = {}
    for feature in chosen.values():
        frames.update(feature.frames)
        first.update(feature.first)
        second.update(feature.second)
    windowed = trailing_columns(
        panel,
        [first, second],
        reach=max((feature.reach for feature in chosen.values()), default=0),
        mode=spec.mode,
        key=spec.key,
        time=spec.time,
        block_rows=block_rows,
        frames=frames,
    )
    for steps in zip_longest(*[feature.combine for feature in chosen.values()]):
        columns: dict[str, Column] = {}
        for step in filter(None, steps):
            columns.update(step())
        windowed = windowed.withColumns(columns)
    return windowed.select(*panel.columns, *chosen)


def add_interactions(
    features: DataFrame, spec: FeatureSpec, wanted: Collection[str] | None = None
) -> DataFrame:
    return features.withColumns(
        {
            name: F.col(left) * F.col(right)
            for name, (left, right) in spec.interactions.items()
            if wanted is None or name in wanted
        }
    )


def existing_columns(frame: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns the frame has, in the wanted order."""
    return frame.select(*[name for name in wanted if name in frame.columns])


def feature_table(
    panel: DataFrame,
    spec: FeatureSpec,
    columns: Sequence[str],
) -> DataFrame:
    """Compute exactly ``columns``, in that order."""
    wanted = set(columns)
    for name in wanted & set(spec.interactions):
        wanted.update(spec.interactions[name])
    # The windows move rows between tasks, so calendar parts come after them.
    with_windows = add_window_features(panel, spec, wanted)
    with_calendar = add_calendar_features(with_windows, spec, wanted)
    return add_interactions(with_calendar, spec, wanted).select(*columns)


def training_features(
    panel: DataFrame,
    start: str,
    end: str,
    split: str,
    spec: FeatureSpec | None = None,
    columns: Sequence[str] = TRAINING_COLUMNS,
) -> DataFrame:
    """Complete feature rows of the days ``start`` to ``end``, labelled by split.

    The split follows the windows, so evaluation lags may use training hours.
    """
    spec = spec or FeatureSpec()
    history = panel_range(panel, start, end, spec.time)
    features = feature_table(history, spec, columns)
    is_train = F.col(spec.time) < moment(split)
    return features.dropna(how="any").withColumn(
        "split", F.when(is_train, "train").otherwise("eval")
    )


def train_eval_split(features: DataFrame) -> tuple[DataFrame, DataFrame]:
    train = features.where(F.col("split") == "train").drop("split")
    evaluation = features.where(F.col("split") == "eval").drop("split")
    return train, evaluation


def split_sizes(features: DataFrame) -> DataFrame:
    return features.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


def split_bounds(features: DataFrame, time: str = "timestamp_hour") -> DataFrame:
    return features.groupBy("split").agg(
        F.min(time).alias("first_hour"), F.max(time).alias("last_hour")
    )
