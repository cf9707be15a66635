"""Trailing windows over a panel, laid out so no task holds a whole building.

A trailing window needs at most ``reach`` earlier rows. The series of a building
is therefore cut into blocks, each block also receives the last ``reach`` rows of
the block before it, and Spark partitions by (building, block). Borrowed rows only
feed the windows and are dropped afterwards, so every result equals the one of an
undivided window.

``hours`` mode cuts by the clock: one shuffle, which the grids of ``hour_grid`` use too. ``rows`` mode cuts by row position,
which first has to be found (rows per chunk, running total, position inside the
chunk). That reads the panel twice, the second time only its key and hour, so the
panel should be a stored table, not raw feeds.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from pyspark.sql.types import DoubleType, StructField, StructType

from hourgrid.functions.clock import hour_index
from hourgrid.operators.hour_grid import Frame, rolled

WindowColumn = Callable[[WindowSpec], Column]

BLOCK_ROWS = 4_096


def trailing_columns(
    panel: DataFrame,
    passes: Sequence[Mapping[str, WindowColumn]],
    *,
    reach: int,
    mode: str,
    key: str = "building_id",
    time: str = "timestamp_hour",
    block_rows: int | None = None,
    frames: Mapping[str, Frame] | None = None,
) -> DataFrame:
    """Add window columns that look back at most ``reach`` rows (or hours).

    Each pass may use the columns of the passes before it; all share one layout, so
    a further pass costs neither a shuffle nor a sort. ``frames`` are aggregates over
    clock hours, for ``hours`` mode; they are taken from each block's grid of hours.
    """
    if not any(passes) and not frames:
        return panel
    block_rows = block_rows or max(BLOCK_ROWS, 16 * reach)
    if reach > block_rows:
        raise ValueError("A block must be at least as long as the reach")
    if mode == "hours":
        placed = panel.withColumn("_at", hour_index(time))
    else:
        placed = _with_row_position(panel, key, time, block_rows)
    window = Window.partitionBy(key, "_block").orderBy("_at")
    windowed = _add(_lend_block_tails(placed, reach, block_rows), passes, window)
    if frames:
        kept = windowed.drop("_at", "_block", "_own").schema
        schema = StructType([*kept, *(StructField(name, DoubleType()) for name in frames)])
        grid = rolled(frames, "_at", "_own", ("_at", "_block", "_own"))
        return windowed.groupBy(key, "_block").applyInArrow(grid, schema)
    return windowed.where("_own").drop("_at", "_block", "_own")


def _add(
    frame: DataFrame, passes: Sequence[Mapping[str, WindowColumn]], window: WindowSpec
) -> DataFrame:
    for columns in passes:
        frame = frame.withColumns({name: make(window) for name, make in columns.items()})
    return frame


def _lend_block_tails(placed: DataFrame, reach: int, block_rows: int) -> DataFrame:
    """Send every row to its block, and the last ``reach`` of a block to the next."""
    size = F.lit(block_rows).cast("bigint")
    home = F.floor(F.col("_at") / size).cast("bigint")
    near_end = F.pmod(F.col("_at"), size) >= block_rows - reach
    blocks = F.when(near_end, F.array(home, home + 1)).otherwise(F.array(home))
    return placed.withColumn("_block", F.explode(blocks)).withColumn(
        "_own", F.col("_block").eqNullSafe(home)
    )


def _with_row_position(
    panel: DataFrame, key: str, time: str, chunk_hours: int
) -> DataFrame:
    """Number a building's rows in time order, ``_at`` = 0, 1, 2, ...

    Row counts per chunk are partially aggregated; their running total orders a
    few chunks per building, not its rows. ``_series`` and ``_chunk`` are never
    NULL, so the join is a plain equality on the keys the rows are already
    partitioned by, and only the counts move.
    """
    name = F.col(key).cast("string")
    series = F.when(name.isNull(), "-").otherwise(F.concat(F.lit("+"), name))
    chunk = F.floor(hour_index(time) / F.lit(chunk_hours)).cast("bigint")
    # Rows without a time sort first, as they do in an undivided window.
    first = F.lit(-(2**62)).cast("bigint")
    chunked = panel.withColumns({"_series": series, "_chunk": F.coalesce(chunk, first)})
    within = Window.partitionBy("_series", "_chunk").orderBy(time)
    earlier = (
        Window.partitionBy("_series")
        .orderBy("_chunk")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = (
        chunked.groupBy("_series", "_chunk")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(
            "_series",
            "_chunk",
            F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
        )
    )
    return (
        chunked.withColumn("_within", F.row_number().over(within))
        .join(before, ["_series", "_chunk"])
        .withColumn("_at", F.col("_before") + F.col("_within") - 1)
        .drop("_series", "_chunk", "_within", "_before")
    )
