"""Writers. Re-running a day, a split or a run replaces its rows, never adds."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from hourgrid.operators import registry
from hourgrid.operators.contributions import PARTITIONS, SCHEMA
from hourgrid.schemas import PANEL_PARTITIONS, PANEL_VALUES, REGISTRY
from hourgrid.session import scratch_path


def _write_partitions(frame: DataFrame, path: str, partitions: tuple[str, ...]) -> int:
    """Replace the partitions the frame holds and return its row count.

    The rebalance hint gathers each partition's rows into full-size files and lets
    adaptive execution split a partition that holds most of the rows. The count is
    observed during the write, so it costs no second job.
    """
    seen = Observation()
    (
        frame.observe(seen, F.count(F.lit(1)).alias("rows"))
        .hint("rebalance", *partitions)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(*partitions)
        .parquet(path)
    )
    return seen.get["rows"]


def _stored(spark: SparkSession, path: str, like: DataFrame) -> DataFrame | None:
    try:
        return spark.read.schema(like.schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _merge_partitions(
    frame: DataFrame,
    path: str,
    partitions: tuple[str, ...],
    keys: tuple[str, ...],
    rank: Column,
    drop: Column,
) -> int:
    """Write the frame into the partitions it touches, keeping what else they hold.

    Of rows with equal keys the one with the highest ``rank`` stays; a stored row has
    rank 1. Stored rows of which ``drop`` is true go. The union is staged in the shared
    folder first, since Spark cannot replace files that it reads. Returns the frame's rows.
    """
    spark = frame.sparkSession
    old = _stored(spark, path, frame)
    if old is None:
        return _write_partitions(frame, path, partitions)
    staged = scratch_path(spark, "merge")
    new = frame.withColumn("_rank", rank)
    new.write.parquet(f"{staged}/new")
    fresh = spark.read.schema(new.schema).parquet(f"{staged}/new")
    if fresh.isEmpty():
        return 0
    touched = fresh.select(*(F.col(name).alias(f"_{name}") for name in partitions)).distinct()
    same = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in partitions]
    kept = old.where(~F.coalesce(drop, F.lit(False))).join(touched, same, "left_semi")
    both = fresh.unionByName(kept.withColumn("_rank", F.lit(1)))
    columns = F.struct(*frame.columns)
    best = both.groupBy(*keys).agg(F.max_by(columns, "_rank").alias("_row")).select("_row.*")
    best.write.parquet(f"{staged}/union")
    _write_partitions(
        spark.read.schema(frame.schema).parquet(f"{staged}/union"), path, partitions
    )
    return fresh.count()


def write_panel(panel: DataFrame, path: str, table: str | None = None) -> int:
    """Replace the days that the panel holds; with ``table``, register it and these days."""
    rows = _write_partitions(panel, path, PANEL_PARTITIONS)
    if table:
        days = _partition_values(panel.select(*PANEL_PARTITIONS))
        register_panel(panel.sparkSession, path, table, days, [])
    return rows


# --- Ingest by source day ---------------------------------------------------------


def contributions_path(path: str) -> str:
    return f"{path.rstrip('/')}_contributions"


def pending_path(path: str) -> str:
    return f"{path.rstrip('/')}_pending"


def rejects_path(path: str) -> str:
    return f"{path.rstrip('/')}_rejects"


def _partition_values(rows: DataFrame) -> list[tuple]:
    """Distinct partition values of a run: calendar days, so a short list."""
    return [tuple(row) for row in rows.distinct().collect()]


def _remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the table's own file system, if it is there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def _partition_folder(path: str, names: tuple[str, ...], values: tuple) -> str:
    parts = (
        f"{name}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}"
        for name, value in zip(names, values, strict=True)
    )
    return "/".join([path.rstrip("/"), *parts])


def _replace_scope(
    frame: DataFrame, path: str, partitions: tuple[str, ...], scope: Column
) -> list[tuple]:
    """Replace every stored partition in ``scope`` by the frame's, also by nothing.

    Returns the partitions that were or are there. ``frame`` must be a stored table. A run
    that fails between the write and the removal is mended by repeating it.
    """
    spark = frame.sparkSession
    old = _stored(spark, path, frame)
    before = [] if old is None else _partition_values(old.where(scope).select(*partitions))
    now = _partition_values(frame.select(*partitions))
    if now:
        _write_partitions(frame, path, partitions)
    for gone in set(before) - set(now):
        _remove(spark, _partition_folder(path, partitions, gone))
    return list(set(before) | set(now))


def _source_days(days: tuple[str, str]) -> Column:
    return F.col("source_day").between(*days)


def write_contributions(kept: DataFrame, path: str, days: tuple[str, str]) -> None:
    """Replace what the source days ``days`` contribute to the panel at ``path``.

    The hour days that had or have contributions of them are noted as pending first, so a
    run that fails half way leaves a list of what a later run has to merge again.
    """
    spark = kept.sparkSession
    target = contributions_path(path)
    old = _stored(spark, target, kept)
    touched = kept.select("hour_day")
    if old is not None:
        touched = touched.unionByName(old.where(_source_days(days)).select("hour_day"))
    touched.distinct().coalesce(1).write.mode("append").parquet(pending_path(path))
    _replace_scope(kept, target, PARTITIONS, _source_days(days))


def merge_pending(
    spark: SparkSession,
    path: str,
    merge: Callable[[DataFrame], DataFrame],
    table: str | None = None,
) -> int:
    """Merge the pending days from all contributions into the panel; returns their rows.

    Only these days' partitions of the contributions are read, whatever source day they
    are filed under. A day without contributions left is removed from the panel.
    """
    pending = spark.read.schema("hour_day date").parquet(pending_path(path)).distinct()
    days = [row.hour_day for row in pending.collect()]
    if not days:
        _remove(spark, pending_path(path))
        return 0
    inside = F.col("hour_day").isin([day for day in days if day is not None])
    if None in days:
        inside = F.coalesce(inside, F.lit(False)) | F.col("hour_day").isNull()
    kept = spark.read.schema(SCHEMA).parquet(contributions_path(path))
    staged = scratch_path(spark, "panel")
    panel = merge(kept.where(inside))
    panel.write.parquet(staged)
    panel = spark.read.schema(panel.schema).parquet(staged)
    now = _partition_values(panel.select(*PANEL_PARTITIONS))
    rows = _write_partitions(panel, path, PANEL_PARTITIONS) if now else 0
    parts = {(d.year, d.month, d.day) if d else (None, None, None) for d in days}
    gone = parts - set(now)
    for day in gone:
        _remove(spark, _partition_folder(path, PANEL_PARTITIONS, day))
    if table and (now or spark.catalog.tableExists(table)):
        register_panel(spark, path, table, now, list(gone))
    _remove(spark, pending_path(path))
    return rows


def write_rejects(rejected: DataFrame, path: str, days: tuple[str, str]) -> None:
    """Replace the rejected lines of the source days, and those without a visible day."""
    spark = rejected.sparkSession
    staged = scratch_path(spark, "rejects")
    rejected.write.parquet(staged)
    stored = spark.read.schema(rejected.schema).parquet(staged)
    scope = _source_days(days) | F.col("source_day").isNull()
    _replace_scope(stored, rejects_path(path), ("source_day",), scope)


def register_panel(
    spark: SparkSession, path: str, table: str, days: list[tuple], gone: list[tuple]
) -> None:
    """Create the table once; later runs add and drop just the days they changed."""
    if not spark.catalog.tableExists(table):
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in PANEL_VALUES)
        keys = ", ".join(f"`{name}` int" for name in PANEL_PARTITIONS)
        by = ", ".join(f"`{name}`" for name in PANEL_PARTITIONS)
        spark.sql(
            f"CREATE TABLE {table} ({fields}, {keys}) USING parquet "
            f"PARTITIONED BY ({by}) LOCATION '{path}'"
        )
        spark.catalog.recoverPartitions(table)
    else:
        def spec(day: tuple) -> str:
            pairs = (f"{n}={v}" for n, v in zip(PANEL_PARTITIONS, day, strict=True))
            return f"PARTITION ({', '.join(pairs)})"

        added = [spec(day) for day in days if None not in day]
        if added:
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(added)}")
        for day in gone:
            if None not in day:
                spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {spec(day)}")
    spark.catalog.refreshTable(table)


def write_feature_sets(features: DataFrame, path: str) -> int:
    """Both sides of the split in one job: ``path/split=train`` and ``split=eval``.

    A side without rows is left empty, with its columns, whatever an earlier run wrote.
    """
    spark = features.sparkSession
    staged = scratch_path(spark, "features")
    features.write.parquet(staged)
    kept = spark.read.schema(features.schema).parquet(staged)
    present = {values[0] for values in _partition_values(kept.select("split"))}
    rows = _write_partitions(kept, path, ("split",)) if present else 0
    for side in {"train", "eval"} - present:
        none = kept.where(F.lit(False)).drop("split").coalesce(1)
        none.write.mode("overwrite").parquet(f"{path.rstrip('/')}/split={side}")
    return rows


def write_features(features: DataFrame, path: str) -> None:
    features.write.mode("overwrite").parquet(path)


def write_forecasts(forecasts: DataFrame, path: str) -> None:
    forecasts.write.mode("overwrite").parquet(path)


def write_measures(long: DataFrame, path: str) -> int:
    """The long measure table, partitioned by date.

    A row replaces the stored one of its time, building and measure; others stay.
    """
    return _merge_partitions(
        long.withColumn("date", F.to_date("time")),
        path,
        ("date",),
        ("time", "dim_building_id", "measure_name"),
        F.lit(2),
        F.lit(False),
    )


def send_measures(long: DataFrame, send: Callable[[Iterator[Row]], None]) -> None:
    """Hand each partition's rows to ``send``, for a store Spark cannot write to.

    ``send`` runs on the executors and should batch its requests; a lost executor
    repeats a partition, so the store must accept the same row twice.
    """
    long.foreachPartition(send)


def write_evaluation_report(report: DataFrame, path: str) -> None:
    report.write.mode("overwrite").json(path)


def set_approval(spark: SparkSession, path: str, status: str, where: Column) -> int:
    """Change the state of stored registry entries; returns how many."""
    stored = spark.read.schema(REGISTRY).parquet(path)
    return append_registry(registry.with_status(stored, status, where), path)


def append_registry(entries: DataFrame, path: str) -> int:
    """Add a run's entries; a repeated run replaces its own, pending again."""
    return _merge_partitions(
        entries,
        path,
        ("model_package_group",),
        ("model_package_id",),
        F.lit(2),
        F.lit(False),
    )
