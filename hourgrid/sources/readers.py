"""Schema'd readers for raw feeds, the panel, feature sets and forecasts."""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourgrid import schemas
from hourgrid.functions.clock import as_datetime, parse_timestamp
from hourgrid.operators.contributions import CORRUPT
from hourgrid.operators.rollup import between_dates
from hourgrid.schemas import PANEL_PARTITIONS
from hourgrid.session import scratch_path

# File suffixes a forecast folder may hold.
PARQUET_SUFFIXES = (".parquet",)
CSV_SUFFIXES = (".csv", ".out")


def _json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_feed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A feed's records, and its corrupt lines in ``CORRUPT``, with the day they show."""
    kept = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    lines = (
        spark.read.schema(kept)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )
    shown = F.nullif(F.regexp_extract(CORRUPT, r'"date_partition_col"\s*:\s*"([^"]*)"', 1), F.lit(""))
    return lines.withColumn("date_partition_col", F.coalesce("date_partition_col", shown))


def rejected(feed: DataFrame, name: str) -> DataFrame:
    """Lines that are no records, with what could be read of them as JSON.

    Naming every field also keeps the scan from leaving columns out: a line is only known
    to be corrupt if its bad field is parsed.
    """
    fields = [c for c in feed.columns if c != CORRUPT]
    return feed.where(F.col(CORRUPT).isNotNull()).select(
        F.lit(name).alias("feed"),
        F.col(CORRUPT).alias("line"),
        F.to_json(F.struct(*fields)).alias("read"),
        F.col("date_partition_col").alias("source_day"),
    )


def read_consumption(spark: SparkSession, path: str, start: str, end: str) -> DataFrame:
    return between_dates(_json(spark, path, schemas.RAW_CONSUMPTION), start, end)


def read_solar(spark: SparkSession, path: str, start: str, end: str) -> DataFrame:
    return between_dates(_json(spark, path, schemas.RAW_SOLAR), start, end)


def read_weather(spark: SparkSession, path: str, start: str, end: str) -> DataFrame:
    return between_dates(_json(spark, path, schemas.RAW_WEATHER), start, end)


def read_calendar(spark: SparkSession, path: str) -> DataFrame:
    return _json(spark, path, schemas.RAW_CALENDAR)


def read_weather_forecast(spark: SparkSession, path: str) -> DataFrame:
    return _json(spark, path, schemas.WEATHER_FORECAST)


def read_evaluation_report(spark: SparkSession, path: str) -> DataFrame:
    return _json(spark, path, schemas.EVALUATION_REPORT)


def _hours_as_ntz(frame: DataFrame) -> DataFrame:
    """Tables written elsewhere may hold zoned hours; keep the wall clock."""
    zoned = [
        field.name for field in frame.schema if isinstance(field.dataType, T.TimestampType)
    ]
    return frame.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned})


def read_panel(
    spark: SparkSession, path: str, start: str | date, end: str | date
) -> DataFrame:
    """The stored panel's rows of the days ``start`` to ``end``, both inclusive.

    The bounds are put on the partition columns, so only those days are listed and
    read; a predicate on the hour alone would scan the whole table.
    """
    first, last = (
        F.lit(as_datetime(bound).date().isoformat()).cast("date") for bound in (start, end)
    )
    day = F.make_date(*PANEL_PARTITIONS)
    return _hours_as_ntz(spark.read.parquet(path)).where(day.between(first, last))


def read_features(
    spark: SparkSession, path: str, merge_schema: bool = False
) -> DataFrame:
    """Every Parquet file below ``path`` as one frame, columns matched by name.

    ``merge_schema`` is for folders whose files differ in columns; it reads the
    footer of every file.
    """
    merge = "true" if merge_schema else "false"
    files = spark.read.option("mergeSchema", merge).option("pathGlobFilter", "*.parquet")
    try:
        return _hours_as_ntz(files.parquet(path))
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise FileNotFoundError(f"No Parquet files found below {path}") from error
        raise


def _forecast_csv(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """CSV files matched by the names in their headers, whatever order or extras.

    The text is read once, into the shared folder, with each line's file and number. A
    file's header is its first line; the table of headers stays in Spark and is joined to
    the lines. The driver sees one number, the width of the widest header.
    """
    staged = scratch_path(spark, "csv_lines")
    lines = spark.read.option("pathGlobFilter", glob or "*").text(path)
    lines.select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("number"),
    ).where(F.trim("value") != "").write.parquet(staged)
    kept = spark.read.parquet(staged)
    # Lines of a block are numbered in order, and the first block of a file starts at 0.
    headers = (
        kept.where("start = 0")
        .groupBy("file")
        .agg(F.min(F.struct("number", "value")).alias("first"))
        .select("file", F.col("first.number").alias("header_number"), F.col("first.value").alias("header"))
    )
    commas = F.length("header") - F.length(F.replace("header", F.lit(","), F.lit("")))
    width = (headers.agg(F.max(commas)).first()[0] or 0) + 1
    cells = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(width)])

    def split(line: str) -> Column:
        parsed = F.from_csv(line, cells.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "))
        return F.array(*(parsed[name] for name in cells.fieldNames()))

    names = headers.select("file", "header_number", F.transform(split("header"), F.trim).alias("names"))
    rows = (
        kept.join(names, "file")
        .where(F.col("number") != F.col("header_number"))
        .select("names", split("value").alias("cells"))
    )

    def read(field: T.StructField) -> Column:
        place = F.array_position("names", F.lit(field.name)).cast("int")
        cell = F.get("cells", place - 1)
        if field.name == "timestamp_hour":
            return F.coalesce(parse_timestamp(cell), cell.try_cast("timestamp_ntz"))
        return cell.try_cast(field.dataType)

    return rows.select(*[read(field).alias(field.name) for field in schemas.FORECAST])


def _forecast_parquet(
    spark: SparkSession, path: str, glob: str | None = None
) -> DataFrame:
    reader = spark.read.schema(schemas.FORECAST)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


def read_forecast_file(spark: SparkSession, path: str) -> DataFrame:
    """One forecast file, by suffix."""
    if path.endswith(PARQUET_SUFFIXES):
        return _forecast_parquet(spark, path)
    if path.endswith(CSV_SUFFIXES):
        return _forecast_csv(spark, path)
    raise ValueError(f"Neither Parquet nor CSV by its suffix: {path}")


def read_forecasts(spark: SparkSession, path: str) -> DataFrame:
    """All forecast files of a folder as one frame; an empty folder gives no rows.

    One read per format, not per file. A file of another type is an error; the
    check lists names only and reads no content.
    """
    names = spark.read.format("binaryFile").load(path).select("path")
    supported = r"\.(parquet|csv|out)$"
    odd = names.where(~F.col("path").rlike(supported)).first()
    if odd is not None:
        raise ValueError(f"Neither Parquet nor CSV by its suffix: {odd.path}")
    return (
        _forecast_parquet(spark, path, "*.parquet")
        .unionByName(_forecast_csv(spark, path, "*.{csv,out}"), allowMissingColumns=True)
    )
