"""What several operators share: word rules, batches and stored tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.session import scratch_path

#: What separates words, as a Java pattern. ``bytes.split()`` uses
#: the same six characters.
SPACE_PATTERN = "[\\x20\\x09-\\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Rows and bytes of one Arrow batch; whole texts can be long.
BATCH_ROWS = 256
BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of whole texts within a worker's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def stored(frame: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    This cuts the lineage, and a lost executor loses nothing of it.
    """
    spark = frame.sparkSession
    path = scratch_path(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def unused(frame: DataFrame, *names: str) -> list[str]:
    """Column names that ``frame`` does not have, in any case of letters."""
    taken = {name.lower() for name in frame.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def present(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def lowered(text: Column) -> Column:
    """Lower-cases A to Z and nothing else."""
    return F.translate(present(text), _UPPER, _UPPER.lower())


def words(text: Column) -> Column:
    """The words of a text, in order; an array without empty strings."""
    return F.array_remove(F.split(present(text), SPACE_PATTERN), "")


def fold(id_column: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    return F.crc32(present(id_column)) % folds


def byte_texts(column: pa.Array) -> list[bytes]:
    """A column of strings as UTF-8 bytes; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def gather(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... for each run, one run after another."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - counts), counts)


def batches(frames: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[list[pa.Array]]:
    for batch in frames:
        yield [batch.column(name) for name in names]
