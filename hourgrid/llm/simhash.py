"""SimHash near-duplicates by multi-index hashing.

A fingerprint has two segments of 32 bits. Two fingerprints within ``MAX_BITS`` = 4
differ in at most two bits of one of the segments, so the Hamming balls of radius 1
around their values of that segment share a key. All ball keys are dealt to tasks,
fingerprints that meet under a key are compared in full, and only a forest of
the links found there leaves the task, not the pairs.

A key with more than ``RUN_LIMIT`` fingerprints is not compared pair by pair. Its
fingerprints enumerate the ball of radius 2 around the whole value instead: two
fingerprints lie within 4 bits exactly if these balls meet. That costs 2,081 keys
per fingerprint, whatever the size of the group, and loses nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from hourgrid.llm.common import byte_texts, present, small_batches, stored
from hourgrid.llm.components import components

MAX_BITS = 4
SHINGLE_WORDS = 4
SEED = 42
RUN_LIMIT = 512
#: Shingles whose bits are unpacked at once.
_BLOCK = 1 << 16


def simhash(text: bytes, size: int = SHINGLE_WORDS) -> int:
    """The 64-bit fingerprint of a text in UTF-8; 0 without words."""
    found = text.lower().split()
    if not found:
        return 0
    if len(found) <= size:
        shingles = [b" ".join(found)]
    else:
        shingles = map(b" ".join, zip(*(found[i:] for i in range(size)), strict=False))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in shingles), dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), _BLOCK):
        block = hashes[start : start + _BLOCK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


@F.arrow_udf(LongType())
def _fingerprint(texts: pa.Array) -> pa.Array:
    found = np.array([simhash(text) for text in byte_texts(texts)], dtype=np.uint64)
    return pa.array(found.view(np.int64))


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` reduced to id, ``text_hash`` and the signed 64-bit ``fp``, stored.

    A null text counts as empty and has fingerprint 0.
    """
    small_batches(docs.sparkSession)
    return stored(
        docs.select(
            F.col("doc_id"),
            F.xxhash64(present(F.col(text))).alias("text_hash"),
            _fingerprint(present(F.col(text))).alias("fp"),
        ),
        "fingerprints",
    )


def _forest(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links value -> smallest linked value within runs of equal sorted keys."""
    count = len(keys)
    labels = np.arange(count)
    firsts, seconds = [], []
    for step in range(1, count):
        first = np.flatnonzero(keys[step:] == keys[:-step])
        if not len(first):
            break
        near = np.bitwise_count(values[first] ^ values[first + step]) <= MAX_BITS
        firsts.append(first[near])
        seconds.append(first[near] + step)
    if not firsts:
        return values[:0], values[:0]
    first, second = np.concatenate(firsts), np.concatenate(seconds)
    while True:
        least = np.minimum(labels[first], labels[second])
        before = labels.copy()
        np.minimum.at(labels, first, least)
        np.minimum.at(labels, second, least)
        labels = labels[labels]
        if np.array_equal(before, labels):
            break
    moved = labels != np.arange(count)
    return values[moved], values[labels[moved]]


def _runs(
    parts: Iterator[pa.RecordBatch], limit: int | None
) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """Whole runs of equal keys as (keys, values, False); rows of longer runs as (.., True).

    Rows come sorted by key. At most one batch and one run up to ``limit`` are held.
    """
    held_keys = np.empty(0, dtype=np.int64)
    held = np.empty(0, dtype=np.uint64)
    over: int | None = None
    for part in parts:
        keys = part.column("key").to_numpy()
        values = part.column("fp").to_numpy().view(np.uint64)
        if over is not None:
            rest = int(np.searchsorted(keys, over, side="right"))
            yield keys[:rest], values[:rest], True
            keys, values = keys[rest:], values[rest:]
            if not len(keys):
                continue
            over = None
        keys, values = np.concatenate([held_keys, keys]), np.concatenate([held, values])
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        sizes = np.diff(np.r_[starts, len(keys)])
        last = int(starts[-1])
        long = np.repeat(sizes > limit, sizes)
        if sizes[-1] > limit:
            over, last = int(keys[-1]), len(keys)
        plain = ~long[:last]
        yield keys[:last][plain], values[:last][plain], False
        if long.any():
            yield keys[long], values[long], True
        held_keys, held = keys[last:], values[last:]
    yield held_keys, held, False


def _link_rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for keys, values, long in _runs(parts, RUN_LIMIT):
        if long:
            first = second = values
        else:
            first, second = _forest(keys, values)
        if len(first):
            yield pa.record_batch(
                {
                    "fp": first.view(np.int64),
                    "other": second.view(np.int64),
                    "long": np.full(len(first), long),
                }
            )


def _midpoint_masks() -> np.ndarray:
    bits = [np.uint64(1) << np.uint64(i) for i in range(64)]
    pairs = [a | b for a, b in combinations(bits, 2)]
    return np.array([np.uint64(0), *bits, *pairs], dtype=np.uint64)


def _midpoints(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    masks = _midpoint_masks()
    for part in parts:
        for fp in part.column("fp").to_numpy().view(np.uint64):
            keys = (masks ^ fp).view(np.int64)
            yield pa.record_batch(
                {"key": keys, "fp": np.full(len(keys), np.uint64(fp)).view(np.int64)}
            )


def _meetings(table: DataFrame) -> DataFrame:
    """Tie all fingerprints under a key to the smallest; a hot key is pre-aggregated."""
    least = table.groupBy("key").agg(
        F.min("fp").alias("other"), F.count(F.lit(1)).alias("n")
    )
    met = least.where("n > 1").drop("n")
    return table.join(met, "key").where("fp != other").select("fp", "other").distinct()


def links(distinct: DataFrame) -> DataFrame:
    """``fp``, ``other``: true links that connect what is within ``MAX_BITS`` bits.

    ``distinct`` holds each fingerprint once, in column ``fp``.
    """
    low = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))
    high = F.shiftrightunsigned("fp", 32)
    flips = [0, *(1 << i for i in range(32))]
    balls = F.array(
        *(low.bitwiseXOR(F.lit(m)) for m in flips),
        *(high.bitwiseXOR(F.lit(m)).bitwiseOR(F.lit(1 << 32)) for m in flips),
    )
    table = distinct.select("fp", F.explode(balls).alias("key")).repartition("key")
    found = stored(
        table.sortWithinPartitions("key", "fp").mapInArrow(
            _link_rows, "fp bigint, other bigint, long boolean"
        ),
        "candidates",
    )
    dense = found.where("long").select("fp").distinct()
    middle = dense.mapInArrow(_midpoints, "key bigint, fp bigint")
    return (
        found.where("not long").select("fp", "other").distinct().union(_meetings(middle))
    )


def _labelled(docs: DataFrame, text: str) -> DataFrame:
    prints = fingerprints(docs, text)
    distinct = stored(
        prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct"
    )
    roots = components(links(distinct.select("fp")), "fp", "other")
    tied = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    smallest = tied.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = tied.join(smallest, "root").select("fp", "root", "component_id")
    return prints.join(labels, "fp")


def near_duplicates(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per document: doc_id, text_hash, fp, component_id.

    component_id is the smallest doc_id that links reach. Documents without words
    have fingerprint 0 and link like any other; so do nulls and repeated rows. A
    component whose doc_ids are all null has a null id; an empty table gives none.
    Other columns of ``docs``, whatever their names, are not looked at.
    """
    return _labelled(docs, text).select("doc_id", "text_hash", "fp", "component_id")


def hex_print(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def keep_one(docs: DataFrame, text: str = "text") -> DataFrame:
    """One document of each component, with the columns of ``docs``.

    The smallest doc_id stays. Among rows that repeat it, the one with the smallest
    text hash stays, and of rows that share that too, the first by all columns. A
    component without any doc_id keeps one row by the same rule.
    """
    winners = (
        _labelled(docs, text)
        .where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("root", "component_id")
        .agg(F.min("text_hash").alias("_won_hash"))
        .select(F.col("component_id").alias("_won_id"), "_won_hash")
    )
    text_hash = F.xxhash64(present(F.col(text)))
    same = F.col("doc_id").eqNullSafe(F.col("_won_id")) & (text_hash == F.col("_won_hash"))
    order = Window.partitionBy("doc_id", text_hash).orderBy(*docs.columns)
    return (
        docs.join(winners, same, "left_semi")
        .withColumn("_rank", F.row_number().over(order))
        .where("_rank = 1")
        .select(*docs.columns)
    )
