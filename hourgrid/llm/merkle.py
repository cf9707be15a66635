"""Document fingerprints as Merkle trees over sections, paragraphs and sentences.

Leaves are sentences, their parents paragraphs (lines), and paragraphs form sections. A
section ends at a blank line or after a paragraph whose hash says so, so an edit moves
no boundary far from it. The root tells whether texts are equal; below it, differing
branches locate edits, and the weight of equal leaves is the likeness.

Every inner node hashes its children's hashes and nothing else, so equality rests on the
tree. A fingerprint is written ``root/section/section...``, a section its paragraphs and a
paragraph its leaves' hashes and lengths, so the stored string is the whole tree.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourgrid.llm.common import byte_texts, present, small_batches

#: A paragraph ends its section if its hash is divisible by this.
SECTION_PARAGRAPHS = 8
#: Documents meet the next one within buckets of neighbouring ids of about this size; the
#: driver holds an id and a hash per bucket, so there are at most ``MOST_BUCKETS``.
BUCKET_BYTES, MOST_BUCKETS = 8 << 20, 100_000
_SENTENCES = re.compile(r"[^.!?]*[.!?]*", re.S)


_leaf, _node = xxhash.xxh64_hexdigest, xxhash.xxh128_hexdigest


@dataclass(frozen=True)
class Tree:
    """``sections`` hold paragraphs, which hold (leaf hash, code points)."""

    root: str
    sections: tuple[tuple[tuple[tuple[str, int], ...], ...], ...]

    def leaves(self) -> Counter:
        """Code points under each leaf hash; repeated leaves add up."""
        out: Counter = Counter()
        for section in self.sections:
            for paragraph in section:
                for leaf, size in paragraph:
                    out[leaf] += size
        return out

    def text(self) -> str:
        parts = [self.root]
        for section in self.sections:
            parts.append(
                ",".join(
                    "+".join(f"{leaf}:{size:x}" for leaf, size in paragraph)
                    for paragraph in section
                )
            )
        return "/".join(parts)


def tree(text: str) -> Tree:
    sections, current, hashes, section_hashes = [], [], [], []
    for line in text.split("\n"):
        # The line break itself counts as one code point of the last leaf.
        found = [x for x in _SENTENCES.findall(line) if x] or [""]
        leaves = tuple(
            (_leaf(x.encode()), len(x) + (i == len(found) - 1)) for i, x in enumerate(found)
        )
        paragraph = _node(" ".join(leaf for leaf, _ in leaves).encode())
        current.append(leaves)
        hashes.append(paragraph)
        if not line.strip() or int(paragraph, 16) % SECTION_PARAGRAPHS == 0:
            sections.append(tuple(current))
            section_hashes.append(_node(",".join(hashes).encode()))
            current, hashes = [], []
    if current:
        sections.append(tuple(current))
        section_hashes.append(_node(",".join(hashes).encode()))
    return Tree(_node("/".join(section_hashes).encode()), tuple(sections))


def likeness(one: Tree, other: Tree) -> float:
    """1 for equal roots, else the Jaccard weight of equal leaves."""
    if one.root == other.root:
        return 1.0
    a, b = one.leaves(), other.leaves()
    shared = sum((a & b).values())
    return shared / max(sum((a | b).values()), 1)


def changed_sections(one: Tree, other: Tree) -> list[int]:
    """Numbers of the sections of ``other`` that ``one`` has not, equal ones taken in pairs."""
    left = Counter(one.sections)
    out = []
    for number, section in enumerate(other.sections):
        if left[section] > 0:
            left[section] -= 1
        else:
            out.append(number)
    return out


def edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_FIELDS = (
    ("doc_id", pa.int64()),
    ("n_chars", pa.int64()),
    ("edited_sha256", pa.string()),
    ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()),
    ("near_edited", pa.float64()),
    ("near_next", pa.float64()),
)
_DDL = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def _row(doc_id, text: str, own: Tree, following: str, after: Tree) -> tuple:
    changed = edited(text, following)
    other = tree(changed)
    return (
        doc_id,
        len(text),
        hashlib.sha256(changed.encode()).hexdigest(),
        own.text(),
        other.text(),
        likeness(own, other),
        likeness(own, after),
    )


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(_FIELDS)
    arrays = [pa.array(c, t) for c, (_, t) in zip(columns, _FIELDS, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[n for n, _ in _FIELDS])


def _neighbours(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order; each meets the next one. A bucket ends with the text that follows it."""
    held = None
    for part in parts:
        rows = []
        for doc_id, follows, raw in zip(
            part.column("doc_id").to_pylist(),
            part.column("follows").to_pylist(),
            byte_texts(part.column("text")),
            strict=True,
        ):
            text = raw.decode()
            own = tree(text)
            if held is not None:
                rows.append(_row(*held, text, own))
            held = None if follows else (doc_id, text, own)
            if len(rows) >= 128:
                yield _batch(rows)
                rows = []
        yield _batch(rows)


def _buckets(rows: DataFrame) -> Callable[[Column], Column]:
    """The bucket of an id, in the order of the documents; ids are dealt by quantiles."""
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    wanted = min(MOST_BUCKETS, size // BUCKET_BYTES + 1)
    shares = [i / wanted for i in range(1, wanted)]
    bounds = []
    if shares:
        quantiles = F.percentile_approx("doc_id", shares, max(10_000, 10 * wanted))
        bounds = rows.agg(quantiles).first()[0] or []
    ends = np.unique(np.array(bounds, dtype=np.int64))

    @F.arrow_udf("int")
    def bucket(ids: pa.Array) -> pa.Array:
        place = len(ends) - np.searchsorted(ends, ids.fill_null(0).to_numpy(zero_copy_only=False))
        place[ids.is_null().to_numpy(zero_copy_only=False)] = len(ends) + 1
        return pa.array(place, pa.int32())

    return bucket


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, both fingerprints, near_edited, near_next.

    The next document is that with the next smaller doc_id; after the last comes the
    first, which for a single document is itself. Rows that repeat a doc_id follow each
    other by their text's hash; null ids come last. Null texts count as empty, an empty
    table gives no rows, and other columns are not looked at. One shuffle deals the texts
    by buckets of neighbouring ids, and nothing is stored: the first text of each bucket,
    at most ``MOST_BUCKETS`` of them, is found beforehand and closes the one before. A
    task holds a row at a time. Rows that share one id share a bucket.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), present(F.col(text)).cast("binary").alias("text")
    ).withColumn("h", F.xxhash64("text"))
    bucket = _buckets(rows)
    order = F.struct(F.col("doc_id").isNull(), F.bitwise_not("doc_id").alias("down"), "h")
    firsts = (
        rows.select("doc_id", "h").withColumn("bucket", bucket("doc_id"))
        .groupBy("bucket")
        .agg(F.min_by(F.struct("doc_id", "h"), order).alias("first"))
        .orderBy("bucket")
        .collect()
    )
    # The first row of a bucket follows the bucket before it; the very first follows the last.
    closing = [
        (firsts[i - 1]["bucket"], row["first"]["doc_id"], row["first"]["h"])
        for i, row in enumerate(firsts)
    ]
    ends = spark.createDataFrame(closing, "bucket int, end_id long, end_h long")
    same = F.col("doc_id").eqNullSafe(F.col("end_id")) & (F.col("h") == F.col("end_h"))
    closes = (
        rows.join(F.broadcast(ends), same)
        .groupBy("bucket")
        .agg(F.min("text").alias("text"))
        .select("bucket", F.lit(True).alias("follows"), F.lit(None).cast("long").alias("doc_id"), "text")
        .withColumn("h", F.lit(None).cast("long"))
    )
    dealt = rows.select(bucket("doc_id").alias("bucket"), F.lit(False).alias("follows"), "doc_id", "text", "h")
    return (
        dealt.unionByName(closes)
        .repartition("bucket")
        .sortWithinPartitions("bucket", "follows", F.col("doc_id").desc_nulls_last(), "h", "text")
        .select("doc_id", "follows", "text")
        .mapInArrow(_neighbours, _DDL)
    )
