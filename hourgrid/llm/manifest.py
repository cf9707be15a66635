"""Merkle manifest of a dataset, kept as a postorder append log.

Rows of a series (a language) are its leaves, in order. Eight nodes in a row become their
parent, until one is left. Aligned builders each take a block of 512 leaves and append
nodes to their part of the log as they complete, children before their parent. Blocks'
last nodes are the leaves of the next tier, so a series of any length takes a few tiers
and no builder sees more than 512 nodes. Where a node stands in the log follows from the
sizes of the subtrees before it (``place``), so siblings are read by address, not searched.

Texts are hashed where they are read; later steps move some hundred bytes per row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourgrid.llm.common import fold, lowered, stored

#: Children of a node, and the levels that one builder completes.
FAN, BLOCK_LEVELS = 8, 3
BLOCK = FAN**BLOCK_LEVELS
#: The fields of a leaf, in the order in which they are hashed.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_DIGEST = 32

Path = Sequence[tuple[bytes, bytes]]


# --- The log ------------------------------------------------------------------


def parent(digests: bytes) -> bytes:
    """Hash of a run of digests, concatenated as hex text."""
    return hashlib.sha256(digests.hex().encode()).digest()


def levels_of(count: int) -> int:
    """Levels above ``count`` leaves until one node is left."""
    levels = 0
    while count > 1:
        count, levels = -(-count // FAN), levels + 1
    return levels


def place(level: int, index: int, count: int) -> int:
    """Where node ``index`` of ``level`` stands in the log of ``count`` leaves.

    It completes with its last leaf. Before it stand all nodes that the leaves before that
    one complete, one per full subtree, and its own descendants that end there.
    """
    last = min((index + 1) * FAN**level, count) - 1
    before = last
    while last:
        last //= FAN
        before += last
    return before + level


def append(leaves: Sequence[bytes], levels: int) -> bytes:
    """The log of some leaves, raised ``levels`` levels, in the order of completion."""
    log: list[bytes] = []
    runs: list[list[bytes]] = [[] for _ in range(levels + 1)]

    def close(level: int) -> None:
        node = parent(b"".join(runs[level]))
        runs[level].clear()
        log.append(node)
        runs[level + 1].append(node)

    for leaf in leaves:
        log.append(leaf)
        runs[0].append(leaf)
        level = 0
        while level < levels and len(runs[level]) == FAN:
            close(level)
            level += 1
    for level in range(levels):
        if runs[level]:
            close(level)
    return b"".join(log)


def node_at(log: bytes, at: int) -> bytes:
    return log[_DIGEST * at : _DIGEST * (at + 1)]


def paths(log: bytes, count: int, levels: int) -> list[Path]:
    """Per leaf the siblings before and after it, level by level, read by address."""
    found: list[Path] = [[]]
    for level in reversed(range(levels)):
        nodes = -(-count // FAN**level)
        below: list[Path] = []
        for start in range(0, nodes, FAN):
            run = [node_at(log, place(level, i, count)) for i in range(start, min(start + FAN, nodes))]
            above = found[start // FAN]
            for i in range(len(run)):
                below.append([(b"".join(run[:i]), b"".join(run[i + 1 :])), *above])
        found = below
    return found


def folded(leaf: bytes, path: Path) -> bytes:
    """The root that a leaf and its siblings lead to."""
    for before, after in path:
        leaf = parent(before + leaf + after)
    return leaf


# --- Rows in order ------------------------------------------------------------


def numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Adds ``at``, the row's number within its ``series`` by ``order``, and ``count``.

    ``rows`` must be a stored table. One range shuffle deals it; equal keys are told apart
    by their place in the table, so no key fills a task. Totals per part are summed over a
    few rows per series.
    """
    keyed = rows.withColumn("_tie", F.monotonically_increasing_id())
    keys = ["series", *order, "_tie"]
    placed = stored(
        keyed.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .select(
            *rows.columns,
            F.spark_partition_id().alias("_part"),
            F.monotonically_increasing_id().alias("_seq"),
        ),
        "numbered",
    )
    series = Window.partitionBy("series")
    earlier = series.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        placed.groupBy("series", "_part")
        .agg(F.min("_seq").alias("_first"), F.count(F.lit(1)).alias("_rows"))
        .withColumns(
            {
                "_before": F.coalesce(F.sum("_rows").over(earlier), F.lit(0)),
                "count": F.sum("_rows").over(series),
            }
        )
        .drop("_rows")
    )
    return (
        placed.join(parts, ["series", "_part"])
        .withColumn("at", F.col("_before") + F.col("_seq") - F.col("_first"))
        .drop("_part", "_seq", "_before", "_first")
    )


# --- Builders -----------------------------------------------------------------


def _build(block: pa.Table) -> pa.Table:
    """One builder: the nodes of a block, sorted, to its part of the log."""
    order = np.argsort(block.column("at").to_numpy())
    count = block.column("count")[0].as_py()
    leaves = [x.as_py() for x in block.column("digest").combine_chunks().take(pa.array(order))]
    log = append(leaves, BLOCK_LEVELS if count > BLOCK else levels_of(count))
    columns = {
        "series": block.column("series").slice(0, 1),
        "block": block.column("block").slice(0, 1),
        "count": block.column("count").slice(0, 1),
        "size": pa.array([len(leaves)], pa.int32()),
        "log": pa.array([log], pa.binary()),
    }
    if "item" in block.schema.names:
        items = block.column("item").combine_chunks().take(pa.array(order))
        columns["items"] = pa.ListArray.from_arrays(pa.array([0, len(items)], pa.int32()), items)
    return pa.table(columns)


@dataclass(frozen=True)
class Tree:
    """The parts of the log by tier, leaves first; and the last node of every series."""

    tiers: list[DataFrame]
    roots: DataFrame


def build(nodes: DataFrame) -> Tree:
    """Trees over ``series``, ``at``, ``count``, ``digest`` and optional ``item``."""
    largest = nodes.agg(F.max("count")).first()[0] or 0
    fields = "series string, block bigint, count bigint, size int, log binary"
    if "item" in nodes.columns:
        fields += f", items array<{nodes.schema['item'].dataType.simpleString()}>"
    tiers: list[DataFrame] = []
    while True:
        blocks = nodes.withColumn("block", F.floor(F.col("at") / BLOCK))
        log = stored(blocks.groupBy("series", "block").applyInArrow(_build, fields), "log")
        tiers.append(log)
        top = F.substring("log", -_DIGEST, _DIGEST).alias("digest")
        count = F.ceil(F.col("count") / BLOCK).alias("count")
        nodes = log.select("series", F.col("block").alias("at"), count, top)
        fields = "series string, block bigint, count bigint, size int, log binary"
        if largest <= BLOCK:
            return Tree(tiers, nodes.select("series", "digest"))
        largest = -(-largest // BLOCK)


# --- Proofs -------------------------------------------------------------------

_PATH = pa.list_(pa.struct([("before", pa.binary()), ("after", pa.binary())]))
_PATH_DDL = "array<struct<before: binary, after: binary>>"


def _blocks(part: pa.RecordBatch) -> Iterator[tuple[dict, list[Path]]]:
    """The rows of a tier, and the whole path of each of their leaves."""
    for row in part.to_pylist():
        above = [(step["before"], step["after"]) for step in row["path"]]
        levels = BLOCK_LEVELS if row["count"] > BLOCK else levels_of(row["count"])
        yield row, [[*own, *above] for own in paths(row["log"], row["size"], levels)]


def _steps(path: Path) -> list[dict]:
    return [{"before": before, "after": after} for before, after in path]


def _descend(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each leaf of a tier as the block of the tier below it, with its path."""
    for part in parts:
        out: dict[str, list] = {"series": [], "block": [], "path": [], "tops": []}
        for row, found in _blocks(part):
            first = row["block"] * BLOCK
            out["series"] += [row["series"]] * len(found)
            out["block"] += range(first, first + len(found))
            out["path"] += map(_steps, found)
            out["tops"] += [row["tops"]] * len(found)
        types = (pa.string(), pa.int64(), _PATH, pa.list_(pa.binary()))
        arrays = [pa.array(v, t) for v, t in zip(out.values(), types, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, names=list(out))


def _descended(tree: Tree, top: DataFrame) -> DataFrame:
    """The leaf tier with each block's ``path`` to the root and ``tops`` (digests met there)."""
    ddl = f"series string, block bigint, path {_PATH_DDL}, tops array<binary>"
    *lower, highest = tree.tiers
    joined = highest.join(top, ["series", "block"])
    for tier in reversed(lower):
        joined = tier.join(joined.mapInArrow(_descend, ddl), ["series", "block"])
    return joined


def _series_paths(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Items of the upper tree are series; their paths start the lower tree's."""
    for part in parts:
        out: dict[str, list] = {"series": [], "block": [], "path": [], "tops": []}
        for row, found in _blocks(part):
            for item, path, at in zip(row["items"], found, range(row["size"]), strict=True):
                own = node_at(row["log"], place(0, at, row["size"]))
                out["series"].append(item)
                out["block"].append(0)
                out["path"].append(_steps(path))
                out["tops"].append([own, *row["tops"]])
        types = (pa.string(), pa.int64(), _PATH, pa.list_(pa.binary()))
        arrays = [pa.array(v, t) for v, t in zip(out.values(), types, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, names=list(out))


_PROOF = (
    ("doc_id", pa.int64()),
    ("leaf", pa.string()),
    ("subroot", pa.string()),
    ("root", pa.string()),
    ("proof", pa.string()),
    ("proof_sha256", pa.string()),
    ("folded_root", pa.string()),
    ("verified", pa.bool_()),
)
_PROOF_DDL = (
    "doc_id bigint, leaf string, subroot string, root string, proof string, proof_sha256 string,"
    " folded_root string, verified boolean"
)


def _prover(whole: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def prove(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows = []
            for row, found in _blocks(part):
                subroot, root = row["tops"]
                for at, (item, path) in enumerate(zip(row["items"], found, strict=True)):
                    leaf = node_at(row["log"], place(0, at, row["size"]))
                    proof = b"".join(before + after for before, after in path).hex()
                    end = folded(item["tampered"] or leaf, path)
                    rows.append(
                        (
                            item["doc_id"],
                            leaf.hex(),
                            subroot.hex(),
                            root.hex(),
                            proof if whole else None,
                            hashlib.sha256(proof.encode()).hexdigest(),
                            end.hex(),
                            end == root,
                        )
                    )
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(_PROOF)
            arrays = [pa.array(c, t) for c, (_, t) in zip(columns, _PROOF, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=[n for n, _ in _PROOF])

    return prove


# --- Documents ----------------------------------------------------------------


def leaf_digest(**fields: Column) -> Column:
    """A row's leaf: each field as ``-`` or its bytes' number, ``:`` and itself."""
    parts = []
    for column in fields.values():
        value = column.cast("string")
        framed = F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)
        parts.append(F.when(value.isNull(), "-").otherwise(framed))
    return F.unhex(F.sha2(F.concat(*parts), 256))


@dataclass(frozen=True)
class Manifest:
    """The log of every language and that over the languages' roots."""

    documents: Tree
    languages: Tree

    def proofs(self, whole: bool = True) -> DataFrame:
        """One row per document: its leaf, its proof, and the root they lead to.

        ``proof`` (hex of the siblings, left to right, level by level up to the root) is
        null unless ``whole``; ``proof_sha256`` is always there.
        """
        start = self.languages.roots.select(
            "series",
            F.lit(0).cast("long").alias("block"),
            F.array().cast(_PATH_DDL).alias("path"),
            F.array("digest").alias("tops"),
        )
        ddl = f"series string, block bigint, path {_PATH_DDL}, tops array<binary>"
        top = _descended(self.languages, start).mapInArrow(_series_paths, ddl)
        return _descended(self.documents, top).mapInArrow(_prover(whole), _PROOF_DDL)

    def log(self) -> DataFrame:
        """``series``, ``position``, ``level``, ``index``, ``digest`` (hex) of all documents' nodes."""
        parts = [
            tier.mapInArrow(
                _log_rows(BLOCK_LEVELS * number),
                "series string, position bigint, level int, index bigint, digest string",
            )
            for number, tier in enumerate(self._counted())
        ]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    def _counted(self) -> list[DataFrame]:
        """The documents' tiers, with ``leaves``, the number of leaves of the whole series."""
        leaves = self.documents.tiers[0].where("block = 0").select("series", F.col("count").alias("leaves"))
        return [
            tier.select("series", "block", "count", "size", "log").join(leaves, "series")
            for tier in self.documents.tiers
        ]


def _log_rows(base: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of a tier whose leaves are at level ``base``; these themselves stand a tier lower."""

    def expand(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            out: dict[str, list] = {"series": [], "position": [], "level": [], "index": [], "digest": []}
            for row in part.to_pylist():
                levels = BLOCK_LEVELS if row["count"] > BLOCK else levels_of(row["count"])
                for level in range(1 if base else 0, levels + 1):
                    first = row["block"] * BLOCK // FAN**level
                    for i in range(-(-row["size"] // FAN**level)):
                        node = node_at(row["log"], place(level, i, row["size"]))
                        out["series"].append(row["series"])
                        out["position"].append(place(base + level, first + i, row["leaves"]))
                        out["level"].append(base + level)
                        out["index"].append(first + i)
                        out["digest"].append(node.hex())
            types = (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.string())
            arrays = [pa.array(v, t) for v, t in zip(out.values(), types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=list(out))

    return expand


def manifest(docs: DataFrame) -> Manifest:
    """The manifest of ``docs`` by language, and the leaves of its tampered documents.

    Where 3 divides the crc32 of the id as text, a tampered leaf (A-Z of the text lowered)
    is kept beside the leaf, to test that proofs notice. A null id counts as empty text
    there, so it is tampered with, and comes first in its language. Rows of equal id
    follow each other by their leaf; equal rows have equal leaves, so their order changes
    nothing. Null and empty texts differ (``-`` and ``0:``). Columns other than the five
    fields are not looked at.
    """
    fields = {name: F.col(name) for name in FIELDS}
    changed = leaf_digest(**{**fields, "text": F.when(F.col("text").isNotNull(), lowered(F.col("text")))})
    lang = F.col("lang").cast("string")
    leaves = stored(
        docs.select(
            F.when(lang.isNull(), "-").otherwise(F.concat(F.lit("+"), lang)).alias("series"),
            F.col("doc_id").cast("long").alias("doc_id"),
            leaf_digest(**fields).alias("digest"),
            F.when(fold(F.col("doc_id"), 3) == 0, changed).alias("tampered"),
        ),
        "leaves",
    )
    rows = numbered(leaves, ["doc_id", "digest"])
    documents = build(
        rows.select("series", "at", "count", "digest", F.struct("doc_id", "tampered").alias("item"))
    )
    # '+' precedes '-', so the sign alone would put null last.
    name = F.struct((F.substring("series", 1, 1) == "+").alias("named"), "series")
    subroots = stored(
        documents.roots.select(F.lit("").alias("series"), name.alias("name"), "digest"), "subroots"
    )
    ordered = numbered(subroots, ["name"])
    languages = build(
        ordered.select("series", "at", "count", "digest", F.col("name.series").alias("item"))
    )
    return Manifest(documents, languages)


def audit(docs: DataFrame) -> DataFrame:
    """Every document's proof against the manifest, tampered ones recomputed (``manifest``).

    An empty table gives no rows; repeated rows give one each.
    """
    return manifest(docs).proofs(whole=False).drop("proof")
