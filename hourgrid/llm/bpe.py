"""Byte-level BPE by a segment tree, with decoding.

Each match of the vocabulary's pattern is encoded by itself. A segment tree over its
byte positions holds the rank of the pair that starts there; the root is the leftmost
least rank. A merge changes the pair at the merged position and at the live neighbour
before it and removes the one after it, each a logarithmic point update.

Matches that a worker has not seen are merged together: their trees are rows of one array,
and each step makes the next merge of all of them, so numpy does the point updates.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from hourgrid.llm.common import byte_texts, gather, present, small_batches

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Matches remembered per Python worker, and the longest that is remembered.
CACHED, CACHED_CHARS = 400_000, 64
_NONE = 1 << 62
#: Bytes of the longest match that is merged together with others.
_WIDE = 64


def ranks(name: str = VOCABULARY) -> dict[bytes, int]:
    with open(public_tokenizers.path(name), "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def pieces(name: str = VOCABULARY) -> list[bytes]:
    """The bytes of each id."""
    found = ranks(name)
    table = [b""] * (max(found.values()) + 1)
    for piece, rank in found.items():
        table[rank] = piece
    return table


def merged(piece: bytes, rank: dict[bytes, int]) -> tuple[int, ...]:
    """The ids of one match."""
    whole = rank.get(piece)
    if whole is not None:
        return (whole,)
    n = len(piece)
    size = 1 << (n - 2).bit_length()
    tree = [_NONE] * (2 * size)
    for i in range(n - 1):
        pair = rank.get(piece[i : i + 2])
        if pair is not None:
            tree[size + i] = pair * n + i
    for i in range(size - 1, 0, -1):
        a, b = tree[2 * i], tree[2 * i + 1]
        tree[i] = a if a < b else b
    follow = list(range(1, n + 1))
    before = list(range(-1, n))

    def put(at: int, start: int, end: int) -> None:
        pair = rank.get(piece[start:end]) if end - start <= 256 else None
        node = at + size
        tree[node] = _NONE if pair is None else pair * n + at
        node >>= 1
        while node:
            a, b = tree[2 * node], tree[2 * node + 1]
            least = a if a < b else b
            if tree[node] == least:
                break
            tree[node] = least
            node >>= 1

    while tree[1] < _NONE:
        i = tree[1] % n
        j = follow[i]
        k = follow[j]
        follow[i] = k
        before[k] = i
        if j < n - 1:
            put(j, 0, 1 << 30)
        if k < n:
            put(i, i, follow[k])
        else:
            put(i, 0, 1 << 30)
        if i:
            put(before[i], before[i], k)
    out = []
    i = 0
    while i < n:
        out.append(rank[piece[i : follow[i]]])
        i = follow[i]
    return tuple(out)


class Merger:
    """Merges many matches at once; ``rank`` has every single byte."""

    def __init__(self, rank: dict[bytes, int]):
        self.rank = rank
        self.single = np.array([rank[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for piece, number in rank.items():
            for cut in range(1, len(piece)):
                left, right = rank.get(piece[:cut]), rank.get(piece[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = number
        self.keys = np.array(sorted(pairs), np.int64)
        self.ranks = np.array([pairs[key] for key in self.keys.tolist()], np.int64)

    def _pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.ranks[at], _NONE)

    def _leaf(self, rank: np.ndarray, at: np.ndarray) -> np.ndarray:
        return np.where(rank == _NONE, _NONE, rank * _WIDE + at)

    def merge(self, found: list[bytes]) -> list[bytes]:
        """Per match its ids, packed as int32; all have 2 to ``_WIDE`` bytes."""
        out: list[bytes] = [b""] * len(found)
        lengths = np.array([len(x) for x in found])
        size = 2
        while size <= _WIDE:
            own = np.flatnonzero((lengths <= size) & (lengths > (size // 2 if size > 2 else 0))).tolist()
            if own:
                ids, counts = self._merge([found[i] for i in own], size)
                packed, ends = ids.astype(np.int32).tobytes(), (4 * np.cumsum(counts)).tolist()
                for i, start, end in zip(own, [0, *ends], ends, strict=False):
                    out[i] = packed[start:end]
            size *= 2
        return out

    def _merge(self, found: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
        rows, n = len(found), np.array([len(x) for x in found])
        raw = np.frombuffer(b"".join(x.ljust(size, b"\0") for x in found), np.uint8).reshape(rows, size)
        token = self.single[raw]
        place = np.arange(size)
        pair = self._pair(token[:, :-1].ravel(), token[:, 1:].ravel()).reshape(rows, size - 1)
        pair[place[1:] >= n[:, None]] = _NONE
        tree = np.full((rows, 2 * size), _NONE, np.int64)
        tree[:, size : 2 * size - 1] = self._leaf(pair, place[:-1])
        level = size
        while level > 1:
            tree[:, level // 2 : level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
            level //= 2
        follow = np.tile(np.arange(1, size + 2), (rows, 1))
        before = np.tile(np.arange(-1, size), (rows, 1))
        alive = place < n[:, None]

        def put(row: np.ndarray, at: np.ndarray, leaf: np.ndarray) -> None:
            node = at + size
            tree[row, node] = leaf
            while size > 1 and len(node) and node[0] > 1:
                least = np.minimum(tree[row, node], tree[row, node ^ 1])
                node = node >> 1
                tree[row, node] = least

        live = np.flatnonzero(tree[:, 1] < _NONE)
        while len(live):
            root = tree[live, 1]
            i = root % _WIDE
            j = follow[live, i]
            k = follow[live, j]
            token[live, i] = root // _WIDE
            follow[live, i] = k
            before[live, k] = i
            alive[live, j] = False
            put(live, j, np.full(len(live), _NONE))
            inside = k < n[live]
            after = np.where(inside, k, 0)
            put(live, i, self._leaf(np.where(inside, self._pair(token[live, i], token[live, after]), _NONE), i))
            some = np.flatnonzero(i > 0)
            row, here = live[some], i[some]
            prior = before[row, here]
            put(row, prior, self._leaf(self._pair(token[row, prior], token[row, here]), prior))
            live = live[tree[live, 1] < _NONE]
        return token[alive], alive.sum(axis=1)


class Encoder:
    """Encodes texts; remembers matches up to a bound."""

    def __init__(self, name: str = VOCABULARY):
        self.rank = ranks(name)
        self.merger = Merger(self.rank)
        self.matches = regex.compile(public_tokenizers.PATTERN).findall
        self.known: dict[str, bytes] = {}

    def packed(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as int32 bytes."""
        found = [self.matches(text) for text in texts]
        unseen = set().union(*found) - self.known.keys()
        if len(self.known) + len(unseen) > CACHED:
            self.known.clear()
            unseen = set().union(*found)
        known, together = self.known, []
        for match in unseen:
            raw = match.encode()
            whole = self.rank.get(raw)
            if whole is not None:
                known[match] = whole.to_bytes(4, "little")
            elif len(raw) <= _WIDE:
                together.append((match, raw))
            else:
                known[match] = np.array(merged(raw, self.rank), np.int32).tobytes()
        for (match, _), ids in zip(together, self.merger.merge([raw for _, raw in together]), strict=True):
            known[match] = ids
        out = [b"".join(map(known.__getitem__, matches)) for matches in found]
        for match in unseen:
            if len(match) > CACHED_CHARS:
                del known[match]
        return out

    def ids(self, text: str) -> list[int]:
        return np.frombuffer(self.packed([text])[0], np.int32).tolist()


def _encode(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    code = Encoder()
    for part in parts:
        at = part.schema.get_field_index("_text")
        packed = code.packed([text.decode() for text in byte_texts(part.column(at))])
        offsets = np.concatenate([[0], np.cumsum([len(ids) // 4 for ids in packed], dtype=np.int64)])
        ids = pa.array(np.frombuffer(b"".join(packed), np.int32))
        columns = [part.column(i) for i in range(part.num_columns) if i != at]
        names = [n for n in part.schema.names if n != "_text"]
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), ids)
        yield pa.RecordBatch.from_arrays([*columns, lists], names=[*names, "token_ids"])


def encode(docs: DataFrame, text: str = "text", keep: tuple[str, ...] | None = None) -> DataFrame:
    """The ``keep`` columns of ``docs`` (default: all) and ``token_ids`` of the whole text.

    A null or empty text has no ids. Repeated rows give repeated rows; an empty table
    gives none. A column ``token_ids`` or ``_text`` of ``docs`` is replaced.
    """
    small_batches(docs.sparkSession)
    names = [c for c in (keep or docs.columns) if c not in ("token_ids", "_text")]
    frame = docs.select(*names, present(F.col(text)).cast("binary").alias("_text"))
    fields = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*names).schema.fields
    )
    return frame.mapInArrow(_encode, f"{fields}, token_ids array<int>")


@F.arrow_udf(BinaryType())
def decode(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The bytes that ids stand for; null counts as no ids."""
    table = pieces()
    sizes = np.array([len(piece) for piece in table], np.int64)
    starts = np.cumsum(sizes) - sizes
    everything = np.frombuffer(b"".join(table), np.uint8)
    for ids in parts:
        flat = ids.flatten().to_numpy(zero_copy_only=False)
        counts = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
        data = everything[gather(starts[flat], sizes[flat])].tobytes()
        ends = np.concatenate([[0], np.cumsum(sizes[flat])])
        offsets = ends[np.concatenate([[0], np.cumsum(counts)])].astype(np.int32)
        buffers = [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)]
        yield pa.Array.from_buffers(pa.binary(), len(ids), buffers)
