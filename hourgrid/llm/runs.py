"""Periodic runs of words, found with longest common extensions.

A run is a maximal stretch of words that repeats with its smallest period four times or
more (and holds six words or more). Candidates come from a harmonic grid: for period p a
stretch of 4 p words always covers some multiple of 3 p together with the word p later, so
only n / 3p places per period are looked at. How far the equality of i and i + p reaches to
either side are longest common extensions (LCE), answered in two steps: compare a few words
until both places fall on a difference cover, then take a range minimum over the sorted
suffixes that start on the cover. No other suffixes are sorted.

Texts of one batch form one sequence, each closed by a number that occurs nowhere else, so
that nothing reaches from one text into the next and numpy works on all texts at once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourgrid.llm.common import byte_texts, gather, present, small_batches

#: A perfect difference cover, every number modulo 21 is a difference of two.
COVER_MODULUS, COVER = 21, (0, 1, 6, 8, 18)
#: A run has so many periods and words at least.
LEAST_PERIODS, LEAST_WORDS = 4, 6
#: Places of the grid that are looked at in one go.
GRID_CHUNK = 1 << 19


def _shifts() -> np.ndarray:
    """For two residues, the least step that brings both onto the cover."""
    v = COVER_MODULUS
    on = np.zeros(v, bool)
    on[list(COVER)] = True
    table = np.full((v, v), v, np.int64)
    for step in reversed(range(v)):
        hit = np.roll(on, -step)
        table[np.outer(hit, hit)] = step
    return table


class Extensions:
    """LCE of any two places of a sequence whose last number occurs once.

    Memory and time grow with the length (times its logarithm for the sampled fifth).
    """

    def __init__(self, numbers: np.ndarray):
        v = COVER_MODULUS
        n = len(numbers)
        top = int(numbers.max()) + 1 if n else 0
        # Every place within reach has v words to read; the padding occurs nowhere else.
        self.words = np.concatenate([numbers, np.arange(top, top + 2 * v)]).astype(np.int32)
        self.shift = _shifts()
        classes = [np.arange(d, n + v, v) for d in COVER]
        self.sampled = np.concatenate(classes)
        self.slot = np.full(n + v, -1, np.int32)
        self.slot[self.sampled] = np.arange(len(self.sampled), dtype=np.int32)
        self._sort([len(c) for c in classes])

    def _sort(self, sizes: Sequence[int]) -> None:
        """Sorts the sampled suffixes, read as blocks of v words, by doubling."""
        m = len(self.sampled)
        blocks = self.words[self.sampled[:, None] + np.arange(COVER_MODULUS)]
        rows = np.ascontiguousarray(blocks).view([("", np.void, blocks.itemsize * blocks.shape[1])]).ravel()
        _, names = np.unique(rows["f0"], return_inverse=True)
        # The slots of one residue lie in a row; past its last there is nothing (rank -1).
        ends = np.repeat(np.cumsum(sizes), sizes)
        here = np.arange(m)
        ranks, reach = [names.astype(np.int64)], 1
        while ranks[-1].max(initial=-1) + 1 < m:
            own = ranks[-1]
            follows = here + reach
            inside = follows < ends
            other = np.where(inside, own[np.where(inside, follows, 0)], -1)
            _, merged = np.unique(own * (m + 1) + other + 1, return_inverse=True)
            ranks.append(merged.astype(np.int64))
            reach *= 2
        self.rank = ranks[-1]
        order = np.argsort(self.rank)
        # Common blocks of neighbours in that order: equal names of 2**k blocks, largest first.
        a, b = order[:-1].copy(), order[1:].copy()
        common = np.zeros(max(m - 1, 0), np.int32)
        ends = np.append(ends, m)
        alive = np.ones(len(common), bool)
        for level in reversed(range(len(ranks) - 1)):
            live = np.flatnonzero(alive)
            same = live[ranks[level][a[live]] == ranks[level][b[live]]]
            step = 1 << level
            common[same] += step
            a[same] += step
            b[same] += step
            alive[same] = (a[same] < ends[order[:-1][same]]) & (b[same] < ends[order[1:][same]])
        self.minima = [common]
        width = 1
        while 2 * width <= len(common):
            last = self.minima[-1]
            self.minima.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def _blocks(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Common blocks of two different sampled places: a range minimum."""
        a, b = self.rank[self.slot[i]], self.rank[self.slot[j]]
        low, high = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.empty(len(i), np.int64)
        for k in np.unique(level):
            own = level == k
            table = self.minima[k]
            out[own] = np.minimum(table[low[own]], table[high[own] - (1 << int(k))])
        return out

    def _compare(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Equal words from two places on, ``most`` (under v) at most."""
        out = np.zeros(len(i), np.int64)
        live = np.flatnonzero(most > 0)
        step = 0
        while len(live):
            live = live[self.words[i[live] + step] == self.words[j[live] + step]]
            step += 1
            out[live] = step
            live = live[most[live] > step]
        return out

    def lce(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Equal words from each pair of different places on."""
        v = COVER_MODULUS
        to = self.shift[i % v, j % v]
        out = self._compare(i, j, to)
        far = np.flatnonzero(out == to)
        if len(far):
            reached = to[far] + v * self._blocks(i[far] + to[far], j[far] + to[far])
            rest = self._compare(i[far] + reached, j[far] + reached, np.full(len(far), v - 1))
            out[far] = reached + rest
        return out


def _grid(sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """text, period and place within the text of the harmonic grid, in chunks."""
    periods = np.where(sizes >= LEAST_WORDS, np.maximum(sizes // LEAST_PERIODS, 1), 0)
    text = np.repeat(np.arange(len(sizes)), periods)
    period = gather(np.ones(len(sizes), np.int64), periods)
    least = np.maximum(LEAST_WORDS, LEAST_PERIODS * period)
    step = least - period
    places = np.where(sizes[text] >= least, (sizes[text] - period - 1) // step + 1, 0)
    total = np.cumsum(places)
    start = 0
    while start < len(places):
        done = total[start - 1] if start else 0
        end = max(int(np.searchsorted(total, done + GRID_CHUNK, "right")), start + 1)
        count = places[start:end]
        at = gather(np.zeros(end - start, np.int64), count) * np.repeat(step[start:end], count)
        yield np.repeat(text[start:end], count), np.repeat(period[start:end], count), at
        start = end


def find_runs(numbers: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Rows text, start, length, period of all runs, in that order (by start, then period).

    ``numbers`` holds the words of all texts, one text after another; ``sizes`` their counts.
    """
    sizes = np.asarray(sizes, np.int64)
    n = int(sizes.sum())
    top = int(numbers.max()) + 1 if n else 0
    starts = np.cumsum(sizes + 1) - (sizes + 1)
    sequence = np.empty(n + len(sizes), np.int64)
    inner = gather(starts, sizes)
    sequence[inner] = numbers
    sequence[starts + sizes] = top + np.arange(len(sizes))
    chunks = []
    for text, period, at in _grid(sizes):
        place = starts[text] + at
        hit = np.flatnonzero(sequence[place] == sequence[place + period])
        chunks.append((text[hit], period[hit], place[hit]))
    text, period, place = (np.concatenate(c) if c else np.empty(0, np.int64) for c in zip(*chunks, strict=True)) if chunks else [np.empty(0, np.int64)] * 3
    if not len(text):
        return np.empty((0, 4), np.int64)
    forward = Extensions(sequence).lce(place, place + period)
    last = len(sequence) - 1
    # Backwards, the numbers that close texts stand before them; one more opens the first.
    turned = np.append(sequence[::-1], top + len(sizes))
    back = Extensions(turned).lce(last - place + 1, last - place - period + 1)
    length = back + forward + period
    kept = np.flatnonzero(length >= np.maximum(LEAST_WORDS, LEAST_PERIODS * period))
    found = np.column_stack([text, place - back - starts[text], length, period])[kept]
    # Several places meet the same run, and multiples of its period the same stretch.
    found = found[np.lexsort(found.T[::-1])]
    first = np.ones(len(found), bool)
    first[1:] = (found[1:, :3] != found[:-1, :3]).any(axis=1)
    found = found[first]
    return found[np.lexsort((found[:, 3], found[:, 1], found[:, 0]))]


def kept_words(runs: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For every word of all texts, whether no run holds it after the run's first period."""
    starts = np.cumsum(sizes) - sizes
    change = np.zeros(int(sizes.sum()) + 1, np.int64)
    base = starts[runs[:, 0]] + runs[:, 1]
    np.add.at(change, base + runs[:, 3], 1)
    np.add.at(change, base + runs[:, 2], -1)
    return np.cumsum(change[:-1]) == 0


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_DDL = "runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"


def _scan(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        at = part.schema.get_field_index("_text")
        found = [raw.split() for raw in byte_texts(part.column(at))]
        number: dict[bytes, int] = {}
        sizes = np.array([len(words) for words in found], np.int64)
        numbers = np.fromiter(
            (number.setdefault(w, len(number)) for words in found for w in words), np.int64, int(sizes.sum())
        )
        runs = find_runs(numbers, sizes)
        keep = kept_words(runs, sizes)
        ends = np.cumsum(sizes)
        touched = set(runs[:, 0].tolist())
        collapsed = []
        for k, words in enumerate(found):
            if k in touched:
                own = keep[ends[k] - sizes[k] : ends[k]]
                words = [words[i] for i in np.flatnonzero(own)]
            collapsed.append(b" ".join(words))
        offsets = np.concatenate([[0], np.cumsum(np.bincount(runs[:, 0], minlength=len(found)))])
        rows = pa.StructArray.from_arrays([pa.array(runs[:, c]) for c in (1, 2, 3)], fields=list(_RUN))
        columns = [part.column(i) for i in range(part.num_columns) if i != at]
        names = [name for name in part.schema.names if name != "_text"]
        yield pa.RecordBatch.from_arrays(
            [
                *columns,
                pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rows),
                pa.array(collapsed, pa.binary()).cast(pa.string()),
            ],
            names=[*names, "runs", "collapsed"],
        )


def periodic_runs(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns, ``runs`` (start, length, period, by start) and ``collapsed``.

    ``collapsed`` is the text's words without those that a run repeats, joined by one
    space. A null text counts as empty: no runs, an empty ``collapsed``. Rows that repeat
    give a row each, an empty table none. Columns not in ``keep`` are not looked at;
    ``runs``, ``collapsed`` and ``_text`` in ``keep`` are replaced. A row is judged by
    itself, so there is no shuffle, and memory is that of a batch of whole texts.
    """
    small_batches(docs.sparkSession)
    names = [c for c in keep if c not in ("runs", "collapsed", "_text")]
    frame = docs.select(*names, present(F.col(text)).cast("binary").alias("_text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*names).schema)
    return frame.mapInArrow(_scan, f"{fields}, {_DDL}")
