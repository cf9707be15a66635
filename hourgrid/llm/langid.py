"""Language identification by segmentation-marginalised unigrams.

The pieces of a fixed public vocabulary have a probability in each language. A word's
probability is the sum over all its segmentations into pieces, by the forward
algorithm; a text's is the product over its words. Piece probabilities are fitted by
expectation maximisation over the same segmentations, on a bounded sample.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourgrid.llm.common import byte_texts, fold, present, small_batches, stored

VOCABULARY = "piece_bpe_32k.model"
#: Labelled documents per language, in expectation, that the piece probabilities are fitted on.
SAMPLE_DOCS = 1_000
SAMPLE_SEED = 11
ROUNDS = 2
SMOOTHING = 0.1
#: Runs remembered per Python worker; runs up to this length are summed many at a time.
CACHED, TOGETHER_CHARS = 400_000, 64
#: Runs up to this length cannot leave the range of a double; longer ones are rescaled.
PLAIN_CHARS = 32
_LETTERS = re.compile(r"[^\W\d_]+")
UNKNOWN = ""


def vocabulary(name: str = VOCABULARY) -> list[str]:
    """Lower-cased letter pieces; a leading underline marks the start of a word."""
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
    found = set()
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i).lower().replace("▁", "_")
        if piece.lstrip("_").isalpha() and piece.count("_") <= 1:
            found.add(piece)
    return sorted(found | {"_", UNKNOWN})


def letter_runs(text: str) -> list[str]:
    """Runs of letters, lower-cased; signs like a half are no letters."""
    out = []
    for run in _LETTERS.findall(text.lower()):
        if run.isalpha():
            out.append(run)
        else:
            out += "".join(c if c.isalpha() else " " for c in run).split()
    return out


def longest(table: dict) -> int:
    return max(map(len, table))


def _spans(marked: str, table: dict, most: int) -> list[list[tuple[int, str]]]:
    """For each end, the starts of pieces and the pieces; an unknown letter is UNKNOWN."""
    out = []
    for end in range(1, len(marked) + 1):
        found = []
        for start in range(max(0, end - most), end):
            piece = marked[start:end]
            if piece in table:
                found.append((start, piece))
        if marked[end - 1] not in table:
            found.append((end - 1, UNKNOWN))
        out.append(found)
    return out


def forward(run: str, table: dict[str, tuple[float, ...]], languages: int, most: int | None = None) -> tuple[float, ...]:
    """log probability of a run in each language, over all segmentations.

    ``most`` is the longest piece's length. Sums that get small are rescaled, with all sums
    that a later piece can still start from, so a run may be of any length.
    """
    most = most or longest(table)
    sums, logs = [[1.0] * languages], [0.0] * languages
    for found in _spans("_" + run, table, most):
        here = [0.0] * languages
        for start, piece in found:
            before, p = sums[start], table[piece]
            for k in range(languages):
                here[k] += before[k] * p[k]
        sums.append(here)
        for k in range(languages):
            if here[k] < 1e-100:
                scale = here[k]
                logs[k] += math.log(scale)
                for row in sums[-most:]:
                    row[k] /= scale
    return tuple(log + math.log(x) for log, x in zip(logs, sums[-1], strict=True))


def expected(run: str, table: dict[str, tuple[float, ...]], k: int, most: int | None = None) -> dict[str, float]:
    """Expected piece counts of a run in language k, by forward and backward sums."""
    marked = "_" + run
    spans = _spans(marked, table, most or longest(table))
    out: dict[str, float] = defaultdict(float)
    if len(marked) > PLAIN_CHARS:
        return _expected_logs(spans, table, k)
    ahead = [1.0]
    for found in spans:
        ahead.append(sum(ahead[start] * table[piece][k] for start, piece in found))
    back = [0.0] * (len(marked) + 1)
    back[-1] = 1.0
    for end in range(len(marked), 0, -1):
        for start, piece in spans[end - 1]:
            weight = table[piece][k] * back[end]
            back[start] += weight
            out[piece] += ahead[start] * weight / ahead[-1]
    return out


def _log_sum(values: list[float]) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(x - top) for x in values))


def _expected_logs(spans: list[list[tuple[int, str]]], table: dict, k: int) -> dict[str, float]:
    """``expected`` in logarithms, for runs of any length."""
    ahead = [0.0]
    for found in spans:
        ahead.append(_log_sum([ahead[start] + math.log(table[piece][k]) for start, piece in found]))
    follow: list[list[float]] = [[] for _ in ahead]
    follow[-1].append(0.0)
    out: dict[str, float] = defaultdict(float)
    for end in range(len(spans), 0, -1):
        back = _log_sum(follow[end])
        for start, piece in spans[end - 1]:
            weight = math.log(table[piece][k]) + back
            follow[start].append(weight)
            out[piece] += math.exp(ahead[start] + weight - ahead[-1])
    return out


class Segmenter:
    """The forward sums of many runs at once: a trie of pieces, read by all runs together."""

    def __init__(self, table: dict[str, tuple[float, ...]]):
        self.table, self.most = table, longest(table)
        pieces = list(table)
        self.languages = len(table[UNKNOWN])
        self.share = np.array([table[piece] for piece in pieces]).reshape(len(pieces), self.languages)
        self.unknown = pieces.index(UNKNOWN)
        ends = {"": 0}
        edges: dict[int, int] = {}
        last = [-1]
        for number, piece in enumerate(pieces):
            state = 0
            for i, letter in enumerate(piece):
                after = ends.setdefault(piece[: i + 1], len(last))
                if after == len(last):
                    last.append(-1)
                edges[state << 21 | ord(letter)] = after
                state = after
            if piece:
                last[state] = number
        self.keys = np.array(sorted(edges), np.int64)
        self.next = np.array([edges[key] for key in self.keys.tolist()], np.int64)
        self.last = np.array(last)

    def logs(self, runs: list[str]) -> np.ndarray:
        """A row of log probabilities per run."""
        out = np.zeros((len(runs), self.languages))
        sizes = np.array([len(run) for run in runs])
        for size in np.unique(sizes).tolist():
            own = np.flatnonzero(sizes == size)
            if size > TOGETHER_CHARS:
                for i in own.tolist():
                    out[i] = forward(runs[i], self.table, self.languages, self.most)
            else:
                out[own] = self._together(["_" + runs[i] for i in own.tolist()], size + 1)
        return out

    def _together(self, marked: list[str], size: int) -> np.ndarray:
        rows = len(marked)
        codes = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32).reshape(rows, size)
        codes = codes.astype(np.int64)
        sums = np.zeros((rows, size + 1, self.languages))
        sums[:, 0] = 1.0
        scaled = np.zeros((rows, self.languages))
        state = np.empty(rows, np.int64)
        for start in range(size):
            small = np.flatnonzero((sums[:, start] < 1e-100).any(axis=1))
            if len(small):
                by = sums[small, start]
                scaled[small] += np.log(by)
                sums[small, start:] /= by[:, None]
            live = np.arange(rows)
            state[:] = 0
            for end in range(start, min(start + self.most, size)):
                key = state[live] << 21 | codes[live, end]
                at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                known = self.keys[at] == key
                live, at = live[known], at[known]
                if len(live):
                    state[live] = self.next[at]
                    piece = self.last[state[live]]
                    whole = piece >= 0
                    row = live[whole]
                    sums[row, end + 1] += sums[row, start] * self.share[piece[whole]]
                if end == start:
                    alone = np.ones(rows, bool)
                    alone[live] = self.last[state[live]] < 0
                    sums[alone, end + 1] += sums[alone, start] * self.share[self.unknown]
                if not len(live):
                    break
        return scaled + np.log(sums[:, size])


def _fit_round(sample: DataFrame, languages: list[str], table: dict) -> dict:
    shared = sample.sparkSession.sparkContext.broadcast(table)
    place = {name: k for k, name in enumerate(languages)}

    def gather(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            runs: Counter = Counter()
            texts = byte_texts(part.column("text"))
            for lang, text in zip(part.column("lang").to_pylist(), texts, strict=True):
                k = place[lang]
                runs.update((k, run) for run in letter_runs(text.decode()))
            sums: dict = defaultdict(float)
            most = longest(shared.value)
            for (k, run), n in runs.items():
                for piece, weight in expected(run, shared.value, k, most).items():
                    sums[k, piece] += n * weight
            yield pa.record_batch(
                {
                    "k": pa.array([k for k, _ in sums], pa.int32()),
                    "piece": pa.array([piece for _, piece in sums], pa.string()),
                    "n": pa.array(list(sums.values()), pa.float64()),
                }
            )

    # One row per piece and language: the vocabulary bounds it.
    counts = sample.mapInArrow(gather, "k int, piece string, n double")
    rows = counts.groupBy("k", "piece").agg(F.sum("n").alias("n")).collect()
    found = {(row["k"], row["piece"]): row["n"] for row in rows}
    totals = [0.0] * len(languages)
    for (k, _), n in found.items():
        totals[k] += n
    size = len(table)
    return {
        piece: tuple(
            (found.get((k, piece), 0.0) + SMOOTHING) / (totals[k] + SMOOTHING * size)
            for k in range(len(languages))
        )
        for piece in table
    }


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang"):
    """(languages, piece -> probabilities) from rows with a language.

    The sample is drawn per language, so a rare one is kept whole. The driver sees the
    languages' counts. A table without labelled rows gives no languages.
    """
    known = labelled.where(F.col(lang).isNotNull()).select(
        present(F.col(text)).cast("binary").alias("text"), F.col(lang).alias("lang")
    )
    sizes = {row["lang"]: row["count"] for row in known.groupBy("lang").count().collect()}
    shares = {lang: min(1.0, SAMPLE_DOCS / size) for lang, size in sizes.items()}
    # sampleBy needs a value to start from, also for a table without labelled rows.
    drawn = known.sampleBy("lang", shares, SAMPLE_SEED) if shares else known.limit(0)
    sample = stored(drawn, "languages").repartition(16)
    languages = sorted(row["lang"] for row in sample.select("lang").distinct().collect())
    pieces = vocabulary()
    table = {piece: (1.0 / len(pieces),) * len(languages) for piece in pieces}
    for _ in range(ROUNDS if languages else 0):
        table = _fit_round(sample, languages, table)
    return languages, table


def predict(docs: DataFrame, model, text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score of each document.

    ``und`` with score 0 when the text is null or has no letter, or nothing was
    learned. Ties go to the alphabetically first language. Repeated rows give repeated
    rows, an empty table gives none, and other columns are not looked at.
    """
    spark = docs.sparkSession
    small_batches(spark)
    languages, table = model
    shared = spark.sparkContext.broadcast(table)
    count = len(languages)

    def score(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segmenter = Segmenter(shared.value) if count else None
        known: dict[str, int] = {}
        logs = np.zeros((0, count))
        for part in parts:
            found = [letter_runs(raw.decode()) for raw in byte_texts(part.column("text"))]
            if segmenter is not None:
                unseen = set().union(*found) - known.keys()
                if len(known) + len(unseen) > CACHED:
                    known, logs = {}, np.zeros((0, count))
                    unseen = set().union(*found)
                fresh = sorted(unseen)
                known.update(zip(fresh, range(len(known), len(known) + len(fresh)), strict=True))
                logs = np.concatenate([logs, segmenter.logs(fresh)])
            names, values = [], []
            for runs in found:
                if not runs or not count:
                    names.append("und")
                    values.append(0.0)
                    continue
                total = logs[np.fromiter(map(known.__getitem__, runs), np.int64, len(runs))].sum(axis=0)
                best = int(total.argmax())
                names.append(languages[best])
                values.append(float(1.0 / np.exp(total - total[best]).sum()))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(names, pa.string()),
                    pa.array(values, pa.float64()),
                ],
                names=["doc_id", "lang_pred", "score"],
            )

    return docs.select("doc_id", present(F.col(text)).cast("binary").alias("text")).mapInArrow(
        score, "doc_id bigint, lang_pred string, score double"
    )


def held_out(doc_id: Column) -> Column:
    return fold(doc_id, 4) == 2


def identify(docs: DataFrame) -> DataFrame:
    """Learns from the documents that are not held out and predicts all."""
    model = fit(docs.where(~held_out(F.col("doc_id"))))
    return predict(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )
