"""Language-model scores from a Brown class-based bigram model.

P(text) is the product over tokens of P(class | class before) * P(word | class). Words
are put into classes by exchange over the whole training corpus: each word moves to the
class that gains most, and a round of moves stays only if the likelihood rises; else
fewer words move, until it rises no more. Frequent words, with at least ``CLASS_SHARE``
of the tokens, are exchanged in rounds, so there are at most 1 / CLASS_SHARE of them.
Then every other word seen ``LEAST`` times or more takes its best class against these,
on Spark, grouped by word. Words seen less form classes by their last character.

Texts are read twice: once to count words, once to store them as numbers. Words with at
least ``KNOWN_SHARE`` of the tokens, at most 1 / KNOWN_SHARE, are numbered; the others
are joined on 64-bit hashes.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.llm.common import byte_texts, fold, present, small_batches, stored

CLASSES = 24
#: Classes of the rarest words: ends a sentence, ends a clause, neither. Then the text's end.
REST, END = CLASSES, CLASSES + 3
ALL = CLASSES + 4
CLASS_SHARE, KNOWN_SHARE = 1e-5, 1e-6
#: Times that a word must be seen to have a class of its choice, at any size of the corpus.
LEAST = 3
#: Rounds end when the likelihood rises by less than this share, or after so many.
RISE, ROUNDS = 1e-4, 12
#: The least share of words that a round tries to move.
FEWEST = 0.2
#: Codes of two classes around a word and its own rest class.
CODES = ALL * ALL * 3
ADDED = 0.1
#: Weight of the class's own frequency in a transition.
PRIOR = 50.0
#: Distinct words, or contexts of words, that a task holds before it hands them on.
HELD = 400_000


def rest_class(word: bytes) -> int:
    last = word[-1:]
    return REST if last in b".!?" else REST + 1 if last in b",;:" else REST + 2


def _hash(word: bytes) -> int:
    value = xxhash.xxh64_intdigest(word)
    return value - (1 << 64) if value >= 1 << 63 else value


def _word_counts(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    ends = 0

    def rows(counts: Counter) -> pa.RecordBatch:
        return pa.record_batch(
            {
                "word": pa.array(list(counts), pa.binary()),
                "c": pa.array(list(counts.values()), pa.int64()),
            }
        )

    for part in parts:
        for raw in byte_texts(part.column("text")):
            # Lower-cases A to Z alone, as bytes.
            counts.update(raw.lower().split())
            ends += 1
            if len(counts) >= HELD:
                yield rows(counts)
                counts = Counter()
    if ends:
        # The end token is the one empty word.
        counts[b""] = ends
    yield rows(counts)


def _numbered(shared) -> Callable:
    """Texts as packed int32 numbers, closed by the end's; a rare word is -1 - 3 * k - its rest
    class, where k is its place among the text's rare hashes."""

    def number(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = shared.value
        end = len(places)
        for part in parts:
            ids, rare = [], []
            for raw in byte_texts(part.column("text")):
                words = raw.lower().split()
                found = list(map(places.get, words))
                own: dict[bytes, int] = {}
                if None in found:
                    for i, place in enumerate(found):
                        if place is None:
                            word = words[i]
                            k = own.setdefault(word, len(own))
                            found[i] = -1 - 3 * k - (rest_class(word) - REST)
                found.append(end)
                ids.append(_packed(np.array(found, dtype="<i4")))
                rare.append([_hash(w) for w in own])
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    part.column("held_out"),
                    pa.array(ids, pa.binary()),
                    pa.array(rare, pa.list_(pa.int64())),
                ],
                names=["doc_id", "held_out", "ids", "rare"],
            )

    return number


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers byte plane by byte plane, compressed: the high planes are nearly all zero."""
    return zlib.compress(numbers.view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a batch, one text after another, and the texts' lengths."""
    texts = [zlib.decompress(v) for v in column.to_pylist()]
    lengths = np.array([len(t) // 4 for t in texts], dtype=np.int64)
    flat = np.empty((int(lengths.sum()), 4), dtype=np.uint8)
    at = 0
    for t, n in zip(texts, lengths.tolist(), strict=True):
        flat[at : at + n] = np.frombuffer(t, dtype=np.uint8).reshape(4, n).T
        at += n
    return flat.reshape(-1).view("<i4"), lengths


def _kinds(flat: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """The class of each number; of rare words, the rest class."""
    return np.where(flat < 0, REST + (-1 - flat) % 3, classes[np.maximum(flat, 0)])


def _before(kind: np.ndarray) -> np.ndarray:
    # Every text closes with the end, so the first of the next text stands after one.
    return np.r_[END, kind[:-1]]


def _contexts(shared, spots: int) -> Callable:
    """Per frequent word, how often each class stands before and after it."""

    def collect(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = shared.value
        # One row per word, and one per other class, for the class-to-class counts.
        table = np.zeros((spots + ALL - CLASSES, 2 * ALL), dtype=np.int64)
        cells = table.reshape(-1)
        for part in parts:
            flat, _ = _flat(part.column("ids"))
            if not len(flat):
                continue
            kind = _kinds(flat, classes)
            frequent = (flat >= 0) & (flat < spots)
            at = np.where(frequent, flat, spots + kind - CLASSES).astype(np.int64) * (2 * ALL)
            np.add.at(cells, at + _before(kind), 1)
            np.add.at(cells, at[:-1] + ALL + kind[1:], 1)
        used = np.flatnonzero(table.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), *(pa.array(column) for column in table[used].T)],
            names=["id", *(f"c{k}" for k in range(2 * ALL))],
        )

    return collect


def _context_table(numbered: DataFrame, classes: np.ndarray, spots: int) -> np.ndarray:
    """Summed contexts; at most 1 / CLASS_SHARE rows of small numbers reach the driver.

    Each core fills one table, so what is shuffled does not grow with the input's splits.
    """
    cores = numbered.sparkSession.sparkContext.defaultParallelism
    shared = numbered.sparkSession.sparkContext.broadcast(classes)
    names = [f"c{k}" for k in range(2 * ALL)]
    ddl = "id bigint, " + ", ".join(f"{n} bigint" for n in names)
    sums = (
        numbered.select("ids")
        .coalesce(cores)
        .mapInArrow(_contexts(shared, spots), ddl)
        .groupBy("id")
        .agg(*(F.sum(n).alias(n) for n in names))
    )
    out = np.zeros((spots + ALL - CLASSES, 2 * ALL))
    found = sums.toArrow()
    if found.num_rows:
        out[found.column("id").to_numpy()] = np.column_stack(
            [found.column(n).to_numpy() for n in names]
        )
    shared.unpersist()
    return out


def _class_counts(table: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Transitions [before, class]."""
    out = np.zeros((ALL, ALL))
    np.add.at(out, np.r_[classes, np.arange(CLASSES, ALL)], table[:, :ALL])
    return out.T


def likelihood(moves: np.ndarray) -> float:
    """What classes add to the log-likelihood: their tokens' mutual information."""

    def part(n: np.ndarray) -> float:
        return float((n * np.log(np.maximum(n, 1))).sum())

    return part(moves) - part(moves.sum(axis=0)) - part(moves.sum(axis=1))


def _gains(moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What a token gains in a class: [before, class] and [class, after]."""
    moves = moves + 0.5
    before, after = moves.sum(axis=1), moves.sum(axis=0)
    into = np.log(moves / before[:, None] / after[None, :])[:, :CLASSES]
    return into, np.log(moves / before[:, None])[:CLASSES, :]


def exchange(table: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """The class of each word that most raises the likelihood, contexts held."""
    into, out_of = _gains(_class_counts(table, classes))
    spots = len(classes)
    gain = table[:spots, :ALL] @ into + table[:spots, ALL:] @ out_of.T
    return gain.argmax(axis=1).astype(np.int16)


def cluster(count: Callable[[np.ndarray], np.ndarray], classes: np.ndarray):
    """(classes, transitions) after exchange; ``count`` gives the contexts under classes."""
    table = count(classes)
    best = likelihood(_class_counts(table, classes))
    share = 1.0
    chance = np.random.default_rng(1)
    for _ in range(ROUNDS if len(classes) else 0):
        wanted = exchange(table, classes)
        moving = (wanted != classes) & (chance.random(len(classes)) < share)
        trial = np.where(moving, wanted, classes)
        if not moving.any():
            break
        counted = count(trial)
        now = likelihood(_class_counts(counted, trial))
        if now > best:
            small = now - best < RISE * abs(best)
            classes, table, best = trial, counted, now
            if small:
                break
        else:
            share /= 2
            if share < FEWEST:
                break
    return classes, _class_counts(table, classes)


def _rare_contexts(shared, spots: int) -> Callable:
    """(hash, times * CODES + code) of words not frequent; a code has the classes around and
    the rest class."""

    def rows(keys: list, codes: list) -> pa.RecordBatch:
        h = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        code = np.concatenate(codes) if codes else np.zeros(0, np.int64)
        order = np.lexsort((code, h))
        h, code = h[order], code[order]
        first = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (code[1:] != code[:-1])][: len(h)])
        return pa.record_batch(
            {
                "h": pa.array(h[first]),
                "packed": pa.array(np.diff(np.r_[first, len(h)]) * CODES + code[first]),
            }
        )

    def collect(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, hashes = shared.value
        keys: list[np.ndarray] = []
        codes: list[np.ndarray] = []
        held = 0
        for part in parts:
            flat, lengths = _flat(part.column("ids"))
            if not len(flat):
                continue
            kind = _kinds(flat, classes)
            around = _before(kind) * ALL + np.r_[kind[1:], END]
            at = np.flatnonzero((flat < 0) | ((flat >= spots) & (flat < len(hashes))))
            h = np.where(flat[at] < 0, _own(part, flat, lengths, at), hashes[np.maximum(flat[at], 0)] if len(hashes) else 0)
            keys.append(h.astype(np.int64))
            # Outside the frequent words every class is still a rest class.
            codes.append(around[at].astype(np.int64) * 3 + kind[at] - REST)
            held += len(at)
            if held >= 4 * HELD:
                yield rows(keys, codes)
                keys, codes, held = [], [], 0
        yield rows(keys, codes)

    return collect


def _own(part: pa.RecordBatch, flat: np.ndarray, lengths: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The hashes of the rare words at these places; 0 at others."""
    lists = part.column("rare").to_pylist()
    sizes = np.array([len(x) for x in lists], dtype=np.int64)
    hashes = np.array([h for x in lists for h in x] or [0], dtype=np.int64)
    text = np.repeat(np.arange(len(lengths)), lengths)[at]
    k = (-1 - flat[at]) // 3
    place = (np.cumsum(sizes) - sizes)[text] + k
    return np.where(flat[at] < 0, hashes[np.where(flat[at] < 0, place, 0)], 0)


def _learned(numbered: DataFrame, classes: np.ndarray, hashes: np.ndarray, moves: np.ndarray, spots: int) -> DataFrame:
    """h, c and kind of every training word that is not frequent."""
    spark: SparkSession = numbered.sparkSession
    into, out_of = _gains(moves)
    around = [
        ((b * ALL + a) * 3 + rest, rest, [float(x) for x in into[b] + out_of[:, a]])
        for b in range(ALL)
        for a in range(ALL)
        for rest in range(3)
    ]
    gains = spark.createDataFrame(around, "code int, rest int, g array<double>")
    shared = spark.sparkContext.broadcast((classes, hashes))
    rows = numbered.select("ids", "rare").mapInArrow(
        _rare_contexts(shared, spots), "h bigint, packed bigint"
    )
    sums = [F.sum(F.col("n") * F.col("g")[k]) for k in range(CLASSES)]
    best = F.array(*sums)
    return stored(
        rows.repartition("h")
        .select("h", F.pmod("packed", F.lit(CODES)).cast("int").alias("code"), F.expr(f"packed div {CODES}").alias("n"))
        .join(F.broadcast(gains), "code")
        .groupBy("h")
        .agg(F.sum("n").alias("c"), F.max("rest").alias("rest"), best.alias("gain"))
        .select(
            "h",
            "c",
            F.when(F.col("c") < LEAST, REST + F.col("rest"))
            .otherwise(F.array_position("gain", F.array_max("gain")) - 1)
            .cast("int")
            .alias("kind"),
        ),
        "learned",
    )


def held_out(doc_id: Column) -> Column:
    return fold(doc_id, 10) == 0


def _placed(shared) -> Callable:
    """Texts as their tokens' classes, one byte each, with what needs no class."""

    def place(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, own, ended = shared.value
        for part in parts:
            flat, lengths = _flat(part.column("ids"))
            if not len(flat):
                continue
            kind = _kinds(flat, classes)
            at = np.flatnonzero(flat < 0)
            sizes = part.column("k").value_lengths().to_numpy(zero_copy_only=False)
            starts = np.cumsum(sizes) - sizes
            entries = np.zeros(int(sizes.sum()) + 1, np.int64)
            spots = np.repeat(starts, sizes) + part.column("k").flatten().to_numpy()
            entries[spots] = part.column("v").flatten().to_numpy()
            text = np.repeat(np.arange(len(lengths)), lengths)[at]
            entry = entries[starts[text] + (-1 - flat[at]) // 3]
            counts, learned = entry >> 6, (entry & 63) - 1
            # A word of no training document keeps its rest class.
            kind[at] = np.where(learned < 0, kind[at], learned)
            log = own[np.maximum(flat, 0)]
            log[at] = np.log10(counts + ADDED)
            met = (flat >= 0) & ((flat < len(own) - 1) | ended)
            met[at] = counts > 0
            firsts = np.cumsum(lengths) - lengths
            codes = kind.astype(np.uint8).tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    part.column("held_out"),
                    pa.array(lengths),
                    pa.array(np.add.reduceat(met.astype(np.int64), firsts)),
                    pa.array(np.add.reduceat(log, firsts)),
                    pa.array([codes[f : f + n] for f, n in zip(firsts, lengths, strict=True)], pa.binary()),
                ],
                names=["doc_id", "held_out", "n_tokens", "n_known", "own", "kinds"],
            )

    return place


def _classes_of(part: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(part.column("kinds").to_pylist()), np.uint8).astype(np.int64)


def _transitions(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    moves = np.zeros(ALL * ALL, dtype=np.int64)
    for part in parts:
        kind = _classes_of(part)
        if len(kind):
            moves += np.bincount(_before(kind) * ALL + kind, minlength=ALL * ALL)
    used = np.flatnonzero(moves)
    yield pa.record_batch({"move": pa.array(used), "n": pa.array(moves[used])})


def _scores(shared) -> Callable:
    def score(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step, class_below = shared.value
        for part in parts:
            kind = _classes_of(part)
            lengths = part.column("n_tokens").to_numpy()
            moved = step[_before(kind), kind] - class_below[kind] if len(kind) else np.zeros(0)
            sums = np.add.reduceat(moved, np.cumsum(lengths) - lengths) if len(kind) else moved
            names = ["doc_id", "held_out", "n_tokens", "n_known", "own"]
            yield pa.RecordBatch.from_arrays(
                [*(part.column(n) for n in names), pa.array(sums)], names=[*names, "moved"]
            )

    return score


def score(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity.

    Learns from documents that are not held out and scores all. A null or empty text is
    its end token alone. Repeated rows are learned from and returned each, null ids
    included; an empty table gives none, and a corpus without training documents gives
    every word the count 0. Other columns are not looked at.
    """
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        present(F.col(text)).cast("binary").alias("text"),
    )
    counts = stored(
        texts.where("not held_out")
        .select("text")
        .mapInArrow(_word_counts, "word binary, c bigint")
        .groupBy("word")
        .agg(F.sum("c").alias("c")),
        "counts",
    )
    totals = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    tokens, vocabulary = int(totals["n"] or 0), totals["v"]
    rows = counts.where(F.col("c") >= KNOWN_SHARE * tokens).toArrow()
    known = dict(zip(rows.column("word").to_pylist(), rows.column("c").to_pylist(), strict=True))
    ends = known.pop(b"", None)
    if ends is None:
        ends = counts.where(F.length("word") == 0).agg(F.max("c")).first()[0] or 0
    chosen = sorted(known, key=lambda w: (-known[w], w))
    spots = sum(known[w] >= max(LEAST, CLASS_SHARE * tokens) for w in chosen)
    hashes = np.array([_hash(w) for w in chosen], dtype=np.int64)
    own = np.log10(np.array([known[w] for w in chosen] + [ends], dtype=float) + ADDED)
    rest = np.array([rest_class(w) for w in chosen] + [END], dtype=np.int16)

    places = spark.sparkContext.broadcast({w: i for i, w in enumerate(chosen)})
    numbered = stored(
        texts.mapInArrow(
            _numbered(places), "doc_id bigint, held_out boolean, ids binary, rare array<bigint>"
        ).withColumn("row", F.monotonically_increasing_id()),
        "numbered",
    )
    places.unpersist()
    training = numbered.where("not held_out")

    # Start: by rank, with words that end a sentence or clause apart.
    start = ((np.arange(spots) + 8 * (rest[:spots].astype(int) - REST)) % CLASSES).astype(np.int16)
    clustered, moves = cluster(
        lambda classes: _context_table(training, np.r_[classes, rest[spots:]], spots), start
    )
    classes = np.r_[clustered, rest[spots:]].astype(np.int64)
    learned = _learned(training, classes, hashes, moves, spots)
    # Numbered words that are not frequent: no more of them than 1 / KNOWN_SHARE.
    later = learned.where(F.col("c") >= KNOWN_SHARE * tokens).toArrow()
    kind_of = dict(zip(later.column("h").to_pylist(), later.column("kind").to_pylist(), strict=True))
    for i in range(spots, len(chosen)):
        classes[i] = kind_of.get(int(hashes[i]), classes[i])

    # Rare words return to their texts as a place and one number, count * 64 + class + 1.
    found = F.coalesce(F.col("c") * 64 + F.col("kind") + 1, F.lit(0)).cast("long")
    rare = (
        numbered.select("row", F.posexplode("rare").alias("k", "h"))
        .join(learned, "h", "left")
        .select("row", "k", found.alias("v"))
        .repartition("row")
        .groupBy("row")
        .agg(F.collect_list(F.struct("k", "v")).alias("found"))
    )
    below = math.log10(tokens + ADDED * (vocabulary + 1))
    shared = spark.sparkContext.broadcast((classes, own, ends > 0))
    placed = stored(
        numbered.drop("rare")
        .join(rare, "row", "left")
        .select(
            "doc_id",
            "held_out",
            "ids",
            F.coalesce("found.k", F.array().cast("array<int>")).alias("k"),
            F.coalesce("found.v", F.array().cast("array<bigint>")).alias("v"),
        )
        .mapInArrow(
            _placed(shared),
            "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, own double, kinds binary",
        ),
        "placed",
    )
    moves = np.zeros(ALL * ALL)
    moved = placed.where("not held_out").select("kinds").mapInArrow(_transitions, "move bigint, n bigint")
    for row in moved.groupBy("move").agg(F.sum("n").alias("n")).collect():
        moves[row["move"]] = row["n"]
    moves = moves.reshape(ALL, ALL)
    # Tokens and distinct words of each class.
    sizes = moves.sum(axis=0)
    kinds = np.bincount(classes, minlength=ALL).astype(float)
    for row in learned.where(F.col("c") < KNOWN_SHARE * tokens).groupBy("kind").count().collect():
        kinds[row["kind"]] += row["count"]
    share = (sizes + 1) / (moves.sum() + ALL)
    step = np.log10((moves + PRIOR * share) / (moves.sum(axis=1, keepdims=True) + PRIOR))
    class_below = np.log10(sizes + ADDED * (kinds + 1))
    model = spark.sparkContext.broadcast((step, class_below))
    scored = placed.mapInArrow(
        _scores(model),
        "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, own double, moved double",
    ).withColumn("score", F.col("own") + F.col("moved"))
    return scored.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("own") - F.col("n_tokens") * below).alias("base_score"),
        "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )
