"""Quality rules as a short-circuit cascade, in built-in expressions only.

Each rule rejects a document by one expression. On a sample, a rule's cost is the
time of a scan that evaluates it, and its selectivity the share of documents that it
rejects. The cascade asks the rules in the order of rejections per cost, and a CASE
expression stops at the first that rejects. The order never changes the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourgrid.llm.common import present, stored, words

#: Documents, in expectation, that costs and selectivities are estimated on.
SAMPLE_DOCS = 2_000
SAMPLE_SEED = 7
WINDOW_WORDS = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
BASE_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SPACES = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Rule:
    """``rejects`` builds, from text and base counts, what is true of a bad document."""

    name: str
    rejects: Callable[[Column, Column], Column]


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, also inside its lambdas."""
    return F.transform(F.array(value), use)[0]


def _count(text: Column, characters: str) -> Column:
    """How often characters of a class, as a pattern states it, stand in the text."""
    return F.length(F.regexp_replace(text, f"[^{characters}]+", ""))


def symbol_count(text: Column) -> Column:
    return _count(text, "#*$%&|<>")


def word_characters(found: Column) -> Column:
    return F.length(F.array_join(found, ""))


def _worded_lines(text: Column) -> Column:
    spaces = F.lit(_SPACES)
    return F.filter(F.split(text, "\n"), lambda line: F.btrim(line, spaces) != "")


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    return _let(
        _worded_lines(text), lambda lines: F.size(lines) - F.size(F.array_distinct(lines))
    )


def _covered(hashes: Column) -> Column:
    """Words that repeated windows cover, from the windows' hashes in text order.

    Sorted with their positions, equal hashes stand together. The starts of repeated
    windows, in order, each cover min(8, distance from the start before) words more.
    """
    placed = F.array_sort(
        F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    )

    def starts(rows: Column) -> Column:
        def again(row: Column, k: Column) -> Column:
            before, after = F.get(rows, k - 1), F.get(rows, k + 1)
            return F.coalesce(before["h"] == row["h"], F.lit(False)) | F.coalesce(
                after["h"] == row["h"], F.lit(False)
            )

        return F.array_sort(F.transform(F.filter(rows, again), lambda row: row["i"]))

    def add(state: Column, start: Column) -> Column:
        more = F.least(F.lit(WINDOW_WORDS), start - state["last"])
        return F.struct(
            (state["total"] + more).alias("total"), start.alias("last")
        )

    first = F.struct(F.lit(0).alias("total"), F.lit(-WINDOW_WORDS).alias("last"))
    return F.aggregate(_let(placed, starts), first, add, lambda state: state["total"])


def repeated_words(found: Column) -> Column:
    """Words in windows of 8 words that occur twice or more, first included.

    Windows are compared by a 64-bit hash: for a text of a million words, the chance
    that two different windows meet is about 3 in 100 million.
    """

    def pairs(hashes: Column, distance: int) -> Column:
        return F.transform(
            hashes, lambda h, i: F.xxhash64(h, F.get(hashes, i + distance))
        )

    def count(hashes: Column) -> Column:
        return F.when(
            F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)
        ).otherwise(_covered(hashes))

    # Hashes of 1, 2, 4 and 8 words, each from two of the size before.
    one = F.transform(found, lambda word: F.xxhash64(word))
    eight = _let(
        one,
        lambda a: _let(pairs(a, 1), lambda b: _let(pairs(b, 2), lambda c: pairs(c, 4))),
    )
    whole = F.slice(eight, F.lit(1), F.size(found) - (WINDOW_WORDS - 1))
    return F.when(F.size(found) < WINDOW_WORDS, F.lit(0)).otherwise(_let(whole, count))


#: The production rules. Thresholds are shares of a document's words, characters or lines.
RULES: tuple[Rule, ...] = (
    Rule("symbols", lambda text, base: base["n_symbols"] > 0.1 * base["n_words"]),
    Rule(
        "word_length",
        lambda text, base: ~(
            base["word_chars"] / F.greatest(base["n_words"], F.lit(1))
        ).between(2.0, 15.0),
    ),
    Rule(
        "shouting",
        lambda text, base: _count(text, r"\p{Lu}") > 0.5 * base["word_chars"],
    ),
    Rule("exclamations", lambda text, base: _count(text, "!") > 0.3 * base["n_words"]),
    Rule(
        "repeated_lines",
        lambda text, base: base["n_dup_lines"] > 0.3 * F.size(_worded_lines(text)),
    ),
    Rule("digits", lambda text, base: _count(text, "0-9") > 0.3 * base["word_chars"]),
)


def measured(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text"):
    """(name, selectivity, seconds) of each rule on a sample of ``docs``."""
    share = min(1.0, SAMPLE_DOCS / max(docs.count(), 1))
    sample = docs.select(present(F.col(text)).alias("text")).sample(share, seed=SAMPLE_SEED)
    base = _let(words(F.col("text")), lambda found: _base(F.col("text"), found))
    sample = stored(sample.withColumn("base", base), "sample")
    figures = []
    for rule in rules:
        reject = F.count_if(rule.rejects(F.col("text"), F.col("base")))
        asked = sample.agg(reject.alias("rejected"), F.count(F.lit(1)).alias("asked"))
        began = time.perf_counter()
        row = asked.first()
        figures.append(
            (rule.name, row["rejected"] / max(row["asked"], 1), time.perf_counter() - began)
        )
    return figures


def ordered(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> list[Rule]:
    """The rules by rejections per second, highest first; ties keep their order."""
    if not rules:
        return []
    value = {name: share / seconds for name, share, seconds in measured(docs, rules, text)}
    return sorted(rules, key=lambda rule: -value[rule.name])


def _base(text: Column, found: Column) -> Column:
    """The base counts as one struct."""
    values = (
        F.size(found),
        word_characters(found),
        symbol_count(text),
        duplicate_lines(text),
        repeated_words(found),
    )
    named = zip(BASE_COUNTS, values, strict=True)
    return F.struct(*(value.cast("long").alias(name) for name, value in named))


def _judged(text: Column, cascade: Sequence[Rule]) -> Column:
    """The base counts, base_failed and kept as one struct.

    Bound values keep each count from being computed again where it is used.
    """

    def judge(base: Column) -> Column:
        words_seen = base["n_words"]
        failed = (words_seen < MIN_WORDS) | (
            100 * base["n_repeat_words"] > MAX_REPEAT_PERCENT * words_seen
        )
        verdict = F.when(failed, False)
        for rule in cascade:
            verdict = verdict.when(rule.rejects(text, base), False)
        counts = [base[name].alias(name) for name in BASE_COUNTS]
        return F.struct(
            *counts, failed.alias("base_failed"), verdict.otherwise(True).alias("kept")
        )

    return _let(
        words(text), lambda found: _let(_base(text, found), judge)
    )


def assess(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """One row per document: doc_id, the base counts, base_failed and kept.

    A null or empty text has no words, so it fails the base. Repeated rows give
    repeated rows, an empty table gives none, and other columns are not looked at.
    """
    judged = _judged(present(F.col(text)), ordered(docs, rules, text))
    return docs.select("doc_id", F.inline(F.array(judged)))


def keep_good(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """The documents that base and rules keep, with the columns of ``docs``."""
    judged = _judged(present(F.col(text)), ordered(docs, rules, text))
    return docs.where(judged["kept"])
