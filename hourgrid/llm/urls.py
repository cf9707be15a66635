"""URL filter: rules, and for the rest a character language-model ratio.

Two smoothed variable-order Markov models give the probability of a URL's characters,
one learned from URLs that the rules allow, one from those that they block. The
difference of log-likelihoods per character is compared with a threshold calibrated on
rule-judged URLs that the models have not seen.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourgrid.llm.common import fold, present, small_batches, stored

#: Verdict, host and path of each rule.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
ORDER = 4
#: Contexts with a smaller share of a model's characters are left to shorter ones, so a
#: model holds at most (ORDER + 1) / MIN_SHARE entries.
MIN_SHARE = 1e-5
STRENGTH = 4.0
ALPHABET = 256
FOLDS, BINS, SPAN = 5, 400, 8.0


def host(url: Column) -> Column:
    rest = F.regexp_extract(present(url), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    return F.regexp_extract(present(url), r"(?s)^.*?://[^/?#]*(/[^?#]*)", 1)


def judged(pages: DataFrame, url: str = "url") -> DataFrame:
    """page_id, host, path, rule and its verdict; null where no rule fits."""
    frame = pages.select(
        "page_id",
        present(F.col(url)).alias("url"),
        host(F.col(url)).alias("host"),
        path(F.col(url)).alias("path"),
    )
    rule = verdict = None
    for say, name, begin in sorted(RULES, key=lambda r: -len(r[1] + r[2])):
        fits = (
            (F.col("host") == name) | F.endswith(F.col("host"), F.lit(f".{name}"))
        ) & F.startswith(F.col("path"), F.lit(begin))
        rule = F.when(fits, name + begin) if rule is None else rule.when(fits, name + begin)
        verdict = F.when(fits, say) if verdict is None else verdict.when(fits, say)
    return frame.withColumns({"rule": rule, "rule_verdict": verdict})


def symbols(url: str) -> str:
    """What a model reads: digits become 0, since numbers only name pages."""
    return "^" * ORDER + "".join("0" if c.isdigit() else c for c in url) + "$"


def _grams(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        counts: Counter = Counter()
        rows = zip(
            part.column("url").to_pylist(), part.column("rule_verdict").to_pylist(), strict=True
        )
        for url, verdict in rows:
            text = symbols(url)
            for at in range(ORDER, len(text)):
                for size in range(ORDER + 1):
                    counts[verdict, text[at - size : at + 1]] += 1
        yield pa.record_batch(
            {
                "verdict": pa.array([v for v, _ in counts], pa.string()),
                "gram": pa.array([g for _, g in counts], pa.string()),
                "n": pa.array(list(counts.values()), pa.int64()),
            }
        )


def fit(known: DataFrame) -> dict[str, tuple[dict[str, int], dict[str, int]]]:
    """verdict -> (n-gram counts, context counts), from rows with url and rule_verdict."""
    counts = stored(
        known.select("url", "rule_verdict")
        .mapInArrow(_grams, "verdict string, gram string, n bigint")
        .groupBy("verdict", "gram")
        .agg(F.sum("n").alias("n")),
        "grams",
    )
    totals = counts.where(F.length("gram") == 1).groupBy("verdict").agg(F.sum("n").alias("total"))
    kept = counts.join(F.broadcast(totals), "verdict").where(F.col("n") >= MIN_SHARE * F.col("total"))
    models: dict = {"allow": ({}, Counter()), "block": ({}, Counter())}
    for row in kept.select("verdict", "gram", "n").collect():
        grams, contexts = models[row["verdict"]]
        grams[row["gram"]] = row["n"]
        contexts[row["gram"][:-1]] += row["n"]
    return models


def log_likelihood(text: str, model) -> float:
    """log probability of the symbols; each order is smoothed with the one below."""
    grams, contexts = model
    total = 0.0
    for at in range(ORDER, len(text)):
        p = 1.0 / ALPHABET
        for size in range(ORDER + 1):
            seen = contexts.get(text[at - size : at])
            if not seen:
                break
            p = (grams.get(text[at - size : at + 1], 0) + STRENGTH * p) / (seen + STRENGTH)
        total += math.log(p)
    return total


def _scored(rows: DataFrame, models) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(models)

    def score(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        allow, block = shared.value["allow"], shared.value["block"]
        for part in parts:
            values = []
            for url in part.column("url").to_pylist():
                text = symbols(url)
                gap = log_likelihood(text, allow) - log_likelihood(text, block)
                values.append(gap / (len(text) - ORDER))
            arrays = [*part.columns, pa.array(values, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*part.schema.names, "ratio"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(score, f"{fields}, ratio double")


def calibrate(scored: DataFrame) -> float:
    """The threshold with the least sum of both error rates, from a histogram of ratios."""
    place = F.floor((F.col("ratio") + SPAN) / (2 * SPAN) * BINS).cast("int")
    bins = scored.select(
        "rule_verdict", F.greatest(F.lit(0), F.least(F.lit(BINS - 1), place)).alias("bin")
    )
    counts = {"allow": [0] * BINS, "block": [0] * BINS}
    for row in bins.groupBy("rule_verdict", "bin").count().collect():
        counts[row["rule_verdict"]][row["bin"]] = row["count"]
    good, bad = max(sum(counts["allow"]), 1), max(sum(counts["block"]), 1)
    errors = []
    lost, caught = 0, 0
    for cut in range(BINS + 1):
        errors.append((lost / good - caught / bad, abs(cut - BINS / 2), cut))
        if cut < BINS:
            lost += counts["allow"][cut]
            caught += counts["block"][cut]
    return min(errors)[2] / BINS * 2 * SPAN - SPAN


def filter_urls(pages: DataFrame, url: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict, ratio of every page.

    A null url and one without ``://`` have empty host and path, fit no rule and are
    judged by the models like any other. Without any rule-judged URL the models say the
    same and all is allowed. Repeated rows give repeated rows, an empty table gives none,
    and other columns are not looked at.
    """
    small_batches(pages.sparkSession)
    frame = judged(pages, url)
    known = frame.where(F.col("rule_verdict").isNotNull())
    apart = fold(F.col("page_id"), FOLDS) == 0
    models = fit(known.where(~apart))
    cut = calibrate(_scored(known.where(apart).select("url", "rule_verdict"), models))
    verdict = F.coalesce("rule_verdict", F.when(F.col("ratio") >= cut, "allow").otherwise("block"))
    return _scored(frame, models).select(
        "page_id", "host", "path", "rule", verdict.alias("verdict"), "ratio"
    )
