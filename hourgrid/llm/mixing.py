"""Mixing to target weights with soft membership.

A classifier learned from a labelled table gives each document posteriors over the
domains. Nonnegative document rates are then fitted by projected-gradient least squares,
so that the expected tokens of each domain, sum(rate * tokens * posterior), meet their
targets. A step needs one number per domain from all documents; rates are recomputed
from the steps' residuals, so the fit holds no state outside one narrow table.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourgrid.llm.common import byte_texts, lowered, present, small_batches, stored

#: Labelled documents, in expectation, that the classifier is fitted on.
SAMPLE_DOCS = 20_000
SAMPLE_SEED = 5
#: Words that the classifier reads: those with the highest G-squared above the least.
FEATURES, MIN_G2 = 512, 25.0
#: Ridge penalty and steps of the logistic regression.
PENALTY, FIT_STEPS = 0.002, 60
STEPS, STEP_SIZE, TOLERANCE = 40, 1.0, 1e-6
#: Rates of the main domain this near to 1 count as 1 where asked for.
SNAP = 0.05
#: Production targets: shares of the mixed tokens.
TARGETS = {"q1t0": 0.93, "q0t0": 0.05, "q1t1": 0.01, "q0t1": 0.01}


def features(raw: bytes) -> set[bytes]:
    """The words of a lower-cased text, without end marks, and signs of its form.

    A sign is a byte that no word can be, with a level.
    """
    words = raw.split()
    found = {w.strip(b".,!?") for w in words}
    if len(words) < 20:
        found.add(b"\0 few")
    symbols = sum(raw.count(c) for c in (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">"))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    signs = {
        "symbols": symbols / max(len(words), 1),
        "calls": raw.count(b"!") / max(len(words), 1),
        "lines": 1 - len(set(lines)) / max(len(lines), 1),
        "words": 1 - len(found) / max(len(words), 1),
    }
    for name, share in signs.items():
        found.add(f"\0 {name} {min(math.ceil(10 * share), 10)}".encode())
    return found


def _present_words(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(domain, word, documents of the batch that hold it)."""
    for part in parts:
        counts: Counter = Counter()
        domains = part.column("domain").to_pylist()
        for domain, raw in zip(domains, byte_texts(part.column("text")), strict=True):
            counts.update((domain, word) for word in features(raw))
        yield pa.record_batch(
            {
                "domain": pa.array([d for d, _ in counts], pa.string()),
                "word": pa.array([w for _, w in counts], pa.binary()),
                "n": pa.array(list(counts.values()), pa.int64()),
            }
        )


def fit(docs: DataFrame, labels: DataFrame, text: str = "text"):
    """(domains, intercepts, word -> weight per domain) of a logistic regression on words.

    A domain is named by the labels' values, such as ``q1t0``; rows with a null label are
    not learned from. Repeated labels of a document count once, by the greatest value.
    """
    named = (
        labels.where("quality is not null and toxic is not null and doc_id is not null")
        .groupBy("doc_id")
        .agg(F.max(F.struct("toxic", "quality")).alias("_l"))
        .select("doc_id", F.format_string("q%dt%d", "_l.quality", "_l.toxic").alias("domain"))
    )
    share = min(1.0, SAMPLE_DOCS / max(named.count(), 1))
    rows = docs.select("doc_id", lowered(F.col(text)).cast("binary").alias("text"))
    chosen = named.sample(share, seed=SAMPLE_SEED)
    known = stored(rows.join(chosen, "doc_id").select("domain", "text"), "labelled")
    sizes = {r["domain"]: r["count"] for r in known.groupBy("domain").count().collect()}
    domains = sorted(sizes)
    if not domains:
        return [], [], {}
    counted = (
        known.mapInArrow(_present_words, "domain string, word binary, n bigint")
        .groupBy("word")
        .agg(*(F.sum(F.when(F.col("domain") == d, F.col("n")).otherwise(0)).alias(d) for d in domains))
    )
    total = sum(sizes.values())
    seen = sum((F.col(d) for d in domains), F.lit(0))

    def part_of_g2(observed: Column, expected: Column) -> Column:
        return F.when(observed > 0, observed * F.log(observed / expected)).otherwise(0.0)

    g2 = F.lit(0.0)
    for d in domains:
        g2 = g2 + part_of_g2(F.col(d), seen * (sizes[d] / total))
        g2 = g2 + part_of_g2(sizes[d] - F.col(d), (total - seen) * (sizes[d] / total))
    best = counted.withColumn("g2", 2 * g2).where(F.col("g2") >= MIN_G2)
    found = best.orderBy(F.desc("g2"), "word").limit(FEATURES).collect()
    chosen_words = [bytes(row["word"]) for row in found]
    if len(domains) == 1 or not chosen_words:
        return domains, [math.log(sizes[d] / total) for d in domains], {}
    place = {word: i for i, word in enumerate(chosen_words)}

    def mark(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = byte_texts(part.column("text"))
            marks = [
                [place[w] for w in features(raw) & place.keys()] for raw in texts
            ]
            labels = [float(domains.index(d)) for d in part.column("domain").to_pylist()]
            yield pa.record_batch(
                {
                    "label": pa.array(labels, pa.float64()),
                    "marks": pa.array(marks, pa.list_(pa.int32())),
                }
            )

    marked = stored(known.mapInArrow(mark, "label double, marks array<int>"), "marked")
    spots = F.sequence(F.lit(0), F.lit(len(place) - 1))
    vector = array_to_vector(
        F.transform(spots, lambda i: F.array_contains("marks", i).cast("double"))
    )
    regression = LogisticRegression(
        regParam=PENALTY, maxIter=FIT_STEPS, standardization=False, family="multinomial"
    ).fit(marked.select("label", vector.alias("features")))
    slopes = regression.coefficientMatrix.toArray().T
    weights = {word: tuple(map(float, slopes[i])) for word, i in place.items()}
    return domains, [float(x) for x in regression.interceptVector], weights


def posteriors(docs: DataFrame, model, text: str = "text") -> DataFrame:
    """doc_id, text_hash, tokens (words) and p, the posterior of each domain."""
    domains, base, weights = model
    shared = docs.sparkSession.sparkContext.broadcast((base, weights))

    def score(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prior, table = shared.value
        keys = table.keys()
        for part in parts:
            tokens, values = [], []
            for raw in byte_texts(part.column("text")):
                tokens.append(len(raw.split()))
                total = list(prior)
                for word in keys & features(raw):
                    total = [a + b for a, b in zip(total, table[word], strict=True)]
                high = max(total, default=0.0)
                shares = [math.exp(x - high) for x in total]
                values.append([s / sum(shares) for s in shares])
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    part.column("text_hash"),
                    pa.array(tokens, pa.int64()),
                    pa.array(values, pa.list_(pa.float64())),
                ],
                names=["doc_id", "text_hash", "tokens", "p"],
            )

    rows = docs.select(
        "doc_id",
        F.xxhash64(present(F.col(text))).alias("text_hash"),
        lowered(F.col(text)).cast("binary").alias("text"),
    )
    return rows.mapInArrow(score, "doc_id bigint, text_hash bigint, tokens bigint, p array<double>")


def _rate(steps: list[list[float]], p: Column) -> Column:
    """The rate after all steps, from 1; each step moves against p . residuals."""
    if not steps:
        return F.lit(1.0)
    held = F.array(*(F.array(*(F.lit(x) for x in step)) for step in steps))

    def move(rate: Column, step: Column) -> Column:
        slope = F.aggregate(
            F.zip_with(step, p, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x
        )
        return F.greatest(F.lit(0.0), rate - STEP_SIZE * slope)

    return F.aggregate(held, F.lit(1.0), move)


def rates(members: DataFrame, domains: list[str], targets: Mapping[str, float]) -> DataFrame:
    """``members`` with ``rate``, and ``main``: is the domain with most tokens the likeliest.

    Targets name shares of the mixed tokens; a domain without one gets none. The total is
    the least at which the domain with most tokens keeps all of them. Residuals are taken
    relative to a domain's tokens, and the step is scaled by a document's tokens, so the
    Hessian's eigenvalues are at most 1 and a step of 1 is stable.
    """
    count = len(domains)
    if not count:
        return members.withColumns({"rate": F.lit(1.0), "main": F.lit(True)})
    spots = range(count)

    def totals(rate: Column) -> list[float]:
        sums = [F.sum(rate * F.col("tokens") * F.col("p")[k]).alias(f"s{k}") for k in spots]
        return [x or 0.0 for x in members.agg(*sums).first()]

    own = totals(F.lit(1.0))
    largest = max(spots, key=lambda k: own[k])
    share = [targets.get(d, 0.0) for d in domains]
    scale = own[largest] / share[largest] if share[largest] else sum(own)
    goal = [s * scale for s in share]
    steps: list[list[float]] = []
    for _ in range(STEPS):
        now = totals(_rate(steps, F.col("p"))) if steps else own
        gaps = [(now[k] - goal[k]) / own[k] if own[k] else 0.0 for k in spots]
        if max(map(abs, gaps)) < TOLERANCE:
            break
        steps.append(gaps)
    main = F.col("p")[largest] >= F.array_max("p")
    return members.withColumns({"rate": _rate(steps, F.col("p")), "main": main})


def mixed(
    docs: DataFrame,
    labels: DataFrame,
    targets: Mapping[str, float] = TARGETS,
    text: str = "text",
    snap: bool = False,
) -> DataFrame:
    """doc_id, text_hash, tokens, p, rate, copies of every document.

    ``copies`` is the rate rounded up with a chance of its fraction, by a hash of id and
    text, so expected totals stay on target; with ``snap``, rates of the main domain within
    ``SNAP`` of 1 become 1 first, so its documents are not lost by a small chance. Null and empty texts have no tokens and the rate of their posterior. Without
    labelled documents every rate is 1. Repeated rows get equal rates; an empty table
    gives no rows, and other columns are not looked at.
    """
    small_batches(docs.sparkSession)
    model = fit(docs, labels, text)
    members = stored(posteriors(docs, model, text), "members")
    chance = F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(1_000_003)) / 1_000_003
    rated = rates(members, model[0], targets)
    if snap:
        near = F.col("main") & (F.abs(F.col("rate") - 1) <= SNAP)
        rated = rated.withColumn("rate", F.when(near, 1.0).otherwise(F.col("rate")))
    return rated.drop("main").withColumn("copies", F.floor(F.col("rate") + chance).cast("long"))


def mix(
    docs: DataFrame,
    labels: DataFrame,
    targets: Mapping[str, float] = TARGETS,
    text: str = "text",
    snap: bool = True,
) -> DataFrame:
    """The documents, each as often as its copies say, with the columns of ``docs``."""
    chosen = (
        mixed(docs, labels, targets, text, snap)
        .where("copies > 0")
        .dropDuplicates(["doc_id", "text_hash"])
        .select(F.struct("doc_id", "text_hash", "copies").alias("_mix"))
    )
    # The documents travel as one struct, so none of their columns meets one of ours.
    rows = docs.select(F.struct(*docs.columns).alias("_doc"))
    held, entry = F.col("_doc"), F.col("_mix")
    same = held["doc_id"].eqNullSafe(entry["doc_id"]) & (
        F.xxhash64(present(held[text])) == entry["text_hash"]
    )
    times = F.explode(F.sequence(F.lit(1), entry["copies"].cast("int"))).alias("_copy")
    return rows.join(chosen, same).select("_doc", times).select("_doc.*")
