"""Secret scan: a random forest removes false positives among candidates.

A candidate is a long run of key characters with a digit. Its features are length,
character transitions, dictionary coverage, path signs and neighbouring words, all in
built-in expressions; the forest is Spark ML's. It is trained from labelled findings: a
table of candidates with a label, by default candidates of the corpus that a narrow rule
labels (``weak_label``), on a bounded sample of each label.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourgrid.llm.common import present, stored, words
from hourgrid.session import scratch_path

VALUE = "[A-Za-z0-9+/_-]{12,}"
#: Labelled findings of either label, in expectation, that the forest is trained on.
SAMPLE_FINDINGS = 10_000
SAMPLE_SEED = 3
#: A label with fewer findings has each repeated, at a part of its weight, so that trees see them.
LEAST_FINDINGS = 100
TREES, DEPTH = 20, 6
MASK = "[SECRET]"
#: Words of names, and words that fill harmless identifiers.
_NAMES = "token|secret|passw|pwd|api[_-]?key|access[_-]?key|private[_-]?key|auth|credential|bearer"
_DICTIONARY = (
    "token|secret|password|example|sample|test|demo|dummy|placeholder|your|insert|change|here|"
    "index|page|image|photo|file|document|report|version|release|build|static|content|assets|"
    "article|product|category|user|home|html|json|http|www|com|org|net|data|name|time|date|"
    "with|that|from|this|and|the|for|ing|tion|ment|der|die|und|que|los|las"
)
_KNOWN = "^AKIA[0-9A-Z]{16}$|^gh[pousr]_[0-9A-Za-z]{36,}$|^xox[abprs]-[0-9A-Za-z-]{10,}$|^sk_live_[0-9A-Za-z]{16,}$"
FEATURES = (
    "length",
    "runs",
    "distinct",
    "digit_share",
    "upper_share",
    "hex_only",
    "coverage",
    "path",
    "named",
    "assigned",
    "known",
)


def candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, text_hash, before (the two words before, and the word's start) and value."""
    found = words(F.col(text))

    def place(word: Column, at: Column) -> Column:
        return F.struct(word.alias("word"), at.alias("at"))

    def likely(entry: Column) -> Column:
        word = entry["word"]
        return (F.length(word) >= 12) & word.rlike("[0-9]") & word.rlike(VALUE)

    rows = docs.select(
        "doc_id",
        F.xxhash64(present(F.col(text))).alias("text_hash"),
        F.explode(
            F.transform(F.array(found), lambda w: F.struct(
                w.alias("all"), F.filter(F.transform(w, place), likely).alias("hits")
            ))
        ).alias("_w"),
    ).where(F.size("_w.hits") > 0)
    near = F.transform(
        F.col("_w.hits"),
        lambda hit: F.struct(
            hit["word"].alias("word"),
            hit["at"].alias("at"),
            F.concat_ws(
                " ", F.get(F.col("_w.all"), hit["at"] - 2), F.get(F.col("_w.all"), hit["at"] - 1)
            ).alias("before"),
        ),
    )
    hits = rows.select("doc_id", "text_hash", F.inline(near))
    values = hits.withColumn(
        "value", F.explode(F.array_distinct(F.regexp_extract_all("word", F.lit(f"({VALUE})"), 1)))
    ).where(F.col("value").rlike("[0-9]"))
    start = F.expr("substring_index(word, value, 1)")
    return values.select(
        "doc_id",
        "text_hash",
        F.col("at").alias("word_number"),
        F.concat_ws(" ", F.substring("before", -80, 80), F.substring(start, -80, 80)).alias("before"),
        "value",
    )


def featured(found: DataFrame) -> DataFrame:
    value, before = F.col("value"), F.lower("before")
    size = F.length(value)

    def share(characters: str) -> Column:
        return F.length(F.regexp_replace(value, f"[^{characters}]+", "")) / size

    runs = value
    for characters, sign in (("a-z", "a"), ("A-Z", "A"), ("0-9", "0")):
        runs = F.regexp_replace(runs, f"[{characters}]+", sign)
    uncovered = F.length(F.regexp_replace(F.lower(value), _DICTIONARY, ""))
    columns = {
        "length": size,
        "runs": F.length(runs) / size,
        "distinct": F.size(F.array_distinct(F.split(value, ""))),
        "digit_share": share("0-9"),
        "upper_share": share("A-Z"),
        "hex_only": value.rlike("^[0-9a-f]+$|^[0-9A-F]+$").cast("int"),
        "coverage": 1 - uncovered / size,
        "path": (value.contains("/") | before.rlike("://|/")).cast("int"),
        "named": before.rlike(_NAMES).cast("int"),
        "assigned": before.rlike("[=:]\\s*[\"']?\\s*$").cast("int"),
        "known": value.rlike(_KNOWN).cast("int"),
    }
    return found.withColumns({name: c.cast("double") for name, c in columns.items()})


def weak_label(rows: DataFrame) -> Column:
    """1 for a published key format, or a mixed value assigned to a secret's name."""
    assigned = (F.col("named") == 1) & (F.col("assigned") == 1) & (F.col("path") == 0)
    mixed = F.col("digit_share").between(0.1, 0.95) & (F.col("coverage") < 0.3)
    return F.when((F.col("known") == 1) | (assigned & mixed), 1.0).otherwise(0.0)


def findings(rows: DataFrame) -> DataFrame:
    """Labelled findings from featured candidates, on a bounded sample of each label.

    All candidates are labelled and counted first, so a label that is rare is kept whole
    whatever the size of the table. ``weight`` restores the shares of the labels.
    """
    labelled = rows.withColumn("label", weak_label(rows))
    sizes = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}
    share, copies = F.lit(1.0), F.lit(1)
    for label, size in sizes.items():
        own = F.col("label") == label
        share = F.when(own, min(1.0, SAMPLE_FINDINGS / size)).otherwise(share)
        copies = F.when(own, -(-LEAST_FINDINGS // size)).otherwise(copies)
    sampled = labelled.withColumns({"_share": share, "_copies": copies}).where(
        F.rand(SAMPLE_SEED) < F.col("_share")
    )
    weighed = sampled.withColumn("weight", 1 / (F.col("_share") * F.col("_copies")))
    return weighed.withColumn("_copy", F.explode(F.sequence(F.lit(1), "_copies"))).drop("_share", "_copies", "_copy")


def scan(docs: DataFrame, labelled: DataFrame | None = None, text: str = "text") -> DataFrame:
    """doc_id, text_hash, word_number, before, value, probability, is_secret.

    One row per candidate; ``labelled`` has before, value and a label of 0 or 1. If it
    has but one class, that is every candidate's verdict, and without any nothing is a
    secret. Null and empty texts have no candidates, repeated rows have theirs each, an
    empty table gives none, and other columns are not looked at.
    """
    rows = stored(featured(candidates(docs, text)), "candidates")
    known = findings(rows) if labelled is None else featured(labelled).withColumn("weight", F.lit(1.0))
    known = stored(known.select(*FEATURES, F.col("label").cast("double").alias("label"), "weight"), "findings")
    spread = known.agg(F.min("label").alias("low"), F.max("label").alias("high")).first()
    if spread["low"] == spread["high"]:
        scored = rows.withColumn("probability", F.lit(float(spread["high"] or 0.0)))
    else:
        vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
        fitted = RandomForestClassifier(
            numTrees=TREES, maxDepth=DEPTH, seed=SAMPLE_SEED, labelCol="label", probabilityCol="shares", weightCol="weight"
        ).fit(vectors.transform(known))
        # A fitted forest holds its training summary and through it the session, which tasks
        # cannot take along; the stored one does not.
        path = scratch_path(docs.sparkSession, "forest")
        fitted.save(path)
        forest = RandomForestClassificationModel.load(path)
        scored = forest.transform(vectors.transform(rows)).withColumn(
            "probability", vector_to_array("shares")[1]
        )
    return scored.select(
        "doc_id",
        "text_hash",
        "word_number",
        "before",
        "value",
        "probability",
        (F.col("probability") >= 0.5).alias("is_secret"),
    )


def redact(docs: DataFrame, labelled: DataFrame | None = None, text: str = "text") -> DataFrame:
    """The documents with every secret masked; other columns stay as they are, whatever their names."""
    found = (
        scan(docs, labelled, text)
        .where("is_secret")
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_set("value").alias("values"))
        .select(F.struct("doc_id", "text_hash", "values").alias("_secret"))
    )
    # The documents travel as one struct, so none of their columns meets one of ours.
    rows = docs.select(F.struct(*docs.columns).alias("_doc"))
    held, secret = F.col("_doc"), F.col("_secret")
    same = held["doc_id"].eqNullSafe(secret["doc_id"]) & (
        F.xxhash64(present(held[text])) == secret["text_hash"]
    )
    # Longer values first, so that none is cut by one that it contains.
    longest = F.reverse(
        F.array_sort(F.transform(secret["values"], lambda v: F.struct(F.length(v).alias("n"), v.alias("v"))))
    )
    masked = F.aggregate(
        longest, held[text], lambda clean, entry: F.replace(clean, entry["v"], F.lit(MASK))
    )
    joined = rows.join(found, same, "left")
    clean = F.when(secret.isNull(), held[text]).otherwise(masked)
    return joined.select(*((clean if c == text else held[c]).alias(c) for c in docs.columns))
