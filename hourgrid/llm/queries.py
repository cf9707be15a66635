"""The dealt operators over their whole tables, and the SQL that states them where it can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.llm import (
    bpe,
    brown,
    langid,
    licenses,
    manifest,
    merkle,
    mixing,
    quality,
    runs,
    secrets,
    simhash,
    tokencounts,
    urls,
)
from hourgrid.llm.common import present, words


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", simhash.hex_print(F.col("fp")).alias("fingerprint"), "component_id"
    )


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(_table(spark, sf_dir, "documents"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"))


def op4_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.fingerprints(_table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencounts.section_tokens(_table(spark, sf_dir, "documents"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_table(spark, sf_dir, "documents")).drop("text_hash")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.encode(_table(spark, sf_dir, "documents"), keep=("doc_id",))
    ids = F.array_join(F.col("token_ids").cast("array<string>"), " ")
    return encoded.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2(bpe.decode("token_ids"), 256).alias("decoded_sha256"),
    )


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return mixing.mixed(docs, labels).drop("text_hash")


def op9_brown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown.score(_table(spark, sf_dir, "documents"))


def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(_table(spark, sf_dir, "pages"))


def op11_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(_table(spark, sf_dir, "documents"))
    starts = F.transform("places", lambda p: p["start"].cast("long"))
    base, more = (F.transform(name, lambda x: x["label"]) for name in ("places", "spans"))

    def listed(labels: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        listed(base).alias("base_labels"),
        listed(F.concat(base, more)).alias("labels"),
        "score",
    )


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.audit(_table(spark, sf_dir, "documents"))


def looped(doc_id: Column, text: Column) -> Column:
    """A tenth of the texts (by the crc32 of the id; a null id counts as empty text) loops.

    From word a on, such a text repeats its next p words to its own end.
    """
    h = F.crc32(present(doc_id))
    g = F.floor(h / 10)

    def loop(found: Column) -> Column:
        n = F.size(found).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        a, p, left = a.cast("int"), p.cast("int"), (n - a).cast("int")
        cycle = F.array_repeat(F.slice(found, a + 1, p), F.ceil(left / p).cast("int"))
        whole = F.concat(F.slice(found, F.lit(1), a), F.slice(F.flatten(cycle), F.lit(1), left))
        return F.when(n > 0, F.array_join(whole, " ")).otherwise(present(text))

    # One array of one array: the words are split once, not once per use.
    return F.when(h % 10 == 0, F.transform(F.array(words(text)), loop)[0]).otherwise(present(text))


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = runs.periodic_runs(docs.select("doc_id", looped(F.col("doc_id"), F.col("text")).alias("text")))
    # Greatest length first, then the smallest start and period.
    best = F.get(
        F.array_sort(
            F.transform(
                "runs",
                lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period")),
            )
        ),
        F.lit(0),
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.array_join(F.transform(lines, lambda line: F.concat(line, F.lit("\n"))), "")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        (-best["less"]).alias("length"),
        best["period"].alias("period"),
        F.floor(-1000 * best["less"] / best["period"]).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_simhash,
        op2_quality,
        op3_language,
        op4_merkle,
        op5_token_counts,
        op6_secrets,
        op7_bpe,
        op8_mixing,
        op9_brown,
        op10_urls,
        op11_licenses,
        op12_manifest,
        op13_runs,
    )
}
#: Windows that occur again are found by grouping all windows of all texts by text and
#: words; the rules are stated one by one, without an order.
_QUALITY_SQL = r"""
WITH texts AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text FROM documents
), split AS (
  SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'),
                        lambda w: w <> '') AS ws,
         list_filter(string_split(text, chr(10)),
                     lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls
  FROM texts
), places AS (
  SELECT k, ws, unnest(range(1, len(ws) - 6)) AS i FROM split WHERE len(ws) >= 8
), windows AS (
  SELECT k, i, count(*) OVER (PARTITION BY k, list_slice(ws, i, i + 7)) AS n FROM places
), starts AS (
  SELECT k, least(8, i - lag(i, 1, -8) OVER (PARTITION BY k ORDER BY i)) AS more
  FROM windows WHERE n > 1
), covered AS (
  SELECT k, sum(more) AS n FROM starts GROUP BY k
), base AS (
  SELECT doc_id, text, len(ls) AS n_lines, len(ws)::BIGINT AS n_words,
         length(array_to_string(ws, ''))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         coalesce(covered.n, 0)::BIGINT AS n_repeat_words
  FROM split LEFT JOIN covered USING (k)
), judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
         n_symbols > 0.1::DOUBLE * n_words
      OR word_chars::DOUBLE / greatest(n_words, 1) NOT BETWEEN 2 AND 15
      OR length(regexp_replace(text, '[^\p{Lu}]+', '', 'g')) > 0.5::DOUBLE * word_chars
      OR length(regexp_replace(text, '[^!]+', '', 'g')) > 0.3::DOUBLE * n_words
      OR n_dup_lines > 0.3::DOUBLE * n_lines
      OR length(regexp_replace(text, '[^0-9]+', '', 'g')) > 0.3::DOUBLE * word_chars
         AS rejected
  FROM base
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT rejected AS kept
FROM judged
"""

#: The others are not stated by SQL: each has a hash, a model or a vocabulary that DuckDB
#: lacks. tests/llm holds the brute-force versions.
ORACLE_SQL: dict[str, str] = {"op2_quality": _QUALITY_SQL}
