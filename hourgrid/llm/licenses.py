"""License scan by diagonal voting.

All rolling grams of three words of all texts are joined, in Spark, with the places where
a template has them. A hit at word ``i`` of a text and word ``j`` of a template votes for
the diagonal ``i - j``. A phrase counts where all its grams vote for one diagonal; a notice
may have gained or lost words, so neighbouring diagonals are merged first, and the span
they cover is verified by the share of the template that its hits spell out.

The join compares the words themselves beside their hash, so every vote is exact, and
verification needs no second look at the text: texts are never shuffled.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourgrid.llm.common import lowered, present

#: Words of a gram: the shortest phrase has three.
GRAM = 3
#: Diagonals this close belong to one span: so many words were added or lost between hits.
DRIFT = 6
#: A span is a notice if its hits spell out this share of the longer of the two.
SHARE = 0.8
#: Template grams up to this many are broadcast (some 100 bytes each); beyond, they are shuffled.
BROADCAST_GRAMS = 200_000
#: What separates words, as a Java pattern.
GAPS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

#: Phrases, and the label of each.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: Public notices, and the label of each.
NOTICES = {
    "this work is licensed under the gnu general public license version 3": "gpl-3",
    "this work is licensed under the gnu general public license version 2": "gpl-2",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu "
    "general public license as published by the free software foundation either version 3 of the license "
    "or at your option any later version": "gpl-3",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu "
    "general public license as published by the free software foundation either version 2 of the license "
    "or at your option any later version": "gpl-2",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu "
    "lesser general public license as published by the free software foundation": "lgpl",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu "
    "affero general public license as published by the free software foundation": "agpl-3",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2",
    "licensed under the apache license version 2 0 the license you may not use this file except in "
    "compliance with the license": "apache-2",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and "
    "associated documentation files the software to deal in the software without restriction including "
    "without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
    "copies of the software": "mit",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is "
    "hereby granted": "isc",
    "redistribution and use in source and binary forms with or without modification are permitted provided "
    "that the following conditions are met": "bsd",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by",
    "this work is licensed under a creative commons attribution sharealike 4 0 international license": "cc-by-sa",
    "this work is licensed under a creative commons attribution noncommercial 4 0 international license": "cc-by-nc",
    "licensed under cc by nc 4 0": "cc-by-nc",
}


def word_list(text: str) -> list[str]:
    return [w for w in re.split(GAPS, re.sub("[A-Z]", lambda m: m.group().lower(), text)) if w]


def templates(
    spark: SparkSession, phrases: Mapping[str, str] = PHRASES, notices: Mapping[str, str] = NOTICES
) -> DataFrame:
    """``template``, ``label``, ``phrase``, ``size`` (words), ``at`` and the gram's words.

    Phrases and notices of fewer words than a gram are refused: they have no gram.
    """
    rows = []
    for exact, group in ((True, phrases), (False, notices)):
        for text, label in group.items():
            found = word_list(text)
            if len(found) < GRAM:
                raise ValueError(f"A template needs {GRAM} words: {text!r}")
            number = len({r[0] for r in rows})
            rows += [
                (number, label, exact, len(found), at, *found[at : at + GRAM])
                for at in range(len(found) - GRAM + 1)
            ]
    columns = ", ".join(f"t{i} string" for i in range(GRAM))
    schema = f"template int, label string, phrase boolean, size int, at int, {columns}"
    made = spark.createDataFrame(rows, schema)
    made = made.withColumn("t_hash", F.xxhash64(*(f"t{i}" for i in range(GRAM))))
    return F.broadcast(made) if len(rows) <= BROADCAST_GRAMS else made


def license_words(text: Column) -> Column:
    """Runs of digits, letters and signs beyond ASCII, A-Z lowered."""
    return F.array_remove(F.split(lowered(text), GAPS), "")


def _key(text: Column) -> Column:
    """16 bytes for a text: rows of equal id and text have equal results."""
    return F.unhex(F.md5(present(text)))


def hits(docs: DataFrame, table: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id``, ``key``, the template's columns and ``diagonal``: one row per vote."""
    found = license_words(F.col(text))
    # Column i of the zip starts at word i, so each entry is a gram; the last ones lack words.
    shifted = [F.slice(F.col("_words"), F.lit(i + 1), F.size("_words")) for i in range(GRAM)]
    fields = ", ".join(f"g{i}: string" for i in range(GRAM))
    grams = (
        docs.select("doc_id", _key(F.col(text)).alias("key"), found.alias("_words"))
        .select("doc_id", "key", F.posexplode(F.arrays_zip(*shifted).cast(f"array<struct<{fields}>>")))
        .select("doc_id", "key", "pos", "col.*")
        .where(F.col(f"g{GRAM - 1}").isNotNull())
        .withColumn("hash", F.xxhash64(*(f"g{i}" for i in range(GRAM))))
    )
    same = F.col("hash") == F.col("t_hash")
    for i in range(GRAM):
        same = same & (F.col(f"g{i}") == F.col(f"t{i}"))
    return grams.join(table, same).select(
        "doc_id",
        "key",
        "template",
        "label",
        "phrase",
        "size",
        "at",
        (F.col("pos") - F.col("at")).alias("diagonal"),
    )


def diagonals(votes: DataFrame) -> DataFrame:
    """One row per text, template and diagonal with the template places that voted for it.

    Equal rows of the input vote for the same places, which a set counts once.
    """
    return votes.groupBy("doc_id", "key", "template", "label", "phrase", "size", "diagonal").agg(
        F.collect_set("at").alias("places")
    )


def phrase_places(found: DataFrame) -> DataFrame:
    """Diagonals that all grams of a phrase voted for: its words stand there, consecutively."""
    whole = F.size("places") == F.col("size") - GRAM + 1
    return found.where(F.col("phrase") & whole)


def notice_spans(found: DataFrame) -> DataFrame:
    """Merged diagonals of notices: ``first``, ``last`` word, ``score``.

    A diagonal joins the one before it (of the same text and template) if it is at most
    ``DRIFT`` words on. The score is the number of template words that hits spell out, over
    the longer of template and span. A word that is said twice counts once, so a span that
    was merged over several notices scores low: it is cut into its diagonals again, which
    are scored one by one.
    """
    key = ["doc_id", "key", "template", "label", "size"]
    ordered = Window.partitionBy(*key).orderBy("diagonal")
    far = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(ordered) > DRIFT, F.lit(True))
    rows = found.where(~F.col("phrase")).withColumn("_far", far.cast("int"))
    rows = rows.withColumn("_group", F.sum("_far").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    single = rows.withColumn("_group", -F.row_number().over(ordered))
    ends = F.struct(
        (F.col("diagonal") + F.array_min("places")).alias("low"),
        (F.col("diagonal") + F.array_max("places") + GRAM - 1).alias("high"),
    )
    merged = (
        rows.unionByName(single)
        .withColumn("_ends", ends)
        .groupBy(*key, "_group")
        .agg(
            F.min("_ends.low").alias("first"),
            F.max("_ends.high").alias("last"),
            F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"),
        )
    )
    spelt = F.array_distinct(
        F.flatten(F.transform("places", lambda p: F.transform(F.sequence(F.lit(0), F.lit(GRAM - 1)), lambda i: p + i)))
    )
    longer = F.greatest(F.col("size"), F.col("last") - F.col("first") + 1)
    return merged.withColumn("score", F.size(spelt) / longer).select(*key, "first", "last", "score")


_SPAN_DDL = "struct<template: int, label: string, first: int, last: int, score: double>"
_PLACE_DDL = "struct<label: string, start: int>"
_SPAN = pa.list_(
    pa.struct(
        [
            ("template", pa.int32()),
            ("label", pa.string()),
            ("first", pa.int32()),
            ("last", pa.int32()),
            ("score", pa.float64()),
        ]
    )
)


def best_spans(spans: list[dict]) -> list[dict]:
    """Spans no better one overlaps, in order of their first word.

    Better is a higher score, then a longer span, then the smaller template number. Spans
    are taken from the best down, by a search among those that are taken already.
    """
    taken: list[tuple[int, int]] = []
    out = []
    for span in sorted(spans, key=lambda s: (-s["score"], s["first"] - s["last"], s["template"], s["first"])):
        first, last = span["first"], span["last"]
        at = bisect_left(taken, (first, first))
        if at < len(taken) and taken[at][0] <= last:
            continue
        if at and taken[at - 1][1] >= first:
            continue
        insort(taken, (first, last))
        out.append(span)
    return sorted(out, key=lambda s: s["first"])


def _choose(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for spans in parts:
        yield pa.array([best_spans(row or []) for row in spans.to_pylist()], _SPAN)


def scan(
    docs: DataFrame,
    phrases: Mapping[str, str] = PHRASES,
    notices: Mapping[str, str] = NOTICES,
    text: str = "text",
) -> DataFrame:
    """``doc_id``, ``n_words``, ``places`` of phrases, ``spans`` of notices, ``score``.

    ``places`` are structs of label and start, ``spans`` of template, label, first and last
    word and score, both empty where a text has none. ``score`` is 1 with a phrase, else
    the best score of any span, chosen or not, and 0 without a hit. Null texts count as
    empty and have no words. Rows that repeat give a row each; an empty table gives none;
    other columns are not looked at. A group that is gathered holds one text's hits.
    """
    found = diagonals(hits(docs, templates(docs.sparkSession, phrases, notices), text))
    exact = phrase_places(found).select(
        "doc_id",
        "key",
        F.struct("label", F.col("diagonal").alias("start")).alias("place"),
        F.lit(None).cast(_SPAN_DDL).alias("span"),
        F.lit(1.0).alias("score"),
    )
    span = F.struct("template", "label", "first", "last", "score")
    loose = notice_spans(found).select(
        "doc_id",
        "key",
        F.lit(None).cast(_PLACE_DDL).alias("place"),
        F.when(F.col("score") >= SHARE, span).alias("span"),
        "score",
    )
    own = (
        exact.unionByName(loose)
        .groupBy("doc_id", "key")
        .agg(
            F.collect_list("place").alias("places"),
            F.collect_list("span").alias("spans"),
            F.max("score").alias("score"),
        )
        .select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), "places", "score", F.arrow_udf(_choose, f"array<{_SPAN_DDL}>")("spans").alias("spans"))
    )
    rows = docs.select(
        "doc_id", _key(F.col(text)).alias("key"), F.size(license_words(F.col(text))).cast("long").alias("n_words")
    )
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key"))
    return rows.join(own, same, "left").select(
        "doc_id",
        "n_words",
        F.coalesce("places", F.array().cast(f"array<{_PLACE_DDL}>")).alias("places"),
        F.coalesce("spans", F.array().cast(f"array<{_SPAN_DDL}>")).alias("spans"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
