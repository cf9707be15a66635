"""The license scan against plain searches."""

from __future__ import annotations

import random
import re

from hourgrid.llm import licenses, queries

MIT, APACHE, GPL = (
    "Released under the MIT License.",
    "Licensed under the Apache License, Version 2.0.",
    "This work is licensed under the GNU General Public License, version 3.",
)


def brute_places(text: str | None) -> list[tuple[str, int]]:
    words = licenses.word_list(text or "")
    out = []
    for phrase, label in licenses.PHRASES.items():
        own = phrase.split()
        out += [(label, i) for i in range(len(words)) if words[i : i + len(own)] == own]
    return sorted(out)


def brute_words(text: str | None) -> list[str]:
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def _texts() -> list[str | None]:
    rng = random.Random(3)
    words = "river stone under the mit license apache version 2 cc by nc É 日本".split()
    grant = max(licenses.NOTICES, key=len)
    changed = grant.split()
    changed[10:10] = ["the", "new"]
    del changed[30]
    out: list[str | None] = [None, "", "?", "mit", MIT, APACHE, GPL, "CC-BY-NC 4.0", "cc by-nc", "under the mit\nLICENSE under the mit license"]
    out += [" ".join(rng.choices(words, k=rng.randrange(60))) for _ in range(60)]
    out += ["x " * 300 + MIT + " y" * 300 + APACHE, "cc by nc " * 4000, f"A. {grant}. B", " ".join(changed)]
    out += [" ".join(grant.split()[:20]), f"{GPL} {GPL}\n{MIT}", GPL.replace("3", "2"), MIT]
    return out


def test_scan(spark):
    texts = _texts()
    rows = [(i if i else None, t, "clash", 5, "c") for i, t in enumerate(texts)] + [(None, MIT, "", 1, ""), (None, MIT, "", 1, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, key string, score int, places string").repartition(3)
    result = licenses.scan(frame).collect()
    assert len(result) == len(rows)
    found = {r.doc_id: r for r in result if r.doc_id is not None}
    for i, text in enumerate(texts):
        if not i:
            continue
        r = found[i]
        assert r.n_words == len(brute_words(text))
        assert sorted((p.label, p.start) for p in r.places) == brute_places(text)
        assert 0 <= r.score <= 1 and (r.score == 1) >= bool(r.places)
        spans = sorted((s.first, s.last) for s in r.spans)
        assert all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False))
        assert all(s.score >= licenses.SHARE for s in r.spans)
    nulls = [r for r in result if r.doc_id is None]
    assert sorted(len(r.places) for r in nulls) == [0, 1, 1]
    at = {t: found[i] for i, t in enumerate(texts) if i}
    assert [s.label for s in at[GPL].spans] == ["gpl-3"] and at[GPL].score == 1
    assert [s.label for s in at[GPL.replace("3", "2")].spans] == ["gpl-2"]
    assert [(s.label, s.first) for s in at[f"{GPL} {GPL}\n{MIT}"].spans] == [("gpl-3", 0), ("gpl-3", 12)]
    grant = max(licenses.NOTICES, key=len)
    [whole] = at[f"A. {grant}. B"].spans
    assert (whole.label, whole.first, whole.last, whole.score) == ("mit", 1, len(grant.split()), 1)
    [edited] = found[texts.index(" ".join(grant.split()[:20])) - 1].spans
    assert edited.label == "mit" and licenses.SHARE <= edited.score < 1
    assert not at[" ".join(grant.split()[:20])].spans
    assert licenses.scan(frame.limit(0)).count() == 0


def test_own_templates(spark):
    frame = spark.createDataFrame([(1, "all of one two three four"), (2, "one two")], "doc_id long, text string")
    found = {r.doc_id: r for r in licenses.scan(frame, {"one two three": "a"}, {}).collect()}
    assert [tuple(p) for p in found[1].places] == [("a", 2)] and not found[2].places
    refused = False
    try:
        licenses.templates(spark, {"too short": "x"}, {})
    except ValueError:
        refused = True
    assert refused


def test_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = queries.op11_licenses(spark, folder).collect()
    assert len(found) == len(docs)
    for r in found:
        places = brute_places(docs[r.doc_id])
        starts = [start for _, start in places]
        labels = {label for label, _ in places}
        if "gnu general public license version 3" in " ".join(brute_words(docs[r.doc_id])):
            labels.add("gpl-3")
        assert (r.n_words, r.n_base) == (len(brute_words(docs[r.doc_id])), len(places))
        assert (r.first_word, r.last_word) == ((min(starts), max(starts)) if starts else (None, None))
        assert r.base_labels == ",".join(sorted({label for label, _ in places}))
        assert r.labels == ",".join(sorted(labels))
