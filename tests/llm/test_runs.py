"""Runs and extensions against plain scans."""

from __future__ import annotations

import hashlib
import random
import re
from zlib import crc32

import numpy as np
import pytest

from hourgrid.llm import queries
from hourgrid.llm import runs as r


def brute(words: list) -> list[tuple[int, int, int]]:
    """All maximal stretches of four periods or more, by comparing words one by one."""
    found: dict = {}
    n = len(words)
    for period in range(1, n // 4 + 2):
        start = 0
        while start + period < n:
            end = start
            while end + period < n and words[end] == words[end + period]:
                end += 1
            length = end - start + period
            if end > start and length >= max(6, 4 * period):
                found.setdefault((start, length), period)
            start = max(end, start + 1) if end == start else end + 1
    return sorted((s, length, p) for (s, length), p in found.items())


def _sequences() -> list[list[int]]:
    rng = random.Random(5)
    out: list[list[int]] = [[], [1], [1] * 5, [1] * 6, [1] * 7, [1, 2] * 3, [1, 2] * 4, [1, 2] * 4 + [1]]
    for size in (20, 60, 150, 400):
        for letters in (1, 2, 3, 50):
            out.append([rng.randrange(letters) for _ in range(size)])
    for _ in range(30):
        words = [rng.randrange(30) for _ in range(rng.randrange(40))]
        for _ in range(rng.randrange(1, 4)):
            unit = [rng.randrange(rng.choice([2, 9])) for _ in range(rng.randrange(1, 45))]
            words += unit * rng.randrange(2, 9) + unit[: rng.randrange(len(unit))]
            words += [rng.randrange(30) for _ in range(rng.randrange(3))]
        out.append(words)
    out.append(list(range(100, 350)) * 5)
    return out


def test_cover_reaches_every_difference():
    v = r.COVER_MODULUS
    assert {(a - b) % v for a in r.COVER for b in r.COVER} == set(range(v))
    table = r._shifts()
    assert table.max() < v
    for i in range(v):
        for j in range(v):
            assert {(i + table[i, j]) % v, (j + table[i, j]) % v} <= set(r.COVER)


def test_extensions_equal_comparing():
    rng = random.Random(2)
    for words in _sequences():
        numbers = np.array([*words, 10**6], np.int64)
        known = r.Extensions(numbers)
        n = len(numbers)
        pairs = [(rng.randrange(n), rng.randrange(n)) for _ in range(200)]
        pairs = [(i, j) for i, j in pairs if i != j]
        if not pairs:
            continue
        i, j = (np.array(x) for x in zip(*pairs, strict=True))
        wanted = []
        for a, b in pairs:
            k = 0
            while max(a, b) + k < n and numbers[a + k] == numbers[b + k]:
                k += 1
            wanted.append(k)
        assert known.lce(i, j).tolist() == wanted


@pytest.mark.parametrize("chunk", [1, 1 << 19])
def test_runs_equal_brute_force(monkeypatch, chunk):
    monkeypatch.setattr(r, "GRID_CHUNK", chunk)
    texts = _sequences()
    sizes = np.array([len(t) for t in texts])
    found = r.find_runs(np.concatenate([np.array(t, np.int64) for t in texts]), sizes)
    keep = np.split(r.kept_words(found, sizes), np.cumsum(sizes)[:-1])
    for k, words in enumerate(texts):
        wanted = brute(words)
        assert [tuple(x) for x in found[found[:, 0] == k][:, 1:].tolist()] == wanted
        dropped = {i for s, length, p in wanted for i in range(s + p, s + length)}
        assert np.flatnonzero(~keep[k]).tolist() == sorted(dropped)


def test_no_texts():
    assert r.find_runs(np.empty(0, np.int64), np.empty(0, np.int64)).shape == (0, 4)
    assert r.find_runs(np.empty(0, np.int64), np.array([0, 0])).shape == (0, 4)


def test_operator(spark):
    texts = ["a b " * 5 + "c", None, "", "x", "é " * 20 + "end", " \n", "w " * 30000, "a b " * 5 + "c"]
    rows = [(i if i != 3 else None, t, "clash", 1) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, runs string, number int").repartition(2)
    found = {x.doc_id: x for x in r.periodic_runs(frame).collect()}
    assert len(found) == len(texts)
    for doc_id, text, *_ in rows:
        words = (text or "").split()
        wanted = [(0, 30000, 1)] if doc_id == 6 else brute(words)
        assert [tuple(x) for x in found[doc_id].runs] == wanted
        dropped = {i for s, length, p in wanted for i in range(s + p, s + length)}
        assert found[doc_id].collapsed == " ".join(w for i, w in enumerate(words) if i not in dropped)
    assert r.periodic_runs(frame.limit(0)).count() == 0


def test_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    found = {x.doc_id: x for x in queries.op13_runs(spark, folder).collect()}
    assert len(found) == len(docs)
    looped = 0
    for doc in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", doc.text or "")
        n, h = len(words), crc32(str(doc.doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            looped += 1
        runs = brute(words)
        dropped = {i for s, length, p in runs for i in range(s + p, s + length)}
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        lines = "".join(f"{s},{length},{p}\n" for s, length, p in runs)
        kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
        assert tuple(found[doc.doc_id]) == (
            doc.doc_id,
            len(runs),
            *((None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])),
            hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(kept.encode()).hexdigest(),
        )
    assert looped > 10


def test_query_on_odd_rows(spark, tmp_path):
    rows = [(None, None, 1), (None, "a b c", 1), (7, "", 1), (35, "one two", 1), (35, "one two", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, runs int").write.parquet(
        str(tmp_path / "documents.parquet")
    )
    found = queries.op13_runs(spark, str(tmp_path)).collect()
    assert len(found) == len(rows) and all(x.runs_sha256 and x.collapsed_sha256 for x in found)
    spark.createDataFrame([], "doc_id long, text string").write.parquet(str(tmp_path / "e/documents.parquet"))
    assert queries.op13_runs(spark, str(tmp_path / "e")).count() == 0
