"""The manifest against a plain tree over sorted rows."""

from __future__ import annotations

import hashlib
import random
from collections import Counter
from zlib import crc32

import pytest

from hourgrid.llm import manifest as m

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, series string, at int, log string"


def _hash(parts) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _framed(value) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def _levels(nodes: list[str]) -> list[list[str]]:
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([_hash(last[i : i + 8]) for i in range(0, len(last), 8)])
    return levels


def _path(levels: list[list[str]], at: int) -> list[tuple[list[str], list[str]]]:
    out = []
    for level in levels[:-1]:
        start = at // 8 * 8
        run = level[start : start + 8]
        out.append((run[: at - start], run[at - start + 1 :]))
        at //= 8
    return out


def _fold(node: str, path) -> str:
    for before, after in path:
        node = _hash([*before, node, *after])
    return node


def brute(rows) -> Counter:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row."""
    by_lang: dict = {}
    for row in rows:
        doc_id, source, lang, n_chars, text = row[:5]
        low = None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        leaf = _hash(map(_framed, (doc_id, source, lang, n_chars, text)))
        tampered = _hash(map(_framed, (doc_id, source, lang, n_chars, low)))
        hit = crc32(("" if doc_id is None else str(doc_id)).encode()) % 3 == 0
        key = (doc_id is not None, doc_id or 0, leaf)
        by_lang.setdefault(lang, []).append((key, doc_id, leaf, tampered if hit else leaf))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        by_lang[lang].sort(key=lambda r: r[0])
        trees[lang] = _levels([r[2] for r in by_lang[lang]])
    top = _levels([trees[lang][-1][0] for lang in langs])
    root, out = top[-1][0] if langs else None, Counter()
    for number, lang in enumerate(langs):
        for at, (_, doc_id, leaf, seen) in enumerate(by_lang[lang]):
            path = _path(trees[lang], at) + _path(top, number)
            proof = _hash(x for before, after in path for x in (*before, *after))
            end = _fold(seen, path)
            out[doc_id, leaf, trees[lang][-1][0], root, proof, end, end == root] += 1
    return out


def _rows(langs, sizes):
    rng, out = random.Random(1), []
    for lang, size in zip(langs, sizes, strict=True):
        for _ in range(size):
            text = rng.choice([None, "", "Abc É 日本", "plain", f"River {rng.random()}", "X" * 5000])
            out.append((rng.randint(-3, 10**6), rng.choice([None, "s-1"]), lang, rng.choice([None, 7]), text))
    out += [(None, None, langs[0], None, None), (None, None, langs[0], None, "Q"), out[0], out[0]]
    return [(*row, "series", 1, "log") for row in out]


@pytest.mark.parametrize(
    "langs, sizes",
    [
        ([None, "en", "", "de", "é"], [3, 1300, 64, 513, 9]),
        (["one"], [0]),
        ([f"l{i}" for i in range(11)], [1] * 11),
    ],
)
def test_audit_equals_brute_force(spark, langs, sizes):
    rows = _rows(langs, sizes) if sum(sizes) else [(7, None, "one", 1, "Lone", "", 0, "")]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = Counter(
        (r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified)
        for r in m.audit(frame).collect()
    )
    assert found == brute(rows)


def test_empty_table(spark):
    assert m.audit(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("count", [1, 2, 7, 8, 9, 63, 64, 65, 100, 511, 512, 513, 700])
def test_places_follow_the_order_of_completion(count):
    leaves = [hashlib.sha256(str(i).encode()).digest() for i in range(count)]
    levels = m.levels_of(count)
    log = m.append(leaves, levels)
    naive = _levels([x.hex() for x in leaves])
    assert len(naive) == levels + 1
    places = [m.place(h, i, count) for h, level in enumerate(naive) for i in range(len(level))]
    assert sorted(places) == list(range(len(log) // 32))
    assert all(
        m.node_at(log, m.place(h, i, count)).hex() == node
        for h, level in enumerate(naive)
        for i, node in enumerate(level)
    )
    assert {m.folded(x, path) for x, path in zip(leaves, m.paths(log, count, levels), strict=True)} == {
        bytes.fromhex(naive[-1][0])
    }


def test_log_is_one_postorder_per_language(spark):
    rows = _rows(["en", None], [5000, 20])
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    kept = m.manifest(frame)
    logs: dict = {}
    for r in kept.log().collect():
        logs.setdefault(r.series, {})[r.position] = (r.level, r["index"], r.digest)
    for series, log in logs.items():
        assert sorted(log) == list(range(len(log)))
        leaves = [d for _, (level, _, d) in sorted(log.items()) if level == 0]
        naive = _levels(leaves)
        assert len(log) == sum(map(len, naive))
        assert all(naive[level][index] == d for level, index, d in log.values()), series
    whole = kept.proofs().collect()
    assert all(hashlib.sha256(r.proof.encode()).hexdigest() == r.proof_sha256 for r in whole)
    assert not all(r.verified for r in whole) and any(r.verified for r in whole)
