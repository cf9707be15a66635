from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

import corpus_pipeline
from hourgrid.llm import bpe, jaccard, quality, simhash

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    good = corpus_pipeline.quality_rules(spark, docs, FOLDER)
    kept = {r.doc_id for r in quality.assess(docs).where("kept").collect()}
    assert {r.doc_id for r in good.collect()} == kept
    out = corpus_pipeline.run(spark, FOLDER).collect()
    assert out and {r.doc_id for r in out} <= kept
    code = bpe.Encoder()
    assert all(r.token_ids == code.ids(r.text) for r in out)


def test_empty_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
        assert docs.count() == 0


def _alike(a: str, b: str) -> float:
    x, y = (set(jaccard.shingles(t.encode()).tolist()) for t in (a, b))
    return len(x & y) / len(x | y)


def test_near_copies_beyond_four_bits(spark):
    rng = random.Random(6)
    vocabulary = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(500)]
    rows, far, chained = [], 0, []
    for i in range(40):
        words = rng.choices(vocabulary, k=150)
        # Edits at the end: 0.86 to the original, then under 0.8.
        near, less = " ".join(words[:140] + ["new"] * 6), " ".join(words[:118])
        rows += [(3 * i, " ".join(words)), (3 * i + 1, near), (3 * i + 2, less)]
        assert _alike(rows[-3][1], near) >= 0.8 > max(_alike(rows[-3][1], less), 0)
        prints = [simhash.simhash(t.encode()) for t in (rows[-3][1], near)]
        far += (prints[0] ^ prints[1]).bit_count() > simhash.MAX_BITS
        chained.append(_alike(near, less) >= 0.8)
    assert far > 10
    rows += [(200, None), (201, " "), (202, "Two  words"), (203, "two words"), (None, "two words"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = corpus_pipeline.near_dedup(spark, docs, FOLDER)
    wanted = {3 * i for i in range(40)} | {3 * i + 2 for i in range(40) if not chained[i]} | {200, 202}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(wanted)


def test_near_copies_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rng = random.Random(7)
    base = [f"w{rng.randint(0, 900)}" for _ in range(60)]
    # A group under common keys whose members are often under 0.8 to its ends.
    rows = [(i, r.text) for i, r in enumerate(docs.select("text").orderBy("doc_id").limit(300).collect())]
    for i in range(300, 420):
        words = list(base)
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(60)] = f"x{rng.randint(0, 50)}"
        rows.append((i, " ".join(words)))
    sets = [set(jaccard.shingles((t or "").encode()).tolist()) for _, t in rows]
    group = list(range(len(rows)))

    def root(i: int) -> int:
        while group[i] != i:
            i = group[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both >= 0.8 * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                group[max(x, y)] = min(x, y)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id for r in jaccard.keep_one(frame).collect()}
    assert kept == {root(i) for i in range(len(rows))}


def test_near_copies_in_small_cells(spark, monkeypatch):
    # Blocks of three texts: keys with many groups are dealt over many cells.
    monkeypatch.setattr(jaccard, "CELL", 3)
    monkeypatch.setattr(jaccard, "CELL_SHINGLES", 100)
    rng = random.Random(8)
    base = [f"w{rng.randint(0, 900)}" for _ in range(60)]
    rows = []
    for i in range(90):
        words = list(base)
        for _ in range(rng.randint(1, 4)):
            words[rng.randrange(60)] = f"x{rng.randint(0, 50)}"
        rows.append((i, " ".join(words), "a", 1))
    group = {i: i for i, *_ in rows}
    for a, text, *_ in rows:
        for b, other, *_ in rows[:a]:
            if _alike(text, other) >= 0.8 and group[a] != group[b]:
                low, high = sorted((group[a], group[b]))
                group = {k: low if g == high else g for k, g in group.items()}
    names = "doc_id long, text string, _rank string, won_id int"
    kept = jaccard.keep_one(spark.createDataFrame(rows, names)).collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(group.values()))
    assert all(r._rank == "a" and r.won_id == 1 for r in kept)
    assert 1 < len(kept) < 90


def _plain_print(hashes: list[int]) -> int:
    """SimHash, bit by bit: bit b of the fingerprint, from its first byte's highest bit."""
    top, ones = 2**64 - 1, [0] * jaccard.BITS
    for h in hashes:
        for w, word in enumerate(jaccard._WORDS.tolist()):
            x = h ^ word
            for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
                x = (x ^ x >> 33) * factor & top
            x ^= x >> 33
            for i, byte in enumerate(x.to_bytes(8, "little")):
                for b in range(8):
                    ones[64 * w + 8 * i + b] += byte >> 7 - b & 1
    return sum(1 << len(ones) - 1 - b for b, n in enumerate(ones) if 2 * n > len(hashes))


def _print(text: str) -> np.ndarray:
    return jaccard.fingerprint(jaccard.shingles(text.encode())).view(np.uint64)


def test_near_dedup_meets_by_simhash(spark):
    rng = random.Random(9)
    rows = []
    for i in range(100):
        words = rng.choices([f"w{k}" for k in range(400)], k=rng.randint(12, 320))
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words[: len(words) * 7 // 8]))]
    docs = spark.createDataFrame([*rows, (200, None)], "doc_id long, text string")
    found = {r.doc_id: r for r in jaccard.sketches(docs).collect()}
    for i in (0, 7, 200):
        hashes = jaccard.shingles((dict(rows).get(i) or "").encode()).tolist()
        assert int.from_bytes(found[i].print, "big") == _plain_print(hashes)
        assert found[i].n == len(hashes)
    alike = 0
    for (_, a), (_, b) in zip(rows[::2], rows[1::2], strict=True):
        if _alike(a, b) >= 0.8:
            alike += 1
            x, y = _print(a), _print(b)
            assert (x.view(np.uint16) == y.view(np.uint16)).any()
            assert np.bitwise_count(x[:2] ^ y[:2]).sum() <= jaccard.NEAR_BITS
            assert np.bitwise_count(x ^ y).sum() <= jaccard.FAR_BITS
    assert alike > 50


def test_neighbours_under_segments(monkeypatch):
    monkeypatch.setattr(jaccard, "_AT_ONCE", 50)
    monkeypatch.setattr(jaccard, "RUN_LIMIT", 40)
    rng = np.random.default_rng(3)
    # Segment 4 is longer than a block, segment 7 is long, segment 1 has one text.
    segment = np.repeat(np.arange(9), [20, 1, 30, 0, 130, 12, 3, 45, 16]).astype(np.int32)
    key = rng.permutation(len(segment)).astype(np.int64)
    bits = rng.integers(-(1 << 63), (1 << 63) - 1, (len(segment), 2))
    for i in range(0, len(segment), 3):
        bits[i] = bits[rng.integers(0, len(segment))] ^ (np.int64(1) << rng.integers(0, 60, 2))
    whole = bits.view(np.uint64).tolist()
    rows = pa.record_batch({"segment": segment, "key": key, "a": bits[:, 0], "b": bits[:, 1]})
    parts = [rows.slice(i, 7) for i in range(0, len(segment), 7)]
    bands: dict = {}
    for part in jaccard._neighbours(iter(parts)):
        for row in part.to_pylist():
            bands.setdefault(row["band"], set()).add(row["key"])
    group = {(s, k): {k} for s, k in zip(segment.tolist(), key.tolist(), strict=True)}
    for i in range(len(segment)):
        for j in range(i):
            apart = sum((x ^ y).bit_count() for x, y in zip(whole[i], whole[j], strict=True))
            long = segment[i] in (4, 7)
            if segment[i] == segment[j] and (long or apart <= jaccard.NEAR_BITS):
                both = group[segment[i], key[i]] | group[segment[j], key[j]]
                for k in both:
                    group[segment[i], k] = both
    wanted = {(s, frozenset(g)) for (s, _), g in group.items() if len(g) > 1}
    assert sorted(sorted(g) for g in bands.values()) == sorted(sorted(g) for _, g in wanted)
    assert len(wanted) > 5


def test_pairs_grow_with_texts(spark, monkeypatch):
    # A group whose segments have many hubs: a pair for each text and hub would be many rows.
    rng = random.Random(10)
    base = [f"w{rng.randint(0, 900)}" for _ in range(60)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(rng.randint(1, 4)):
            words[rng.randrange(60)] = f"x{rng.randint(0, 50)}"
        rows.append((i, " ".join(words)))
    group = {i: i for i, _ in rows}
    for a, text in rows:
        for b, other in rows[:a]:
            if group[a] != group[b] and _alike(text, other) >= 0.8:
                low, high = sorted((group[a], group[b]))
                group = {k: low if g == high else g for k, g in group.items()}
    counts = []
    attached = jaccard._attached

    def counted(pairs, *rest):
        out = attached(pairs, *rest)
        counts.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "_attached", counted)
    kept = jaccard.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(group.values()))
    assert 0 < sum(counts) <= 2 * len(rows)


def test_cell_links_meet_hubs(monkeypatch):
    rng = random.Random(11)
    base = [f"w{rng.randint(0, 900)}" for _ in range(60)]
    texts = [" ".join([*base[:57], *(f"y{i}{k}" for k in range(3))]) for i in range(6)]
    sets = [jaccard.shingles(t.encode()) for t in texts]
    sizes = np.array([len(x) for x in sets])
    keys = np.arange(10, 16)
    # Texts 4 and 5 are one group, named 3; text 2 is the hub.
    parts = np.array([10, 11, 12, 13, 3, 3])
    prints = np.stack([_print(t) for t in texts])
    assert min(_alike(texts[2], t) for t in texts) >= 0.8

    def found(far: int, hub: int, side: list[int]) -> set:
        monkeypatch.setattr(jaccard, "FAR_BITS", far)
        is_hub = (np.arange(6) == hub).astype(np.int8)
        cell = (keys, sizes, parts, np.array(side, np.int32), is_hub, prints, np.concatenate(sets))
        out = jaccard._cell_links([tuple(c.copy() for c in cell)])
        return {(r["key"], r["other"]) for part in out for r in part.to_pylist()}

    # However far their fingerprints are, all meet the hub.
    assert found(-1, 9, [2] * 6) == set()
    assert found(-1, 2, [2] * 6) == {(10, 12), (11, 12), (12, 13), (3, 12)}
    assert found(-1, 2, [0, 0, 1, 1, 1, 1]) == {(10, 12), (11, 12)}
    assert found(-1, 0, [0, 0, 1, 1, 1, 1]) == {(10, 12), (10, 13), (3, 10)}
    # Of each two groups one link, named by the groups.
    assert found(2048, 9, [2] * 6) == {(10, 11), (10, 12), (10, 13), (3, 10)}
