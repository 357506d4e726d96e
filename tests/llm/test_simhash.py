from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from conftest import SMALL

from servery.llm import simhash
from servery.llm.queries import QUERIES

SPACE = re.compile("[\x20\x09-\x0d]+")


def brute_fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    found = [w for w in SPACE.split(lowered) if w]
    if not found:
        return 0
    grams = [" ".join(found[i : i + 3]) for i in range(len(found) - 2)] or [" ".join(found)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps: dict, radius: int = 2):
    parent = {k: k for k in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(fps)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if (fps[a] ^ fps[b]).bit_count() <= radius:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {k: find(k) for k in ids}


def test_query_matches_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = QUERIES["op4_gray_simhash"](spark, SMALL).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    fps = {d: brute_fingerprint(t) for d, t in texts.items()}
    assert {r.doc_id: r.fingerprint for r in rows} == {d: f"{f:016x}" for d, f in fps.items()}
    assert {r.doc_id: r.component_id for r in rows} == brute_components(fps)


@pytest.mark.parametrize("block, radius, turns", [(4, 2, 1), (50, 2, 2), (4096, 2, 1), (16, 6, 4), (4096, 7, 4)])
def test_links_join_the_same_groups_at_any_block_size(spark, monkeypatch, block, radius, turns):
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng = random.Random(block)
    fps = set()
    for _ in range(12):  # chains and dense groups around a centre
        f = rng.getrandbits(64)
        for _ in range(25):
            fps.add(f)
            for _ in range(radius - 1):
                f ^= 1 << rng.randrange(64)
            f ^= 1 << rng.randrange(rng.choice([2, 64]))
    fps |= {rng.getrandbits(64) for _ in range(100)} | {0, 1, 2**64 - 1}
    signed = np.array(sorted(fps), np.uint64).view(np.int64).tolist()
    frame = spark.createDataFrame([(f,) for f in signed], "fp long")
    roots = {r.node: r.root for r in simhash.components(simhash.links(frame, radius, turns)).collect()}
    groups, expected = defaultdict(set), defaultdict(set)
    for f in signed:
        groups[roots.get(f, f)].add(f)
    for f, root in brute_components({f: f % 2**64 for f in signed}, radius).items():
        expected[root].add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_search_has_full_recall():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 500, dtype=np.uint64)
    other = base ^ (np.uint64(1) << rng.integers(0, 64, 500).astype(np.uint64))
    owned = np.unique(np.concatenate([base, other]))
    owned = owned[np.argsort(simhash._gray_rank(owned))]
    q, near = simhash.Nodes(owned, owned).near(owned, 3)
    distance = np.bitwise_count(owned[:, None] ^ owned[None, :])
    assert set(zip(q.tolist(), near.tolist())) == set(zip(*map(np.ndarray.tolist, np.nonzero(distance <= 3))))


def test_nulls_copies_long_texts_and_clashing_names(spark):
    long = "word " * 60_000
    rows = [(1, None, 1), (2, "", 1), (3, " \t", 1), (4, "A b", 1), (5, "a B", 1), (6, long, 1), (6, long, 1), (None, "zz", 1), (None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    out = sorted(((r.doc_id, r.component_id) for r in simhash.simhash_digest(docs).collect()), key=str)
    assert out == sorted([(1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (6, 6), (6, 6), (None, None), (None, 1)], key=str)
    kept = sorted((r.doc_id for r in simhash.deduplicated(docs).collect()), key=str)
    assert kept == [1, 4, 6, None, None]
    assert simhash.simhash_digest(docs.limit(0)).collect() == []
    assert simhash.deduplicated(docs.limit(0)).collect() == []
