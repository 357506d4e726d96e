from __future__ import annotations

import hashlib
import random
import re

import pytest
from conftest import SMALL
from oracle_check import compare, connect

from servery.llm import contamination
from servery.llm.queries import ORACLE, QUERIES

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    out = []
    for doc_id, text in docs:
        w, hit, ids = words(text), set(), set()
        for item_id, item in items:
            v = words(item)
            size = min(10, len(v))
            wins = {tuple(v[i : i + size]) for i in range(len(v) - size + 1)} if v else set()
            for p in range(len(w) - size + 1):
                if tuple(w[p : p + size]) in wins:
                    hit |= set(range(p, p + size))
                    ids.add(item_id)
        names = sorted(str(i) for i in ids if i is not None)
        out.append((doc_id, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def test_query_matches_sql(spark):
    name = "op9_positional_decontamination"
    assert compare(QUERIES[name](spark, SMALL), connect(SMALL), ORACLE[name]) > 0


@pytest.mark.parametrize("broadcast", [200_000, 0])
def test_matches_brute_force(spark, monkeypatch, broadcast):
    monkeypatch.setattr(contamination, "BROADCAST_ROWS", broadcast)
    rng = random.Random(5)
    vocabulary = ["the", "of", "a", "É", "é", "x1", *[f"w{i}" for i in range(12)]]
    text = lambda n: " ".join(rng.choices(vocabulary, k=n))
    items = [(i, text(rng.randint(8, 25))) for i in range(12)]
    items += [(20, "The, Of"), (21, "a"), (22, None), (23, "!?"), (3, items[4][1]), (None, text(12)), (30, "absent word")]
    docs = [(i, text(rng.randint(0, 80))) for i in range(40)]
    docs += [(100 + i, f"{text(9)} {item.upper() if item.isascii() else item}!! {text(5)}") for i, (_, item) in enumerate(items) if item]
    docs += [(200, None), (201, ""), (202, "word " * 30_000 + items[0][1]), (None, items[1][1]), (203, items[2][1]), (203, items[2][1])]
    frame = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, text string, term int, win int")
    tests = spark.createDataFrame([(*i, "s") for i in items], "item_id long, text string, start string")
    rows = contamination.contamination_digest(frame, tests).collect()
    assert sorted(map(tuple, rows), key=str) == brute(docs, items)
    clean = {r.doc_id for r in contamination.decontaminated(frame, tests).collect()}
    assert clean == {r.doc_id for r in rows if not r.contaminated}


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "p p alpha q beta r"), (2, "alpha beta"), (3, "alpha q q q q q beta")], "doc_id long, text string")
    terms = spark.createDataFrame([("alpha",), ("beta",)], "term string")
    rare = spark.createDataFrame([("w", "alpha", 0, 1, 2), ("w", "beta", 1, 2, 2)], "win string, term string, offset int, k int, needed int")
    index = contamination.postings(docs, terms, 2)
    assert [(int(r._id), r.start) for r in contamination.near_starts(index, rare, 2, slop=2).collect()] == [(1, 2)]
    assert [(int(r._id), r.start) for r in contamination.starts(index, rare, 2).collect()] == [(2, 0)]


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert contamination.contamination_digest(docs.limit(0), items).collect() == []
    (row,) = contamination.contamination_digest(docs, items.limit(0)).collect()
    assert (row.n_words, row.n_hit, row.contaminated) == (2, 0, False)


def brute_near(docs, items, slop=1):
    out = {}
    for doc_id, text in docs:
        w, near = words(text), set()
        for item_id, item in items:
            v, size = words(item), min(10, len(words(item)))
            wins = [v[i : i + size] for i in range(len(v) - size + 1)] if v else []
            if any(w[p : p + size] == win for win in wins for p in range(len(w) - size + 1)):
                continue
            for win in wins:
                for s in range(-size - slop, len(w) + slop):
                    n = sum(t in w[max(0, s + o - slop) : max(0, s + o + slop + 1)] for o, t in enumerate(win))
                    if n >= size - (size >= 5):
                        near.add(item_id)
        out[doc_id] = sorted(map(str, near))
    return out


@pytest.mark.parametrize("broadcast", [200_000, 0])
def test_proximity_matches_brute_force(spark, monkeypatch, broadcast):
    monkeypatch.setattr(contamination, "BROADCAST_ROWS", broadcast)
    rng = random.Random(6)
    vocabulary = ["the", "of", "a", *[f"w{i}" for i in range(60)]]
    text = lambda n: rng.choices(vocabulary, k=n)
    items = [(i, text(rng.randint(2, 24))) for i in range(16)] + [(20, ["lone"]), (21, ["absent", *text(9)])]
    docs = [(i, text(40)) for i in range(20)] + [(50, []), (51, ["lone"]), (52, items[-1][1][1:])]
    for k, (_, item) in enumerate(items):
        at = len(item) // 2
        for j, quoted in enumerate(([*item[:at], "put", *item[at:]], [*item[:at], *item[at + 1 :]], [*item[:at], "x", *item[at + 1 :]], item)):
            docs.append((100 + 10 * k + j, [*text(6), *quoted, *text(6)]))
    docs, items = ([(i, " ".join(w)) for i, w in rows] for rows in (docs, items))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    rows = contamination.proximity_digest(frame, spark.createDataFrame(items, "item_id long, text string")).collect()
    expected = brute_near(docs, items)
    assert {r.doc_id: r.near_items for r in rows} == expected and len(rows) == len(docs)
    assert all(r.n_near == len(r.near_items) for r in rows)
    for k, (i, item) in enumerate(items):
        if len(item.split()) >= 10:  # a word put in, left out or replaced
            assert str(i) not in expected[100 + 10 * k + 3]
            assert all(str(i) in expected[100 + 10 * k + j] for j in range(3) if len(item.split()) < 20)
