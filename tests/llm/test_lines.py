from __future__ import annotations

import hashlib
import random
import re
import struct

import pytest
import xxhash
from conftest import SMALL

from servery.llm import lines
from servery.llm.queries import QUERIES

SPACE = " \t\n\x0b\x0c\r"
CUT = re.compile(r"(?<=\n)(?=[^\n])|(?<=[.!?] )(?=\S)")


def mix(a, b):
    """Spark's hash of two longs."""
    for x in (a, b):
        seed = 42 if x is a else h  # noqa: F821
        h = xxhash.xxh64_intdigest(struct.pack("<q", x), seed)
    return struct.unpack("<q", struct.pack("<Q", h))[0]


def packed(h, size):
    h = struct.unpack("<q", struct.pack("<Q", h % 2**64))[0]
    return (h & ~63) | min(size, 63)


def hashed(text):
    units = CUT.split(text)
    bare = [u.strip(SPACE).encode() for u in units]
    return units, [packed(xxhash.xxh64_intdigest(u, 42), len(u)) for u in bare]


def fingerprints(h):
    size = lambda x: x & 63
    grams, step = list(h), 1
    while step < lines.GRAM_LINES:
        grams = [
            x if size(x) >= lines.GRAM_BYTES or i + step >= len(h) else packed(mix(x, grams[i + step]), size(x) + size(grams[i + step]))
            for i, x in enumerate(grams)
        ]
        step *= 2
    n = sum(size(x) >= lines.GRAM_BYTES or i + lines.GRAM_LINES <= len(h) for i, x in enumerate(grams))
    chosen = set()
    for i in range(n):  # windows, cut short by the end and by lines that are grams
        window = []
        for j in range(i, min(i + lines.WINDOW, n)):
            window.append((grams[j], j))
            if size(h[j]) >= lines.GRAM_BYTES:
                break
        chosen.add(min(window)[1])
    return [(grams[i], i) for i in sorted(chosen)]


def runs_of(places):
    runs = []
    for i in sorted(places):
        if runs and runs[-1][1] == i:
            runs[-1][1] = i + 1
        else:
            runs.append([i, i + 1])
    return runs


def long_runs(units, places):
    size = lambda a, b: sum(len(u.strip(SPACE).encode()) for u in units[a:b])
    return {i for a, b in runs_of(places) if b - a >= lines.RUN_LINES or size(a, b) >= lines.RUN_BYTES for i in range(a, b)}


def brute(texts: dict):
    """What is left of each text."""
    of = {d: hashed(t) for d, t in texts.items() if t is not None}
    places = {}
    for d in sorted(of):
        for g, pos in fingerprints(of[d][1]):
            places.setdefault(g, []).append((d, pos))
    gone = {d: set() for d in of}
    for found in places.values():
        d0, p0 = min(found)
        first = of[d0][1]
        for d, pos in found:
            if (d, pos) == (d0, p0):
                continue
            own = of[d][1]
            for step in (1, -1):
                for k in range(0 if step > 0 else 1, (lines.REACH if step > 0 else lines.WINDOW) + 1):
                    a, b = pos + step * k, p0 + step * k
                    if not (0 <= a < len(own) and 0 <= b < len(first)) or k and own[a] != first[b]:
                        break
                    gone[d].add(a)
    gone = {d: long_runs(of[d][0], gone[d]) for d in of}
    left = {d: "".join(u for i, u in enumerate(of[d][0]) if i not in gone[d]) for d in of}
    return {d: (left.get(d), len(of[d][0]) if d in of else 0, len(gone.get(d, ()))) for d in texts}


def check(rows, texts):
    expected = brute(texts)
    for r in rows:
        text, n, deleted = expected[r.doc_id]
        digest = None if text is None else hashlib.sha256(text.encode()).hexdigest()
        assert (r.n_lines, r.n_deleted, r.kept_sha256) == (n, deleted, digest), r.doc_id


def test_query_matches_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = QUERIES["op7_winnowed_lines"](spark, SMALL).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    check(rows, texts)
    assert sum(r.n_deleted for r in rows) > 50


def sentence(rng, n):
    return " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(n)).capitalize() + ". "


def test_passages_go_wherever_they_stand_and_clean_text_stays(spark):
    rng = random.Random(4)
    passage = "".join(sentence(rng, 9) for _ in range(7))
    own = {d: [sentence(rng, 8) for _ in range(6)] for d in range(12)}
    texts = {d: "".join([*s[:3], passage if d % 2 else "", *s[3:]]) for d, s in own.items()}
    texts[20] = "a b\n" * 40 + passage  # within one document, too
    texts[21] = texts[3]
    docs = spark.createDataFrame([(d, t, 1) for d, t in texts.items()], "doc_id long, text string, n_lines int")
    check(lines.line_digest(docs).collect(), texts)
    left = {r.doc_id: r.text for r in lines.deduplicated(docs).collect()}
    assert 21 not in left and left[1] == texts[1]
    for d, s in own.items():
        assert all(x.strip() in left[d] for x in s)
        if d % 2 and d > 1:
            assert sum(x.strip(". ") in left[d] for x in passage.split(". ") if x) <= 2
    assert left[20].count("a b") < 20


def test_nulls_empty_long_and_repeated_rows(spark):
    long = "".join(f"line {i}\n" for i in range(20_000))
    rows = [(1, None, 0), (2, "", 0), (3, long, 0), (4, long, 0), (5, "x" * 200, 0), (6, "x" * 200, 0), (None, "x" * 200, 0), (7, "\n\n", 0), (5, "x" * 200, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs int")
    out = lines.line_digest(docs).collect()
    assert len(out) == len(rows)
    check([r for r in out if r.doc_id is not None], {r[0]: r[1] for r in rows if r[0] is not None})
    kept = sorted((r.doc_id for r in lines.deduplicated(docs).collect()), key=str)
    assert kept == [1, 2, 3, 5, 5, 7, None]
    assert lines.line_digest(docs.limit(0)).collect() == []


@pytest.mark.parametrize("text", ["", "a", "a\n\nb. C! d", "x.  y", "\n", " a. b\n  c"])
def test_lines_put_together_are_the_text(spark, text):
    (row,) = spark.createDataFrame([(text,)], "text string").select(lines.lines(lines.F.col("text")).alias("l")).collect()
    assert "".join(row.l) == text and row.l == CUT.split(text)


def test_own_text_stays_beside_a_large_share_of_repeats(spark):
    rng = random.Random(8)
    shared = "".join(sentence(rng, 9) for _ in range(60))
    own = "".join(sentence(rng, 9) for _ in range(8))
    scrap = sentence(rng, 9)
    docs = spark.createDataFrame([(1, shared), (2, shared + own), (3, shared + scrap)], "doc_id long, text string")
    left = {r.doc_id: r.text for r in lines.deduplicated(docs, 0.2, 50).collect()}
    assert left == {1: shared, 2: own}
    assert lines.deduplicated(docs, 0.2, 1).count() == 3


def test_every_common_gram_goes_whatever_stands_around_it(spark):
    """An expectation of its own: all runs of lines of a gram's length that stand earlier as well."""
    rng = random.Random(9)
    paragraph = " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(55)) + "\n"
    texts = {d: f"{sentence(rng, 20)}\n{paragraph}{sentence(rng, 20)}\n" for d in range(30)}
    run = [sentence(rng, 6) + "\n" for _ in range(40)]
    for k in range(12):  # documents that overlap by degrees, the longer ones later
        texts[100 + 3 * k] = sentence(rng, 8) + "\n" + "".join(run[k + 1 : k + 6]) + sentence(rng, 8)
        texts[101 + 3 * k] = sentence(rng, 8) + "\n" + "".join(run[k : k + 25])
        texts[102 + 3 * k] = sentence(rng, 8) + "\n" + "".join(run[k : k + 25])
    seen, due = set(), {}
    for d, text in sorted(texts.items()):
        units = [u.strip(SPACE) for u in CUT.split(text)]
        due[d] = set()
        for i in range(len(units)):
            n = next((n for n in range(1, min(12, len(units) - i) + 1) if n == 12 or sum(len(u) for u in units[i : i + n]) >= 100), None)
            gram = tuple(units[i : i + n]) if n else None
            if gram in seen:
                due[d] |= set(range(i, i + n))
            elif gram:
                seen.add(gram)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    gone = {r.doc_id: {i for a, b in r._runs for i in range(a, b)} for r in lines.deletions(lines.indexed(docs)).collect()}
    assert all(len(due[d]) == 1 for d in range(1, 30)) and all(due[102 + 3 * k] for k in range(12))
    for d, text in texts.items():
        units = CUT.split(text)
        assert due[d] <= long_runs(units, gone.get(d, set())), d


def test_runs_of_short_lines_of_any_lengths_share_a_fingerprint():
    """Any run of 100 bytes or 12 lines has the same fingerprint in both texts."""
    rng = random.Random(6)
    word = lambda n: "".join(rng.choices("abcdefghij", k=n))
    for k in range(20_000):
        most = rng.choice([3, 8, 12, 16, 20, 31, 40])
        run = []
        while len(run) < 12 and sum(map(len, run)) < 100:
            run.append(word(rng.randint(1, most)))
        around = lambda: [word(rng.randint(1, most)) for _ in range(14)]
        found = [{g for g, _ in fingerprints(hashed("\n".join([*around(), *run, *around()]))[1])} for _ in range(2)]
        assert found[0] & found[1], run


def test_fingerprints_are_window_minima(spark):
    rng = random.Random(7)
    texts = ["\n".join("".join(rng.choices("ab", k=rng.choice([1, 5, 9, 15, 23, 24, 70]))) for _ in range(n)) for n in [0, 1, 2, 3, 7, 8, 9, 40, 400]]
    rows = lines.indexed(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert len(rows) == len(texts)
    for r in rows:
        h = hashed(texts[r.doc_id])[1]
        assert r.h == h and [tuple(f) for f in r.f] == fingerprints(h)
    assert sum(len(r.f) for r in rows) < 0.8 * sum(len(r.h) for r in rows)


CLASHING = "doc_id long, text string, _id long, _n long, _runs string, _hash string, _text string, _bytes int, h int, f int, row int, rest int, left int, key int"


def test_other_columns_stay_whatever_their_names(spark):
    own = (1, 2, "r", "h", "t", 5, 6, 7, 8, 9, 10, 11)
    docs = spark.createDataFrame([(1, "x" * 200, *own), (2, "x" * 200 + "\nmine", *own)], CLASHING)
    left = {r.doc_id: tuple(r) for r in lines.without_repeats(docs).collect()}
    assert left == {1: (1, "x" * 200, *own, 1, 0), 2: (2, "mine", *own, 2, 1)}
    kept = lines.deduplicated(docs)
    assert kept.columns == docs.columns and {tuple(r)[:2] for r in kept.collect()} == {(1, "x" * 200), (2, "mine")}
    assert all(tuple(r)[2:] == own for r in kept.collect())
