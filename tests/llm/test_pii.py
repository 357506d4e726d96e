from __future__ import annotations

import hashlib
import random
import re
import time

import pytest
from conftest import SMALL
from hypothesis import given, settings
from hypothesis import strategies as st

from servery.llm import pii
from servery.llm.queries import QUERIES

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def brute(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    found = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    found += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 14 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(digits(m[0])) <= 15]
    return sorted(found)


PIECES = ["a@b.c", "x.y%+@d-e.f.g", "@", ".", "1.2.3.4", "256.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112",
          "+1 (017) 555-7713", "+", "7", " ", "-", "é", "_", "(", "00012.0.0.1"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=14).map("".join))
def test_plain_detectors_match_the_patterns(text):
    assert pii.identifiers(text) == brute(text)


def test_query_matches_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = QUERIES["op10_deobfuscated_pii"](spark, SMALL).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        found = brute(texts[r.doc_id])
        joined = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in found)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(f[1] == i for f in found) for i in range(4)]
        assert set(joined.split(",")) <= set(r.spans.split(","))
    assert sum(r.n_email + r.n_phone for r in rows) > 10


@pytest.mark.parametrize(
    "text, kind, span",
    [
        ("mail jo [at] ex (dot) org now", "email", "jo [at] ex (dot) org"),
        ("mail jo at example dot com now", "email", "jo at example dot com"),
        ("mail jo at example.com now", "email", "jo at example.com"),
        ("mail j\u043e@ex\u200bample.com", "email", "j\u043e@ex\u200bample.com"),
        ("call +1 five five five 123 4567 now", "phone", "+1 five five five 123 4567"),
        ("\uff14\uff11\uff11\uff11 1111 1111 1111", "card", "\uff14\uff11\uff11\uff11 1111 1111 1111"),
        ("host 10 (dot) 0 (dot) 0 (dot) 1 up", "ip", "10 (dot) 0 (dot) 0 (dot) 1"),
        ("jo (at) ex dot com", "email", "jo (at) ex dot com"),
    ],
)
def test_disguises_map_back_to_source_characters(text, kind, span):
    ((start, k, end),) = pii.disguised(text, pii.identifiers(text))
    assert (pii.KINDS[k], text[start:end]) == (kind, span)


@pytest.mark.parametrize("text", ["he was at that. Then", "at dot", "one two", "(at)", "plain a@b.com", "look at me dot"])
def test_plain_prose_gains_nothing(text):
    assert pii.disguised(text, pii.identifiers(text)) == []


def test_nulls_empty_long_and_repeated_rows(spark):
    long = "x" * 200_000 + " " + "1" * 100_000 + " a@b.co " + "word " * 50_000
    rows = [(1, None, "q"), (2, "", "q"), (None, "a@b.co", "q"), (3, long, None), (3, long, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    out = pii.pii_digest(docs).collect()
    assert sorted(r.n_email for r in out) == [0, 0, 1, 1, 1]
    empty = hashlib.sha256(b"").hexdigest()
    assert [(r.base_sha256, r.spans) for r in out if r.doc_id in (1, 2)] == [(empty, "")] * 2
    assert pii.pii_digest(docs.limit(0)).collect() == []
    texts = {r.doc_id: r.text for r in pii.redacted(docs).collect()}
    assert texts[1] is None and texts[None] == "[email]" and "[email]" in texts[3]


def test_offsets_survive_random_disguises():
    rng = random.Random(3)
    for _ in range(200):
        text = "".join(rng.choice(["a", " ", "\u0430", "\u200b", "[at]", " dot ", "one two ", "\uff11"]) for _ in range(12))
        out = pii.readable(text)
        if out is not None:
            assert len(out.text) == len(out.starts) == len(out.ends)
            assert all(0 <= s < e <= len(text) for s, e in zip(out.starts, out.ends))
            assert list(out.starts) == sorted(out.starts)


def test_many_identifiers_and_one_disguise_take_linear_time():
    text = " ".join(f"a{i}@mail.example.org" for i in range(20_000)) + " jane [at] site [dot] org"
    known = pii.identifiers(text)
    begin = time.process_time()
    added = pii.disguised(text, known)
    assert len(known) == 20_000 and len(added) == 1
    assert time.process_time() - begin < 10


def test_columns_called_like_the_spans_are_replaced(spark):
    docs = spark.createDataFrame([(1, "a@b.org", 1, 2)], "doc_id long, text string, base int, added int")
    (row,) = pii.found_in(docs).collect()
    assert [tuple(s) for s in row.base] == [("email", 0, 7)] and row.added == []
