from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from conftest import SMALL
from oracle_check import compare, connect

from servery.llm import fim
from servery.llm.queries import ORACLE, QUERIES

TOKEN = re.compile(r"[A-Za-z]+|[^A-Za-z]")


def brute(doc_id, text):
    text = text or ""
    tokens = TOKEN.findall(text)
    n = len(tokens)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    c, d = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (tokens[:c], tokens[c:d], tokens[d:]))
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_query_matches_sql(spark):
    name = "op13_rank_index_fim"
    assert compare(QUERIES[name](spark, SMALL), connect(SMALL), ORACLE[name]) > 0


@pytest.mark.parametrize("epsilon", [0, 1, 32, 100])
def test_index_is_exact_and_its_segments_keep_the_bound(epsilon):
    rng = np.random.default_rng(epsilon)
    steps = [rng.integers(1, 9, 5000), np.ones(3000, np.int64), rng.integers(1, 5000, 300), np.array([1, 10**6, 1, 1, 10**6])]
    for step in [*steps, np.concatenate(steps), np.zeros(0, np.int64)]:
        offsets = np.concatenate([[0], step.cumsum()])
        index = fim.RankIndex(offsets, epsilon)
        ranks = np.arange(len(offsets))
        assert (index.offsets(ranks) == offsets).all()
        assert (abs(offsets - index.predicted(ranks)) <= epsilon + 0.5).all()
    assert len(fim.RankIndex(np.arange(100_000)).first) == 1
    words = np.concatenate([[0], rng.integers(1, 6, 20_000).cumsum()])
    assert len(fim.RankIndex(words).first) < 400


TEXTS = ["one two, three", "", None, "é", "ab" * 50_000, "x y " * 100_000, "a<P>b", "<S>", "<M", "<", "a < P > b", "\n\n \t", "漢字kana😀!!",
         "<P<S", "0123456789", "same text", "same text", "\x00a\x00", "ﬁne É É​."]


def test_rows_match_brute_force(spark):
    rng = random.Random(3)
    texts = TEXTS + ["".join(rng.choice("abcXYZ é<>PSM.\n1😀") for _ in range(rng.randrange(200))) for _ in range(300)]
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)] + [(None, "no id at all", "x", 1), (15, "same text", "x", 1)]
    # Extra columns take the names of results and of what is computed on the way.
    docs = spark.createDataFrame(rows, "doc_id long, text string, form string, cut int")
    out = fim.rearranged(docs).collect()
    got = sorted((str(r.doc_id), r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in out)
    assert got == sorted((str(r[0]), *brute(r[0], r[1])) for r in rows)
    assert {r.form for r in out} == {"plain", "psm", "spm"}
    sums = fim.fim_digest(docs).select("doc_id", "restored_sha256").collect()
    want = sorted((str(r[0]), hashlib.sha256((r[1] or "").encode()).hexdigest()) for r in rows)
    assert sorted((str(r.doc_id), r.restored_sha256) for r in sums) == want


def test_empty_table(spark):
    assert fim.fim_digest(spark.createDataFrame([], "doc_id long, text string")).collect() == []
