from __future__ import annotations

import re

import pytest
from conftest import SMALL
from oracle_check import compare, connect

from servery.llm import hosts
from servery.llm.queries import ORACLE, QUERIES

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    text = text or ""
    found = WORD.findall(text)
    grams = [tuple(found[i : i + 3]) for i in range(len(found) - 2)]
    places = {}
    for i, g in enumerate(grams):
        places.setdefault(g, []).append(i)
    covered = {i + k for p in places.values() if len(p) > 1 for i in p for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(found),
        sum(map(len, found)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_query_matches_sql(spark):
    name = "op3_host_rules"
    assert compare(QUERIES[name](spark, SMALL), connect(SMALL), ORACLE[name]) > 0


TEXTS = ["a b c a b c", "a a a a a", "x\n\nx \nx\n", " # é$ ü\t\x0bz", "a b", "   ", "a b c d e a b c x b c d", "", None,
         "one two " * 30_000, "w" * 100_000]


def test_counts_match_brute_force(spark):
    docs = spark.createDataFrame([(i, t, 7) for i, t in enumerate(TEXTS)], "doc_id long, text string, n_words int")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    rows = hosts.measured(docs).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        assert tuple(r[n] for n in names) == brute(TEXTS[r.doc_id]), r.doc_id


def test_bad_hosts_lose_their_documents_and_small_ones_get_the_benefit(spark):
    good = " ".join(f"word{i}" for i in range(60))
    rows = [(i, good, "fine") for i in range(200)] + [(500 + i, good if i % 10 == 0 else "short", "bad") for i in range(200)]
    rows += [(800 + h * 10 + i, good, f"h{h}") for h in range(10) for i in range(5)]
    rows += [(990, "short", "tiny"), (991, good, "tiny"), (None, None, None), (1, good, "fine")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = hosts.host_rule_digest(docs).collect()
    assert len(out) == len(rows)
    kept = {r.doc_id: r.kept for r in out}
    assert kept[1] and not kept[500] and kept[991] and not kept[990] and kept[800] and not kept[None]


@pytest.mark.parametrize("rows", [[], [(1, None, None)]])
def test_empty_tables(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert len(hosts.host_rule_digest(docs).collect()) == len(rows)
