from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from servery.llm import packing
from servery.llm.queries import QUERIES

PATH = packing.default_tokenizer()
WHOLE = Tokenizer.from_file(PATH)
IDS = packing.Ids(open(PATH, encoding="utf-8").read(), "<u4")


def expected(text):
    return np.array([*WHOLE.encode(text or "", add_special_tokens=False).ids, 1], "<u4")


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=30) | st.lists(st.sampled_from(["'s", "<|endoftext|>", " ", "́", "e", " ", "\x85", "\x1c", "\n", "A1", "İ", "Σ", ".", ",", "THE", "é", "\u00a0", "\u2003", "\x1f", "<|ENDOFTEXT|>", "ﬁ", "K"]), max_size=9).map("".join))
def test_ids_of_pieces_are_those_of_the_text(text):
    assert IDS.of([text, None, text]) == [expected(text).tobytes(), expected("").tobytes(), expected(text).tobytes()]


def check(rows, texts):
    """Every id in one piece, windows without gaps, digests of the right ids."""
    of_doc, of_window = defaultdict(list), defaultdict(list)
    for r in rows:
        of_doc[r.doc_id].append(r)
        of_window[r.sequence_id].append((r.offset, r.length))
        ids = expected(texts[r.doc_id])
        assert r.doc_tokens == len(ids)
        assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
    for doc_id, text in texts.items():
        pieces = sorted((r.start, r.length) for r in of_doc[doc_id])
        assert [s for s, _ in pieces] == [sum(n for _, n in pieces[:i]) for i in range(len(pieces))]
        assert sum(n for _, n in pieces) == len(expected(text))
    for pieces in of_window.values():
        pieces.sort()
        assert [o for o, _ in pieces] == [sum(n for _, n in pieces[:i]) for i in range(len(pieces))]
        assert sum(n for _, n in pieces) <= packing.WINDOW
    return of_window


def test_query_round_trip(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    of_window = check(QUERIES["op6_retrieval_packing"](spark, SMALL).collect(), texts)
    full = sum(n for pieces in of_window.values() for _, n in pieces)
    assert full > 0.98 * packing.WINDOW * len(of_window)


def test_neighbours_share_words(spark):
    topic = lambda k: " ".join(f"{k}{w}" for w in ("alpha", "beta", "gamma", "delta") * 20)
    rows = [(i, topic(["fish", "rock", "bird"][i % 3])) for i in range(60)]
    pieces = packing.packed(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    topics = defaultdict(Counter)
    for r in pieces:
        topics[r.sequence_id][r.doc_id % 3] += 1
    first = topics[min(topics)]
    assert max(first.values()) >= 0.8 * sum(first.values())


def test_scores_match_brute_force():
    rng = np.random.default_rng(2)
    documents = [rng.integers(0, 30, rng.integers(1, 40)) for _ in range(25)]
    inverse = np.maximum(0, rng.normal(1, 1, 30))
    index = packing.Index(documents, inverse, 20.0)
    for seed in range(25):
        for d, ids in enumerate(documents):
            score = 0.0
            for t in set(documents[seed].tolist()):
                tf = (ids == t).sum()
                score += inverse[t] * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(ids) / 20.0)) if tf else 0
            assert np.isclose(index.scores(seed)[d], score)


@pytest.mark.parametrize("lengths", [[1], [2048], [2049, 1], [5000, 3, 3000, 1], [700] * 9, [1] * 5000])
def test_windows_hold_every_id_once(lengths):
    seen, fill = Counter(), Counter()
    for d, start, length, number, offset in packing.windows(lengths, lambda s: np.zeros(len(lengths))):
        assert length > 0 and start == seen[d] and offset == fill[number]
        seen[d] += length
        fill[number] += length
    assert [seen[d] for d in range(len(lengths))] == lengths
    assert len(fill) == -(-sum(lengths) // 2048) and max(fill.values()) <= 2048


def test_nulls_empty_long_and_repeated_rows(spark):
    rows = [(1, None, 5), (2, "", 5), (3, "word é " * 20_000, 5), (4, " \n", None), (None, "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int")
    check(packing.packing_digest(docs).collect(), {r[0]: r[1] for r in rows})
    twice = packing.packing_digest(docs.where("doc_id = 2").unionByName(docs.where("doc_id = 2"))).collect()
    assert [(r.doc_tokens, r.length) for r in twice] == [(1, 1), (1, 1)]
    assert packing.packing_digest(docs.limit(0)).collect() == []


def test_a_worker_learns_a_word_once(monkeypatch):
    definition = open(PATH, encoding="utf-8").read()
    learned = Counter()
    learn = packing.Ids._learned
    monkeypatch.setattr(packing.Ids, "_learned", lambda self, word: learned.update([word]) or learn(self, word))
    packing._ids.cache_clear()
    texts = ["Fish, rock\xa0bird fish.", "rock,\nfish\x85bird\x0b(fish)", "naïve Fish\x1cRock"]
    for _ in range(2):  # two tasks of one worker
        assert packing._ids(definition, "<u4").of(texts) == [expected(text).tobytes() for text in texts]
    assert {"fish", "rock", "bird", "fish,", "rock,"} <= set(learned) and max(learned.values()) == 1


def test_only_words_of_other_letters_are_encoded_by_all_steps(monkeypatch):
    definition = open(PATH, encoding="utf-8").read()
    ids = packing.Ids(definition, "<u4")
    encoded = []
    encode = packing.Ids._encoded
    monkeypatch.setattr(packing.Ids, "_encoded", lambda self, words: encoded.extend(words) or encode(self, words))
    text = "Fish rock “bird” don't Tree. <|ENDOFTEXT|> žába 12"
    assert ids.of([text]) == [expected(text).tobytes()]
    assert sorted(encoded) == sorted(["“bird”", "don't", ".", "<|ENDOFTEXT|>", "žába", "12"])


def test_words_are_forgotten_when_they_are_many(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 3)
    ids = packing.Ids(open(PATH, encoding="utf-8").read(), "<u4")
    texts = ["one two, three four. five's žába два", "два one's two (three) four", "один два три четыре five"]
    assert ids.of(texts) == [expected(text).tobytes() for text in texts]
    assert len(ids.known) <= 7
