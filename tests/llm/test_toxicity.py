from __future__ import annotations

import random
import zlib

import numpy as np
from conftest import SMALL

from servery.llm import toxicity
from servery.llm.queries import QUERIES

BAD = ["idiot", "moron", "scumbag", "worthless", "pathetic"]


def corpus(n: int, seed: int = 1):
    rng = random.Random(seed)
    plain = ["".join(rng.choice(["an", "or", "the", "ti", "on", "re"]) for _ in range(3)) for _ in range(60)]
    rows = []
    for i in range(n):
        found, toxic = rng.choices(plain, k=rng.randint(5, 120)), int(i % 5 == 0)
        if toxic:
            found[rng.randrange(len(found))] = rng.choice(BAD)
        rows.append((i, " ".join(found), toxic))
    return rows


def test_query_covers_every_document_and_hides_a_quarter(spark):
    rows = QUERIES["op8_subword_toxicity"](spark, SMALL).collect()
    ids = [r.doc_id for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id").collect()]
    assert sorted(r.doc_id for r in rows) == sorted(ids)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)


def test_held_out_accuracy_and_unseen_misspellings(spark):
    rows = corpus(1500)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], 0, r[2]) for r in rows], "doc_id long, quality int, toxic int")
    toxic = {r[0]: r[2] for r in rows}
    out = [r for r in toxicity.toxicity_scores(docs, labels).collect() if r.held_out]
    assert len(out) > 300
    assert np.mean([r.predicted == toxic[r.doc_id] for r in out]) > 0.97
    model = toxicity.fit_on(docs, labels)
    seen, unseen, clean = toxicity.scores(["theantire idiot", "theantire idiott", rows[1][1]], model, {})
    assert seen > 0.5 and unseen > 0.5 and clean < 0.3


def test_labels_of_held_out_rows_and_contradictions_are_not_learnt(spark):
    docs = spark.createDataFrame([(i, "a b", i) for i in range(40)], "doc_id long, text string, toxic int")
    labels = spark.createDataFrame([*[(i, i % 2) for i in range(40)], (1, 0), (3, None)], "doc_id long, toxic int")
    ids = {r.doc_id for r in toxicity.training_sample(docs, labels).collect()}
    assert ids and 1 not in ids and all(zlib.crc32(str(i).encode()) % 4 != 2 for i in ids)
    assert toxicity.training_sample(docs, labels, 5).count() == 5


def test_nulls_empty_texts_repeated_rows_and_clashing_names(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, " \n", "x"), (None, "a idiot", None), (4, "!!", "x"), (4, "!!", "x")]
    docs = spark.createDataFrame([*rows, (5, "w" * 30000 + " " + "word " * 30000, "x")], "doc_id long, text string, predicted string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = toxicity.toxicity_scores(docs, labels).collect()
    assert len(out) == 7 and {r.score for r in out} == {0.5}
    assert toxicity.toxicity_scores(docs.limit(0), labels).collect() == []


def test_slices_do_not_change_scores():
    rows = corpus(200)
    model = toxicity.fit([r[1] for r in rows], [r[2] for r in rows], steps=20)
    texts = [r[1] for r in rows]
    whole, known = toxicity.scores(texts, model, {}), {}
    parts = np.concatenate([toxicity.scores(run, model, known) for run in toxicity._slices(texts, 500)])
    assert np.allclose(whole, parts)
