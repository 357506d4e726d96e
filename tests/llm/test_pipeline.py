from __future__ import annotations

import corpus_pipeline
import test_contamination
import test_lines
import test_simhash
from conftest import SMALL

from servery.llm import toxicity
from servery.llm.common import stored, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_each_stage_does_its_own_work(spark):
    docs = table(spark, SMALL, "documents")
    kept = {"": {r.doc_id: r.text for r in docs.collect()}}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SMALL), "stage")
        assert docs.columns == COLUMNS
        rows = docs.collect()
        kept[name] = {r.doc_id: r.text for r in rows}
        assert len(rows) == len(kept[name])
    start, toxic, line, near, last = kept.values()

    model = toxicity.fit_on(table(spark, SMALL, "documents"), table(spark, SMALL, "labels"))
    ids = sorted(start)
    scores = dict(zip(ids, toxicity.scores([start[d] for d in ids], model, {})))
    assert toxic == {d: t for d, t in start.items() if scores[d] < corpus_pipeline.TOXIC}

    left = test_lines.brute(toxic)
    assert line == {d: t for d, (t, _, deleted) in left.items() if not deleted or t.strip(test_lines.SPACE)}

    groups = test_simhash.brute_components({d: test_simhash.brute_fingerprint(t) for d, t in line.items()})
    assert near == {d: t for d, t in line.items() if groups[d] == d}

    items = [(r.item_id, r.text) for r in table(spark, SMALL, "benchmark").collect()]
    dirty = {r[0] for r in test_contamination.brute(list(near.items()), items) if r[-1]}
    assert dirty and last == {d: t for d, t in near.items() if d not in dirty}

    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    assert {r.doc_id for r in pieces} == set(last)


CLASHING = ["_id", "_text", "_n", "_hash", "_bytes", "_score", "score", "n_deleted", "fp", "row", "rest", "base"]


def test_nulls_copies_empty_tables_and_clashing_names(spark, tmp_path):
    own = [f"own {c}" for c in CLASHING]
    words = " ".join(f"w{i}" for i in range(400))
    texts = [(1, words), (2, words), (2, words), (3, None), (4, ""), (None, words), (None, None), (5, "long text. " * 30_000)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)
    rows = [(d, t, None, None, None, *own) for d, t in texts]
    plain = [(100 + i, " ".join(f"{w}{i}" for w in ("kind", "mild", "calm", "fair"))) for i in range(60)]
    rows += [(d, t, None, None, None, *own) for d, t in plain]
    spark.createDataFrame([(d, 0) for d, _ in plain], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([("i", "some item of the benchmark")], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for some in (rows, []):
        docs = spark.createDataFrame(some, schema)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stored(stage(spark, docs, str(tmp_path)), "stage")
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", *CLASHING], name
        kept = docs.collect()
        assert all(list(r)[5:] == own for r in kept)
        # Texts without a word are near-duplicates of each other; rows without an id stay.
        assert sorted((r.doc_id for r in kept if (r.doc_id or 0) < 100), key=str) == ([1, 3, 5, None, None] if some else [])
        pieces = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
        assert len({r.doc_id for r in pieces}) == (64 if some else 0)


def test_run_on_the_whole_table(spark):
    rows = corpus_pipeline.run(spark, SMALL).collect()
    assert len({(r.doc_id, r.start) for r in rows}) == len(rows) > 500
