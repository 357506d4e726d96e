from __future__ import annotations

import itertools
import random

import pytest
from conftest import SMALL

from servery.llm import chat
from servery.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, part string"


def test_viterbi_is_the_best_path():
    rng = random.Random(1)
    model = chat.Model({("move", 1, 1, 2): 50.0, ("emit", 1, 1, 1): 30.0})
    for _ in range(30):
        lines = [(rng.randint(0, 1), (rng.choice([0, 1, 2, 3, 3]), rng.randint(0, 1), rng.randint(0, 3))) for _ in range(5)]

        def score(path):
            before, total = chat.START, 0.0
            for state, (opens, seen) in zip(path, lines):
                total += model.move[opens][before][state] + model.emission(seen)[state]
                before = state
            return total

        best = max(itertools.product(range(3), repeat=5), key=score)
        assert score(model.decode(lines, chat.START)) == pytest.approx(score(best))


def test_chunks_do_not_change_the_result(spark, monkeypatch):
    rng = random.Random(2)
    texts = ["User: hi?", "fine.", "Assistant: " + "word " * 30, "x\nQ: why?\nbecause", "", None, "[system] be kind"]
    rows = [(c, t, rng.choice(chat.ROLES), rng.choice(texts), "p") for c in range(4) for t in range(40)]
    frame = spark.createDataFrame(rows, SCHEMA)
    counts = {("emit", s, f, v): rng.random() * 9 for s in range(3) for f, n in enumerate(chat.Model.VALUES) for v in range(n)}
    counts |= {("move", o, b, s): rng.random() * 9 for o in (0, 1) for b in range(4) for s in range(3)}
    model = chat.Model(counts)  # without ties
    whole = sorted(map(tuple, chat.rendered(frame, model).collect()))
    monkeypatch.setattr(chat, "CHUNK_TURNS", 3)
    assert sorted(map(tuple, chat.rendered(frame, model).collect())) == whole
    assert len({r[:2] for r in whole}) == 160


def test_query_keeps_every_line_and_recovers_roles(spark):
    given = {(r.conv_id, r.turn): r for r in spark.read.parquet(f"{SMALL}/conversations.parquet").collect()}
    rows = QUERIES["op1_hmm_transcripts"](spark, SMALL).collect()
    assert {(r.conv_id, r.turn) for r in rows} == set(given)
    assert sum(r.n_lines for r in rows) == sum(r.text.count("\n") + 1 for r in given.values())
    right = sum(given[r.conv_id, r.turn].role == r.role for r in rows)
    assert right / len(rows) > 0.9


def test_held_out_roles_are_recovered(spark):
    rows = chat.chunked(spark.read.parquet(f"{SMALL}/conversations.parquet"))
    model = chat.fitted(rows, held_out=2)
    out = rows.where("pmod(xxhash64(_key), 4) = 2").select("conv_id", "turn", "role", "text")
    roles = {(r.conv_id, r.turn): r.role for r in out.collect()}
    found = chat.rendered(out, model).collect()
    assert sum(roles[r.conv_id, r.turn] == r.role for r in found) > 0.9 * len(found)


def test_markers_split_rows_and_make_way_for_headers(spark):
    text = "User: how are you?\n**Assistant**: well\nthank you\nHuman: good"
    frame = spark.createDataFrame([(1, 0, None, text, "p")], SCHEMA)
    rows = sorted(chat.rendered(frame).collect(), key=lambda r: r.part)
    assert [r.role for r in rows] == ["user", "assistant", "user"]
    joined = "".join(r.rendered for r in rows)
    assert joined == "<|user|>\nhow are you?\n<|assistant|>\nwell\nthank you\n<|user|>\ngood\n"


def test_nulls_empty_long_and_repeated_rows(spark):
    rows = [(None, None, None, None, None), (1, None, "user", "a", "p"), (1, 0, "robot", "", None), (None, 3, "user", "b", "p")]
    rows += [(2, 1, "user", "word " * 60_000, "p")] * 2 + [(3, t, "user", "hi", "p") for t in range(1000)] + [(4, -5, "user", "x", "p")]
    out = chat.rendered(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(out) == len(rows)
    assert chat.rendered(spark.createDataFrame([], SCHEMA)).collect() == []
