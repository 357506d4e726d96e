"""Chat transcripts: who says what, by a hidden Markov model, and canonical turns.

The states are the roles. A line shows its speaker marker, if it has one, whether it asks, and
how long it is; a role rarely changes inside a paragraph and mostly does between two. The
probabilities are counted over all conversations that name their roles, on top of prior counts
that say what markers mean. Roles are recovered by Viterbi; markers then give way to one header
for each change of role.

A conversation may be of any length: it is decoded in chunks. Each chunk is first summed up as the
best score between every state before it and every state at its end; these small tables are put
together along the conversation, which fixes the states at the seams, and then the chunks are
decoded between them. The result is that of one pass over the whole.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import groupby

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROLES = ("system", "user", "assistant")
START = len(ROLES)
#: Turn numbers in a chunk.
CHUNK_TURNS = 256
# Words that name a speaker.
_SPEAKERS = {
    "system": 0, "instruction": 0, "instructions": 0,
    "user": 1, "human": 1, "customer": 1, "question": 1, "q": 1, "me": 1,
    "assistant": 2, "ai": 2, "bot": 2, "agent": 2, "model": 2, "answer": 2, "a": 2,
}
_MARKER = re.compile(
    r"^\s*(?:\*\*|\[|<\|?|#+\s*)?(" + "|".join(sorted(_SPEAKERS, key=len, reverse=True)) + r")(?:\*\*|\]|\|?>)?\s*(?::|(?<=[\]>])|(?<=\|>))\s*",
    re.I,
)
Features = tuple[int, int, int]


def marker(line: str) -> tuple[int, int]:
    """The role a line names as its speaker (``START``: none), and where its text begins."""
    found = _MARKER.match(line)
    return (_SPEAKERS[found[1].lower()], found.end()) if found else (START, 0)


def features(line: str) -> Features:
    size = len(line)
    return marker(line)[0], int(line.rstrip().endswith("?")), 0 if size < 40 else 1 if size < 160 else 2 if size < 640 else 3


class Model:
    """Log probabilities from counts: ``("emit", state, feature, value)`` and
    ``("move", whether the line opens, state before, state)``."""

    VALUES = (4, 2, 4)

    def __init__(self, counts: dict[tuple, float]) -> None:
        prior: Counter = Counter()
        for state in range(START):
            for value in range(START):  # a marker says who speaks; most lines have none
                prior["emit", state, 0, value] = 20 if value == state else 0.05
            prior["emit", state, 0, START] = 60
            for feature in (1, 2):
                for value in range(self.VALUES[feature]):
                    prior["emit", state, feature, value] = 1
            for before in range(START + 1):
                prior["move", 0, before, state] = 200 if before == state else 1
                prior["move", 1, before, state] = 2 if before == state else 6
        both = prior + Counter(counts)

        def logs(keys: list[tuple]) -> list[float]:
            total = sum(both[k] for k in keys)
            return [math.log(both[k] / total) for k in keys]

        self.emit = [
            [logs([("emit", s, f, v) for v in range(n)]) for f, n in enumerate(self.VALUES)] for s in range(START)
        ]
        self.move = [[logs([("move", p, b, s) for s in range(START)]) for b in range(START + 1)] for p in (0, 1)]

    def emission(self, seen: Features) -> list[float]:
        return [sum(self.emit[s][f][v] for f, v in enumerate(seen)) for s in range(START)]

    def summary(self, lines: list[tuple[int, Features]]) -> list[list[float]]:
        """The best score from each state before the lines to each state at their end."""
        return [self._forward(lines, before)[0] for before in range(START + 1)]

    def _forward(self, lines, before: int) -> tuple[list[float], list[list[int]]]:
        scores, came = None, []
        for opens, seen in lines:
            move, emit = self.move[opens], self.emission(seen)
            if scores is None:
                scores = [move[before][s] + emit[s] for s in range(START)]
                came.append([before] * START)
                continue
            best = [max(range(START), key=lambda b: scores[b] + move[b][s]) for s in range(START)]
            scores = [scores[best[s]] + move[best[s]][s] + emit[s] for s in range(START)]
            came.append(best)
        return scores, came

    def decode(self, lines: list[tuple[int, Features]], before: int, last: int | None = None) -> list[int]:
        """The best states of lines, from a state before them to a state at their end."""
        if not lines:
            return []
        scores, came = self._forward(lines, before)
        state = last if last is not None else max(range(START), key=lambda s: scores[s])
        path = [state]
        for best in reversed(came[1:]):
            path.append(best[path[-1]])
        return path[::-1]


def _lines(text: str | None) -> list[str]:
    return (text or "").split("\n")


def _chunk_lines(rows: list[tuple]) -> list[tuple[int, Features]]:
    return [(opens(i, seen := features(line)), seen) for row in rows for i, line in enumerate(_lines(row[-1]))]


def opens(place: int, seen: Features) -> int:
    """Whether a line may well be another speaker's: the first of a paragraph, or one that names
    a speaker."""
    return int(place == 0 or seen[0] != START)


def chunked(conversations: DataFrame) -> DataFrame:
    """``_key``, ``_chunk``, conv_id, turn, role, text. A conversation's chunks are ranges of
    turn numbers; rows without a turn come last. A row without a conversation is one of its own,
    so that such rows never meet in one task."""
    own = F.concat(F.lit("-"), F.xxhash64("turn", "text").cast("string"))
    chunk = F.floor(F.col("turn") / CHUNK_TURNS).cast("long")
    return conversations.select(
        F.coalesce(F.concat(F.lit("+"), F.col("conv_id").cast("string")), own).alias("_key"),
        F.coalesce(chunk, F.lit(2**62)).alias("_chunk"),
        "conv_id",
        "turn",
        "role",
        "text",
    )


def _by_chunk(rows: DataFrame, make: Callable[[list[tuple]], list[tuple]], schema: str) -> DataFrame:
    """``make`` of the rows of each chunk, in the order of turn and text."""
    names = [c for c in rows.columns if c not in ("_key", "_chunk")]
    order = [F.col("turn").asc_nulls_last(), F.col("text").asc_nulls_first()]
    dealt = rows.repartition("_key", "_chunk").sortWithinPartitions("_key", "_chunk", *order)
    out = [field.split()[0] for field in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        each = (row for b in batches for row in b[["_key", "_chunk", *names]].astype(object).itertuples(index=False, name=None))
        made: list[tuple] = []
        for _, group in groupby(each, key=lambda row: row[:2]):
            made += make(list(group))
            if len(made) > 5000:
                yield pd.DataFrame(made, columns=out)
                made = []
        yield pd.DataFrame(made, columns=out)

    return dealt.mapInPandas(run, schema)


def fitted(rows: DataFrame, held_out: int | None = None) -> Model:
    """The model of all rows whose role is one of ``ROLES``. Moves are counted inside chunks.
    ``held_out``: leave out keys whose hash modulo 4 is this."""
    known = rows.where(F.col("role").isin(*ROLES))
    if held_out is not None:
        known = known.where(F.pmod(F.xxhash64("_key"), F.lit(4)) != held_out)

    def count(group: list[tuple]) -> list[tuple]:
        counts: Counter = Counter()
        before = START if group[0][1] <= 0 else None
        for row in group:
            state = ROLES.index(row[4])
            for i, line in enumerate(_lines(row[-1])):
                seen = features(line)
                if before is not None:
                    counts["move", opens(i, seen), before, state] += 1
                for f, v in enumerate(seen):
                    counts["emit", state, f, v] += 1
                before = state
        return [(*k, n) for k, n in counts.items()]

    each = _by_chunk(known, count, "kind string, a int, b int, c int, n long")
    rows = each.groupBy("kind", "a", "b", "c").agg(F.sum("n").alias("n")).collect()  # some 50 rows
    return Model({tuple(r)[:4]: float(r["n"]) for r in rows})


def seams(rows: DataFrame, model: Model) -> DataFrame:
    """``_key``, ``_chunk``, ``before``, ``last``: the states around each chunk."""
    width = START * (START + 1)

    def sum_up(group: list[tuple]) -> list[tuple]:
        return [(*group[0][:2], *[x for line in model.summary(_chunk_lines(group)) for x in line])]

    scores = _by_chunk(rows, sum_up, "_key string, _chunk long, " + ", ".join(f"s{i} double" for i in range(width)))

    def join(chunks: list[tuple]) -> list[tuple]:
        """From the first chunk on the best scores, then the states from the last chunk back."""
        best, came = None, []
        for chunk in chunks:
            table = [chunk[2 + START * b : 2 + START * (b + 1)] for b in range(START + 1)]
            if best is None:
                best = list(table[START])
                came.append([START] * START)
            else:
                froms = [max(range(START), key=lambda b: best[b] + table[b][s]) for s in range(START)]
                best = [best[froms[s]] + table[froms[s]][s] for s in range(START)]
                came.append(froms)
        last, out = max(range(START), key=lambda s: best[s]), []
        for chunk, froms in zip(reversed(chunks), reversed(came)):
            out.append((*chunk[:2], froms[last], last))
            last = froms[last]
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        each = (row for b in batches for row in b.itertuples(index=False, name=None))
        made: list[tuple] = []
        for _, chunks in groupby(each, key=lambda row: row[0]):
            made += join(list(chunks))
            if len(made) > 5000:
                yield pd.DataFrame(made, columns=["_key", "_chunk", "before", "last"])
                made = []
        yield pd.DataFrame(made, columns=["_key", "_chunk", "before", "last"])

    dealt = scores.repartition("_key").sortWithinPartitions("_key", "_chunk")
    return dealt.mapInPandas(run, "_key string, _chunk long, before int, last int")


def rendered(conversations: DataFrame, model: Model | None = None) -> DataFrame:
    """The canonical turns: conv_id, turn, ``part``, the recovered ``role``, ``n_lines``,
    ``opens`` and ``rendered``. Put together in order, ``rendered`` is the transcript: a header
    where the role changes, then the lines without their markers.

    A row has a part for each role that its lines change to; NULL and empty texts are one empty
    line. Rows that are alike stay as many. The role column serves to fit the model only.
    """
    rows = chunked(conversations)
    model = model or fitted(rows)
    states = seams(rows, model)

    def render(group: list[tuple]) -> list[tuple]:
        before, last = int(group[0][-2]), int(group[0][-1])
        path = model.decode(_chunk_lines([row[:-2] for row in group]), before, last)
        out, at = [], 0
        for row in group:
            conv_id, turn, text = row[2], row[3], row[5]
            found = _lines(text)
            states = path[at : at + len(found)]
            at += len(found)
            for part, (state, some) in enumerate(groupby(zip(states, found), key=lambda x: x[0])):
                plain = [line[marker(line)[1] :] if marker(line)[0] == state else line for _, line in some]
                changes = state != before
                header = f"<|{ROLES[state]}|>\n" if changes else ""
                out.append((conv_id, turn, part, ROLES[state], len(plain), changes, header + "\n".join(plain) + "\n"))
                before = state
        return out

    kinds = {c: conversations.schema[c].dataType.simpleString() for c in ("conv_id", "turn")}
    joined = rows.drop("role").withColumn("role", F.lit(None).cast("string")).select(*rows.columns).join(states, ["_key", "_chunk"])
    return _by_chunk(
        joined,
        render,
        f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, part int, role string, n_lines long, opens boolean, rendered string",
    )
