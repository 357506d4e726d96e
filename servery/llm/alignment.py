"""Alignment of two tokenizers by pointer jumping.

Both tokenizers cover the same bytes, so their tokens overlap. Every token points to the token,
of either side, that reaches farthest to the right of those it overlaps. Following the pointers
leads to the last token of a component, and doubling them (each pointer becomes its target's) gets
there in as many rounds as the longest chain has binary digits; the tokens that end up alike are
a group. All texts of a slice are worked on at once.

Texts are tokenized once, and their ids stored. Every two tokens that overlap are a link; how
often the two ids of a link are linked is counted over the corpus, in each task first. The most
frequent pairs, ``HEAD`` at most, are sent to all tasks; links of the others are joined to their
counts by a shuffle, counted by row and pair before.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from servery.llm.common import stored

#: Pairs of ids whose counts every task gets; 16 bytes each.
HEAD = 1 << 19
#: Pairs a task holds before it puts equal ones together.
HELD = 4 << 20
#: Characters, and bytes of ids, that are worked on at a time.
SLICE = 1 << 19
#: How a piece spells a space.
SPACE = "▁"
#: How a byte-level tokenizer parts texts of which no step changes a character.
PLAIN_BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
PLAIN_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Any character that is neither printable Latin nor a tab or line end.
_UNUSUAL = re.compile("[^\t\n\r -~\xa1-\u024f]")


def default_tokenizers() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def _byte_of_character() -> dict[str, int]:
    """What each character of a byte-level vocabulary stands for: printable ones for themselves,
    the other bytes, in order, for the characters from 256."""
    printable = {b for first, last in (("!", "~"), ("¡", "¬"), ("®", "ÿ")) for b in range(ord(first), ord(last) + 1)}
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteLevel:
    """The byte-level tokenizer (a JSON definition). Special tokens in a text are plain text.

    Where the definition is the plain byte-level pattern, and its merges are in the order of their
    ids, another encoder takes the same steps faster; texts with characters that editions of Unicode
    might class otherwise are left to the definition itself.
    """

    def __init__(self, definition: bytes) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition.decode("utf-8"))
        self.tokenizer.encode_special_tokens = True
        table = _byte_of_character()
        size = self.tokenizer.get_vocab_size()
        names = list(map(self.tokenizer.id_to_token, range(size)))
        self.pieces = [bytes(table[c] for c in t) if set(t) <= table.keys() else t.encode() for t in names]
        self.plain = None
        steps = json.loads(definition)
        pairs = [tuple(m if isinstance(m, list) else m.split(" ")) for m in steps["model"].get("merges", [])]
        in_order = [a + b for a, b in pairs] == names[256 : 256 + len(pairs)] and set(names[:256]) == table.keys()
        if in_order and steps["normalizer"] is None and steps["pre_tokenizer"] == PLAIN_BYTE_LEVEL:
            import tiktoken

            ranks = {p: i for i, p in enumerate(self.pieces[: 256 + len(pairs)])}
            self.plain = tiktoken.Encoding("plain", pat_str=PLAIN_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, texts: list[str]) -> list[list[int]]:
        if self.plain is None:
            return [self._ids(t) for t in texts]
        return [self._ids(t) if _UNUSUAL.search(t) else self.plain.encode_ordinary(" " + t) for t in texts]

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(" " + text, add_special_tokens=False).ids


class Pieces:
    """The sentence-piece tokenizer (a serialized model), which puts a space in front itself."""

    def __init__(self, model: bytes) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        names = map(self.model.id_to_piece, range(self.model.get_piece_size()))
        self.pieces = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(SPACE, " ").encode("utf-8") for i, p in enumerate(names)]

    def ids(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


class Encoder:
    """The ids of texts on both sides, as little-endian bytes."""

    def __init__(self, a: bytes, b: bytes) -> None:
        self.sides = _loaded(ByteLevel, a), _loaded(Pieces, b)

    def of(self, texts: list[str | None]) -> list[tuple[bytes, ...]]:
        """Of each text, none of NULL and empty ones and of those that either side does not spell."""
        some = [t or "" for t in texts]
        fits, out = np.array([bool(t) for t in some], bool), []
        whole = [(" " + t).encode("utf-8", "surrogatepass") for t in some]
        for side in self.sides:
            ids, piece, width = side.ids(some), side.pieces.__getitem__, _width(side.pieces)
            fits &= [b"".join(map(piece, x)) == w for x, w in zip(ids, whole)]
            out.append([np.array(x, width).tobytes() for x in ids])
        return [found if ok else (b"", b"") for found, ok in zip(zip(*out), fits.tolist())]


@cache
def _loaded(kind: type, *definitions: bytes):
    """One for each definition in a process."""
    return kind(*definitions)


def _width(pieces: list[bytes]) -> str:
    return "<u2" if len(pieces) <= 1 << 16 else "<u4"


def tokenized(docs: DataFrame, a: bytes, b: bytes) -> DataFrame:
    """``row`` (a number), doc_id, and the ids ``a`` and ``b`` as little-endian bytes, stored. Texts that are NULL,
    empty, or not what the bytes of both sides make up have none."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((a, b))

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = _loaded(Encoder, *shared.value)
        for batch in batches:
            texts = batch["text"].tolist()
            for first, last in _runs(np.array([len(t or "") for t in texts])):
                rows, found = batch.iloc[first:last], encoder.of(texts[first:last])
                yield pd.DataFrame({"row": rows["row"], "doc_id": rows["doc_id"], "a": [x for x, _ in found], "b": [x for _, x in found]})

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return stored(rows.mapInPandas(encode, f"row long, doc_id {kind}, a binary, b binary"), "token-ids")


def _runs(sizes: np.ndarray, most: int = SLICE) -> Iterator[tuple[int, int]]:
    """From and up to, of runs of rows of about so much in all; one row at least."""
    ends = np.append(0, sizes.cumsum())
    at = 0
    while at < len(sizes):
        after = max(at + 1, int(np.searchsorted(ends, ends[at] + most, "right")) - 1)
        yield at, after
        at = after


class Slice:
    """The tokens of several texts, one after another: ``a`` and ``b`` their ids, ``rows_a`` and ``rows_b`` the place
    of each token's text, ``group_a`` and ``group_b`` its group, counted through, and the links: ``code`` of the two ids, and
    ``row``."""

    def __init__(self, a: list[bytes], b: list[bytes], left: list[bytes], right: list[bytes], bytes_a: np.ndarray, bytes_b: np.ndarray):
        wide_a, wide_b = _width(left), _width(right)
        self.a = np.frombuffer(b"".join(a), wide_a).astype(np.int64)
        self.b = np.frombuffer(b"".join(b), wide_b).astype(np.int64)
        self.n_a = np.array([len(x) for x in a], np.int64) // np.dtype(wide_a).itemsize
        self.n_b = np.array([len(x) for x in b], np.int64) // np.dtype(wide_b).itemsize
        ends_a, ends_b = bytes_a[self.a].cumsum(), bytes_b[self.b].cumsum()
        # The token of the other side that holds a token's last byte reaches farthest of all that overlap it.
        over_a, over_b = np.searchsorted(ends_b, ends_a), np.searchsorted(ends_a, ends_b)
        inner = ends_a[over_b] > ends_b if len(ends_b) else np.zeros(0, bool)
        terminal = terminals(over_a, np.where(inner, over_b, -1))
        # Groups are numbered by their last token on the right, at which both sides end.
        number = (~inner).cumsum() - 1
        self.group_a, self.group_b = number[terminal[: len(self.a)]], number[terminal[len(self.a) :]]
        self.rows_a, self.rows_b = (np.repeat(np.arange(len(n)), n) for n in (self.n_a, self.n_b))
        self.n_groups = np.bincount(self.rows_b[~inner], minlength=len(a))
        # Two tokens overlap in one stretch, which ends where the first of them does.
        if len(self.b):
            self.code = np.concatenate([self.a * len(right) + self.b[over_a], (self.a[over_b] * len(right) + self.b)[inner]])
        else:
            self.code = self.a
        self.row = np.concatenate([self.rows_a, self.rows_b[inner]])
        self.n_links = self.n_a + self.n_b - self.n_groups

    def by_row(self, values: np.ndarray) -> np.ndarray:
        """The sums of a value for each link, exact: links come by row twice, for either side."""
        out = np.zeros(len(self.n_a), np.int64)
        for sizes, some in ((self.n_a, values[: len(self.a)]), (self.n_b - self.n_groups, values[len(self.a) :])):
            sums, ends = np.append(0, some.cumsum()), np.append(0, sizes.cumsum())
            out += sums[ends[1:]] - sums[ends[:-1]]
        return out


def terminals(over_a: np.ndarray, over_b: np.ndarray) -> np.ndarray:
    """For all tokens of the left and then the right side, the right token their component ends
    with. ``over_a`` has the right token each left one points to, ``over_b`` the left token each right one points
    to, or -1 where both sides end."""
    n = len(over_a)
    itself = n + np.arange(len(over_b))
    pointer = np.concatenate([n + over_a, np.where(over_b >= 0, over_b, itself)])
    while True:
        farther = pointer[pointer]
        if (farther == pointer).all():
            return pointer - n
        pointer = farther


def slices(batch: pd.DataFrame, left: list[bytes], right: list[bytes]) -> Iterator[tuple[pd.DataFrame, Slice]]:
    bytes_a, bytes_b = (np.array([len(p) for p in side], np.int64) for side in (left, right))
    for first, last in _runs(batch["a"].map(len).to_numpy()):
        some = batch.iloc[first:last]
        yield some, Slice(some["a"].tolist(), some["b"].tolist(), left, right, bytes_a, bytes_b)


def _put_together(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    found, at = np.unique(np.concatenate(codes), return_inverse=True)
    return found, np.bincount(at, np.concatenate(counts)).astype(np.int64)


def pair_counts(tokens: DataFrame, left: list[bytes], right: list[bytes]) -> DataFrame:
    """``code`` (left id times the right vocabulary, plus right id), ``n`` links of the corpus, and ``best``: whether no
    pair with that right id has more. Stored."""
    width = len(right)
    shared = tokens.sparkSession.sparkContext.broadcast((left, right))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes, counts, held = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
        for batch in batches:
            for _, s in slices(batch, *shared.value):
                places, found = pd.factorize(s.code)
                codes.append(found)
                counts.append(np.bincount(places, minlength=len(found)))
                held += len(found)
                if held > HELD:
                    (found, n) = _put_together(codes, counts)
                    codes, counts, held = [found], [n], 0
                    if len(found) > HELD // 2:
                        yield pd.DataFrame({"code": found, "n": n})
                        codes, counts = [found[:0]], [n[:0]]
        found, n = _put_together(codes, counts)
        yield pd.DataFrame({"code": found, "n": n})

    pairs = tokens.select("a", "b").mapInPandas(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    pairs = stored(pairs, "pairs")
    most = pairs.groupBy((F.col("code") % width).alias("b")).agg(F.max("n").alias("most"))
    # One row for each id of the right vocabulary at most.
    joined = pairs.join(F.broadcast(most), F.col("code") % width == F.col("b"))
    return stored(joined.select("code", "n", (F.col("n") == F.col("most")).alias("best")), "pair-counts")


def frequent(pairs: DataFrame, most: int = HEAD) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Codes in order, counts and ``best`` of the pairs with a count of at least the last value,
    the smallest power of two for which there are no more than ``most`` of them."""
    sizes = pairs.groupBy(F.length(F.bin("n")).alias("bits")).count().collect()  # 64 rows at most
    least, total = 0, 0
    for row in sorted(sizes, reverse=True):
        total += row["count"]
        if total > most:
            least = 1 << row["bits"]
            break
    rows = pairs.where(F.col("n") >= least).toPandas().sort_values("code")
    return rows["code"].to_numpy(np.int64), rows["n"].to_numpy(np.int64), rows["best"].to_numpy(bool), least


def _rendered(s: Slice, names_a: np.ndarray, names_b: np.ndarray) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` of each text. A token's name has a comma after it, which gives way to
    a bar after the last one of the left side, and a semicolon after that of the right."""
    last_a, last_b = (np.append(g[1:] != g[:-1], True) if len(g) else g.astype(bool) for g in (s.group_a, s.group_b))
    groups = int(s.n_groups.sum())
    in_a, in_b = np.bincount(s.group_a, minlength=groups), np.bincount(s.group_b, minlength=groups)
    before_a, before_b = in_a.cumsum(), in_b.cumsum() - in_b
    text = np.empty(len(s.a) + len(s.b), names_a.dtype)
    text[np.arange(len(s.a)) + before_b[s.group_a]] = names_a[s.a + last_a * (len(names_a) // 2)]
    text[np.arange(len(s.b)) + before_a[s.group_b]] = names_b[s.b + last_b * (len(names_b) // 2)]
    ends = np.append(0, (s.n_a + s.n_b).cumsum()).tolist()
    return [text[i:j].tobytes().translate(None, b"\0")[:-1].decode() for i, j in zip(ends, ends[1:])]


def _names(n: int, ends: tuple[str, str]) -> np.ndarray:
    """Decimal ids with what follows them, of one width, for either end."""
    return np.array([f"{i}{end}".encode() for end in ends for i in range(n)], "S12")


def aligned(docs: DataFrame, a: str | None = None, b: str | None = None, head: int = HEAD) -> tuple[DataFrame, DataFrame]:
    """Of each row ``row``, doc_id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, its ``groups`` as text, and ``n_best`` and ``count_sum``
    over its links of frequent pairs; ``rest`` has the other pairs and how often the row links them. The second table has the counts of
    all pairs. ``a`` and ``b`` are the paths of the tokenizers on the driver."""
    spark = docs.sparkSession
    defaults = default_tokenizers() if a is None or b is None else (a, b)
    with open(a or defaults[0], "rb") as one, open(b or defaults[1], "rb") as two:
        definitions = one.read(), two.read()
    left, right = _loaded(ByteLevel, definitions[0]).pieces, _loaded(Pieces, definitions[1]).pieces
    tokens = tokenized(docs, *definitions)
    pairs = pair_counts(tokens, left, right)
    shared = spark.sparkContext.broadcast((left, right, *frequent(pairs, head)[:3]))

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        left, right, codes, counts, best = shared.value
        names = _names(len(left), (",", "|")), _names(len(right), (",", ";"))
        for batch in batches:
            for rows, s in slices(batch, left, right):
                places, found = pd.factorize(s.code)
                at = np.minimum(np.searchsorted(codes, found), max(len(codes) - 1, 0))
                known = codes[at] == found if len(codes) else np.zeros(len(found), bool)
                # What each link adds; those of rare pairs nothing yet.
                sums = s.by_row(np.where(known, counts[at], 0)[places] if len(codes) else np.zeros_like(s.code))
                bests = s.by_row((known & best[at]).astype(np.int64)[places] if len(codes) else np.zeros_like(s.code))
                n = len(rows)
                left_over = ~known[places]
                rare, times = np.unique(np.stack([s.row[left_over], s.code[left_over]]), axis=1, return_counts=True)
                cut = np.searchsorted(rare[0], np.arange(n + 1)).tolist()
                yield pd.DataFrame(
                    {
                        "row": rows["row"].to_numpy(),
                        "doc_id": rows["doc_id"].to_numpy(),
                        "n_a": s.n_a,
                        "n_b": s.n_b,
                        "n_groups": s.n_groups,
                        "n_links": s.n_links,
                        "groups": _rendered(s, *names),
                        "n_best": bests,
                        "count_sum": sums,
                        "rest": [[{"code": c, "times": t} for c, t in zip(rare[1][i:j].tolist(), times[i:j].tolist())] for i, j in zip(cut, cut[1:])],
                    }
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"row long, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups string, n_best long, count_sum long, "
        "rest array<struct<code: long, times: long>>"
    )
    return tokens.mapInPandas(describe, schema), pairs


def alignment_digest(docs: DataFrame, head: int = HEAD) -> DataFrame:
    """Counts of each row, and a check sum of its groups.

    Rows of NULL or empty texts, and of texts that the tokens do not spell, have zeros and an
    empty check sum. Repeated rows each count and come out; other columns are left out.
    """
    rows, pairs = aligned(docs.select("doc_id", "text"), head=head)
    digest = F.when(F.col("n_groups") == 0, "").otherwise(F.sha2(F.col("groups").cast("binary"), 256))
    rows = stored(rows.withColumn("groups_sha256", digest).drop("groups"), "alignments")
    rest = rows.where(F.size("rest") > 0).select("row", F.explode("rest").alias("r")).select("row", "r.code", "r.times")
    # A rare pair's rows are fewer than what made the others frequent, so none is a hot key.
    met = rest.join(pairs, "code").groupBy("row").agg(
        F.sum(F.col("times") * F.col("best").cast("long")).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum")
    )
    plus = lambda c, d: (F.col(c) + F.coalesce(d, F.lit(0).cast("long"))).alias(c)
    out = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
    return rows.drop("rest").join(met, "row", "left").select(*out, plus("n_best", "more_best"), plus("count_sum", "more_sum"), "groups_sha256")
