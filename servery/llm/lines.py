"""Removal of repeated runs of lines, by winnowing.

A text is taken as lines; a line of several sentences counts as one line for each, so that a
passage is found in the middle of a paragraph as well. Every line is hashed. A gram is the hash
of so many lines, by powers of two, as have ``GRAM_BYTES`` in all, or of ``GRAM_LINES`` lines; it
starts at each line. Of each window of ``WINDOW`` consecutive grams the smallest is a fingerprint.
A window ends with the first line that is a gram by itself, so such a line is found alone,
whatever stands around it. What two texts share, and is as long as a window, has a fingerprint in
both: runs of ``RUN_BYTES`` are longer than any window with its grams.

The first document that has a fingerprint keeps it. In later places the match is extended both
ways, line by line, as far as the next fingerprint can be. The lines of all matches make runs, and
those of ``RUN_BYTES`` or ``RUN_LINES`` are deleted.

Only fingerprints are shuffled, and each later place meets one first place, so a passage that is
everywhere costs a row for each of its places. DataFrame expressions only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from servery.llm.common import WORD_SPACE, stored
from servery.llm.hosts import let

#: A gram has as many lines, by powers of two, as make up so many bytes, or ``GRAM_LINES`` lines.
GRAM_BYTES = 24
GRAM_LINES = 8
#: Grams of which the smallest is a fingerprint.
WINDOW = 4
#: What is deleted has at least so many bytes, or so many lines.
RUN_BYTES = 100
RUN_LINES = 12
#: Lines a match is extended forward: as far as the end of a run can be from its last
#: fingerprint. Its beginning is less than ``WINDOW`` lines before the first.
REACH = 2 * GRAM_LINES + WINDOW
#: The low bits of a hash hold the bytes it stands for, up to this number.
_BYTES = 63
#: More than a text can have lines.
_PLACES = 1 << 31
_LINES = r"(?<=\n)(?=[^\n])|(?<=[.!?] )(?=\S)"


def lines(text: Column) -> Column:
    """The lines of a text, each with the white space that ends it; together they are the text."""
    return F.split(F.coalesce(text, F.lit("")), _LINES)


def _bytes(h: Column) -> Column:
    return h.bitwiseAND(F.lit(_BYTES).cast("long"))


def _packed(h: Column, size: Column) -> Column:
    """A hash with the bytes it stands for in its low bits."""
    return h.bitwiseAND(F.lit(~_BYTES).cast("long")).bitwiseOR(F.least(size, F.lit(_BYTES)).cast("long"))


def _hashed(text: Column) -> Column:
    """The hash of each line, without the space around it."""
    bare = F.transform(lines(text), lambda line: F.btrim(line, F.lit(WORD_SPACE)))
    return F.transform(bare, lambda t: _packed(F.xxhash64(t), F.octet_length(t)))


def _grams(h: Column) -> Column:
    """The gram that starts at each line; NULL where the text ends before one is complete."""

    def doubled(g: Column, step: int) -> Column:
        def both(x: Column, i: Column) -> Column:
            after = F.get(g, i + step)
            joined = _packed(F.xxhash64(x, after), _bytes(x) + _bytes(after))
            return F.when((_bytes(x) >= GRAM_BYTES) | after.isNull(), x).otherwise(joined)

        return F.transform(g, both)

    steps = [1 << k for k in range(GRAM_LINES.bit_length() - 1)]
    nested = reduce(lambda made, step: lambda g: let(doubled(g, step), made), reversed(steps), lambda g: g)
    whole = lambda n: lambda x, i: F.when((_bytes(x) >= GRAM_BYTES) | (i + GRAM_LINES <= n), x)
    return F.transform(nested(h), whole(F.size(h)))


def _fingerprints(h: Column) -> Column:
    """Gram and place of the smallest gram of each window, the first of equals."""

    def chosen(g: Column) -> Column:
        def smallest(x: Column, i: Column) -> Column:
            alone = lambda k: F.coalesce(_bytes(F.get(h, i + k)) >= GRAM_BYTES, F.lit(False))
            before = lambda k: F.coalesce(x < F.get(g, i - k), F.lit(False))
            after = lambda k: F.coalesce(x <= F.get(g, i + k), F.lit(True))
            found = F.lit(False)
            for back in range(WINDOW):  # the window that starts so many lines before
                holds = F.lit(True)
                for k in range(back, 0, -1):
                    holds = holds & ~alone(-k) & before(k)
                rest = F.lit(True)
                for k in range(WINDOW - 1 - back, 0, -1):
                    rest = alone(k - 1) | (after(k) & rest)
                found = found | (holds & rest)
            return F.when(x.isNotNull() & found, F.struct(x.alias("g"), i.alias("pos")))

        return F.filter(F.transform(g, smallest), lambda f: f.isNotNull())

    return let(_grams(h), chosen)


def indexed(docs: DataFrame) -> DataFrame:
    """doc_id, ``_text`` (a hash of the text), the line hashes ``h`` and the fingerprints ``f``
    of each different row, stored. Rows without an id or a text are left out."""
    known = docs.where("doc_id IS NOT NULL AND text IS NOT NULL")
    rows = known.select("doc_id", F.xxhash64("text").alias("_text"), _hashed(F.col("text")).alias("h"))
    return stored(rows.select("doc_id", "_text", "h", _fingerprints(F.col("h")).alias("f")), "lines")


def _first_places(places: DataFrame) -> DataFrame:
    """Of each gram that stands twice or more ``g``, ``first`` and ``first_pos``: the smallest id
    that has it, and its smallest place there."""
    kind = places.schema["doc_id"].dataType
    if isinstance(kind, IntegralType):
        # Both in one number of fixed width, which is aggregated by hash, without a sort.
        both = F.min(F.col("doc_id").cast("decimal(20,0)") * F.lit(_PLACES) + F.col("pos"))
        doc = F.floor(F.col("p") / _PLACES)
        first, at = doc.cast(kind), (F.col("p") - doc * F.lit(_PLACES)).cast("int")
    else:
        both, first, at = F.min(F.struct("doc_id", "pos")), F.col("p.doc_id"), F.col("p.pos")
    found = places.groupBy("g").agg(both.alias("p"), F.count("*").alias("n")).where("n > 1")
    return found.select("g", first.alias("first"), at.alias("first_pos"))


def repeats(index: DataFrame) -> DataFrame:
    """doc_id, ``_text``, ``pos``, ``first``, ``first_pos``: each later place of a fingerprint,
    with the first document that has it and its first place there. The smaller id comes first.

    The first places are detached from their grouping, so that the join can split the places
    of a gram that a third of all documents have.
    """
    places = index.select("doc_id", "_text", F.explode("f").alias("f")).select("doc_id", "_text", "f.g", "f.pos")
    met = places.join(_first_places(places).hint("rebalance"), "g")
    return stored(met.where("doc_id != first OR pos > first_pos").drop("g"), "repeats")


def _extended(h: Column, other: Column, m: Column, ahead: Column) -> Column:
    """The lines around a match that are alike on both sides: from, and up to but without. It is
    extended forward by ``ahead`` lines at most."""

    def reach(step: int, most: Column) -> Column:
        here, there = (lambda k: m["pos"] + step * k), (lambda k: m["first_pos"] + step * k)
        inside = lambda k: (here(k) >= 0) & (there(k) >= 0)
        alike = lambda k: inside(k) & F.coalesce(F.get(h, here(k)) == F.get(other, there(k)), F.lit(False))
        return F.aggregate(
            F.sequence(F.lit(1), most),
            F.lit(0),
            lambda n, k: F.when((n == k - 1) & alike(k), k).otherwise(n),
        )

    return F.struct((m["pos"] - reach(-1, F.lit(WINDOW))).alias("a"), (m["pos"] + reach(1, ahead) + 1).alias("b"))


def deletions(index: DataFrame) -> DataFrame:
    """doc_id, ``_text``, ``_runs``: the runs of lines in matches, sorted, apart from each other.
    Some may be too short to be deleted."""
    matched = repeats(index).groupBy("doc_id", "_text", "first").agg(
        F.array_sort(F.collect_set(F.struct((F.col("pos") - F.col("first_pos")).alias("d"), "pos"))).alias("m")
    )
    own = index.select("doc_id", "_text", "h").dropDuplicates(["doc_id", "_text"])
    other = own.select(F.col("doc_id").alias("first"), F.col("_text").alias("_other"), F.col("h").alias("_h"))
    both = matched.join(own, ["doc_id", "_text"]).join(other, "first")
    # In one document a line must not be its own first place; rows that share an id stay apart.
    both = both.where("doc_id != first OR _text = _other")

    def span(m: Column, i: Column) -> Column:
        # Forward no farther than the next match of the same distance, which goes on from there.
        after = F.get("m", i + 1)
        gap = F.when(after["d"] == m["d"], after["pos"] - m["pos"] - 1)
        ahead = F.greatest(F.least(gap, F.lit(REACH)), F.lit(1))
        at = F.struct(m["pos"].alias("pos"), (m["pos"] - m["d"]).alias("first_pos"))
        return _extended(F.col("h"), F.col("_h"), at, ahead)

    spans = both.select("doc_id", "_text", F.transform("m", span).alias("s"))
    spans = spans.select("doc_id", "_text", F.filter("s", lambda s: s["b"] > s["a"]).alias("s"))
    every = spans.groupBy("doc_id", "_text").agg(F.array_sort(F.flatten(F.collect_list("s"))).alias("s"))
    joined = F.aggregate(
        "s",
        F.array().cast("array<struct<a: int, b: int>>"),
        lambda runs, s: F.when(
            (F.size(runs) > 0) & (s["a"] <= F.get(runs, F.size(runs) - 1)["b"]),
            F.concat(
                F.slice(runs, 1, F.size(runs) - 1),
                F.array(
                    F.struct(
                        F.get(runs, F.size(runs) - 1)["a"].alias("a"),
                        F.greatest(F.get(runs, F.size(runs) - 1)["b"], s["b"]).alias("b"),
                    )
                ),
            ),
        ).otherwise(F.concat(runs, F.array(s))),
    )
    return every.select("doc_id", "_text", joined.alias("_runs"))


def _long(found: Column, runs: Column) -> Column:
    """The runs of ``RUN_LINES`` or ``RUN_BYTES``, white space around the lines not counted."""

    def size(r: Column) -> Column:
        some = F.slice(found, r["a"] + 1, r["b"] - r["a"])
        return F.aggregate(some, F.lit(0), lambda n, line: n + F.octet_length(F.btrim(line, F.lit(WORD_SPACE))))

    return F.filter(runs, lambda r: (r["b"] - r["a"] >= RUN_LINES) | (size(r) >= RUN_BYTES))


def _kept(found: Column, runs: Column) -> Column:
    """The lines between the runs, put together."""
    after = F.concat(F.array(F.lit(0)), F.transform(runs, lambda r: r["b"]))
    before = F.concat(F.transform(runs, lambda r: r["a"]), F.array(F.size(found)))
    pieces = F.zip_with(after, before, lambda a, b: F.array_join(F.slice(found, a + 1, F.greatest(b - a, F.lit(0))), ""))
    return F.array_join(pieces, "")


def _left(text: Column, runs: Column) -> Column:
    """What is left of a text, and how many lines are deleted (``text``, ``n``). Without a run
    that is long enough the text is as it was."""

    def cut(found: Column) -> Column:
        def without(due: Column) -> Column:
            deleted = F.aggregate(due, F.lit(0), lambda n, r: n + r["b"] - r["a"])
            return F.struct(F.when(F.size(due) == 0, text).otherwise(_kept(found, due)).alias("text"), deleted.alias("n"))

        return let(_long(found, runs), without)

    whole = F.struct(text.alias("text"), F.lit(0).alias("n"))
    return F.when(runs.isNull(), whole).otherwise(let(lines(text), cut))


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the text that is left, and ``n_lines``, ``n_deleted`` (long). Where nothing
    is deleted the text is as it was; rows without an id or a text have 0 of either. Rows that
    agree in id and text count as one document and get the same text. Columns of these two names
    are replaced; any others are kept, whatever they are called."""
    index = indexed(docs.select("doc_id", "text"))
    known = index.select("doc_id", "_text", F.size("h").cast("long").alias("_n")).distinct()
    # Only texts with a run to delete are cut into lines again.
    cut = known.join(deletions(index), ["doc_id", "_text"], "left").withColumnsRenamed({"doc_id": "_id", "_text": "_hash"})
    # The caller's columns travel as one, so that none can clash.
    keyed = docs.select(F.struct(*docs.columns).alias("row"), F.xxhash64("text").alias("key"))
    joined = keyed.join(cut, (F.col("row.doc_id") == F.col("_id")) & (F.col("key") == F.col("_hash")), "left")
    left = joined.select("row", "_n", _left(F.col("row.text"), F.col("_runs")).alias("left"))
    zero = F.lit(0).cast("long")
    kept = [c for c in docs.columns if c not in ("n_lines", "n_deleted")]
    return left.select(
        *[F.col("left.text").alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in kept],
        F.coalesce("_n", zero).alias("n_lines"),
        F.col("left.n").cast("long").alias("n_deleted"),
    )


def deduplicated(docs: DataFrame, least: float = 0.0, least_words: int = 50) -> DataFrame:
    """The columns of ``docs``, without repeated runs, and without the rows of which nothing but
    white space is left, or both no more than the share ``least`` of their bytes and fewer than
    ``least_words`` words. Rows of which nothing is deleted stay, empty ones too."""
    rest = F.struct(*[c for c in docs.columns if c != "text"]).alias("rest")
    left = without_repeats(docs.select("doc_id", "text", rest, F.octet_length("text").alias("bytes")))
    bare = F.btrim("text", F.lit(WORD_SPACE))
    few = F.size(F.split(bare, f"[{WORD_SPACE}]+")) < least_words
    little = (bare == "") | ((F.octet_length("text") <= least * F.col("bytes")) & few)
    kept = left.where((F.col("n_deleted") == 0) | ~little)
    return kept.select(*[F.col("text") if c == "text" else F.col("rest").getField(c).alias(c) for c in docs.columns])


def line_digest(docs: DataFrame) -> DataFrame:
    """Of each document its lines, how many of them are deleted, and a digest of what is left."""
    left = without_repeats(docs.select("doc_id", "text"))
    digest = F.sha2(F.col("text").cast("binary"), 256)
    return left.select("doc_id", "n_lines", "n_deleted", digest.alias("kept_sha256"))
