"""Fill-in-the-middle texts, cut by a learned rank index.

A text is taken as tokens: runs of ASCII letters, and every other character by itself. Its
boundaries, ranked from 0 to the number of tokens, lie at growing offsets, which a few straight
segments follow: each segment reaches as far as one line from its first boundary stays within
``EPSILON`` characters of all the others. What a line is off at each boundary is stored in a byte,
so a predicted offset is put right exactly, without the text being cut into tokens.

Which boundaries are cuts, and the order of the pieces, is decided by hashes of the id, so that a
text comes out alike at every run. Every row is worked on by itself.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Characters by which a line may miss a boundary; a residual fits in a signed byte.
EPSILON = 32
#: Boundaries a segment is first tried on; twice as many each time it reaches the last of them.
BLOCK = 128
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of a hundred texts so many are rearranged, and of those so many with the suffix in front.
REARRANGED, SUFFIX_FIRST = 90, 20


def boundaries(text: str) -> np.ndarray:
    """The offsets, in code points, at which tokens begin, and the end of the text."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    letter = ((code | 0x20) - np.uint32(ord("a"))) < 26  # unsigned: what is below wraps round
    inner = np.flatnonzero(~(letter[1:] & letter[:-1])) + 1
    return np.concatenate([[0], inner, [len(code)]]) if len(code) else np.zeros(1, np.int64)


class RankIndex:
    """Offsets by rank: segments (first rank, its offset, slope) and a residual for each rank."""

    def __init__(self, offsets: np.ndarray, epsilon: int = EPSILON) -> None:
        first, slope = [], []
        n, at = len(offsets), 0
        while at < n:
            low, high, reach, block = -np.inf, np.inf, at + 1, BLOCK
            while reach < n:
                steps = np.arange(reach - at, min(reach + block, n) - at)
                rise = offsets[reach : reach + block] - offsets[at]
                # The slopes that pass near enough to every boundary so far: a cone that shrinks.
                lows = np.maximum(np.maximum.accumulate((rise - epsilon) / steps), low)
                highs = np.minimum(np.minimum.accumulate((rise + epsilon) / steps), high)
                good = int((lows <= highs).argmin()) if lows[-1] > highs[-1] else len(steps)
                if good:
                    low, high = lows[good - 1], highs[good - 1]
                reach += good
                if good < len(steps):
                    break
                block *= 2
            first.append(at)
            slope.append((low + high) / 2 if reach > at + 1 else 0.0)
            at = reach
        self.first, self.slope = np.array(first, np.int64), np.array(slope)
        self.base = offsets[self.first]
        self.size = n
        self.residuals = (offsets - self.predicted(np.arange(n))).astype(np.int8)

    def predicted(self, ranks: np.ndarray) -> np.ndarray:
        """The offsets as the segments have them."""
        k = np.searchsorted(self.first, ranks, "right") - 1
        return self.base[k] + np.rint(self.slope[k] * (ranks - self.first[k])).astype(np.int64)

    def offsets(self, ranks: np.ndarray) -> np.ndarray:
        """The offsets as they are."""
        return self.predicted(ranks) + self.residuals[ranks]


@F.pandas_udf(T.StructType([T.StructField(c, T.LongType()) for c in ("n", "first", "second")]))
def _cuts(text: pd.Series, one: pd.Series, two: pd.Series) -> pd.DataFrame:
    """The number of tokens, and the offsets of the two boundaries that the numbers choose."""
    out = np.zeros((len(text), 3), np.int64)
    for i, (value, a, b) in enumerate(zip(text, one, two)):
        if value:
            index = RankIndex(boundaries(value))
            ranks = np.array([a % index.size, b % index.size])
            out[i] = index.size - 1, *np.sort(index.offsets(ranks))
    return pd.DataFrame(out, columns=["n", "first", "second"])


def _number(digest: Column, place: int) -> Column:
    """One of the eight-digit groups of a digest in hexadecimal, from 1."""
    return F.conv(F.substring(digest, 8 * place - 7, 8), 16, 10).cast("long")


def restored(output: Column, form: Column) -> Column:
    """The text that was rearranged."""
    piece = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    order = F.when(form == "psm", F.concat(piece[1], piece[3], piece[2])).otherwise(F.concat(piece[2], piece[3], piece[1]))
    return F.when(form == "plain", output).otherwise(order)


def rearranged(docs: DataFrame) -> DataFrame:
    """doc_id, ``n`` (tokens), ``form`` (plain, psm or spm), ``prefix_chars``, ``middle_chars`` and
    the ``output`` of each row; other columns of ``docs`` are left out, whatever their names.

    NULL texts count as empty ones, which are plain; so are texts that hold one of the marks. Rows
    without an id are rearranged as if their id were the empty string. Repeated rows each come out.
    """
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *[_number(digest, k).alias(f"h{k}") for k in (1, 2, 3, 4)])
    cut = rows.withColumn("cut", _cuts("text", "h1", "h2"))
    text = F.col("text")
    marked = text.contains(PREFIX) | text.contains(SUFFIX) | text.contains(MIDDLE)
    plain = (text == "") | marked | (F.col("h3") % 100 >= REARRANGED)
    form = F.when(plain, "plain").when(F.col("h4") % 100 < SUFFIX_FIRST, "spm").otherwise("psm")
    middle = F.col("cut.second") - F.col("cut.first")
    formed = cut.select("doc_id", "text", form.alias("form"), "cut.n", F.col("cut.first").alias("at"), middle.alias("size"))
    piece = lambda start, size: F.substring(text, start, size)
    at, size = F.col("at").cast("int"), F.col("size").cast("int")
    prefix, middle, suffix = piece(F.lit(1), at), piece(at + 1, size), piece(at + size + 1, F.char_length(text))
    chars = lambda c: F.when(F.col("form") != "plain", F.col(c))
    return formed.select(
        "doc_id",
        "n",
        "form",
        chars("at").alias("prefix_chars"),
        chars("size").alias("middle_chars"),
        F.when(F.col("form") == "plain", text)
        .when(F.col("form") == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
        .otherwise(F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
        .alias("output"),
    )


def fim_digest(docs: DataFrame) -> DataFrame:
    """The rearranged texts, and the texts rebuilt from them, as check sums."""
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return rearranged(docs).select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        sha(F.col("output")).alias("output_sha256"),
        sha(restored(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )


FIM_SQL = r"""
WITH doc AS (
    SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS ws,
           sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
    FROM documents
), number AS (
    SELECT *, len(ws) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
           ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
    FROM doc
), piece AS (
    SELECT doc_id, n, t,
           CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
           least(h1 % (n + 1), h2 % (n + 1)) AS c, greatest(h1 % (n + 1), h2 % (n + 1)) AS d,
           array_to_string(ws[1:c], '') AS p, array_to_string(ws[c + 1:d], '') AS m, array_to_string(ws[d + 1:n], '') AS s
    FROM number
)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(p)::BIGINT END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM piece
"""
