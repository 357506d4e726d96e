"""Quality rules on documents, judged by host.

Each document is measured once, inside its row. How often a host's documents fail a rule says
more about the next one than its own figures do, but few documents say little: each host's rate
is drawn towards the mean of all hosts by a beta prior that is estimated from the hosts
themselves. Hosts whose drawn-in rate is past the limit lose all their documents.

DataFrame expressions only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from servery.llm.common import WORD_SPACE, stored

SYMBOLS = "#*$%&|<>"
#: A host is rejected when more than this share of its documents is expected to fail.
HOST_LIMIT = 0.5


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """The words of a whole text, in order; none of NULL."""
    trimmed = F.btrim(text, F.lit(WORD_SPACE))
    return F.when(F.coalesce(trimmed, F.lit("")) == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, r"[\x20\x09-\x0D]+")
    )


def repeated_words(found: Column, window: int = 3) -> Column:
    """How many of the words lie in a run of ``window`` words that the text has twice or more.

    Windows are told apart by a 64-bit hash. Only where two are alike are they sorted, with
    their places, so that equal ones stand side by side.
    """

    def covered(grams: Column) -> Column:
        placed = F.array_sort(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))

        def alike(rows: Column) -> Column:
            twin = lambda r, k: (F.get(rows, k - 1)["g"] == r["g"]) | (F.get(rows, k + 1)["g"] == r["g"])
            return F.transform(F.filter(rows, lambda r, k: F.coalesce(twin(r, k), F.lit(False))), lambda r: r["i"])

        # Each window adds the words that the one before it did not reach.
        return F.aggregate(
            F.array_sort(let(placed, alike)),
            F.struct(F.lit(-window).alias("last"), F.lit(0).alias("n")),
            lambda a, i: F.struct(
                i.alias("last"), (a["n"] + F.least(F.lit(window), i - a["last"])).alias("n")
            ),
            lambda a: a["n"],
        )

    def count(hashes: Column) -> Column:
        last = F.size(hashes) - window
        grams = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(window)]))
        repeats = let(grams, lambda g: F.when(F.size(F.array_distinct(g)) < F.size(g), covered(g)).otherwise(0))
        return F.when(last < 1, F.lit(0)).otherwise(repeats)

    return let(F.transform(found, lambda w: F.xxhash64(w)), count)


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that are equal to an earlier line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.btrim(x, F.lit(WORD_SPACE)) != "")
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the text but with n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words (long), ``base_failed`` and ``rule_failed``. Of NULL and empty texts all
    counts are 0, so they fail. Columns of these names are replaced."""
    value = F.coalesce(F.col(text), F.lit(""))
    without = lambda chars: F.char_length(F.translate(value, chars, ""))
    counts = docs.withColumn("_words", words(F.col(text))).select(
        *[c for c in docs.columns if c != text and c not in MEASURES],
        F.size("_words").cast("long").alias("n_words"),
        without(WORD_SPACE).cast("long").alias("word_chars"),
        (F.char_length(value) - without(SYMBOLS)).cast("long").alias("n_symbols"),
        duplicate_lines(F.col(text)).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("_words")).cast("long").alias("n_repeat_words"),
    )
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    # What the hosts' rates count besides: a tenth of symbols, five repeated lines or more.
    other = (10 * F.col("n_symbols") > F.col("word_chars")) | (F.col("n_dup_lines") >= 5)
    return counts.withColumn("base_failed", base).withColumn("rule_failed", base | other)


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "rule_failed")


def host_rates(rows: DataFrame, host: str) -> DataFrame:
    """A row for each host, NULL being one: ``host_docs``, ``host_failures``."""
    return rows.groupBy(F.col(host).alias("_host")).agg(
        F.count("*").alias("host_docs"), F.sum(F.col("rule_failed").cast("long")).alias("host_failures")
    )


def prior(rates: DataFrame) -> tuple[float, float]:
    """``a``, ``b`` of the beta distribution of the hosts' rates, by their mean and by the
    variance that is left when what small numbers explain is taken off. Hosts that vary no more
    than chance would are taken as equal: the prior then weighs as much as all of a host."""
    rate = F.col("host_failures") / F.col("host_docs")
    s = rates.agg(
        F.count("*").alias("hosts"),
        F.sum("host_docs").alias("n"),
        F.sum("host_failures").alias("failed"),
        F.sum(rate * rate).alias("squares"),
        F.sum(rate).alias("rates"),
        F.sum(1 / F.col("host_docs")).alias("inverse"),
    ).first()
    if not s["n"]:
        return 1.0, 1.0
    mean = (s["failed"] + 1) / (s["n"] + 2)
    spread = s["squares"] / s["hosts"] - (s["rates"] / s["hosts"]) ** 2
    chance = mean * (1 - mean) * s["inverse"] / s["hosts"]
    most = s["n"] / s["hosts"]
    weight = most if spread <= chance else min(most, max(1.0, mean * (1 - mean) / (spread - chance) - 1))
    return mean * weight, (1 - mean) * weight


def judged(docs: DataFrame, host: str, limit: float = HOST_LIMIT, text: str = "text") -> DataFrame:
    """``measured`` documents with their host's figures, ``host_kept`` and ``kept``. Repeated
    rows each count, and each get a verdict."""
    rows = stored(measured(docs, text), "measured")
    rates = stored(host_rates(rows, host), "hosts")
    a, b = prior(rates)
    expected = (F.col("host_failures") + a) / (F.col("host_docs") + a + b)
    verdicts = rates.withColumn("host_kept", expected <= limit)
    return (
        rows.join(verdicts, rows[host].eqNullSafe(verdicts["_host"]))
        .drop("_host")
        .withColumn("kept", ~F.col("base_failed") & F.col("host_kept"))
    )


def host_rule_digest(docs: DataFrame) -> DataFrame:
    """Counts and verdict of each document; its source is its host."""
    out = ["doc_id", *[c for c in MEASURES if c != "rule_failed"], "kept", "host_docs", "host_failures"]
    return judged(docs.select("doc_id", "source", "text"), "source").select(*out)


HOST_RULE_SQL = r"""
WITH doc AS (
    SELECT doc_id, source, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
    FROM documents
), gram AS (
    SELECT doc_id, p, ws[p] || ' ' || ws[p + 1] || ' ' || ws[p + 2] AS g
    FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS p FROM doc)
), twin AS (
    SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, g) AS n FROM gram) WHERE n > 1
), covered AS (
    SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest([p, p + 1, p + 2]) AS q FROM twin) GROUP BY doc_id
), line AS (
    SELECT doc_id, count(*) - count(DISTINCT x) AS n
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x FROM doc)
    WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY doc_id
), counts AS (
    SELECT doc.doc_id, source, len(ws)::BIGINT AS n_words,
           length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
           (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
           coalesce(line.n, 0)::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words
    FROM doc LEFT JOIN line USING (doc_id) LEFT JOIN covered USING (doc_id)
), flagged AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
           base_failed OR 10 * n_symbols > word_chars OR n_dup_lines >= 5 AS rule_failed
    FROM counts
), host AS (
    SELECT source, count(*)::BIGINT AS host_docs, sum(rule_failed::INT)::BIGINT AS host_failures
    FROM flagged GROUP BY source
), moments AS (
    SELECT count(*) AS hosts, sum(host_docs) AS n, (sum(host_failures) + 1) / (sum(host_docs) + 2) AS mean,
           avg((host_failures / host_docs) ** 2) - avg(host_failures / host_docs) ** 2 AS spread,
           avg(1 / host_docs) * mean * (1 - mean) AS chance
    FROM host
), prior AS (
    SELECT mean, CASE WHEN spread <= chance THEN n / hosts
                      ELSE least(n / hosts, greatest(1, mean * (1 - mean) / (spread - chance) - 1)) END AS weight
    FROM moments
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND (host_failures + mean * weight) / (host_docs + weight) <= 0.5 AS kept,
       host_docs, host_failures
FROM flagged JOIN host ON host.source IS NOT DISTINCT FROM flagged.source, prior
"""
