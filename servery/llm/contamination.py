"""Benchmark decontamination over a distributed positional inverted index.

Items are cut into windows of consecutive words. A window can only occur where its two rarest
terms stand at the right distance, so the index holds the postings of those terms: document and
position. Both lists of a window are moved back by the term's offset, and where they meet the
window may start. The few documents with such starts are indexed in full, and the lists of all
terms of a window are intersected there, which makes the match exact.

How rare a term is, is counted over all documents. Benchmark tables are broadcast while they are
small, and joined by shuffles beyond that. DataFrame expressions only.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from servery.llm.common import stored

#: Words in a window. Items with fewer are one window.
WINDOW = 10
#: Words by which a term of a proximity match may stand off its place.
SLOP = 1
#: Windows of as many terms may lack one of them in a proximity match.
LOOSE = 5
#: Rows up to which a table of the benchmark is broadcast; about 64 bytes each.
BROADCAST_ROWS = 200_000
#: The term that ends every document; no word contains it.
END = "\0"
#: A document is known by its id and a hash of its text; rows that agree in both are alike. So
#: are, but for the id, rows with the id '' and rows without one.
KEY = ("_id", "_text")


def _keyed(docs: DataFrame, text: str = "text") -> DataFrame:
    return docs.withColumn("_id", F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).withColumn(
        "_text", F.coalesce(F.xxhash64(text), F.lit(0))
    )


def words(text: Column) -> Column:
    """A-Z in lower case, then runs of digits, a-z and all that is not ASCII."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    low = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))
    pieces = F.split(low, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    return F.coalesce(F.filter(pieces, lambda w: w != ""), F.array().cast("array<string>"))


def item_windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """item_id and ``terms``, for every window of every item."""
    found = items.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    last = F.greatest(F.size("w") - size, F.lit(0))
    cut = found.select("item_id", "w", F.explode(F.sequence(F.lit(0), last)).alias("at"))
    terms = F.slice("w", F.col("at") + 1, size)
    return cut.select("item_id", terms.alias("terms")).distinct()


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def postings(docs: DataFrame, terms: DataFrame, rows: int, text: str = "text") -> DataFrame:
    """The index of the given terms (column ``term``): doc_id and key of the document, ``term``, ``pos``.
    With the term ``END`` among them every document has a posting that tells its length."""
    keyed = _keyed(docs, text).select("doc_id", *KEY, words(F.col(text)).alias("w"))
    each = keyed.select("doc_id", *KEY, F.posexplode(F.concat("w", F.array(F.lit(END)))).alias("pos", "term"))
    return each.join(_small(terms, rows), "term")


def rarest_terms(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """Of each window the two rarest of its terms: ``win``, ``term``, ``offset``, and their
    number ``k`` (1, 2) out of ``needed``. A window with a term that no document has can't occur
    and is left out."""
    each = windows.select("win", F.size("terms").alias("size"), F.posexplode("terms").alias("offset", "term"))
    known = each.join(counts, "term", "left")
    ranked = known.withColumn("k", F.row_number().over(Window.partitionBy("win").orderBy("n", "term", "offset")))
    whole = Window.partitionBy("win")
    return (
        ranked.withColumn("_rare", F.min(F.coalesce("n", F.lit(0))).over(whole))
        .where("_rare > 0 AND k <= 2")
        .select("win", "term", "offset", "k", F.least("size", F.lit(2)).alias("needed"))
    )


def starts(index: DataFrame, rare: DataFrame, rows: int) -> DataFrame:
    """Key, ``win``, ``start``: where the offset-adjusted lists of the rare terms meet."""
    placed = index.join(_small(rare, rows), "term").withColumn("start", F.col("pos") - F.col("offset")).where("start >= 0")
    # Rows that are alike, and so have their postings twice, count once: the numbers are bits.
    met = placed.groupBy(*KEY, "win", "start", "needed").agg(F.bit_or("k").alias("met"))
    return met.where("met = 2 * needed - 1").select(*KEY, "win", "start")


def near_starts(index: DataFrame, rare: DataFrame, rows: int, slop: int = 3) -> DataFrame:
    """Proximity matches: key, ``win``, ``start`` of its rarest term's list, where the other
    list has a start that differs by 1 to ``slop``."""
    placed = index.join(_small(rare, rows), "term").withColumn("start", F.col("pos") - F.col("offset"))
    first, other = placed.where("k = 1"), placed.where("k = 2")
    # Starts within the slop lie in the same stretch of that length or in one beside it.
    stretch = F.floor(F.col("start") / (slop + 1))
    left = first.select(*KEY, "win", "start", F.explode(F.array(*[stretch + d for d in (-1, 0, 1)])).alias("_at"))
    right = other.select(*KEY, "win", F.col("start").alias("_other"), stretch.alias("_at"))
    joined = left.join(right, [*KEY, "win", "_at"])
    apart = F.abs(F.col("start") - F.col("_other"))
    return joined.where((apart >= 1) & (apart <= slop)).select(*KEY, "win", "start").distinct()


def exact(docs: DataFrame, candidates: DataFrame, windows: DataFrame, rows: int) -> DataFrame:
    """The candidates whose window stands there word for word, with its ``size``."""
    some = _keyed(docs).join(candidates.select(*KEY).distinct(), list(KEY), "left_semi")
    index = some.select(*KEY, F.posexplode(words(F.col("text"))).alias("pos", "term")).distinct()
    each = windows.select("win", F.size("terms").alias("size"), F.posexplode("terms").alias("offset", "term"))
    due = candidates.join(_small(each, rows), "win").withColumn("pos", F.col("start") + F.col("offset"))
    met = due.join(index, [*KEY, "pos", "term"]).groupBy(*KEY, "win", "start", "size").agg(F.count("*").alias("n"))
    return met.where("n = size").select(*KEY, "win", "start", "size")


def matches(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The lengths of all documents (doc_id, key, ``n_words``), the exact matches (key, ``win``,
    ``start``, ``size``), and which items have a window (``item_id``, ``win``)."""
    windows = stored(item_windows(items, size), "windows")
    distinct = windows.select("terms").distinct().withColumn("win", F.monotonically_increasing_id())
    distinct = stored(distinct, "distinct-windows")
    terms = stored(distinct.select(F.explode("terms").alias("term")).distinct(), "terms")
    n_terms, n_windows = terms.count(), distinct.count()
    counts = postings(docs, terms, n_terms).groupBy("term").agg(F.count("*").alias("n"))
    rare = stored(rarest_terms(distinct, counts), "rare")
    chosen = rare.select("term").unionByName(docs.sparkSession.createDataFrame([(END,)], "term string")).distinct()
    index = stored(postings(docs, chosen, n_terms + 1), "index")
    lengths = index.where(F.col("term") == END).select("doc_id", *KEY, F.col("pos").cast("long").alias("n_words"))
    candidates = stored(starts(index.where(F.col("term") != END), rare, 2 * n_windows), "starts")
    found = stored(exact(docs, candidates, distinct, size * n_windows), "matches")
    return lengths, found, windows.join(distinct, "terms").select("item_id", "win")


def contamination_digest(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Of each document its words, how many of them lie in a match, and the items it has. NULL
    texts have no words. Items without an id are matched but not listed. Repeated documents
    each have their row, repeated items count once."""
    lengths, found, of_item = matches(docs.select("doc_id", "text"), items.select("item_id", "text"))
    covered = found.select(*KEY, F.explode(F.sequence("start", F.col("start") + F.col("size") - 1)).alias("pos"))
    hit = covered.distinct().groupBy(*KEY).agg(F.count("*").alias("n_hit"))
    listed = found.select(*KEY, "win").distinct().join(of_item, "win").select(*KEY, F.col("item_id").cast("string").alias("i")).distinct()
    listed = listed.groupBy(*KEY).agg(F.array_sort(F.collect_list("i")).alias("items"))
    rows = lengths.join(hit.join(listed, list(KEY), "left"), list(KEY), "left")
    items_or_none = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return rows.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(items_or_none).cast("long").alias("n_items"),
        F.sha2(F.array_join(items_or_none, ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def decontaminated(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """The documents without a match, all their columns unchanged."""
    _, found, _ = matches(docs.select("doc_id", "text"), items.select("item_id", "text"), size)
    # The caller's columns travel as one, so that none can clash.
    keyed = _keyed(docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "text")).select("row", *KEY)
    # Few documents have a match: while their keys can be sent to all, no text is shuffled.
    dirty = stored(found.select(*KEY).distinct(), "contaminated")
    return keyed.join(_small(dirty, dirty.count()), list(KEY), "left_anti").select("row.*")


def near_matches(docs: DataFrame, items: DataFrame, size: int = WINDOW, slop: int = SLOP) -> DataFrame:
    """Proximity matches: key, ``item_id``, for items of which a window stands in a document with
    each term ``slop`` words or fewer off its place, and no window stands there exactly. One of
    ``LOOSE`` or more terms may be missing, so a word may be put in, left out or replaced.

    Of the three rarest terms a match then has two at least, and where their lists meet within
    the slop, the lists of all terms of the window are compared. Terms that no document has count
    as the rarest.
    """
    windows = stored(item_windows(items, size), "windows")
    distinct = stored(windows.select("terms").distinct().withColumn("win", F.monotonically_increasing_id()), "distinct-windows")
    terms = stored(distinct.select(F.explode("terms").alias("term")).distinct(), "terms")
    n_terms, n_windows = terms.count(), distinct.count()
    counts = postings(docs, terms, n_terms).groupBy("term").agg(F.count("*").alias("n"))
    lacking = F.when(F.col("size") >= LOOSE, 1).otherwise(0)
    each = distinct.select("win", F.size("terms").alias("size"), F.posexplode("terms").alias("offset", "term"))
    order = Window.partitionBy("win").orderBy(F.coalesce("n", F.lit(0)), "term", "offset")
    ranked = each.join(counts, "term", "left").withColumn("k", F.row_number().over(order)).where("k <= 3")
    rare = ranked.select("win", "term", "offset", "k", (F.least("size", F.lit(3)) - lacking).alias("needed"))
    rare = stored(rare, "near-rare")
    index = postings(docs, rare.select("term").distinct(), 3 * n_windows)
    shifts = F.explode(F.array(*[F.lit(d) for d in range(-slop, slop + 1)]))
    placed = index.join(_small(rare, 3 * n_windows), "term").withColumn("shift", shifts)
    placed = placed.withColumn("start", F.col("pos") - F.col("offset") + F.col("shift"))
    met = placed.groupBy(*KEY, "win", "start", "needed").agg(F.bit_or(F.expr("shiftleft(1, k)")).alias("met"))
    candidates = stored(met.where("bit_count(met) >= needed").select(*KEY, "win", "start"), "near-starts")

    some = _keyed(docs).join(candidates.select(*KEY).distinct(), list(KEY), "left_semi")
    every = some.select(*KEY, F.posexplode(words(F.col("text"))).alias("pos", "term")).distinct()
    due = candidates.join(_small(each, size * n_windows), "win").withColumn("shift", shifts)
    due = due.withColumn("pos", F.col("start") + F.col("offset") + F.col("shift"))
    held = due.join(every, [*KEY, "pos", "term"]).groupBy(*KEY, "win", "start", "size", "offset")
    held = held.agg(F.max(F.when(F.col("shift") == 0, 1).otherwise(0)).alias("straight"))
    found = held.groupBy(*KEY, "win", "start", "size").agg(F.count("*").alias("n"), F.sum("straight").alias("straight"))
    found = found.where(F.col("n") >= F.col("size") - lacking).withColumn("exact", F.col("straight") == F.col("size"))
    of_window = found.groupBy(*KEY, "win").agg(F.max("exact").alias("exact"))
    of_item = of_window.join(windows.join(distinct, "terms").select("item_id", "win"), "win")
    return of_item.groupBy(*KEY, "item_id").agg(F.max("exact").alias("exact")).where("NOT exact").drop("exact")


def proximity_digest(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Of each document the items it has nearly but not exactly. Items without an id are
    matched but neither counted nor listed."""
    docs = docs.select("doc_id", "text")
    near = stored(near_matches(docs, items.select("item_id", "text")), "near")
    listed = near.groupBy(*KEY).agg(
        F.count("item_id").alias("n_near"), F.array_sort(F.collect_list(F.col("item_id").cast("string"))).alias("items")
    )
    rows = _keyed(docs).select("doc_id", *KEY).join(listed, list(KEY), "left")
    return rows.select(
        "doc_id",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.coalesce("items", F.array().cast("array<string>")).alias("near_items"),
    )


CONTAMINATION_SQL = r"""
WITH doc AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
    FROM documents
), item AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
    FROM benchmark
), win AS (
    SELECT DISTINCT item_id, least(len(ws), 10) AS size, array_to_string(ws[p : p + least(len(ws), 10) - 1], ' ') AS w
    FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 10, 0) + 2)) AS p FROM item WHERE len(ws) > 0)
), place AS (
    SELECT doc_id, p, size, array_to_string(ws[p : p + size - 1], ' ') AS w
    FROM (SELECT doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS p
          FROM doc, (SELECT DISTINCT size FROM win) WHERE len(ws) >= size)
), found AS (
    SELECT doc_id, p, place.size, item_id FROM place JOIN win USING (w)
), hit AS (
    SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + size)) AS q FROM found) GROUP BY doc_id
), listed AS (
    SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM found) GROUP BY doc_id
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN listed USING (doc_id)
"""
