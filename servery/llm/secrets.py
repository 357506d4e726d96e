"""Secrets, and how many share them.

A credential that many owners publish is an example out of some manual; one that a single owner
has, and that looks random, may be live. So every candidate's hash is counted over the whole
corpus: in how many repositories it lies, and how many owners they have.

DataFrame expressions only. Offsets come from the lengths of what lies between matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from servery.llm.common import stored

#: Kinds, patterns and the group that holds the secret, in their order among spans of one start.
#: Runs are matched whole, so asking for a run's least length in the pattern finds the same runs.
KINDS = ("assign", "access", "hex", "live")
PATTERNS = (
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    r"AKIA[A-Z0-9]{16,}",
    r"[0-9a-f]{24,}",
    r"[A-Za-z0-9+/_-]{32,}",
)
GROUPS = (2, 0, 0, 0)
#: Candidates of the last kind are spans only if they turn out to be live.
ADDED = 3
#: A value that more owners have is an example.
MOST_OWNERS = 2


def _hits(text: Column, kind: int) -> Column:
    """Of each match the length of the gap before it, its own length and its secret."""
    pattern, whole = PATTERNS[kind], F.lit(0)
    gaps, matches = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), whole)
    secret = lambda m: F.regexp_extract(m, pattern, GROUPS[kind]) if GROUPS[kind] else m
    hits = F.zip_with(
        F.slice(gaps, 1, F.size(matches)),
        matches,
        lambda g, m: F.struct(
            F.lit(kind).alias("kind"),
            F.char_length(g).alias("gap"),
            F.char_length(m).alias("length"),
            secret(m).alias("secret"),
        ),
    )
    return F.when(F.coalesce(text, F.lit("")).rlike(pattern), hits).otherwise(F.array().cast(_HITS))


_HITS = "array<struct<kind: int, gap: int, length: int, secret: string>>"


def candidates(docs: DataFrame, repository: str, owner: str, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Every row of ``docs`` without its text, numbered by ``_row``; and a row for each candidate
    in it: ``_row``, repository, owner, ``kind``, ``start``, ``end`` (code points, end exclusive),
    ``secret``. NULL texts have none."""
    found = stored(
        docs.select(
            F.monotonically_increasing_id().alias("_row"),
            *[c for c in docs.columns if c != text],
            F.array(*[_hits(F.col(text), k) for k in range(len(KINDS))]).alias("_hits"),
        ),
        "hits",
    )
    ids = dict.fromkeys([repository, owner])
    each = found.where(F.exists("_hits", lambda h: F.size(h) > 0)).select("_row", *ids, F.explode("_hits").alias("h"))
    each = each.select("_row", *ids, F.posexplode("h").alias("_at", "h")).select("_row", *ids, "_at", "h.*")
    so_far = Window.partitionBy("_row", "kind").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("length")).over(so_far)
    spans = each.withColumn("end", end.cast("int")).withColumn("start", (F.col("end") - F.col("length")).cast("int"))
    long_enough = (F.col("kind") != 0) | (F.char_length("secret") >= 6)
    return found, spans.where(long_enough).select("_row", *ids, "kind", "start", "end", "secret")


def looks_random(secret: Column) -> Column:
    """Digits and letters, twelve different characters at least, and no word of an example."""
    characters = F.size(F.array_distinct(F.split(secret, "")))
    return (
        secret.rlike("[0-9]")
        & secret.rlike("[A-Za-z]")
        & (characters >= 12)
        & ~secret.rlike(r"(?i)example|sample|dummy|test|x{4}|0{6}|123456|abcdef")
    )


def ownership(spans: DataFrame, repository: str, owner: str) -> DataFrame:
    """Of each secret's hash the number of repositories and of owners that have it. NULL counts
    as one of either. Each step combines before it shuffles, so a secret that is everywhere
    costs a row for each owner and task."""
    null_safe = lambda c, name: F.coalesce(F.col(c).cast("string"), F.lit("\0")).alias(name)
    value = F.sha2(F.col("secret").cast("binary"), 256).alias("hash")
    holders = spans.select(value, null_safe(repository, "repository"), null_safe(owner, "owner")).distinct()
    by_owner = holders.groupBy("hash", "owner").agg(F.count("*").alias("n"))
    return by_owner.groupBy("hash").agg(F.sum("n").alias("repositories"), F.count("*").alias("owners"))


def judged(spans: DataFrame, repository: str, owner: str, most_owners: int = MOST_OWNERS) -> DataFrame:
    """``spans`` with repositories, owners, ``example`` (more owners than ``most_owners``) and
    ``live`` (not an example, and random to look at). The counts are detached from their
    grouping, so that the join can split the places of a secret that is everywhere."""
    spans = spans.withColumn("hash", F.sha2(F.col("secret").cast("binary"), 256))
    counted = spans.join(ownership(spans, repository, owner).hint("rebalance"), "hash")
    example = F.col("owners") > most_owners
    return counted.withColumn("example", example).withColumn("live", ~example & looks_random(F.col("secret")))


def _joined(spans: Column) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def secret_digest(docs: DataFrame) -> DataFrame:
    """Of each document its base spans' counts and digest, all its spans, and how many of its
    secrets are live or examples. A document is a repository, its source the owner. Generic runs
    are added where they are live and do not overlap a base span."""
    found, spans = candidates(docs.select("doc_id", "source", "text"), "doc_id", "source")
    spans = judged(spans, "doc_id", "source")
    of_row = spans.groupBy("_row", "doc_id").agg(
        F.array_sort(F.collect_list(F.struct("start", "kind", "end", "example", "live"))).alias("s")
    )
    base = F.filter("s", lambda x: x["kind"] != ADDED)
    of_row = of_row.withColumn("base", base)
    clear = lambda x: ~F.exists("base", lambda y: (y["start"] < x["end"]) & (x["start"] < y["end"]))
    every = F.filter("s", lambda x: (x["kind"] != ADDED) | (x["live"] & clear(x)))
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")
    flagged = lambda name: F.size(F.filter("every", lambda x: x[name])).cast("long").alias(f"n_{name}")
    with_spans = of_row.withColumn("every", every).select(
        "_row",
        *[count(k).alias(f"n_{KINDS[k]}") for k in range(ADDED)],
        F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _joined(F.col("every")).alias("spans"),
        flagged("live"),
        flagged("example"),
    )
    none = {c: F.lit(0).cast("long") for c in ("n_assign", "n_access", "n_hex", "n_live", "n_example")}
    none |= {"base_sha256": F.sha2(F.lit("").cast("binary"), 256), "spans": F.lit("")}
    rows = found.select("_row", "doc_id").join(with_spans, "_row", "left")
    order = ["n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_live", "n_example"]
    return rows.select("doc_id", *[F.coalesce(F.col(c), none[c]).alias(c) for c in order])
