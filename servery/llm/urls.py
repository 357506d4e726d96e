"""URL filters by rules, and beyond them by a tree of path templates.

Each host has a tree of its own. Level by level, the segments that follow a template are told
apart where that says something: a frequent one stays as it is if its URLs differ from those of
its siblings, by how many are blocked among the labelled ones, how many go deeper, and how many
go on with a digit. All others, ids and the like but also frequent branches that are statistically
alike, are merged in one branch, the wildcard.

URLs that a rule decides are the labels. Down the tree the share of blocked ones is drawn towards
that of the template before, from the whole table to the host and on to the full path; templates of
which more than ``LIMIT`` is expected to be blocked are rejected.

DataFrame expressions only. What is counted is counted before it is shuffled, and joins go against
tables of templates, detached from their grouping, so that a host with a third of all URLs can be
split.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from servery.llm.common import stored


class Rule(NamedTuple):
    """Holds for URLs of ``host`` and its subdomains whose path starts with ``path``."""

    verdict: str
    host: str
    path: str


RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)
#: Segments told apart; what follows the last of them is one more, however long.
LEVELS = 6
#: A frequent segment has as many URLs, and one in so many of those its template has.
FEW, ONE_IN = 5, 20
#: Shares differ when they are more than three standard errors apart (squared).
APART = 9.0
#: URLs that the share of the template before weighs as many as.
WEIGHT = 4.0
LIMIT = 0.7
WILDCARD = "*"
#: Signs by which branches are compared: how many of how many.
SIGNS = (("blocked", "labelled"), ("deeper", "urls"), ("digits", "urls"))


def parsed(url: Column) -> tuple[Column, Column]:
    """Host, A-Z in lower case, and path; both empty where there is no ``://``."""
    url = F.coalesce(url, F.lit(""))
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def ruled(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """verdict and ``rule`` of the longest rule that fits; NULL where none does."""
    found = F.lit(None).cast("struct<verdict: string, rule: string>")
    # The shortest first, so that the longest is asked first.
    for rule in sorted(rules, key=lambda r: len(r.host + r.path)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        value = F.struct(F.lit(rule.verdict).alias("verdict"), F.lit(rule.host + rule.path).alias("rule"))
        found = F.when(fits, value).otherwise(found)
    return found


def segments(path: Column, levels: int = LEVELS) -> Column:
    """What stands after each slash; the last of many holds the rest of the path."""
    return F.when(path == "", F.array().cast("array<string>")).otherwise(F.slice(F.split(path, "/", levels + 1), 2, levels))


def _differs(sign: tuple[str, str]) -> Column:
    """Whether a branch and the rest of its template differ in a share, by the pooled test of two
    proportions, multiplied out. Where either has none, or all agree, they do not."""
    hits, trials = sign
    a, n = F.col(hits).cast("double"), F.col(trials).cast("double")
    b, m = F.col(f"all_{hits}") - a, F.col(f"all_{trials}") - n
    gap = a * m - b * n
    return gap * gap * (n + m) > F.lit(APART) * n * m * (a + b) * ((n + m) - (a + b))


def _counts() -> list[Column]:
    """What is counted of a branch; ``_next`` is the segment after it."""
    return [
        F.count("*").alias("urls"),
        F.count("blocked").alias("labelled"),
        F.coalesce(F.sum(F.col("blocked").cast("long")), F.lit(0)).alias("blocked"),
        F.count("_next").alias("deeper"),
        F.count_if(F.col("_next").rlike("^[0-9]")).alias("digits"),
    ]


def kept_segments(rows: DataFrame, level: int) -> DataFrame:
    """host, ``template``, ``segment``: the segments of a level that stay as they are. ``rows``
    have host, ``template``, ``segments`` and ``blocked``, which is NULL without a label."""
    at = rows.where(F.size("segments") > level).select(
        "host", "template", "blocked", F.get("segments", F.lit(level)).alias("segment"), F.get("segments", F.lit(level + 1)).alias("_next")
    )
    names = sorted({c for sign in SIGNS for c in sign})
    whole = at.groupBy("host", "template").agg(*_counts()).where(F.col("urls") >= FEW)
    whole = whole.select("host", "template", *[F.col(c).alias(f"all_{c}") for c in names]).hint("rebalance")
    branch = at.groupBy("host", "template", "segment").agg(*_counts()).where((F.col("urls") >= FEW) & (F.col("segment") != WILDCARD))
    both = branch.join(whole, ["host", "template"]).where(F.col("urls") * ONE_IN >= F.col("all_urls"))
    alone = F.col("urls") == F.col("all_urls")
    return both.where(alone | reduce(Column.__or__, map(_differs, SIGNS))).select("host", "template", "segment")


def templated(rows: DataFrame, levels: int = LEVELS) -> DataFrame:
    """``rows`` with the ``template`` of each path: its segments, or the wildcard in their place."""
    rows = stored(rows.withColumn("template", F.array().cast("array<string>")), "paths")
    deepest = rows.agg(F.max(F.size("segments"))).first()[0] or 0
    for level in range(min(levels, deepest)):
        kept = kept_segments(rows, level).withColumnsRenamed({"host": "_host", "template": "_template", "segment": "_kept"})
        here = F.get("segments", F.lit(level))
        same = (F.col("host") == F.col("_host")) & (F.col("template") == F.col("_template")) & (here == F.col("_kept"))
        step = F.when(here.isNull(), F.col("template")).otherwise(F.concat("template", F.array(F.coalesce("_kept", F.lit(WILDCARD)))))
        joined = rows.join(kept.hint("rebalance"), same, "left")
        rows = stored(joined.select(*[step.alias(c) if c == "template" else rows[c] for c in rows.columns]), "paths")
    return rows


def purity(rows: DataFrame) -> DataFrame:
    """host, ``template``, ``share``: of each full template the share expected to be blocked."""
    total = rows.agg(F.count("blocked").alias("n"), F.coalesce(F.sum(F.col("blocked").cast("long")), F.lit(0)).alias("b")).first()
    prior = (total["b"] + 1) / (total["n"] + 2)
    counts = [F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked")]
    full = rows.groupBy("host", "template").agg(
        F.count("blocked").alias("labelled"), F.coalesce(F.sum(F.col("blocked").cast("long")), F.lit(0)).alias("blocked")
    )
    full = stored(full, "templates")
    lengths = F.sequence(F.lit(0), F.size("template"))
    above = full.select("host", "template", "labelled", "blocked", F.explode(lengths).alias("k")).withColumn("node", F.expr("slice(template, 1, k)"))
    nodes = above.groupBy("host", "node").agg(*counts).hint("rebalance")
    line = above.select("host", "template", "node").join(nodes, ["host", "node"]).groupBy("host", "template")
    line = line.agg(F.array_sort(F.collect_list(F.struct(F.size("node").alias("k"), "labelled", "blocked"))).alias("line"))
    share = F.aggregate("line", F.lit(prior), lambda p, x: (x["blocked"] + F.lit(WEIGHT) * p) / (x["labelled"] + F.lit(WEIGHT)))
    return line.select("host", "template", share.alias("share"))


def judged(pages: DataFrame, rules: Sequence[Rule] = RULES, limit: float = LIMIT) -> DataFrame:
    """page_id, host, path, ``rule``, ``template`` and ``verdict`` (allow or block) of each row; other
    columns of ``pages`` are left out, whatever their names.

    A NULL URL, or one without ``://``, has an empty host and path, and is judged with others of
    that host. Repeated rows count as often as they come. No rows give no rows.
    """
    host, path = parsed(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("_rule", ruled(F.col("host"), F.col("path"), rules)).select(
        "page_id", "host", "path", F.col("_rule.rule").alias("rule"), (F.col("_rule.verdict") == "block").alias("blocked"),
        segments(F.col("path")).alias("segments"),
    )
    rows = templated(rows)
    shares = purity(rows).withColumnsRenamed({"host": "_host", "template": "_template"}).hint("rebalance")
    joined = rows.join(shares, (F.col("host") == F.col("_host")) & (F.col("template") == F.col("_template")))
    block = F.coalesce("blocked", F.col("share") > limit)
    return joined.select(
        "page_id", "host", "path", "rule", F.when(block, "block").otherwise("allow").alias("verdict"),
        F.concat_ws("", F.transform("template", lambda s: F.concat(F.lit("/"), s))).alias("template"),
    )


def _levels_sql() -> str:
    """The levels one after another, as common table expressions."""
    signs = " OR ".join(
        f"pow({h}::DOUBLE * (w.{n} - b.{n}) - (w.{h} - b.{h}) * {n}::DOUBLE, 2)".replace(f"{h}::", f"b.{h}::").replace(f"{n}::", f"b.{n}::")
        + f" * w.{n} > {APART}::DOUBLE * b.{n} * (w.{n} - b.{n}) * w.{h} * (w.{n} - w.{h})"
        for h, n in SIGNS
    )
    counts = (
        "count(*) AS urls, count(blocked) AS labelled, coalesce(sum(blocked::INT), 0)::BIGINT AS blocked, count(nxt) AS deeper, "
        "count(*) FILTER (regexp_matches(nxt, '^[0-9]')) AS digits"
    )
    parts = []
    for k in range(LEVELS):
        at = f"(SELECT host, template, blocked, segs[{k + 1}] AS seg, segs[{k + 2}] AS nxt FROM t{k} WHERE len(segs) > {k})"
        parts.append(
            f"""w{k} AS MATERIALIZED (
    SELECT host, template, {counts} FROM {at} GROUP BY ALL
), b{k} AS MATERIALIZED (
    SELECT host, template, seg, {counts} FROM {at} GROUP BY ALL
), k{k} AS MATERIALIZED (
    SELECT b.host, b.template, b.seg FROM b{k} b JOIN w{k} w USING (host, template)
    WHERE b.urls >= {FEW} AND b.seg <> '{WILDCARD}' AND b.urls * {ONE_IN} >= w.urls
      AND (b.urls = w.urls OR {signs})
), t{k + 1} AS MATERIALIZED (
    SELECT page_id, host, path, rule, blocked, segs, CASE WHEN len(segs) > {k}
               THEN list_append(template, coalesce(kept, '{WILDCARD}')) ELSE template END AS template
    FROM t{k} LEFT JOIN (SELECT host AS kh, template AS kt, seg AS kept FROM k{k}) x
      ON host = kh AND template = kt AND segs[{k + 1}] = kept
)"""
        )
    return ", ".join(parts)


def _rules_sql() -> str:
    ordered = sorted(RULES, key=lambda r: -len(r.host + r.path))
    fits = lambda r: f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')"
    return "CASE " + " ".join(f"WHEN {fits(r)} THEN '{r.verdict} {r.host}{r.path}'" for r in ordered) + " END"


def _shares_sql() -> str:
    """The shares from the whole table down, a column for each level."""
    step = lambda k: (
        f"CASE WHEN len(template) >= {k} THEN (node[{k + 1}].blocked + {WEIGHT}::DOUBLE * s{k - 1}) / (node[{k + 1}].labelled + {WEIGHT}::DOUBLE) "
        f"ELSE s{k - 1} END AS s{k}"
    )
    return ", ".join(step(k) for k in range(LEVELS + 1))


URL_SQL = rf"""
WITH cut AS (
    SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), page AS (
    SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM cut
), t0 AS MATERIALIZED (
    SELECT page_id, host, path, split_part(r, ' ', 2) AS rule, starts_with(r, 'block') AS blocked, segs, []::VARCHAR[] AS template
    FROM (SELECT *, {_rules_sql()} AS r,
                 CASE WHEN path = '' THEN [] WHEN len(string_split(path, '/')) <= {LEVELS + 1} THEN string_split(path, '/')[2:]
                      ELSE list_append(string_split(path, '/')[2:{LEVELS}], array_to_string(string_split(path, '/')[{LEVELS + 1}:], '/')) END AS segs
          FROM page)
), {_levels_sql()}, leaf AS (
    SELECT host, template, count(blocked) AS labelled, coalesce(sum(blocked::INT), 0)::BIGINT AS blocked FROM t{LEVELS} GROUP BY ALL
), above AS (
    SELECT *, template[1:k] AS prefix FROM (SELECT *, unnest(range(0, len(template) + 1)) AS k FROM leaf)
), branch AS (
    SELECT host, prefix, sum(labelled)::BIGINT AS labelled, sum(blocked)::BIGINT AS blocked FROM above GROUP BY ALL
), line AS (
    SELECT host, template, list({{'labelled': branch.labelled, 'blocked': branch.blocked}} ORDER BY k) AS node
    FROM above JOIN branch USING (host, prefix) GROUP BY ALL
), prior AS (
    SELECT (coalesce(sum(blocked::INT), 0) + 1)::DOUBLE / (count(blocked) + 2) AS p FROM t{LEVELS}
), share AS (
    SELECT host, template, p AS s_, {_shares_sql().replace("s-1", "s_")} FROM line, prior
)
SELECT page_id, t.host, path, rule, CASE WHEN coalesce(blocked, s{LEVELS} > {LIMIT}) THEN 'block' ELSE 'allow' END AS verdict,
       array_to_string(list_transform(t.template, lambda x: '/' || x), '') AS template
FROM t{LEVELS} t JOIN share ON share.host = t.host AND share.template = t.template
"""

