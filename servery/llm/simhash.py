"""Near-duplicates by SimHash and a hierarchical index in Gray order.

Fingerprints are sorted by their rank in the Gray code, where neighbours share most of their
bits, and cut into blocks of bounded size. A node of the index stands for a run of consecutive
fingerprints: its mask has the bits in which all of them agree, its pattern the values of those
bits. A query that differs from the pattern in more bits than the radius cannot be near any
member, so the whole run is pruned; a child repeats its parent's bits and adds more, so the
differences add up on the way down.

The upper nodes are the blocks: each fingerprint is sent to the blocks it may have neighbours in.
The lower nodes live in the task that searches a block. Links inside a block are contracted to a
forest before they leave it, so a large group of near copies gives as many rows as members, and
the forests are joined by alternating star contraction.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import accumulate

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from servery.llm.common import stored

#: Differing bits at which two fingerprints are linked.
RADIUS = 2
SHINGLE = 3
SEED = 42
#: Fingerprints in a block, as long as ``MOST_BLOCKS`` suffice; then blocks grow instead, which
#: bounds the table of blocks that every task gets.
BLOCK = 4096
MOST_BLOCKS = 1 << 16
FAN_OUT = 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of the word shingles of a whole text, repeats included; 0 without a word."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII space only
    if not found:
        return 0
    joined = b" ".join(found)
    ends = list(accumulate(len(w) + 1 for w in found))
    starts = [0, *ends[:-1]]
    digest, seed = xxhash.xxh64_intdigest, SEED
    hashes = [digest(joined[s : e - 1], seed) for s, e in zip(starts, ends[shingle - 1 :])] or [digest(joined, seed)]
    h = np.array(hashes, dtype="<u8")
    counts = np.zeros(64, np.int64)
    for at in range(0, len(h), 8192):  # a bounded table of bits, however long the text
        part = h[at : at + 8192]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(h), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, text: str = "text") -> DataFrame:
    """doc_id and ``fp``, the 64 bits as a long, of every row."""

    def compute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fps = [fingerprint(t, shingle) for t in batch.iloc[:, 1]]
            yield pd.DataFrame({"doc_id": batch.iloc[:, 0], "fp": np.array(fps, np.uint64).view(np.int64)})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col(text).alias("text")).mapInPandas(compute, f"doc_id {kind}, fp long")


def gray_rank(fp: Column) -> Column:
    """The place of a code word in the Gray code; as a signed long that sorts like it."""
    rank = fp
    for bits in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, bits))
    return rank.bitwiseXOR(F.lit(-(2**63)))


def _gray_rank(fps: np.ndarray) -> np.ndarray:
    rank = fps.copy()
    for bits in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(bits)
    return rank


class Nodes:
    """Levels of nodes over runs of fingerprints in Gray order, the widest first. Each level has
    the agreeing bits (mask) and their values (pattern) of runs of equal length."""

    def __init__(self, ones: np.ndarray, some: np.ndarray) -> None:
        """``ones`` and ``some``: AND and OR of the fingerprints of each lowest node."""
        self.levels = [(ones & some, ~(ones ^ some))]
        while len(ones) > FAN_OUT:
            starts = np.arange(0, len(ones), FAN_OUT)
            ones, some = np.bitwise_and.reduceat(ones, starts), np.bitwise_or.reduceat(some, starts)
            self.levels.insert(0, (ones, ~(ones ^ some)))

    def near(self, queries: np.ndarray, radius: int, lead: int = 64) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of queries and of the lowest nodes that each may have neighbours in; where
        those are single fingerprints, does have. In the ``lead`` first bits only as many may
        differ as fall to them when the differences are dealt out evenly."""
        first, share = np.uint64((1 << 64) - (1 << (64 - lead))), radius // (64 // lead)
        width = len(self.levels[0][0])
        q, node = np.repeat(np.arange(len(queries)), width), np.tile(np.arange(width), len(queries))
        for depth, (pattern, mask) in enumerate(self.levels):
            if depth:
                q, node = np.repeat(q, FAN_OUT), (node[:, None] * FAN_OUT + np.arange(FAN_OUT)).ravel()
                q, node = q[node < len(pattern)], node[node < len(pattern)]
            differs = (queries[q] ^ pattern[node]) & mask[node]
            keep = np.bitwise_count(differs) <= radius
            if lead < 64:
                keep &= np.bitwise_count(differs & first) <= share
            q, node = q[keep], node[keep]
        return q, node


def _roots(n: int, a: np.ndarray, b: np.ndarray, label: np.ndarray | None = None) -> np.ndarray:
    """For each of n nodes the smallest that links (a, b) lead to."""
    label = np.arange(n) if label is None else label
    while True:
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        if (low == high).all():
            return label
        np.minimum.at(label, high, low)
        while (label != label[label]).any():
            label = label[label]


def forest(owned: np.ndarray, visitors: np.ndarray, radius: int, lead: int = 64, step: int = 2048) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is connected by pairs within ``radius``, one of each pair being
    owned; a fingerprint and the first of its group."""
    owned = owned[np.argsort(_gray_rank(owned), kind="stable")]
    nodes, everyone = Nodes(owned, owned), np.concatenate([owned, visitors])
    label = np.arange(len(everyone))
    for at in range(0, len(everyone), step):
        q, near = nodes.near(everyone[at : at + step], radius, lead)
        label = _roots(len(everyone), q + at, near, label)
    moved = label != np.arange(len(everyone))
    return everyone[moved], everyone[label[moved]]


def links(fps: DataFrame, radius: int = RADIUS, turns: int = 1) -> DataFrame:
    """Links ``a``, ``b`` whose connected components are those of all pairs of fingerprints
    within ``radius``. ``fps`` has the distinct ``fp``, stored.

    For a wide radius the index is built ``turns`` times, each with another stretch of the bits
    in front: of ``turns`` stretches one has no more than its share of the differences, so a pair
    is found in some turn although each prunes by that share.
    """
    found = [_links(_turned(fps, 64 // turns * k), radius, 64 // turns) for k in range(turns)]
    back = [
        part.select(*[_turn(F.col(c), (64 - 64 // turns * k) % 64).alias(c) for c in ("a", "b")])
        for k, part in enumerate(found)
    ]
    return reduce(DataFrame.unionByName, back)


def _turn(fp: Column, bits: int) -> Column:
    return F.shiftleft(fp, bits).bitwiseOR(F.shiftrightunsigned(fp, 64 - bits)) if bits else fp


def _turned(fps: DataFrame, bits: int) -> DataFrame:
    return fps.select(_turn(F.col("fp"), bits).alias("fp"))


def _links(fps: DataFrame, radius: int, lead: int) -> DataFrame:
    n = fps.count()
    size = max(BLOCK, -(-n // MOST_BLOCKS))
    ranges = max(1, min(n // (4 * size), MOST_BLOCKS))
    place = F.monotonically_increasing_id()  # partition and row in it, in sorted order
    inside = place.bitwiseAND(F.lit((1 << 33) - 1))
    blocks = stored(
        fps.select("fp")
        .repartitionByRange(ranges, gray_rank(F.col("fp")))
        .sortWithinPartitions(gray_rank(F.col("fp")))
        .select("fp", (place - inside + F.floor(inside / size)).cast("long").alias("block")),
        "gray",
    )
    # One row for each block: n / BLOCK or MOST_BLOCKS of them, and one for each range, at most.
    upper = blocks.groupBy("block").agg(F.bit_and("fp").alias("ones"), F.bit_or("fp").alias("some"))
    upper = upper.toPandas().sort_values("block")
    shared = fps.sparkSession.sparkContext.broadcast(
        (
            upper["block"].to_numpy(np.int64),
            Nodes(upper["ones"].to_numpy(np.int64).view(np.uint64), upper["some"].to_numpy(np.int64).view(np.uint64)),
        )
        if n
        else None
    )

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, nodes = shared.value or (None, None)
        for batch in batches:
            for at in range(0, len(batch), 2048):
                fp = batch["fp"].to_numpy(np.int64)[at : at + 2048]
                own = np.searchsorted(ids, batch["block"].to_numpy(np.int64)[at : at + 2048])
                q, target = nodes.near(fp.view(np.uint64), radius, lead)
                # Of two blocks one visits the other, by turns.
                visits = (target != own[q]) & (((target + own[q]) % 2 == 0) == (own[q] < target))
                q, target = q[visits], target[visits]
                # A row for each block that is met holds all that goes there.
                for to, what, owned in ((own, fp, True), (target, fp[q], False)):
                    order = np.argsort(to, kind="stable")
                    met, starts = np.unique(to[order], return_index=True)
                    parts = np.split(what[order], starts[1:]) if len(met) else []
                    yield pd.DataFrame({"block": ids[met], "fps": [x.tobytes() for x in parts], "owned": owned})

    def search(group: pd.DataFrame) -> pd.DataFrame:
        parts = lambda rows: np.frombuffer(b"".join(rows), np.uint64)
        a, b = forest(parts(group["fps"][group["owned"]]), parts(group["fps"][~group["owned"]]), radius, lead)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    sent = blocks.mapInPandas(send, "block long, fps binary, owned boolean")
    return sent.groupBy("block").applyInPandas(search, "a long, b long")


def components(edges: DataFrame, most_rounds: int = 50) -> DataFrame:
    """``node``, ``root`` for each node of the links ``a``, ``b``: the smallest node reachable.

    Alternates large-star and small-star contraction (Kiveris et al., 2014), which takes
    logarithmically many rounds. A star's centre is found by an aggregate that combines before
    the shuffle, and detached from its grouping, so that a join on a large centre can be split.
    """
    edges = stored(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    for _ in range(most_rounds):
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b") % 1_000_003).alias("h")).first()
        if state == before or not state["n"]:
            break
        before = state
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        centre = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(centre.hint("rebalance"), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        centre = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(centre.hint("rebalance"), "a").select(F.explode(F.array(F.struct("b", "m"), F.struct(F.col("a").alias("b"), "m"))).alias("e"))
        small = small.select(F.col("e.b").alias("a"), F.col("e.m").alias("b")).where("a != b").distinct()
        edges = stored(small, "links")
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, turns: int = 1) -> DataFrame:
    """doc_id, ``fp`` and ``component_id`` of every row: the smallest doc_id among the rows that
    links lead to. Texts without a word, NULL among them, have fingerprint 0 and are linked like
    any others. Ids that are NULL name no component; a component with no other id has NULL.
    Repeated rows stay repeated."""
    rows = stored(fingerprints(docs, shingle), "fingerprints")
    fps = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    roots = components(links(fps, radius, turns))
    rooted = fps.join(roots, fps.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    by_fp = rooted.join(least.hint("rebalance"), "root").select(F.col("fp").alias("_fp"), "component_id")
    return rows.join(by_fp, F.col("fp") == F.col("_fp")).select("doc_id", "fp", "component_id")


def deduplicated(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, turns: int = 1) -> DataFrame:
    """One row of each group of near-duplicates, the one of the smallest doc_id; of repeated
    ids any one row. Rows without an id belong to no group and stay."""
    found = stored(near_duplicates(docs.where("doc_id IS NOT NULL"), radius, shingle, turns), "groups")
    first = found.where("doc_id = component_id").select("doc_id")
    counted = first.groupBy("doc_id").count()
    once, often = counted.where("count = 1").select("doc_id"), counted.where("count > 1").select("doc_id")
    return (
        docs.join(once, "doc_id", "left_semi")
        .unionByName(docs.join(often, "doc_id", "left_semi").dropDuplicates(["doc_id"]))
        .unionByName(docs.where("doc_id IS NULL"))
    )


def simhash_digest(docs: DataFrame) -> DataFrame:
    """Of each document its fingerprint in hexadecimal digits and its component."""
    return near_duplicates(docs).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
