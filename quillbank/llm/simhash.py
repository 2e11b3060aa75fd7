"""SimHash near-duplicates with vantage-point trees over Hamming distance.

1. Each whole text gets a 64-bit fingerprint; equal fingerprints are grouped first, so a group of exact
   copies is one point from then on.
2. A vantage-point tree over a bounded sample of points (`SAMPLE`) cuts the space into shards: a node
   holds a vantage point and the median distance to it. A point within the median belongs to the inner branch, any
   other to the outer one. By the triangle inequality a point's links can lie in the other branch only if its own
   distance is within the link distance of the median: it visits that branch too. Linked points visit each other's
   shards, so visiting only shards of a higher number finds each link once.
3. Inside a shard the same tree, grown further, prunes in the same way; leaves compare exactly. A shard
   returns a spanning star for each of its groups, not all pairs: a group of thousands of near copies makes as
   many rows as it has points, and no link between groups is lost.
4. Connected components over the stars: alternating large-star and small-star steps.

Distances between random fingerprints crowd around 32 bits, so a level of the tree prunes about a fifth: the
comparisons grow with the number of distinct fingerprints to the power 1.7.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from quillbank.llm.frames import Shared, attach, cut, slices, unpacked

SHINGLE = 3
MAX_BITS = 3
SEED = 42
#: Distinct fingerprints that choose vantage points, at most; all fingerprints are indexed.
SAMPLE = 1 << 14
#: Points a shard is meant to own; the number of shards follows the number of points.
SHARD_POINTS = 4096
#: Points below which a node inside a shard compares directly.
LEAF_POINTS = 256
#: Comparisons made at once.
BLOCK = 1 << 17


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Majority bits of the XXH64 hashes of all word shingles; 0 for a text without words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    n = max(1, len(words) - shingle + 1)
    starts = np.concatenate([[0], ends[: n - 1] + 1]).tolist()
    stops = ends[-n:].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, stops)], dtype="<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        part = hashes[at : at + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def with_fingerprint(documents: DataFrame, shingle: int = SHINGLE, keep: list[str] | None = None) -> DataFrame:
    """`documents` packed by `attach`, with `found.fingerprint` as a bigint of the same bits."""

    def work(batches: Iterator[dict[str, pa.Array]]) -> Iterator[pa.Array]:
        for batch in batches:
            values = np.array([fingerprint(t, shingle) for t in slices(batch["text"])], np.uint64).view(np.int64)
            yield pa.StructArray.from_arrays([pa.array(values)], ["fingerprint"])

    return attach(documents, ["text"], work, "fingerprint bigint", keep)


# Vantage-point trees

def distance(points: np.ndarray, vantage: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ vantage)


def split(points: np.ndarray) -> tuple[np.uint64, int] | None:
    """The vantage point and median distance that spread `points` best, of a few candidates; None if they all coincide."""
    best = None
    for vantage in points[:: max(1, len(points) // 8)][:8]:
        d = distance(points, vantage)
        middle = int(np.median(d))
        if int(d.max()) > middle:
            spread = float(d.std())
            if best is None or spread > best[0]:
                best = (spread, vantage, middle)
    return best and best[1:]


def grow(points: np.ndarray, levels: int) -> tuple | None:
    """A tree as nested (vantage, middle, inner, outer); a shard is None."""
    node = split(points) if levels and len(points) > 1 else None
    if node is None:
        return None
    inside = distance(points, node[0]) <= node[1]
    return (*node, grow(points[inside], levels - 1), grow(points[~inside], levels - 1))


def leaves(tree: tuple | None) -> int:
    return 1 if tree is None else leaves(tree[2]) + leaves(tree[3])


def visits(tree: tuple | None, points: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(shard, indices of the points that visit it, whether it is their own)."""

    def walk(node, first, at, own):
        if node is None:
            yield first, at, own
            return
        vantage, middle, inner, outer = node
        d = distance(points[at], vantage).astype(np.int16)
        for child, start, home, near in (
            (inner, first, d <= middle, d - radius <= middle), (outer, first + leaves(inner), d > middle, d + radius > middle),
        ):
            if near.any():
                yield from walk(child, start, at[near], (own & home)[near])

    yield from walk(tree, 0, np.arange(len(points)), np.ones(len(points), bool))


class Groups:
    """Groups of numbers that are joined pair by pair, many pairs at once."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self, at: np.ndarray) -> np.ndarray:
        up = self.parent[at]
        while (higher := self.parent[up] != up).any():
            up = np.where(higher, self.parent[up], up)
        return up

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            ra, rb = self.roots(a), self.roots(b)
            apart = ra != rb
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(self.parent, np.maximum(ra, rb), np.minimum(ra, rb))


def link(points: np.ndarray, owned: np.ndarray, radius: int) -> np.ndarray:
    """The root of each point's group, given all links between an owned point and any point of the shard."""
    groups = Groups(len(points))

    def compare(mine, asking):
        step = max(1, BLOCK // max(1, len(mine)))
        for at in range(0, len(asking), step):
            some = asking[at : at + step]
            near = np.bitwise_count(points[some][:, None] ^ points[mine][None, :]) <= radius
            a, b = np.nonzero(near)
            groups.join(some[a], mine[b])

    def search(mine, asking):
        node = split(points[mine]) if len(mine) > LEAF_POINTS and len(asking) else None
        if node is None:
            compare(mine, asking)
            return
        d, q = distance(points[mine], node[0]), distance(points[asking], node[0]).astype(np.int16)
        search(mine[d <= node[1]], asking[q - radius <= node[1]])
        search(mine[d > node[1]], asking[q + radius > node[1]])

    search(np.flatnonzero(owned), np.arange(len(points)))
    return groups.roots(np.arange(len(points)))


STAR = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def stars(points: DataFrame, radius: int, shard_points: int = SHARD_POINTS) -> DataFrame:
    """Links (a, b) that join all points of `points` (distinct bigint `fingerprint`) within `radius` bits of each other."""
    spark = points.sparkSession
    n = points.count()
    rows = points.select("fingerprint").orderBy(F.xxhash64("fingerprint"), "fingerprint").limit(SAMPLE).collect()
    sample = np.array([r[0] for r in rows], np.int64).view(np.uint64)
    levels = max(0, math.ceil(math.log2(max(1, n) / shard_points)))
    shared = Shared(spark, grow(sample, levels))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = shared.get()
        for batch in batches:
            values = batch.column(0).to_numpy()
            found = list(visits(tree, values.view(np.uint64), radius))
            own = np.zeros(len(values), np.int64)
            for shard, at, home in found:
                own[at[home]] = shard
            for shard, at, home in found:
                keep = shard >= own[at]
                if keep.any():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(keep.sum(), shard, np.int32)), pa.array(values[at[keep]]), pa.array(home[keep])],
                        names=["shard", "fingerprint", "own"],
                    )

    def shard_links(group: pa.Table) -> pa.Table:
        values = group.column("fingerprint").to_numpy()
        order = np.argsort(values, kind="stable")
        values = values[order]
        root = link(values.view(np.uint64), group.column("own").to_numpy()[order], radius)
        joined = root != np.arange(len(values))
        return pa.table([pa.array(values[joined]), pa.array(values[root[joined]])], schema=STAR)

    routed = points.select("fingerprint").mapInArrow(route, "shard int, fingerprint bigint, own boolean")
    return routed.groupBy("shard").applyInArrow(shard_links, "a bigint, b bigint")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node in `links` (a, b): the least node it is connected with.

    Large-star and small-star steps in turns until nothing changes. Each step reduces by key on the map side and
    joins one row a key back, so a hub is never gathered in one task.
    """

    def least(df):
        return df.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))

    def state(df):
        return df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    pairs = links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    pairs = cut(pairs.distinct())
    before = state(pairs)
    while before[0]:
        both = pairs.union(pairs.select("v", "u"))
        large = both.join(least(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        mins = least(large)
        small = large.join(mins, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(mins.select("u", F.col("m").alias("v"))).where("u != v")
        pairs = cut(small.distinct())
        now = state(pairs)
        if now == before:
            break
        before = now
    nodes = pairs.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
    return nodes.union(pairs.select("v", F.col("v").alias("root")).distinct())


def _classes(marked: DataFrame, max_bits: int, shard_points: int) -> DataFrame:
    """(fingerprint, root, component_id), one row for each fingerprint in `marked` (doc_id, fingerprint)."""
    points = cut(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("least_id")))
    roots = cut(components(stars(points, max_bits, shard_points)))
    classes = points.join(roots, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "least_id", F.coalesce("root", "fingerprint").alias("root")
    )
    ids = classes.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return classes.join(ids, "root").select("fingerprint", "root", "component_id")


def _marked(documents: DataFrame, shingle: int) -> DataFrame:
    return unpacked(with_fingerprint(documents.select("doc_id", "text"), shingle, ["doc_id"]))


def near_duplicates(
    documents: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, shard_points: int = SHARD_POINTS
) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of `documents`.

    Fingerprints that differ in at most `max_bits` bits link; component_id is the smallest doc_id reachable.
    Null and empty texts have fingerprint 0 and link like any other. A null doc_id gets its component's id but
    never is one, unless all its members are null. Repeated rows each get their result.
    """
    marked = cut(_marked(documents, shingle))
    return marked.join(_classes(marked, max_bits, shard_points).drop("root"), "fingerprint").select(
        "doc_id", "fingerprint", "component_id"
    )


def one_of_each(
    documents: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, shard_points: int = SHARD_POINTS
) -> DataFrame:
    """The rows of `documents`, all columns, whose doc_id is the smallest of its component.

    Of repeated rows of that doc_id one stays. Where a component has no ids at all, one row of it stays.
    """
    classes = cut(_classes(cut(_marked(documents, shingle)), max_bits, shard_points))
    stays = classes.where("component_id IS NOT NULL").select(F.col("component_id").alias("stays")).distinct()
    kept = documents.join(stays, documents["doc_id"] == stays["stays"], "left_semi").dropDuplicates(["doc_id"])
    nameless = with_fingerprint(documents.where("doc_id IS NULL"), shingle).alias("d")
    lone = classes.where("component_id IS NULL").select("fingerprint", "root")
    lone = nameless.join(lone, F.col("d.found.fingerprint") == lone["fingerprint"]).dropDuplicates(["root"])
    return kept.union(lone.select("d.row.*"))
