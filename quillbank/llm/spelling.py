"""Spelling variant grouping: words that differ by one code point, found by dense tiles of common prefixes and suffixes.

1. The vocabulary: words of whole texts with their occurrences, counted in each task before they are shuffled.
2. Two words are one edit apart exactly if their common prefix and suffix reach together the longer length less one. For a
   shorter length c, cut c in two halves: an edit leaves the first half equal in both words or, failing that, the last
   half. So each word stands in a group for each half, once as the shorter (c its length) and once as the longer word
   (c its length less one), and a pair meets in exactly one group: by its first half if that is equal, else by its last.
3. A group of more than `TILE` words is cut once more: what lies between the shared prefix and suffix is halved in the same
   way, which makes two smaller groups of it. That goes on until groups fit, so a beginning that a third of all words
   share is dealt to many tasks, and the comparisons grow with the words, not with their square.
4. Groups are tiles: padded matrices of code points, one with words to the left, one with words to the right. The block
   pairs of a tile are compared at once; the first difference from each side gives the common prefix and suffix.
5. A word's form is its near word of most occurrences, if it has `FACTOR` times the word's own. Following forms, whose
   occurrences grow by that factor each time, ends after a number of steps that the largest count bounds; pointers
   double, so the joins are the logarithm of that.

Defined results: a null text has no words, an empty one neither; a null id counts as the empty string before the colon; rows
that repeat count again; words may be of any length; equal counts are decided by code points; empty tables give no rows.
Extra columns of any name are not read.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quillbank.llm.frames import cut, slices

LEAST_LENGTH = 7
LEAST_COUNT = 2
#: How much more often a form must occur.
FACTOR = 10
#: A word of a document loses a code point if this number divides a hash of both.
NOISE = 31
#: Words of a group, at most, unless all that lies between their shared ends is one code point (two in longer words).
TILE = 1024
#: Code points of a group, at most, as above.
TILE_POINTS = 1 << 20
#: Words that are compared against as many others at once; cells of a comparison.
SIDE = 64
CELLS = 1 << 24
#: Words that a task counts before it sends them on.
HELD = 1 << 19

#: One byte a code point: letters stay, A-Z in lower case; all else parts words.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))


def runs(text: bytes) -> list[bytes]:
    """Maximal runs of A-Z, a-z and U+00C0 to U+00FF with A-Z lower-cased, in Latin-1: a byte is a code point."""
    if not text.isascii():
        text = text.decode("utf-8", "replace").encode("latin-1", "replace")
    return text.translate(_LETTERS).split()


def damaged(run: bytes, prefix: int, noise: int = NOISE) -> bytes:
    """The run, without one code point if `noise` divides the crc32 that goes on from `prefix`, the one of `<doc_id>:`."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), prefix)
    if h % noise:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def vocabulary(documents: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, noise: int = NOISE) -> DataFrame:
    """(word, n) of `documents` (doc_id, text): words of at least `least_length` code points with `least_count` occurrences."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def out():
            held = list(counts.items())
            counts.clear()
            for k in range(0, len(held), 10_000):
                words, n = zip(*held[k : k + 10_000])
                yield pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in words], pa.string()), pa.array(n, pa.int64())], names=["word", "n"])

        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), slices(batch.column(1))):
                prefix = zlib.crc32(f"{'' if i is None else i}:".encode())
                for run, n in Counter([r for r in runs(text) if len(r) >= least_length]).items():
                    word = damaged(run, prefix, noise)
                    if len(word) >= least_length:
                        counts[word] += n
                if len(counts) > HELD:
                    yield from out()
        yield from out()

    counted = documents.select("doc_id", "text").mapInArrow(work, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _keyed(rows: DataFrame) -> DataFrame:
    """Adds the key of a group: what its words share. Equal hashes only make a group larger."""
    return rows.withColumn("key", F.expr("xxhash64(path, c, left(word, p), right(word, s))"))


def halved(rows: DataFrame) -> DataFrame:
    """Each row in its two smaller groups: with half of what lies between added to the shared prefix, or the rest of it to
    the suffix. A pair of the second group doesn't share the longer prefix: its common prefix is shorter than `below`."""
    a = "(c - p - s) div 2"
    children = f"array(struct(2 * path AS path, p + {a} AS p, s AS s, below AS below), struct(2 * path + 1 AS path, p AS p, c - p - {a} AS s, p + {a} AS below))"
    return _keyed(rows.selectExpr("word", "n", "c", f"explode({children}) AS x").selectExpr("word", "n", "c", "x.path", "x.p", "x.s", "x.below"))


def groups(words: DataFrame, tile: int = TILE, tile_points: int = TILE_POINTS) -> DataFrame:
    """Rows (word, n, c, path, p, s, below, key) of all groups, each small enough for a tile."""
    start = words.selectExpr("word", "n", "explode(array(char_length(word), char_length(word) - 1)) AS c").where("c > 0")
    rows = cut(halved(start.selectExpr("*", "1L AS path", "0 AS p", "0 AS s", "c + 1 AS below")))
    out = None
    while True:
        sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.sum(F.col("c") + 1).alias("points"), F.max(F.expr("c - p - s")).alias("between"))
        hot = cut(sizes.where(f"between > 1 AND (size > {tile} OR points > {tile_points} AND size > 2)").select("key"))
        if hot.isEmpty():
            return rows if out is None else out.unionByName(rows)
        fit = rows.join(hot, "key", "left_anti")
        out = fit if out is None else out.unionByName(fit)
        rows = cut(halved(rows.join(hot, "key", "left_semi")))


def matrices(words: list[str], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths and the padded code points of words, to the left and to the right."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    points = points.astype(np.uint8) if not len(points) or points.max() < 256 else points
    row = np.repeat(np.arange(len(words)), size)
    at = np.arange(len(points)) - np.repeat(np.cumsum(size) - size, size)
    left, right = np.zeros((len(words), width), points.dtype), np.zeros((len(words), width), points.dtype)
    left[row, at] = points
    right[row, at + np.repeat(width - size, size)] = points
    return size, left, right[:, ::-1]


def tile_pairs(words: list[str], c: int, p: np.ndarray, s: np.ndarray, below: np.ndarray, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Near pairs (i, j) of groups of equal size: `members` holds a group's places in `words` in each row, words of length c first.
    The first of a pair is one of these."""
    flat = members.ravel()
    size, left, right = matrices([words[k] for k in flat], c + 1)
    n_groups, g = members.shape
    shape = (n_groups, g)
    size, left, right = size.reshape(shape), left.reshape(*shape, -1), right.reshape(*shape, -1)
    p, s, below = (x[members[:, 0]][:, None, None] for x in (p, s, below))
    step, shorter = SIDE, int((size == c).sum(axis=1).max(initial=0))
    many = max(1, CELLS // (min(step, g) ** 2 * (c + 1)))
    found_i, found_j = [], []
    for top in range(0, n_groups, many):
        some = slice(top, top + many)
        for a in range(0, g, step):
            for b in range(a, g, step):
                rows, columns = slice(a, a + step), slice(b, b + step)
                la, lb = size[some, rows, None], size[some, None, columns]
                prefix = (left[some, rows, None] != left[some, None, columns]).argmax(axis=-1)
                suffix = (right[some, rows, None] != right[some, None, columns]).argmax(axis=-1)
                near = (prefix + suffix >= np.maximum(la, lb) - 1) & (np.minimum(la, lb) == c) & (prefix < below[some]) & (prefix >= p[some]) & (suffix >= s[some])
                if a == b:
                    near &= np.triu(np.ones((near.shape[1], near.shape[2]), bool), 1)
                k, i, j = np.nonzero(near)
                found_i.append(members[top + k, a + i])
                found_j.append(members[top + k, b + j])
    return np.concatenate([np.zeros(0, np.int64), *found_i]), np.concatenate([np.zeros(0, np.int64), *found_j])


def near_words(words: DataFrame, tile: int = TILE, tile_points: int = TILE_POINTS) -> DataFrame:
    """(word, near, near_n): every pair of words of `words` (word, n) one code point apart, both ways round, once each."""
    rows = groups(words, tile, tile_points)

    def pairs(table: pa.Table) -> Iterator[pa.RecordBatch]:
        """Of whole groups, sorted by key."""
        key = table.column("key").to_numpy()
        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        sizes = np.diff(np.append(starts, len(key)))
        c, p, s, below = (table.column(x).to_numpy() for x in ("c", "p", "s", "below"))
        texts = table.column("word").to_pylist()
        for g, length in sorted(set(zip(sizes.tolist(), c[starts].tolist()))):
            if g == 1:
                continue
            first = starts[(sizes == g) & (c[starts] == length)]
            i, j = tile_pairs(texts, length, p, s, below, first[:, None] + np.arange(g))
            both, other = np.concatenate([i, j]), np.concatenate([j, i])
            for k in range(0, len(both), 10_000):
                yield pa.RecordBatch.from_arrays([
                    pa.array([texts[x] for x in both[k : k + 10_000]], pa.string()), pa.array([texts[x] for x in other[k : k + 10_000]], pa.string()),
                    pa.array(table.column("n").to_numpy()[other[k : k + 10_000]]),
                ], names=["word", "near", "near_n"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch.column(0).to_numpy()
            last = int(np.searchsorted(key, key[-1]))
            if last or held and held[-1].column(0)[-1].as_py() != key[0]:
                yield from pairs(pa.Table.from_batches([*held, batch.slice(0, last)]))
                held = [batch.slice(last)]
            else:
                held.append(batch)
        if held:
            yield from pairs(pa.Table.from_batches(held))

    sorted_rows = rows.select("key", "word", "n", "c", "p", "s", "below").repartition("key").sortWithinPartitions("key", F.char_length("word"))
    return sorted_rows.mapInArrow(work, "word string, near string, near_n bigint")


def roots(forms: DataFrame, most: int) -> DataFrame:
    """(word, root): the last form that following `forms` (word, form) comes to. `most` is the largest count of a word."""
    links = cut(forms.select("word", F.col("form").alias("root")))
    steps = max(1, math.ceil(math.log(max(most, FACTOR), FACTOR)))
    for _ in range(math.ceil(math.log2(steps)) + 1):
        further = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        links = cut(links.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root")))
    return links


def variants(words: DataFrame, tile: int = TILE, tile_points: int = TILE_POINTS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every row of `words` (word, n); words are distinct and not null."""
    words = cut(words.select("word", "n"))
    best = near_words(words, tile, tile_points).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    frequent = F.col("best.less") <= -FACTOR * F.col("n")
    formed = cut(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(frequent, F.col("best.near")).alias("form"),
        F.when(frequent, -F.col("best.less")).alias("form_n")))
    most = words.agg(F.max("n")).first()[0] or 0
    last = roots(formed.where("form IS NOT NULL"), most)
    return formed.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
