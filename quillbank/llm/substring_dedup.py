"""Substring deduplication with a count-min prefilter.

A window is `WINDOW` words in a row of one document. A word goes if a window that covers it also starts in a document
with a smaller doc_id.

Documents are dealt to blocks by a hash of their id, once; three passes read the same blocks.

1. Every block counts its windows in a sketch of `ROWS` rows. It travels as the sorted cells it touched, ten to eighteen bits each;
   ranges of cells are added up in parallel over all blocks. A sketch only overestimates, so a window that is
   repeated anywhere has all its cells counted twice or more. Each block gets back a bit for each of its cells.
2. Windows with all bits set are grouped exactly by 96 bits of hash, a range of hashes at a time. Each block first reduces
   them to the smallest doc_id it holds, so a passage in a third of all documents sends one entry for each block.
3. The hashes that came out as repeated go to the blocks of their documents, which drop the covered words.

The width of the sketch follows the amount of text. No task and no broadcast holds more than one block, one range of cells
or one range of hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from quillbank.llm.frames import quoted, slices

WINDOW = 13
ROWS = 2
#: Windows a block is meant to have, and cells and hashes of suspects of a range, up to a sketch of 2 ** `GROWS_FROM` cells. Beyond, a
#: block grows by a bit for every three of the sketch and a range by one for every two, up to these many bits; else messages (one
#: for each block and range) would grow with the square of the text.
BLOCK_WINDOWS = 1 << 20
RANGE_CELLS = 1 << 23
GROWS_FROM = 33
BLOCK_GROWTH = 3
RANGE_GROWTH = 4
#: Cells for each window, and bytes of text taken as one window; both bear on speed only.
CELLS_A_WINDOW = 1.5
BYTES_A_WINDOW = 6
#: Words whose hashes a task remembers before it starts anew.
REMEMBERED = 1 << 18
FOUND = "n_words bigint, n_removed bigint, kept string, text string"

_FACTORS = np.random.default_rng(5).integers(0, 1 << 63, (ROWS, 64), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Hashes(dict):
    """Hashes by word, made when first asked for."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def windows(words: list[bytes], known: Hashes, window: int = WINDOW) -> np.ndarray:
    """Two independent 64-bit hashes of each window, shape (2, windows): sums of the words' hashes times fixed odd factors."""
    n = len(words) - window + 1
    if n < 1:
        return np.empty((ROWS, 0), np.uint64)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    out = np.zeros((ROWS, n), np.uint64)
    for row in range(ROWS):
        for j in range(window):
            out[row] += h[j : j + n] * _FACTORS[row, j]
        out[row] ^= out[row] >> np.uint64(32)
    return out


def cells(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The cells of the windows in one row of a sketch of 2 ** bits cells."""
    return ((hashes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


def pack(sorted_cells: np.ndarray, span: int) -> bytes:
    """Sorted cells below `span`: how many low bytes each has, these bytes, and a bit string in which ones count entries and zeros
    steps of the high part. The fewer cells, the more low bytes, so a message of few cells is short."""
    n = len(sorted_cells)
    width = min((1, 2, 3, 4), key=lambda w: n * (8 * w + 1) + (span >> 8 * w))
    high = np.zeros(n + (span >> 8 * width) + 1, bool)
    high[(sorted_cells >> 8 * width) + np.arange(n)] = True
    low = sorted_cells.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + low.tobytes() + np.packbits(high).tobytes()


def unpack(packed: bytes, span: int) -> np.ndarray:
    width = packed[0]
    n = (8 * (len(packed) - 1) - (span >> 8 * width) - 1) // (8 * width + 1)  # n times width bytes, and n + high + 1 bits rounded up to bytes
    low = np.zeros((n, 8), np.uint8)
    low[:, :width] = np.frombuffer(packed, np.uint8, n * width, 1).reshape(n, width)
    ones = np.flatnonzero(np.unpackbits(np.frombuffer(packed, np.uint8, offset=1 + n * width)))
    return low.view("<i8").ravel() + ((ones - np.arange(n)) << 8 * width)


def planes(values: np.ndarray) -> bytes:
    """The values byte by byte, all first bytes first: high bytes, mostly zero, then shrink well on the way."""
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def values_of(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, np.uint8).reshape(8, -1).T.copy().view(np.int64).ravel()


def steps(hashes: np.ndarray) -> bytes:
    """Sorted hashes by their distances, which are smaller numbers."""
    return planes(np.diff(hashes, prepend=np.uint64(0)))


def hashes_of(packed: bytes) -> np.ndarray:
    return np.cumsum(values_of(packed).view(np.uint64), dtype=np.uint64)


def _spans(hashes: np.ndarray, n: int) -> list[slice]:
    """For sorted hashes, the part of each of n (a power of two) equal ranges."""
    edges = np.searchsorted(hashes >> np.uint64(32), np.arange(1, n, dtype=np.uint64) * np.uint64((1 << 32) // n))
    return [slice(a, b) for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(hashes)])]


class Sizes:
    """How many blocks, cells and ranges an amount of text makes."""

    def __init__(self, text_bytes: int, window: int):
        expected = max(1, text_bytes // BYTES_A_WINDOW)
        self.window = window
        self.bits = max(10, math.ceil(math.log2(expected * CELLS_A_WINDOW)))
        beyond = max(0, self.bits - GROWS_FROM)
        self.blocks = -(-expected // (BLOCK_WINDOWS << min(BLOCK_GROWTH, -(-beyond // 3))))
        self.range_bits = min(self.bits, int(math.log2(RANGE_CELLS)) + min(RANGE_GROWTH, -(-beyond // 2)))
        self.spans = 1 << (self.bits - self.range_bits)

    def split(self, touched: np.ndarray) -> list[np.ndarray]:
        """Sorted cells by range, counted from the range's first."""
        edges = np.searchsorted(touched, np.arange(1, self.spans, dtype=np.int64) << self.range_bits)
        return [part & ((1 << self.range_bits) - 1) for part in np.split(touched, edges)]


def hashed(block: pa.Table, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, doc_id of each window) of the documents of a block that have an id."""
    known = Hashes()
    held, ids = [np.empty((ROWS, 0), np.uint64)], []
    for doc_id, text in zip(block.column("doc_id").to_pylist(), slices(block.column("text").combine_chunks())):
        if doc_id is not None:
            held.append(windows(text.split(), known, window))
            ids.append(doc_id)
    return np.concatenate(held, axis=1), np.repeat(np.array(ids, np.int64), [h.shape[1] for h in held[1:]])


def sketch(sizes: Sizes):
    """A block's part of the sketch: for each row and range that it touches, the packed cells."""

    def run(keys: tuple[pa.Scalar, ...], block: pa.Table) -> pa.Table:
        hashes, _ = hashed(block, sizes.window)
        out = []
        for row in range(ROWS):
            for k, part in enumerate(sizes.split(np.sort(cells(hashes[row], sizes.bits)))):
                if len(part):
                    out.append((keys[0].as_py(), row, k, pack(part, 1 << sizes.range_bits)))
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary()]
        return pa.table([pa.array([r[c] for r in out], t) for c, t in enumerate(kinds)], names=["block", "line", "span", "packed"])

    return run


def counted_twice(sizes: Sizes):
    """Adds up one range of cells and tells each block, in the order of its cells, which were counted twice or more."""
    span = 1 << sizes.range_bits

    def run(keys: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [r for batch in batches for r in zip(batch.column("block").to_pylist(), batch.column("packed").to_pylist())]
        once, twice = np.zeros(span, bool), np.zeros(span, bool)
        for _, packed in parts:
            at = unpack(packed, span)
            twice[at[1:][at[1:] == at[:-1]]] = True
            twice[at[once[at]]] = True
            once[at] = True
        masks = [np.packbits(twice[unpack(packed, span)]).tobytes() for _, packed in parts]
        line, k = (key.as_py() for key in keys)
        yield pa.RecordBatch.from_arrays(
            [pa.array([b for b, _ in parts], pa.int32()), pa.array([line] * len(parts), pa.int32()), pa.array([k] * len(parts), pa.int32()), pa.array(masks, pa.binary())],
            names=["block", "line", "span", "mask"],
        )

    return run


def suspects(sizes: Sizes):
    """Of each suspected window of a block, its smallest doc_id goes to the range of its hash; larger ones are decided here.

    Decided windows are dealt by hash and document, so that they don't pile up where the others of their hash go.
    """

    def run(block: pa.Table, masks: pa.Table) -> pa.Table:
        hashes, ids = hashed(block, sizes.window)
        told = {(r["line"], r["span"]): r["mask"] for r in masks.to_pylist()}
        doubtful = np.ones(hashes.shape[1], bool)
        for row in range(ROWS):
            touched = cells(hashes[row], sizes.bits)
            order = np.argsort(touched, kind="stable")
            seen = [
                np.unpackbits(np.frombuffer(told[row, k], np.uint8), count=len(part)).astype(bool)
                for k, part in enumerate(sizes.split(touched[order])) if len(part)
            ]
            if seen:
                doubtful[order] &= np.concatenate(seen)
        at = np.flatnonzero(doubtful)
        at = at[np.argsort(ids[at], kind="stable")]
        at = at[np.argsort(hashes[0, at], kind="stable")]
        a, b, d = hashes[0, at], (hashes[1, at] >> np.uint64(32)).astype(np.uint32), ids[at]
        new = np.ones(len(at), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        decided = ~new
        decided[1:] &= d[1:] != d[:-1]
        own_a, own_d = a[decided], d[decided]
        dealt = own_a ^ own_d.view(np.uint64) * _FACTORS[1, 0]
        order = np.argsort(dealt)
        own_a, own_d, dealt = own_a[order], own_d[order], dealt[order]
        a, b, d = a[new], b[new], d[new]
        out = [
            (k, steps(a[x]), b[x].tobytes(), planes(d[x]), own_a[y].tobytes(), planes(own_d[y]))
            for k, (x, y) in enumerate(zip(_spans(a, sizes.spans), _spans(dealt, sizes.spans))) if x.stop > x.start or y.stop > y.start
        ]
        kinds = [pa.int32(), *[pa.binary()] * 5]
        return pa.table([pa.array([r[c] for r in out], t) for c, t in enumerate(kinds)], names=["span", "a", "b", "d", "own_a", "own_d"])

    return run


def settle(keys: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows of a range of hashes whose document isn't the smallest of their hash, and the decided ones."""
    parts = [r for batch in batches for r in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "d", "own_a", "own_d")))]
    a = np.concatenate([hashes_of(r[0]) for r in parts])
    b = np.concatenate([np.frombuffer(r[1], np.uint32) for r in parts])
    d = np.concatenate([values_of(r[2]) for r in parts])
    order = np.lexsort((b, a))
    a, b, d = a[order], b[order], d[order]
    first = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))[: len(a)])
    late = d > np.repeat(np.minimum.reduceat(d, first), np.diff(np.append(first, len(a)))) if len(a) else np.zeros(0, bool)
    gone = np.concatenate([a[late], *[np.frombuffer(r[3], np.uint64) for r in parts]])
    ids = np.concatenate([d[late], *[values_of(r[4]) for r in parts]])
    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(gone.view(np.int64))], names=["doc_id", "a"])


def removal(sizes: Sizes):
    """The documents of a block with the words that stay."""

    def run(block: pa.Table, gone: pa.Table) -> pa.Table:
        order = np.argsort(ids := gone.column("doc_id").to_numpy(), kind="stable")
        ids, bad = ids[order], gone.column("a").to_numpy()[order].view(np.uint64)
        known = Hashes()
        out = []
        texts = block.column("text").combine_chunks()
        for k, (doc_id, text) in enumerate(zip(block.column("doc_id").to_pylist(), slices(texts))):
            words = text.split()
            total = len(words)
            here = slice(0, 0) if doc_id is None else slice(*np.searchsorted(ids, [doc_id, doc_id + 1]).tolist())
            if here.stop > here.start:
                covered = np.isin(windows(words, known, sizes.window)[0], bad[here])
                edges = np.zeros(total + 1, np.int64)
                edges[: len(covered)] += covered
                edges[sizes.window : sizes.window + len(covered)] -= covered
                words = [w for w, s in zip(words, (np.cumsum(edges[:total]) == 0).tolist()) if s]
            kept = b" ".join(words)
            out.append((total, total - len(words), kept, kept if len(words) < total else text if texts[k].is_valid else None))
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        cols = [pa.array([r[c] for r in out], t) for c, t in enumerate(kinds)]
        found = pa.StructArray.from_arrays([*cols[:2], cols[2].cast(pa.string()), cols[3].cast(pa.string())], ["n_words", "n_removed", "kept", "text"])
        return pa.table([block.column("row").combine_chunks(), found], names=["row", "found"])

    return run


def with_removal(documents: DataFrame, window: int = WINDOW, keep: list[str] | None = None) -> DataFrame:
    """Columns `row` (a struct of `keep`, all columns but text by default) and `found`: n_words, n_removed, `kept`, the words that
    stay, joined by one space, and `text`, which is `kept` where words went and else the text as it was.

    Words are parted by ASCII white space and stay unchanged. A null text has no words. A null doc_id is neither smaller nor larger
    than any: its row keeps all words and takes none from others. Rows that share a doc_id take nothing from each other.
    """
    keep = [c for c in documents.columns if c != "text"] if keep is None else keep
    size = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    sizes = Sizes(size, window)
    rows = documents.select(
        F.struct(*[F.col(quoted(c)).alias(c) for c in keep]).alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").alias("text")
    )
    dealt = lambda key: F.pmod(F.xxhash64(key), F.lit(sizes.blocks)).cast("int")
    rows = rows.withColumn("block", F.when(F.col("doc_id").isNotNull(), dealt("doc_id")).otherwise(dealt("text")))
    blocks = rows.groupBy("block")
    touched = blocks.applyInArrow(sketch(sizes), "block int, line int, span int, packed binary")
    masks = touched.groupBy("line", "span").applyInArrow(counted_twice(sizes), "block int, line int, span int, mask binary")
    doubtful = blocks.cogroup(masks.groupBy("block")).applyInArrow(
        suspects(sizes), "span int, a binary, b binary, d binary, own_a binary, own_d binary"
    )
    gone = doubtful.groupBy("span").applyInArrow(settle, "doc_id bigint, a bigint").withColumn("block", dealt("doc_id"))
    return blocks.cogroup(gone.groupBy("block")).applyInArrow(removal(sizes), T.StructType([
        T.StructField("row", rows.schema["row"].dataType), T.StructField("found", T.StructType.fromDDL(FOUND))
    ]))


def deduplicate(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """`documents` with the repeated words taken out of `text`; rows that lose none keep their text as it is."""
    found = with_removal(documents, window)
    return found.select(*[F.col("found.text") if c == "text" else F.col("row")[c].alias(c) for c in documents.columns])
