"""Benchmark decontamination with suffix arrays over the training documents.

Each task splits its documents into shards of a bounded number of words and builds a suffix array of each
shard over word numbers. Every suffix of the benchmark is binary-searched in it, one word deeper at a time,
which narrows the interval of training suffixes that share its words. An interval that is left after a whole
window gives all its occurrences; occurrences in a row make up the longest verbatim matches.

Words the benchmark doesn't have break every match, so only runs of benchmark words as long as the
shortest window are indexed; this leaves no match out.

The benchmark reaches the tasks in blocks of at most `BLOCK_BYTES` (or one item, if that is longer). For each
block the documents are read once more in the same stage; no row is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quillbank.llm.frames import Shared, attach, slices, unpacked, words

WINDOW = 13
SHARD_WORDS = 1 << 20
BLOCK_BYTES = 16 << 20

FOUND = (
    "n_words bigint, n_hit bigint, spans array<int>, items array<string>, "
    "longest struct<n_words: bigint, item_id: string, item_word: bigint, doc_word: bigint>"
)
FOUND_ARROW = pa.struct([
    ("n_words", pa.int64()), ("n_hit", pa.int64()), ("spans", pa.list_(pa.int32())), ("items", pa.list_(pa.string())),
    ("longest", pa.struct([("n_words", pa.int64()), ("item_id", pa.string()), ("item_word", pa.int64()), ("doc_word", pa.int64())])),
])


@dataclass
class Block:
    """Part of the benchmark: all its words as numbers from 1, item after item."""

    numbers: dict[bytes, int]
    tokens: np.ndarray
    start: np.ndarray
    item: np.ndarray
    left: np.ndarray
    window: np.ndarray
    ids: list[str]
    shortest: int
    longest: int

    @classmethod
    def of(cls, items: list[tuple[str, bytes]], window: int) -> Block:
        texts = [(i, w) for i, text in items if (w := words(text))]
        numbers: dict[bytes, int] = {}
        tokens = [numbers.setdefault(x, len(numbers) + 1) for _, w in texts for x in w]
        sizes = np.array([len(w) for _, w in texts], np.int64)
        ends = np.cumsum(sizes)
        item = np.repeat(np.arange(len(texts)), sizes)
        start = np.arange(len(tokens))
        least = np.minimum(sizes, window)
        return cls(
            numbers, np.array(tokens, np.int32), start, item, ends[item] - start if len(texts) else start,
            least[item] if len(texts) else start, [i for i, _ in texts],
            int(least.min(initial=window)), int(sizes.max(initial=1)),
        )


def suffix_array(tokens: np.ndarray, least: int, depth: int) -> np.ndarray:
    """Positions in order of what follows them, up to the next 0, compared over `depth` words or more.

    Left out are runs between zeros that are shorter than `least`. Sorted by prefix doubling.
    """
    breaks = np.flatnonzero(tokens == 0)
    sizes = np.diff(breaks, prepend=-1) - 1
    long = np.flatnonzero(sizes >= least)
    if not len(long):
        return np.empty(0, np.int64)
    size = sizes[long]
    at = np.repeat(breaks[long] - size, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    left = np.repeat(breaks[long], size) - at
    rank = tokens[at].astype(np.int64)
    here = np.arange(len(at))
    reach = 1
    while True:
        after = np.zeros(len(at), np.int64)
        inside = left > reach
        after[inside] = rank[here[inside] + reach]
        order = np.argsort(key := rank * (int(rank.max()) + 1) + after, kind="stable")
        new = np.empty(len(at), np.int64)
        new[order] = 1 + np.cumsum(np.diff(key[order], prepend=key[order[0]]) != 0)
        rank, reach = new, reach * 2
        if reach >= depth or int(rank.max()) == len(at):
            return at[order]


def _bound(tokens, suffixes, low, high, depth, wanted, right):
    """For each query, the first suffix in [low, high) whose word at `depth` is not below (right: is above) the wanted one."""
    low, high = low.copy(), high.copy()
    while (open_ := low < high).any():
        middle = (low + high) >> 1
        seen = tokens[np.where(open_, suffixes[np.where(open_, middle, 0)] + depth, 0)]
        below = open_ & ((seen <= wanted) if right else (seen < wanted))
        low = np.where(below, middle + 1, low)
        high = np.where(open_ & ~below, middle, high)
    return low


def occurrences(tokens: np.ndarray, suffixes: np.ndarray, block: Block) -> tuple[np.ndarray, np.ndarray]:
    """All (benchmark suffix, training position) whose words agree over the window of that item."""
    query = np.flatnonzero(block.left >= block.window)
    low, high = np.zeros(len(query), np.int64), np.full(len(query), len(suffixes))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    depth = 0
    while len(query) and len(suffixes):
        wanted = block.tokens[query + depth]
        low, high = (_bound(tokens, suffixes, low, high, depth, wanted, right) for right in (False, True))
        depth += 1
        done = (low < high) & (block.window[query] == depth)
        if done.any():
            size = (high - low)[done]
            each = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            found.append((np.repeat(query[done], size), suffixes[np.repeat(low[done], size) + each]))
        going = (low < high) & (block.window[query] > depth)
        query, low, high = query[going], low[going], high[going]
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _search(documents: list[np.ndarray], block: Block) -> list[dict]:
    """For each document of a shard: spans of hit words, items found and the longest match."""
    sizes = np.array([len(d) for d in documents])
    first = np.cumsum(sizes + 1) - sizes - 1
    tokens = np.concatenate([np.append(d, np.int32(0)) for d in documents])
    out: list[dict] = [{"spans": [], "items": [], "longest": None} for _ in documents]
    query, at = occurrences(tokens, suffix_array(tokens, block.shortest, block.longest), block)
    if not len(query):
        return out
    covered = np.zeros(len(tokens) + 1, np.int64)
    np.add.at(covered, at, 1)
    np.add.at(covered, at + block.window[query], -1)
    edges = np.diff((np.cumsum(covered) > 0).astype(np.int8), prepend=0)
    for begin, end in zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist()):
        d = int(np.searchsorted(first, begin, "right")) - 1
        out[d]["spans"] += [begin - int(first[d]), end - int(first[d])]
    item = block.item[query]
    order = np.lexsort((at, at - query, item))
    query, at, item = query[order], at[order], item[order]
    new = np.flatnonzero(np.diff(item, prepend=-1).astype(bool) | np.diff(at - query, prepend=0).astype(bool) | (np.diff(at, prepend=-2) != 1))
    length = np.diff(np.append(new, len(at))) + block.window[query[new]] - 1
    origin = block.start[query[new]] - np.searchsorted(block.item, item[new])
    for k, n, offset in zip(new.tolist(), length.tolist(), origin.tolist()):
        d = int(np.searchsorted(first, at[k], "right")) - 1
        match = {"n_words": n, "item_id": block.ids[item[k]], "item_word": offset, "doc_word": int(at[k] - first[d])}
        out[d]["items"].append(match["item_id"])
        out[d]["longest"] = longer(out[d]["longest"], match)
    return out


def longer(a: dict | None, b: dict | None) -> dict | None:
    """The longer match; of two as long, the first in the document and then by item."""
    if a is None or b is None:
        return a or b
    return min(a, b, key=lambda m: (-m["n_words"], m["doc_word"], m["item_id"], m["item_word"]))


def _joined(spans: list[int]) -> list[int]:
    out: list[int] = []
    for begin, end in sorted(zip(spans[::2], spans[1::2])):
        if out and begin <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += [begin, end]
    return out


def _work(block: Block, before: bool):
    lookup = block.numbers.get

    def run(batches: Iterator[dict[str, pa.Array]]) -> Iterator[pa.Array]:
        for batch in batches:
            found: list[dict] = []
            shard: list[np.ndarray] = []
            held = 0
            for text in slices(batch["text"]):
                tokens = words(text)
                shard.append(np.fromiter((lookup(w, 0) for w in tokens), np.int32, len(tokens)))
                held += len(tokens)
                if held >= SHARD_WORDS:
                    found += [x | {"n_words": len(d)} for x, d in zip(_search(shard, block), shard)]
                    shard, held = [], 0
            if shard:
                found += [x | {"n_words": len(d)} for x, d in zip(_search(shard, block), shard)]
            if before:
                for x, old in zip(found, batch["before"].to_pylist()):
                    x["spans"] = _joined(old["spans"] + x["spans"])
                    x["items"] = old["items"] + x["items"]
                    x["longest"] = longer(old["longest"], x["longest"])
            for x in found:
                x["n_hit"] = sum(x["spans"][1::2]) - sum(x["spans"][::2])
                x["items"] = sorted(set(x["items"]))
            yield pa.array(found, FOUND_ARROW)

    return run


def benchmark_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> list[DataFrame]:
    """The items, (item, words), in blocks of about `block_bytes`, dealt by hash; at least one block."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text").alias("words"))
    total = items.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    n = -(-total // block_bytes) or 1
    return [items.where(F.pmod(F.xxhash64("item", "words"), F.lit(n)) == k) if n > 1 else items for k in range(n)]


def find_contamination(
    documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, keep: list[str] | None = None,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """`documents` packed by `attach`; `found` holds what each whole text shares with the benchmark.

    A document word is hit if it lies inside any occurrence of a window: `window` words in a row of an item, or
    all words of an item that has fewer. `spans` lists the hit words as begin and end numbers, `items` the
    ids (as text, sorted) of items with occurring windows, `longest` the longest verbatim match with its places.
    Null texts have no words; items without words match nothing; a null item_id counts as ''. Repeated rows
    each get their result.
    """
    spark = documents.sparkSession
    keep = documents.columns if keep is None else keep
    blocks = benchmark_blocks(benchmark, block_bytes)
    df = documents
    for k, items in enumerate(blocks):
        rows = items.distinct().sort("item", "words").collect()
        shared = Shared(spark, Block.of([(r.item, (r.words or "").encode()) for r in rows], window))
        if k:
            df = df.select("row", F.col("row.text").alias("text"), F.col("found").alias("before"))
            df = attach(df, ["text", "before"], _lazy(shared, True), FOUND, ["row"])
            df = df.select("row.row", "found")
        else:
            carried = keep if len(blocks) == 1 else list(dict.fromkeys([*keep, "text"]))
            df = attach(df, ["text"], _lazy(shared, False), FOUND, carried)
    return df


def _lazy(shared, before: bool):
    return lambda batches: _work(shared.get(), before)(batches)


def is_contaminated(found: str = "found"):
    """A twentieth or more of the words is hit."""
    return (F.col(f"{found}.n_hit") > 0) & (20 * F.col(f"{found}.n_hit") >= F.col(f"{found}.n_words"))


def decontaminate(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of `documents`, all columns, that aren't contaminated."""
    return unpacked(find_contamination(documents, benchmark, window).where(~is_contaminated()), [])
