"""Ranked lexical search by NRA: sequential reads of impact-sorted lists, no random access.

1. Queries become rows of distinct terms with their repeats, dealt to blocks of at most `BLOCK_BYTES` of terms. The
   passes below run once for each block, so neither a broadcast nor the driver holds more than one block.
2. A first pass over the documents counts N, L and, for the terms of the block, df.
3. A second pass cuts each task's documents into shards of at most `SHARD_POSTINGS` postings of those terms. A shard sorts
   the impacts of each term once. For each query its lists are read in step from the highest impact downwards. What a
   document has been seen with is its lower bound; that plus, for each list it was not seen in, the impact last read there
   is its upper bound. Reading goes on until every document whose upper bound reaches the tenth place has equal bounds, so
   membership, ties and scores are final. A task starts its next shard from the places its shards before have filled.
4. Of the shards' results, at most ten a query and task, the best ten a query remain; no document or posting is shuffled.

Scores are integers, so sums don't depend on an order. Defined results: null and empty texts have no terms and are no
document of N; rows that repeat an id are documents of their own; a null id comes behind all others of its score; every row
of the queries is a query of its own, also where ids repeat; a query without terms, and any query where no document has a
positive score, gets no rows; an empty table on either side gives no rows. Extra columns of any name are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from quillbank.llm.frames import Shared, cut, quoted, slices, words

PLACES = 10
#: Bytes of the distinct terms of a block of queries, at most (one query of more is a block by itself).
BLOCK_BYTES = 4 << 20
#: Postings and documents that a shard holds at most, but for one document of more.
SHARD_POSTINGS = 1 << 20
SHARD_DOCUMENTS = 1 << 14
#: Depth that the lists are read to first; it doubles with each round.
FIRST_DEPTH = 64
#: Parts that the results of a query are ranked in before they meet.
SALT = 64


def weight(n: int, df: int) -> int:
    """Of a term that `df` of `n` documents hold."""
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


@dataclass
class Query:
    """One row of the queries: terms by their number in the block's vocabulary, each with its repeats."""

    key: int
    item_id: object
    terms: np.ndarray
    repeats: np.ndarray


@dataclass
class Block:
    """Queries that are answered together."""

    vocabulary: dict[bytes, int]
    queries: list[Query]


@dataclass
class Statistics:
    """N, L and the weight of each term of a block."""

    documents: int
    words: int
    weights: np.ndarray


def query_rows(queries: DataFrame, id_column: str = "item_id") -> DataFrame:
    """(block, item_id, terms array<binary>, repeats array<int>) for every row of `queries` that has terms.

    Rows are dealt to buckets by hash, about one a block; inside a bucket a running sum of bytes cuts blocks, so that
    `BLOCK_BYTES` holds for each of them.
    """
    spark = queries.sparkSession
    narrow = queries.select(F.col(quoted(id_column)).alias("item_id"), "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [Counter(words(t)) for t in slices(batch.column(1))]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([sorted(c) for c in held], pa.list_(pa.binary())),
                pa.array([[c[t] for t in sorted(c)] for c in held], pa.list_(pa.int32())),
                pa.array([sum(map(len, c)) for c in held], pa.int64()),
            ], names=["item_id", "terms", "repeats", "n_bytes"])

    kind = narrow.schema["item_id"].dataType.simpleString()
    parsed = cut(narrow.mapInArrow(work, f"item_id {kind}, terms array<binary>, repeats array<int>, n_bytes bigint").where("n_bytes > 0"))
    total = parsed.agg(F.sum("n_bytes")).first()[0] or 0
    buckets = total // BLOCK_BYTES + 1
    dealt = parsed.withColumn("bucket", F.pmod(F.xxhash64("item_id", "terms"), F.lit(buckets)))
    running = Window.partitionBy("bucket").orderBy("item_id", "terms").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n_bytes").over(running), F.lit(0))
    return cut(dealt.withColumn("part", F.floor(before / BLOCK_BYTES)).select(
        F.struct("bucket", "part").alias("block"), "item_id", "terms", "repeats"))


def blocks(rows: DataFrame) -> Iterator[Block]:
    """The blocks of `query_rows`, one at a time on the driver."""
    for (block,) in rows.select("block").distinct().sort("block").toLocalIterator():
        here = rows.where((F.col("block.bucket") == block.bucket) & (F.col("block.part") == block.part))
        vocabulary: dict[bytes, int] = {}
        queries = []
        for r in here.sort("item_id", "terms", "repeats").collect():
            terms = [vocabulary.setdefault(bytes(t), len(vocabulary)) for t in r.terms]
            queries.append(Query(len(queries), r.item_id, np.array(terms, np.int64), np.array(r.repeats, np.int64)))
        yield Block(vocabulary, queries)


def statistics(documents: DataFrame, vocabulary: dict[bytes, int]) -> Statistics:
    """Counted over all rows of `documents` (text); what comes to the driver is one row a term of the block."""
    shared, size = Shared(documents.sparkSession, vocabulary), len(vocabulary)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.get()
        counts = np.zeros(size + 2, np.int64)
        for batch in batches:
            for text in slices(batch.column(0)):
                if held := words(text):
                    counts[size] += 1
                    counts[size + 1] += len(held)
                    counts[[known[t] for t in known.keys() & set(held)]] += 1
        at = np.flatnonzero(counts)
        for k in range(0, len(at), 10_000):
            yield pa.RecordBatch.from_arrays([pa.array(at[k : k + 10_000]), pa.array(counts[at[k : k + 10_000]])], names=["term", "n"])

    found = dict(documents.select("text").mapInArrow(work, "term bigint, n bigint").groupBy("term").agg(F.sum("n")).collect())
    n = found.get(size, 0)
    return Statistics(n, found.get(size + 1, 0), np.array([weight(n, found.get(t, 0)) for t in range(size)], np.int64))


class Lists:
    """The impact-sorted lists of one shard."""

    def __init__(self, term: np.ndarray, document: np.ndarray, tf: np.ndarray, n_terms: np.ndarray, given: Statistics):
        m = 25 + (75 * n_terms * given.documents) // given.words
        impact = given.weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[document]))
        order = np.lexsort((document, -impact, term))
        self.document, self.impact, self.size = document[order], impact[order], len(n_terms)
        self.start = np.searchsorted(term[order], np.arange(len(given.weights) + 1))

    def best(self, query: Query, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents (by their place in the shard) with their scores: all that are among the best `PLACES` by score, with those
        that tie with the last of them, and score `floor` or more and above 0."""
        starts, ends = self.start[query.terms], self.start[query.terms + 1]
        there = ends > starts
        starts, ends, repeats = starts[there], ends[there], query.repeats[there]
        low = np.zeros(self.size, np.int64)
        unseen = np.ones((len(starts), self.size), bool)
        places = min(PLACES, self.size)
        depth, upto = 0, FIRST_DEPTH
        while True:
            for k, (start, end) in enumerate(zip(starts, ends)):
                if start + depth < end:
                    read = slice(start + depth, min(end, start + upto))
                    low[self.document[read]] += self.impact[read] * repeats[k]
                    unseen[k, self.document[read]] = False
            last = np.minimum(starts + upto, ends) - 1
            open_ = starts + upto < ends
            bound = np.where(open_, self.impact[last] * repeats, 0)
            least = max(1, floor, int(np.partition(low, -places)[-places]) if places else 0)
            if not open_.any():
                break
            rest = bound @ unseen
            if not ((low + rest >= least) & (rest > 0)).any():
                break
            depth, upto = upto, 2 * upto
        found = np.flatnonzero(low >= least)
        return found, low[found]


class Places:
    """The best documents that a task has found for each query, ties with the last place by id."""

    def __init__(self, queries: list[Query]):
        self.queries = queries
        self.held: list[list[tuple]] = [[] for _ in queries]

    def floor(self, k: int) -> int:
        return -self.held[k][-1][0] if len(self.held[k]) == PLACES else 0

    def add(self, lists: Lists, ids: pa.Array) -> None:
        for k, query in enumerate(self.queries):
            at, scores = lists.best(query, self.floor(k))
            if len(at):
                named = ids.take(pa.array(at)).to_pylist()
                found = [(-int(s), i is None, 0 if i is None else i) for s, i in zip(scores, named)]
                self.held[k] = sorted(self.held[k] + found)[:PLACES]

    def batches(self, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
        rows = [(q.key, None if none else i, -s) for q, held in zip(self.queries, self.held) for s, none, i in held]
        for k in range(0, len(rows), 10_000):
            keys, ids, scores = zip(*rows[k : k + 10_000])
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(ids, kind), pa.array(scores, pa.int64())], names=["query", "doc_id", "score"])


def answers(documents: DataFrame, block: Block, given: Statistics) -> DataFrame:
    """(query, doc_id, score): the best `PLACES` documents of each task for each query of the block."""
    shared = Shared(documents.sparkSession, (block, given))
    narrow = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, given = shared.get()
        known, places = block.vocabulary, Places(block.queries)
        ids, n_terms, terms, at, tfs = [], [], [], [], []

        def close():
            if n_terms:
                lists = Lists(*(np.array(x, np.int64) for x in (terms, at, tfs, n_terms)), given)
                places.add(lists, pa.array(ids, pa.int64()))
                for x in (ids, n_terms, terms, at, tfs):
                    x.clear()

        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), slices(batch.column(1))):
                held = words(text)
                counts = Counter(held)
                if not (here := known.keys() & counts.keys()):
                    continue
                if len(n_terms) == SHARD_DOCUMENTS or len(terms) + len(here) > SHARD_POSTINGS:
                    close()
                at += [len(n_terms)] * len(here)
                terms += [known[t] for t in here]
                tfs += [counts[t] for t in here]
                ids.append(i)
                n_terms.append(len(held))
        close()
        yield from places.batches(pa.int64())

    return narrow.mapInArrow(work, "query bigint, doc_id bigint, score bigint")


def best_of(found: DataFrame) -> DataFrame:
    """The best `PLACES` rows of each query with their rank, in parts first so that no task ranks all of a query's rows."""
    order = (F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    salted = found.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALT)))
    part = Window.partitionBy("query", "salt").orderBy(*order)
    some = salted.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= PLACES).drop("rank", "salt")
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order))).where(F.col("rank") <= PLACES)


def search(documents: DataFrame, queries: DataFrame, id_column: str = "item_id") -> DataFrame:
    """(item_id, rank, doc_id, score): for each row of `queries` its ten best of all rows of `documents`."""
    spark = documents.sparkSession
    kind = queries.schema[id_column].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id bigint, score bigint")
    for block in blocks(query_rows(queries, id_column)):
        given = statistics(documents, block.vocabulary)
        if not given.documents:
            break
        names = spark.createDataFrame([(q.key, q.item_id) for q in block.queries], f"query bigint, item_id {kind}")
        ranked = best_of(answers(documents, block, given)).join(names, "query")
        out = out.unionAll(cut(ranked.select("item_id", "rank", "doc_id", "score")))
    return out
