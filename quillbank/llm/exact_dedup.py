"""Exact deduplication with a heavy-hitter split.

Misra-Gries summaries of the digests, one a partition, are merged to at most `COUNTERS` candidates, among which is every
digest of more than rows / (COUNTERS + 1) copies. A second pass counts the candidates exactly and finds the row that
stays; these winners are broadcast (at most `COUNTERS` rows of a few dozen bytes) and copies of them are
resolved on the map side. The remaining digests, none of which is frequent, are shuffled in the ordinary way.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from quillbank.llm.frames import ascii_lower, cut, quoted

COUNTERS = 1024


def digest(text: Column) -> Column:
    """SHA-256 of the text with A-Z lower-cased, in UTF-8; null counts as empty."""
    return F.unhex(F.sha2(ascii_lower(text).cast("binary"), 256))


def summarise(counts: dict, counters: int) -> dict:
    """The Misra-Gries reduction: subtracts the largest count that doesn't fit from all others."""
    if len(counts) <= counters:
        return counts
    least = heapq.nlargest(counters + 1, counts.values())[-1]
    return {k: n - least for k, n in counts.items() if n > least}


def candidates(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """At most `counters` values of the column `digest`, among them each of more than rows / (counters + 1) occurrences."""

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}
        for batch in batches:
            for pair in batch.column(0).value_counts().to_pylist():
                held[pair["values"]] = held.get(pair["values"], 0) + pair["counts"]
            held = summarise(held, counters)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["digest", "n"]
        )

    merged = digests.select("digest").mapInArrow(summary, "digest binary, n bigint").groupBy("digest").agg(F.sum("n").alias("n"))
    rows = merged.orderBy(F.desc("n"), "digest").limit(counters + 1).collect()
    frequent = summarise({bytes(r.digest): r.n for r in rows}, counters)
    return digests.sparkSession.createDataFrame([(bytearray(d),) for d in sorted(frequent)], "digest binary")


def _heavy(keyed: DataFrame, counters: int, best: Column) -> DataFrame:
    """The winners of the candidates, counted exactly: (digest, best, n), at most `counters` rows."""
    return cut(keyed.join(F.broadcast(candidates(keyed, counters)), "digest").groupBy("digest").agg(best.alias("best"), F.count("*").alias("n")))


def groups(documents: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of `documents`.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. The row with the largest doc_id
    stays (null is smaller than any); of repeated rows of that doc_id one is marked as kept.
    """
    keyed = documents.select("doc_id", digest(F.col("text")).alias("digest"), F.monotonically_increasing_id().alias("row_no"))
    keyed = cut(keyed)
    best = F.max(F.struct("doc_id", "row_no"))
    heavy = _heavy(keyed, counters, best)
    light = keyed.join(F.broadcast(heavy.select("digest")), "digest", "left_anti")
    light = light.join(light.groupBy("digest").agg(best.alias("best"), F.count("*").alias("n")), "digest")
    every = keyed.join(F.broadcast(heavy), "digest").unionByName(light)
    return every.select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
        (F.col("row_no") == F.col("best.row_no")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"),
    )


def deduplicate(documents: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """The rows of `documents`, all columns, that stay by the rule of `groups`.

    Copies of frequent texts are dropped before the shuffle, which carries every other row once.
    """
    keyed = documents.select(F.struct(*[F.col(quoted(c)).alias(c) for c in documents.columns]).alias("row"))
    keyed = keyed.select("row", F.col("row.doc_id").alias("doc_id"), digest(F.col("row.text")).alias("digest"))
    ids = cut(keyed.select("doc_id", "digest"))
    heavy = _heavy(ids, counters, F.max("doc_id"))
    light = ids.join(F.broadcast(heavy.select("digest")), "digest", "left_anti").groupBy("digest").agg(F.max("doc_id").alias("best"))
    winners = F.broadcast(heavy.select(F.col("digest").alias("d"), "best", F.lit(True).alias("frequent")))
    rows = keyed.join(winners, F.col("digest") == F.col("d"), "left")
    rows = rows.where("frequent IS NULL OR doc_id <=> best").select("row", "doc_id", "digest")
    stays = light.union(heavy.select("digest", "best"))
    rows = rows.join(stays, "digest").where("doc_id <=> best")
    first = Window.partitionBy("digest").orderBy(F.xxhash64("row.text"))
    return rows.withColumn("nth", F.row_number().over(first)).where("nth = 1").select("row.*")
