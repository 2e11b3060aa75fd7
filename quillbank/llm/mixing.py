"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree; DataFrame and SQL functions only.

1. Targets: sources share `BUDGET` times all words by weight; none gets more than `CAP` times its own words, the excess
   goes to the others by weight.
2. Blocks: a hash of the id deals each source's documents to `BLOCKS` blocks. A source draws all its blocks once
   for each whole time its target holds its size and, for what is left, blocks in permuted order; the last of these gives
   the missing part of each of its documents.
3. Splitting tree: a node holds how many block draws of each source it has. Its first child draws half of them without
   replacement, so its counts are a multivariate-hypergeometric draw and both children add up exactly; the second
   child gets the others. After `levels` halvings each leaf is an output shard with its quota of each source.
4. The shards take disjoint runs of each source's permuted draws, as long as their quotas, and shuffle locally.

Only tables of sources, blocks and quotas are sorted or joined as a whole; their size follows the number of sources.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from quillbank.llm.frames import cut, quoted

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
CAP = 2
BLOCKS = 1024
LEVELS = 4
SEED = 11
#: Words of the mix for a task that writes them, at least; with more data both tasks and their size grow by its root.
TASK_WORDS = 1 << 21
TASK_GROWTH = 32
#: Rows of the table of blocks up to which it is broadcast (about 100 bytes each); beyond, it is joined by shuffle.
BROADCAST_ROWS = 200_000

WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def block_of(doc_id: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(SEED), doc_id), F.lit(blocks)).cast("int")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, cap: float = CAP) -> DataFrame:
    """Adds `nth` (from 0, by code point, null last), `weight` and `target` to one row a source (source, source_size).

    A target is the lesser of cap times the size and of a rate times the weight, one rate for all, which makes the targets add
    up to the budget: what resharing the excess again and again comes to.
    """
    in_order, everything = Window.orderBy(F.col("source").asc_nulls_last()), Window.partitionBy()
    cycle = F.array(*[F.lit(w) for w in weights])
    rated = sizes.withColumn("nth", F.row_number().over(in_order) - 1)
    rated = rated.withColumn("weight", F.element_at(cycle, F.col("nth") % len(weights) + 1)).withColumn("most", F.col("source_size") * float(cap))
    full_first = Window.orderBy(F.col("most") / F.col("weight"), "nth")
    before = full_first.rowsBetween(Window.unboundedPreceding, -1)
    rated = rated.select(
        "*", (F.sum("source_size").over(everything) * float(budget) - F.coalesce(F.sum("most").over(before), F.lit(0.0))).alias("left"),
        F.sum("weight").over(full_first.rowsBetween(Window.currentRow, Window.unboundedFollowing)).alias("sharing"),
    )
    rate = F.max(F.col("left") / F.col("sharing")).over(everything)  # grows until the first source that isn't full, then falls
    return rated.withColumn("rate", rate).select(
        "source", "source_size", "nth", "weight", F.least("most", F.col("rate") * F.col("weight")).alias("target")
    )


def splitting_tree(quotas: DataFrame, levels: int = LEVELS) -> DataFrame:
    """(shard, nth, quota): `quotas` (nth, quota) split exactly among 2 ** levels shards."""
    nodes = quotas.select(F.lit(0).alias("node"), "nth", "quota")
    for level in range(levels):
        slots = nodes.select("node", "nth", F.explode(F.sequence(F.lit(1), F.col("quota").cast("int"))).alias("slot"))
        drawn = Window.partitionBy("node").orderBy(F.xxhash64(F.lit(SEED), F.lit(level), "node", "nth", "slot"), "nth", "slot")
        second = 2 * F.row_number().over(drawn) > F.count("*").over(Window.partitionBy("node"))
        nodes = slots.select((2 * F.col("node") + second.cast("int")).alias("node"), "nth").groupBy("node", "nth").agg(F.count("*").alias("quota"))
    return nodes.withColumnRenamed("node", "shard")


def plan_blocks(sized: DataFrame, blocks: int = BLOCKS, levels: int = LEVELS, **rates) -> DataFrame:
    """One row for each block of a source with documents, from (source, block, size).

    (source, block, source_size, target, passes, part, shards): each document is taken `passes` times whole and
    once more for `part` of its words; `shards` tells where each of these goes.
    """
    by_block = cut(sized.groupBy("source", "block").agg(F.sum("size").alias("block_size")))
    rated = cut(targets(by_block.groupBy("source").agg(F.sum("block_size").alias("source_size")), **rates))
    permuted = Window.partitionBy("nth").orderBy(F.xxhash64(F.lit(SEED), F.lit(-1), "nth", "block"), "block")
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    rest = F.col("target") - F.col("passes") * F.col("source_size")
    before = F.sum("block_size").over(permuted) - F.col("block_size")
    drawn = (
        by_block.withColumnRenamed("source", "block_source").join(rated, F.expr("block_source <=> source")).drop("block_source")
        .withColumn("passes", passes)
        .withColumn("part", F.when(F.col("block_size") > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), (rest - before) / F.col("block_size")))).otherwise(0.0))
    )
    drawn = cut(drawn)
    draws = drawn.where("passes > 0 OR part > 0").select(
        "nth", "block", F.explode(F.expr("sequence(1, passes + IF(part > 0, 1, 0))")).alias("draw")
    )
    order = Window.partitionBy("nth").orderBy(F.xxhash64(F.lit(SEED), F.lit(-2), "nth", "block", "draw"), "block", "draw")
    draws = cut(draws.withColumn("place", F.row_number().over(order)))
    quotas = splitting_tree(draws.groupBy("nth").agg(F.count("*").alias("quota")), levels)
    quotas = quotas.withColumn("until", F.sum("quota").over(Window.partitionBy("nth").orderBy("shard")).cast("int"))
    runs = quotas.select("nth", "shard", F.explode(F.expr("sequence(until - CAST(quota AS int) + 1, until)")).alias("place"))
    dealt = draws.join(runs, ["nth", "place"]).groupBy("nth", "block").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("draw", "shard"))), lambda x: x["shard"]).alias("shards")
    )
    return cut(drawn.join(dealt, ["nth", "block"], "left").select(
        "source", "block", "source_size", "target", "passes", "part", F.coalesce("shards", F.array().cast("array<int>")).alias("shards")
    ))


def pieces(words: float, shards: int) -> int:
    """Into how many pieces each of `shards` shards goes, for a mix of so many words."""
    return max(1, math.ceil(words / shards / max(TASK_WORDS, TASK_GROWTH * math.sqrt(words))))


def _planned(documents: DataFrame, blocks: int, levels: int, **rates) -> tuple[DataFrame, DataFrame]:
    """`documents` as column `row`, with size, block and what `plan_blocks` says of its block; and the plan alone."""
    rows = documents.select(F.struct(*[F.col(quoted(c)).alias(c) for c in documents.columns]).alias("row"))
    sized = rows.select("row", F.col("row.source").alias("source"), block_of(F.col("row.doc_id"), blocks).alias("block"), n_words(F.col("row.text")).alias("size"))
    plan = plan_blocks(sized.select("source", "block", "size"), blocks, levels, **rates)
    plan = plan.withColumnsRenamed({"source": "plan_source", "block": "plan_block"})
    hinted = F.broadcast(plan) if plan.count() <= BROADCAST_ROWS else plan
    return sized.join(hinted, F.expr("source <=> plan_source AND block = plan_block")).drop("plan_source", "plan_block"), plan


def allotments(documents: DataFrame, blocks: int = BLOCKS, levels: int = LEVELS, **rates) -> DataFrame:
    """(doc_id, size, source_size, target, taken, shards) for every row of `documents`.

    size is the number of words (null text: 0), target that of the row's source, taken the words the mix takes of it, repeats
    counted, at most twice its size. A null source is a source of its own, the last; a null doc_id hashes like a
    value; repeated rows are documents of their own. An empty table gives an empty result.
    """
    planned, _ = _planned(documents.select("doc_id", "source", "text"), blocks, levels, **rates)
    taken = F.col("passes") * F.col("size") + F.round(F.col("part") * F.col("size")).cast("bigint")
    return planned.select(F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target", taken.alias("taken"), "shards")


def mix(documents: DataFrame, blocks: int = BLOCKS, levels: int = LEVELS, **rates) -> DataFrame:
    """The mix: the rows of `documents` as often as they are drawn, with `copy`, `taken` (words to read of it), `shard` and
    `position`, the order inside the shard; a task writes a piece of one shard, in order. These four replace columns of the same name. Rows of which no word is taken are absent.
    """
    planned, plan = _planned(documents, blocks, levels, **rates)
    words = plan.groupBy("plan_source").agg(F.max("target").alias("target")).agg(F.sum("target")).first()[0] or 0
    each = pieces(words, 2**levels)
    drawn = planned.select("row", "size", "passes", "part", F.posexplode("shards").alias("copy", "shard"))
    drawn = drawn.withColumn("taken", F.when(F.col("copy") < F.col("passes"), F.col("size")).otherwise(F.round(F.col("part") * F.col("size")).cast("bigint")))
    drawn = drawn.where("taken > 0").withColumn("position", F.xxhash64(F.lit(SEED), F.lit(-3), "shard", "row.doc_id", "copy"))
    piece = F.shiftright((F.shiftright("position", 32) + F.lit(1 << 31)) * F.lit(each), 32)  # the position's place among all, in equal parts
    task = (F.col("shard") * F.lit(each) + piece).cast("int")
    dealt = drawn.repartitionById(2**levels * each, task).sortWithinPartitions("shard", "position")
    own = ["copy", "taken", "shard", "position"]
    return dealt.select(*[F.col(f"row.{quoted(c)}").alias(c) for c in documents.columns if c not in own], *own)
