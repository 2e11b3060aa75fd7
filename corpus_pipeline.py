"""A corpus pipeline over `documents`: each stage reads what the one before it wrote as Parquet."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from quillbank.llm import decontaminate, exact_dedup, frames, mixing, simhash, toxicity


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that score as toxic; learns from the labelled documents among its input."""
    return toxicity.without_toxic(docs, frames.table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts keeps the row with the largest doc_id."""
    return exact_dedup.deduplicate(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints keeps the row with the smallest doc_id."""
    return simhash.one_of_each(docs)


def contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of whose words a twentieth or more repeats the benchmark."""
    return decontaminate.decontaminate(docs, frames.table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draws the documents by the target weights of their sources into output shards, with copy, taken, shard and position."""
    return mixing.mix(docs)


STAGES = [
    ("toxicity", toxic),
    ("exact dedup", exact),
    ("simhash near-dedup", near),
    ("benchmark decontamination", contaminated),
    ("mixing", mixed),
]

#: Stages 1, 3 and 5 (learning, fingerprints, draws by a hash) can't be expressed; tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; the rows between them lie in the checkpoint folder that the cluster shares."""
    docs = frames.table(spark, sf_dir, "documents")
    folder = frames.shared_folder(spark) + f"/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
