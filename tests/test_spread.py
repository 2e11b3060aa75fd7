"""Banks over tables of a single row group."""

import datetime

import pytest
from pyspark.sql import functions as F

from quillbank.plans import banks, file_queries


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Each table one file; half of the keys are missing, the others equal."""
    folder = str(tmp_path_factory.mktemp("tables"))
    day = datetime.datetime(1996, 1, 2)
    spark.createDataFrame(
        [(None if n % 2 else 7, n, "O", 1.5, day, "1-URGENT") for n in range(2000)],
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string",
    ).coalesce(1).write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame(
        [(None if n % 2 else 7, 1 + n % 50, "Brand#13") for n in range(2000)], "p_partkey bigint, p_size int, p_brand string",
    ).coalesce(1).write.parquet(f"{folder}/part.parquet")
    spark.createDataFrame([(None if n % 2 else 7, 1, "s") for n in range(2000)], "s_suppkey bigint, s_nationkey bigint, s_name string"
                          ).coalesce(1).write.parquet(f"{folder}/supplier.parquet")
    spark.createDataFrame([(None if n % 2 else 7, "a\nb") for n in range(2000)], "doc_id bigint, text string"
                          ).coalesce(1).write.parquet(f"{folder}/documents.parquet")
    return folder


@pytest.mark.parametrize("bank", [
    banks.mixed_bank, banks.several_bank, lambda *a: banks.choice_bank(*a, "matching"), banks.counting_bank, banks.puzzle_bank,
    banks.html_lines,
])
def test_rows_of_one_file_are_dealt_to_every_core(spark, tables, bank):
    tasks = 4 * spark.sparkContext.defaultParallelism
    dealt = bank(spark, tables).groupBy(F.spark_partition_id()).count().collect()
    assert len(dealt) == tasks
    assert sum(r["count"] for r in dealt) == 2000
    assert max(r["count"] for r in dealt) < 2 * 2000 / tasks


def test_files_of_one_table_file_are_written_by_every_core(spark, tables, monkeypatch):
    given = []
    monkeypatch.setattr(file_queries.sinks, "write_files", lambda documents, *rest: given.append(documents))
    file_queries._folder(spark, tables, "'{}'")
    file_queries._reference(spark, tables)
    for documents in given:
        assert documents.select(F.spark_partition_id()).distinct().count() == 4 * spark.sparkContext.defaultParallelism
    assert len(given) == 2
