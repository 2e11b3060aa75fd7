"""Outputs: the routed bank, its report tables and the companion jobs' documents.

A bank is written once, keyed by path and partitioned by outcome; reports are
derived from the written table, so the migration is not run again for each.
Files that could not be read are found by joining the listed paths with the written
ones, and each becomes one error row.  The same documents can be written as single
files in folders, as ``write_files`` has it.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillbank.operators.clean import base_folders, clean, relative_path
from quillbank.operators.enrich import UNREADABLE, enrich
from quillbank.plans import reports
from quillbank.plans.migrate import classify
from quillbank.sources import json_files
from quillbank.sources.documents import (
    filter_types, list_documents, read_documents, read_reference, scan_documents, unreadable,
)


def write_bank(classified: DataFrame, path: str, max_records: int = 1_000_000, mode: str = "overwrite") -> None:
    """The routed bank: one partition per outcome, written without a shuffle."""
    (classified.drop("raw", "converted_json").write.mode(mode)
     .option("maxRecordsPerFile", max_records).partitionBy("outcome").parquet(path))


def write_json_lines(documents: DataFrame, column: str, path: str, partition: str) -> None:
    """Document texts, one per line, in a folder per ``partition`` value.

    Line ends inside a text are only layout in JSON and become spaces.
    """
    (documents.selectExpr(f"regexp_replace({column}, '[\\r\\n]+', ' ') AS value", partition)
     .write.mode("overwrite").partitionBy(partition).text(path))


def write_enriched(enriched: DataFrame, path: str) -> None:
    """Enriched documents by category; those that could not be read are listed in ``<path>_errors``."""
    (enriched.where(f"status <> '{UNREADABLE}'").select("path", "filename", "category", "enriched_json")
     .write.mode("overwrite").partitionBy("category").parquet(path))
    write_unreadable(enriched.where(f"status = '{UNREADABLE}'"), path)


def write_unreadable(documents: DataFrame, path: str) -> None:
    (documents.selectExpr("path", "filename", f"'{UNREADABLE}' AS reason")
     .write.mode("overwrite").parquet(f"{path}_errors"))


def write_cleaned(cleaned: DataFrame, path: str) -> None:
    """Cleaned documents keyed by their relative path; those that could not be cleaned are listed in ``<path>_errors``."""
    (cleaned.where("cleaned_json IS NOT NULL").select("rel_path", "filename", "cleaned_json")
     .write.mode("overwrite").parquet(path))
    write_unreadable(cleaned.where("cleaned_json IS NULL"), path)


def report_tables(classified: DataFrame) -> dict[str, DataFrame]:
    return {
        "errors": reports.errors(classified),
        "warnings": reports.warnings(classified),
        "summary": reports.summary(classified),
    }


def write_files(documents: DataFrame, rel_path: Column, text: Column, folder: str, mode: str = "overwrite") -> DataFrame:
    """One file a document with a text, in two phases.  Returns the documents whose path is not inside the folder."""
    json_files.register(documents.sparkSession)
    placed = documents.where(text.isNotNull()).select(rel_path.alias("rel_path"), text.alias("text"))
    (placed.where(json_files.is_inside(F.col("rel_path"))).write.format(json_files.FORMAT).mode(mode).save(folder))
    return documents.where(text.isNotNull() & ~json_files.is_inside(rel_path))


def _below(documents: DataFrame, base_path: str) -> Column:
    return relative_path(F.col("path"), base_folders(documents.sparkSession, base_path))


def write_bank_files(classified: DataFrame, base_path: str, folder: str) -> DataFrame:
    """Payloads as files: a folder per outcome, below it the path that the document has below ``base_path``.

    Give it the bank that ``write_bank`` has written, so that the rules do not run again.
    """
    placed = F.concat_ws("/", "outcome", _below(classified, base_path))
    return write_files(classified, placed, F.col("payload"), folder)


def write_enriched_files(enriched: DataFrame, base_path: str, folder: str) -> DataFrame:
    """Enriched documents as files: a folder per category."""
    placed = F.concat_ws("/", "category", _below(enriched, base_path))
    return write_files(enriched.where(f"status <> '{UNREADABLE}'"), placed, F.col("enriched_json"), folder)


def write_cleaned_files(cleaned: DataFrame, folder: str) -> DataFrame:
    """Cleaned documents as files at their mirrored relative paths."""
    return write_files(cleaned, F.col("rel_path"), F.col("cleaned_json"), folder)


def enrich_folder(spark: SparkSession, source: str, reference: str, target: str, recursive: bool = False) -> None:
    """The enrichment of a folder by a CSV file: documents by category in ``target``, a table of those not read in ``<target>_errors``."""
    listed = _listing(spark, source, target, recursive)
    enriched = enrich(read_documents(spark, source, recursive, tolerant=True), read_reference(spark, reference))
    write_enriched(enriched, target)
    _list_missing(spark, listed, target)


def clean_folder(spark: SparkSession, source: str, target: str) -> None:
    """The cleaning of a folder: documents by relative path in ``target``, a table of those not read in ``<target>_errors``."""
    listed = _listing(spark, source, target)
    write_cleaned(clean(read_documents(spark, source, tolerant=True), source), target)
    written = spark.read.parquet(target).select("rel_path")
    failed = spark.read.parquet(f"{target}_errors").select(relative_path(F.col("path"), base_folders(spark, source)).alias("rel_path"))
    paths = written.unionAll(failed).select(F.col("rel_path").alias("path"))
    own = listed.withColumn("path", relative_path(F.col("path"), base_folders(spark, source)))
    _append_missing(unreadable(own, paths), target)


def _listing(spark: SparkSession, source: str, target: str, recursive: bool = True) -> DataFrame:
    """The files there are before anything is read, kept in ``<target>_listed``."""
    list_documents(spark, source, recursive).write.mode("overwrite").parquet(f"{target}_listed")
    return spark.read.parquet(f"{target}_listed")


def _list_missing(spark: SparkSession, listed: DataFrame, target: str) -> None:
    paths = spark.read.parquet(target).select("path").unionAll(spark.read.parquet(f"{target}_errors").select("path"))
    _append_missing(unreadable(listed, paths), target)


def _append_missing(missing: DataFrame, target: str) -> None:
    missing.selectExpr("path", "filename", f"'{UNREADABLE}' AS reason").write.mode("append").parquet(f"{target}_errors")


def migrate(spark: SparkSession, source: str, target: str, types=None, dry_run: bool = False) -> dict[str, DataFrame]:
    """Read, classify, write and report.  A dry run writes nothing and returns lazy frames.

    A file that cannot be read becomes a document that failed in conversion; with ``types`` it is left out, as its types are unknown.
    """
    if dry_run:
        documents = filter_types(read_documents(spark, source, tolerant=True), types) if types else scan_documents(spark, source)
        classified = classify(documents)
        return {"bank": classified, **report_tables(classified)}
    listed = _listing(spark, source, f"{target}/bank")
    documents = read_documents(spark, source, tolerant=True)
    write_bank(classify(filter_types(documents, types) if types else documents), f"{target}/bank")
    bank = spark.read.parquet(f"{target}/bank")
    if not types:
        missing = classify(unreadable(listed, bank))
        write_bank(missing, f"{target}/bank", mode="append")
        bank = spark.read.parquet(f"{target}/bank")
    tables = report_tables(bank)
    tables["errors"].write.mode("overwrite").parquet(f"{target}/errors")
    if not tables["warnings"].isEmpty():
        tables["warnings"].write.mode("overwrite").parquet(f"{target}/warnings")
    tables["summary"].write.mode("overwrite").parquet(f"{target}/summary")
    return {"bank": bank, **tables}
