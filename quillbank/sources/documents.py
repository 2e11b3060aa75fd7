"""Scans: question documents and the reference table for enrichment."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillbank.functions import resolve as rs
from quillbank.functions.sql import array, let
from quillbank.functions.variants import field, outer_array
from quillbank.operators import skeleton

# Words the reference table treats as missing.
MISSING_WORDS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
REFERENCE_COLUMNS = ["base_question_id", "section_id", "language", "subject", "grade", "country"]


def configure(spark: SparkSession) -> SparkSession:
    """The one session setting results depend on: of a repeated JSON key the last value counts."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return spark


def decoded(uri: Column) -> Column:
    """A file name or path as it is on disk; Spark lists them percent-encoded."""
    return F.coalesce(F.try_url_decode(F.replace(uri, F.lit("+"), F.lit("%2B"))), uri)


def _files(spark: SparkSession, recursive: bool):
    return spark.read.option("recursiveFileLookup", recursive).option("pathGlobFilter", "*.json")


def list_documents(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """One row per ``*.json`` file under ``path``, unread: ``path, filename, n_bytes, modified``.

    Only directory entries are looked at, when the listing is evaluated: write it before a scan that it is to be held against.
    """
    scan = _files(spark, recursive).option("ignoreMissingFiles", True)
    return scan.format("binaryFile").load(path).select(
        decoded(F.col("path")).alias("path"),
        decoded(F.element_at(F.split("path", "/"), -1)).alias("filename"),
        F.col("length").alias("n_bytes"), F.col("modificationTime").alias("modified"),
    )


def read_documents(spark: SparkSession, path: str, recursive: bool = True, tolerant: bool = False) -> DataFrame:
    """One row per ``*.json`` file under ``path``: ``path, filename, raw``.

    Path and name are written as on disk, so ``1 x.json`` is not ``1%20x.json``.
    A file that cannot be read, or that is gone by then, ends the job. A ``tolerant`` scan leaves it out instead;
    ``unreadable`` finds those among the listed files. A refusal by the file system's access control ends the job always.
    """
    configure(spark)
    scan = _files(spark, recursive).option("ignoreCorruptFiles", tolerant).option("ignoreMissingFiles", tolerant)
    return scan.text(path, wholetext=True).select(
        decoded(F.col("_metadata.file_path")).alias("path"),
        decoded(F.col("_metadata.file_name")).alias("filename"),
        F.col("value").alias("raw"),
    )


def same_path(path: Column) -> Column:
    """A path without the slashes by which listings and scans write a local one differently."""
    return F.regexp_replace(path, "^([A-Za-z][A-Za-z0-9+.-]*:)/+", "$1/")


def unreadable(listed: DataFrame, read: DataFrame) -> DataFrame:
    """Documents for the files of ``listed`` whose path no row of ``read`` has: their ``raw`` is NULL.

    Only paths are joined. ``read`` may be a table written from a tolerant scan, so that no file is opened twice.
    """
    there = read.select(same_path(F.col("path")).alias("same")).distinct()
    missing = listed.withColumn("same", same_path(F.col("path"))).join(there, "same", "left_anti")
    return missing.select("path", "filename", F.lit(None).cast("string").alias("raw"))


def scan_documents(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """Every file under ``path``, those that cannot be read with a NULL ``raw``. It opens the files twice."""
    listed = list_documents(spark, path, recursive)
    read = read_documents(spark, path, recursive, tolerant=True)
    return read.unionByName(unreadable(listed, read))


def parsed(raw: str) -> str:
    """JSON text as VARIANT, NULL if malformed, as a SQL expression.

    The text is read as the only element of an array, because the parser by
    itself does not look past the end of the first value.
    """
    return field(wrapped(raw), "$[0]")


def wrapped(raw: str) -> str:
    """JSON text as the only element of an array, NULL if malformed: ``parsed`` without a copy of the document."""
    array_of_one = f"CASE WHEN size({outer_array('w')}) = 1 THEN w END"
    return f"CASE WHEN is_valid_utf8({raw}) THEN {let(f'try_parse_json(concat(\'[\', {raw}, \']\'))', 'w', array_of_one)} END"


def with_fields(documents: DataFrame, raw: str = "raw") -> DataFrame:
    """Adds ``doc`` (VARIANT) and its skeleton ``root``, ``meta`` and ``parts``; they are read from ``wrapped``."""
    return documents.withColumn("wrapped", F.expr(wrapped(raw))).withColumns({
        "doc": F.expr(field("wrapped", "$[0]")),
        "root": F.expr(skeleton.root("wrapped", "$[0]")),
        "meta": F.expr(skeleton.meta("wrapped", "$[0]")),
        "parts": F.expr(skeleton.parts("wrapped", "$[0]")),
    })


def filter_types(documents: DataFrame, types) -> DataFrame:
    """Documents having any part of the given types; unreadable ones are left out.

    Reads the types alone, from ``doc`` where ``with_fields`` has made it, else from the text.
    """
    doc = "doc" if "doc" in documents.columns else parsed("raw")
    each = field(doc, "$.parts", "array<struct<type:variant>>")
    wanted = f"NOT exists(ps, p -> p IS NULL) AND arrays_overlap({rs.question_types('ps', text=True)}, {array(types)})"
    return documents.where(let(each, "ps", wanted))


def read_reference(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """The enrichment table: every column text, plus ``file_order`` for first-match."""
    configure(spark)
    raw = spark.read.csv(path, header=True, inferSchema=False, escape='"', multiLine=multiline)
    texts = [
        F.when(~F.col(c).isin(MISSING_WORDS), F.col(c)).alias(c) if c in raw.columns
        else F.lit(None).cast("string").alias(c)
        for c in REFERENCE_COLUMNS
    ]
    order = F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return raw.select(*texts, order.alias("file_order"))
