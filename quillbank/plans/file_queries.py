"""Named queries over files: documents derived from `supplier` are written one a file, scanned, and written again by the jobs."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillbank.operators.clean import base_folders, clean, relative_path
from quillbank.operators.enrich import enrich
from quillbank.plans.banks import spread, table
from quillbank.plans.migrate import classify
from quillbank.sources import sinks
from quillbank.sources.documents import read_documents, read_reference, scan_documents
from quillbank.sources.scratch import scratch_folder

#: A document of one part; every seventh has no stem, the one behind it no source, the next is no JSON.
QUESTION = (
    "CASE WHEN id % 7 = 3 THEN concat('{\"question_id\": ', id) ELSE concat('{\"parts\": [{\"n\":1,\"type\":\"frq\",\"stem\":', "
    "CASE WHEN id % 7 = 1 THEN 'null' ELSE concat('\"<p class=c>', name, ' é</p>\"') END, ',\"standalone\":true,\"choices\":[],"
    "\"answer\":\"A ', id, '\",\"ai\":{\"ai_template_id\":123456789012}}],\n\"section_id\":\"7\",\"language\":\"en\",\"subject_id\":\"1\","
    "\"subject\":\"S\",\"grade_id\":\"2\",\"grade\":\"G\",\"country\":\"us\",\"question_id\":\"', id, '\",\"source\":', "
    "CASE WHEN id % 7 = 2 THEN 'null' ELSE '\"scan\"' END, ',\"metadata\":{\"id\":', id, ',\"mapped_id\":', id, '}}') END"
)
#: Every tenth lies in the folder itself, the others by nation; names have signs that are written in another way in a URI.
PLACE = "concat(CASE WHEN id % 10 = 0 THEN '' ELSE concat('nation ', nation, '/') END, id, '.json')"
SUPPLIERS = "s_suppkey AS id", "s_nationkey AS nation", "s_name AS name"


def _folder(spark, sf_dir, raw: str) -> str:
    """A folder with a document and a file of another kind for every supplier."""
    folder = scratch_folder(spark)
    rows = spread(table(spark, sf_dir, "supplier")).selectExpr(*SUPPLIERS).selectExpr(f"{PLACE} AS place", f"{raw} AS raw")
    both = rows.selectExpr("inline(array(struct(place, raw), struct(replace(place, '.json', '+.txt') AS place, '{}' AS raw)))")
    sinks.write_files(both, F.col("place"), F.col("raw"), folder)
    return folder


def _read_back(spark, folder: str) -> DataFrame:
    found = read_documents(spark, folder)
    return found.select(relative_path(F.col("path"), base_folders(spark, folder)).alias("rel_path"), F.col("raw").alias("text"))


def scan_files(spark, sf_dir):
    """Both scans of a folder: path, name, bytes, and whether the flat scan has the file too."""
    folder = _folder(spark, sf_dir, QUESTION)
    place = relative_path(F.col("path"), base_folders(spark, folder)).alias("rel_path")
    flat = read_documents(spark, folder, recursive=False).select(place, F.lit(True).alias("flat"))
    found = scan_documents(spark, folder).select(place, "filename", F.sha2(F.col("raw").cast("binary"), 256).alias("raw_sha256"))
    return found.join(flat, "rel_path", "left").withColumn("flat", F.coalesce("flat", F.lit(False)))


def routed_files(spark, sf_dir):
    """The migrated bank as files: a folder for each outcome, original bytes of what failed before the conversion's end."""
    folder, target = _folder(spark, sf_dir, QUESTION), scratch_folder(spark)
    bank = scratch_folder(spark)
    sinks.write_bank(classify(read_documents(spark, folder)), bank)
    sinks.write_bank_files(spark.read.parquet(bank), folder, target)
    return _read_back(spark, target)


def mirrored_files(spark, sf_dir):
    """Cleaned documents as files at the paths that they had; what is no JSON is left out."""
    folder, target = _folder(spark, sf_dir, QUESTION), scratch_folder(spark)
    sinks.write_cleaned_files(clean(read_documents(spark, folder), folder), target)
    return _read_back(spark, target)


def dry_run_summary(spark, sf_dir):
    """The run counters of a migration that writes nothing."""
    return sinks.migrate(spark, _folder(spark, sf_dir, QUESTION), "nowhere", dry_run=True)["summary"]


#: A table of two rows for each supplier but every fourth, with words that stand for missing cells and a quoted comma.
REFERENCE = (
    "concat('section_id,base_question_id,language,subject,grade,country,more\n', id + 5, ',', id, ',en,\"', name, ', \"\"x\"\"\",', "
    "get(array('', 'NA', '4', 'null', 'n/a', ' NA'), CAST(id % 6 AS int)), ',us,y\n', id, ',', id, ',no,no,no,no,no\n')"
)


def _reference(spark, sf_dir) -> str:
    """Files of a few lines each, as exports come."""
    folder = scratch_folder(spark)
    rows = spread(table(spark, sf_dir, "supplier")).selectExpr(*SUPPLIERS).where("id % 4 <> 0")
    sinks.write_files(rows.selectExpr("concat(id, '.csv') AS place", f"{REFERENCE} AS text"), F.col("place"), F.col("text"), folder)
    return folder


def reference_rows(spark, sf_dir):
    """The enrichment table as it is read: text columns, missing words as nulls."""
    return read_reference(spark, _reference(spark, sf_dir)).drop("file_order")


def enriched_files(spark, sf_dir):
    """A flat folder enriched by CSV files, written by category."""
    raw = ("concat('{\"z\":', id, ',\"grade\":9,\"parts\":[', get(array('', '{\"type\":\"frq\"}', '{},{}'), CAST(id % 3 AS int)), "
           "'],\"metadata\":{\"mapped_id\":', id, '}}')")
    folder, target = scratch_folder(spark), scratch_folder(spark)
    rows = spread(table(spark, sf_dir, "supplier")).selectExpr(*SUPPLIERS).selectExpr("concat(id, '.json') AS place", f"{raw} AS raw")
    sinks.write_files(rows, F.col("place"), F.col("raw"), folder)
    enriched = enrich(read_documents(spark, folder, recursive=False), read_reference(spark, _reference(spark, sf_dir)))
    sinks.write_enriched_files(enriched, folder, target)
    return _read_back(spark, target)


QUERIES = {f.__name__: f for f in (scan_files, routed_files, mirrored_files, dry_run_summary, reference_rows, enriched_files)}

_S = """WITH s AS (SELECT s_suppkey AS id, s_name AS name,
  CASE WHEN s_suppkey % 10 = 0 THEN '' ELSE 'nation ' || s_nationkey || '/' END || s_suppkey || '.json' AS place FROM supplier),
d AS (SELECT *, id % 7 AS k, CASE WHEN id % 7 = 3 THEN '{"question_id": ' || id ELSE
  '{"parts": [{"n":1,"type":"frq","stem":' || CASE WHEN id % 7 = 1 THEN 'null' ELSE '"<p class=c>' || name || ' é</p>"' END
  || ',"standalone":true,"choices":[],"answer":"A ' || id || '","ai":{"ai_template_id":123456789012}}],' || chr(10)
  || '"section_id":"7","language":"en","subject_id":"1","subject":"S","grade_id":"2","grade":"G","country":"us","question_id":"' || id
  || '","source":' || CASE WHEN id % 7 = 2 THEN 'null' ELSE '"scan"' END || ',"metadata":{"id":' || id || ',"mapped_id":' || id || '}}' END AS raw FROM s)"""
_MISSING = "(['', 'NA', '4', 'null', 'n/a', ' NA'])[id % 6 + 1]"

ORACLES = {
    "scan_files": _S + " SELECT place AS rel_path, id || '.json' AS filename, sha256(raw) AS raw_sha256, id % 10 = 0 AS flat FROM d",
    "routed_files": _S + """
SELECT CASE k WHEN 3 THEN 'CONVERSION_FAILED' WHEN 1 THEN 'PRE_CONVERSION_VALIDATION_FAILED' WHEN 2 THEN 'POST_CONVERSION_VALIDATION_FAILED'
         ELSE 'CONVERTED' END || '/' || place AS rel_path,
  CASE WHEN k IN (1, 3) THEN raw ELSE '{"question_id":"' || id || '","parent_id":"' || id || '","language_code":"en","language":"English",'
    || '"country_code":"us","country":"United States","subject":"S","subject_id":"1","grade":"G","grade_id":"2","number_of_parts":1,'
    || '"section_id":"7","source":' || CASE WHEN k = 2 THEN 'null' ELSE '"scan"' END || ',"content":{"parts":[{"n":1,"type":"frq","stem":"<p class=c>'
    || name || ' é</p>","ai_template_id":"123456789012","acceptable_answers":["A ' || id || '"],"explanation":null}]}}' END AS text FROM d""",
    "mirrored_files": _S + " SELECT place AS rel_path, replace(raw, '<p class=c>', '<p>') AS text FROM d WHERE k <> 3",
    "dry_run_summary": _S + """
SELECT count(*) AS total, count(*) FILTER (k NOT IN (1, 2, 3)) AS success, count(*) FILTER (k = 1) AS pre_failed, count(*) FILTER (k = 3) AS conversion_failed,
  count(*) FILTER (k = 2) AS post_failed, count(*) FILTER (k IN (1, 2, 3)) AS failed, CAST(0 AS BIGINT) AS warnings,
  round(100.0 * count(*) FILTER (k NOT IN (1, 2, 3)) / count(*), 2)::DOUBLE AS success_rate, count(*) FILTER (k IN (1, 2, 3)) = 0 AS all_converted FROM d""",
    "reference_rows": f"""WITH s AS (SELECT s_suppkey AS id, s_name AS name FROM supplier WHERE s_suppkey % 4 <> 0)
SELECT id::VARCHAR AS base_question_id, (id + 5)::VARCHAR AS section_id, 'en' AS language, name || ', "x"' AS subject,
  CASE WHEN {_MISSING} IN ('', 'NA', 'null', 'n/a') THEN NULL ELSE {_MISSING} END AS grade, 'us' AS country FROM s
UNION ALL SELECT id::VARCHAR, id::VARCHAR, 'no', 'no', 'no', 'no' FROM s""",
    "enriched_files": f"""WITH s AS (SELECT s_suppkey AS id, s_name AS name, (['', '{{"type":"frq"}}', '{{}},{{}}'])[s_suppkey % 3 + 1] AS parts FROM supplier)
SELECT (['unknown', 'frq', 'multipart'])[id % 3 + 1] || '/' || id || '.json' AS rel_path,
  CASE WHEN id % 4 = 0 THEN '{{"z":' || id || ',"grade":9,"parts":[' || parts || '],"metadata":{{"mapped_id":' || id || '}}}}' ELSE
  '{{"z":' || id || ',"grade":' || CASE WHEN {_MISSING} IN ('', 'NA', 'null', 'n/a') THEN 'null' ELSE '"' || {_MISSING} || '"' END || ',"parts":[' || parts
  || '],"metadata":{{"mapped_id":' || id || '}},"answer":"","section_id":"' || (id + 5) || '","language":"en","subject_id":"123456789012","subject":"'
  || name || ', \\"x\\"","grade_id":"123456789012","country":"us","question_id":"' || id || '"}}' END AS text FROM s""",
}
