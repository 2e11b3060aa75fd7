"""Scans, sinks and the companion jobs on small files."""

import json

from pyspark.sql import functions as F

from quillbank import fixed_values as fv
from quillbank.operators.clean import clean
from quillbank.operators.enrich import enrich, first_matches, id_sketch, with_chance
from quillbank.sources import sinks
from quillbank.sources.documents import filter_types, read_documents, read_reference, with_fields
from tests.samples import document, part


def write(folder, files):
    for name, value in files.items():
        path = folder / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(value if isinstance(value, str) else json.dumps(value, ensure_ascii=False, indent=2))


def named(number, *parts, **changes):
    return document(*parts, question_id=str(number), metadata={"id": 1, "mapped_id": number}, **changes)


def test_migrate_routes_every_document(spark, tmp_path):
    source, target = tmp_path / "in", tmp_path / "out"
    write(source, {
        "a/1.json": named(1, part("frq")), "b/1.json": named(1, part("frq", stem=None)), "2.json": named(2, part("mcq")),
        "3.json": "{", "4.json": named(4, part("oq"), source=None), "note.txt": "{}"})
    out = sinks.migrate(spark, str(source), str(target))
    assert out["summary"].first().asDict() == {
        "total": 5, "success": 2, "pre_failed": 1, "conversion_failed": 1, "post_failed": 1, "failed": 3,
        "warnings": 0, "success_rate": 40.0, "all_converted": False}
    bank = spark.read.parquet(str(target / "bank"))
    assert bank.count() == 5 and bank.select("path").distinct().count() == 5
    kept = bank.where(F.col("outcome") == fv.PRE_FAILED).first().payload
    assert kept == (source / "b/1.json").read_text()
    assert sorted(r["Filename"] for r in spark.read.parquet(str(target / "errors")).collect()) == [
        "1.json", "3.json", "4.json"]
    assert not (target / "warnings").exists()

    dry = sinks.migrate(spark, str(source), str(tmp_path / "dry"), types=["mcq"], dry_run=True)
    assert dry["summary"].first().total == 1
    assert not (tmp_path / "dry").exists()


def test_scan_is_recursive_or_flat(spark, tmp_path):
    write(tmp_path, {"1.json": "{}", "x/2.json": "{\n\n}"})
    assert read_documents(spark, str(tmp_path)).count() == 2
    flat = read_documents(spark, str(tmp_path), recursive=False)
    assert [r.filename for r in flat.collect()] == ["1.json"]
    assert read_documents(spark, str(tmp_path / "x/2.json")).first().raw == "{\n\n}"


def test_filter_is_literal(spark):
    rows = [("a", "a.json", json.dumps(document(part("frq_ai")))), ("b", "b.json", json.dumps(document(part("oq"), part("frq", n=2)))),
            ("c", "c.json", '{"parts":[1,{"type":"frq"}]}'), ("d", "d.json", "{"), ("e", "e.json", '{"parts":[{}]}')]
    bank = with_fields(spark.createDataFrame(rows, "path string, filename string, raw string"))
    assert [r.path for r in filter_types(bank, ["frq"]).collect()] == ["b"]
    assert [r.path for r in filter_types(bank, ["unknown"]).collect()] == ["e"]


def test_enrich_from_csv(spark, tmp_path):
    write(tmp_path / "docs", {
        "1.json": {"z": 1.5, "grade": 3, "parts": [{"type": "mcq"}], "metadata": {"y": [1, "é"], "mapped_id": 1}},
        "2.json": {"parts": [{}, {}], "metadata": {"mapped_id": "2"}}, "3.json": {"parts": [], "metadata": {}},
        "4.json": {"metadata": None}, "5.json": {"parts": [{"type": None}]}})
    write(tmp_path, {"r.csv": "base_question_id,section_id,language,subject,grade,extra\n"
                              '1,007,en,"a ""b"", c",,x\n1,no,no,no,no,no\n9,q,q,q,q,q\n'})
    reference = read_reference(spark, str(tmp_path / "r.csv"))
    assert reference.count() == 3
    got = {r.filename: r for r in enrich(read_documents(spark, str(tmp_path / "docs"), False), reference).collect()}
    assert [(got[f"{i}.json"].category, got[f"{i}.json"].status) for i in (1, 2, 3)] == [
        ("mcq", "enriched"), ("multipart", "no_match"), ("unknown", "no_id")]
    assert {got[f"{i}.json"].status for i in (4, 5)} == {"unreadable"}
    doc = json.loads(got["1.json"].enriched_json)
    assert list(doc) == ["z", "grade", "parts", "metadata", "answer", "section_id", "language", "subject_id",
                         "subject", "grade_id", "country", "question_id"]
    assert (doc["section_id"], doc["subject"], doc["grade"], doc["country"], doc["question_id"], doc["z"]) == (
        "007", 'a "b", c', None, None, "1", 1.5)
    assert list(doc["metadata"]) == ["y", "mapped_id"]
    assert got["2.json"].enriched_json == (tmp_path / "docs/2.json").read_text()
    sinks.write_enriched(enrich(read_documents(spark, str(tmp_path / "docs"), False), reference), str(tmp_path / "e"))
    assert spark.read.parquet(str(tmp_path / "e")).count() == 3


def test_first_match_with_a_dominant_key(spark):
    """A third of the rows share one id; the earliest row still wins for every id."""
    rows = spark.range(30000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id % 100 AS string) END AS base_question_id",
        "CAST(30000 - id AS string) AS section_id", "'en' AS language", "'s' AS subject", "'g' AS grade", "'c' AS country",
        "30000 - id AS file_order")
    got = {r.mapped_id: r.match.section_id for r in first_matches(rows).collect()}
    assert got["hot"] == str(30000 - 29997) and len(got) == 101
    plan = first_matches(rows)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan and "Window" not in plan


def wide_bank(spark, n):
    """Ids as numbers, texts, missing; a third of the documents share one id."""
    raw = ("CASE WHEN id % 11 = 0 THEN '{' WHEN id % 7 = 0 THEN '{\"parts\":[]}' "
           "ELSE concat('{\"metadata\":{\"mapped_id\":', CASE WHEN id % 3 = 0 THEN '5' WHEN id % 2 = 0 THEN concat('\"', id, '\"') ELSE CAST(id AS string) END, '}}') END")
    return spark.range(n).selectExpr("concat('/', id, '.json') AS path", "concat(id, '.json') AS filename", f"{raw} AS raw").repartition(3)


def test_enrichment_with_few_matches(spark):
    """The sketch changes the plan, not a row; documents without a chance stay out of the join's exchange."""
    reference = spark.range(0, 4000, 17).selectExpr("CAST(id AS string) AS base_question_id", "CAST(-id AS string) AS section_id", "'en' AS language",
                                                    "'s' AS subject", "'g' AS grade", "'c' AS country", "id AS file_order")
    reference = reference.unionAll(spark.createDataFrame([("5", "hot", "en", "s", "g", "c", 0)], reference.schema))
    docs = wide_bank(spark, 5000)
    rows = lambda df: sorted(df.collect(), key=repr)
    usual, few = enrich(docs, reference), enrich(docs, reference, few_matches=True)
    assert rows(usual) == rows(few) and few.columns == usual.columns
    keyed = spark.range(200_000).selectExpr("CAST(id AS string) AS join_key", "id % 10 <> 0 AS has_id")
    first = keyed.where("has_id AND join_key % 13 = 0")
    got = with_chance(keyed, id_sketch(first)).groupBy("has_id", F.expr("has_id AND join_key % 13 = 0").alias("there"), "chance").count().collect()
    seen = {(r.has_id, r.there, r.chance): r["count"] for r in got}
    assert (True, True, False) not in seen and (False, False, True) not in seen
    assert seen.get((True, False, True), 0) < 0.001 * seen[True, False, False]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = enrich(docs, reference, few_matches=True)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    apart = plan[plan.rindex("NOT "):]
    assert "Union" in plan and "SortMergeJoin" in plan and "BroadcastHashJoin" in plan and "hashpartitioning(has_id" not in apart


def test_enrichment_by_an_empty_table(spark):
    reference = spark.createDataFrame([], "base_question_id string, section_id string, language string, subject string, grade string, country string, file_order bigint")
    got = enrich(wide_bank(spark, 50), reference, few_matches=True)
    assert {r.status for r in got.collect()} == {"no_match", "no_id", "unreadable"} and got.count() == 50


def test_clean_job(spark, tmp_path):
    write(tmp_path / "in", {"a/1.json": {"s": ["<p id='1'>x</p>"]}, "2.json": {"s": "x"}, "3.json": "{",
                            "4.json": '{"s": "\\u003cp id=1>x</p>"}'})
    base = str(tmp_path / "in")
    sinks.write_cleaned(clean(read_documents(spark, base), base), str(tmp_path / "out"))
    got = {r.rel_path: json.loads(r.cleaned_json) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {"a/1.json": {"s": ["<p>x</p>"]}, "2.json": {"s": "x"}, "4.json": {"s": "<p>x</p>"}}
