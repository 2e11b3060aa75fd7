"""Documents and names that a large bank is bound to hold somewhere."""

import json
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quillbank import fixed_values as fv
from quillbank.functions.text import json_number
from quillbank.functions.variants import shown
from quillbank.operators.clean import clean
from quillbank.operators.enrich import enrich
from quillbank.plans.migrate import classify
from quillbank.sources import sinks
from quillbank.sources.documents import filter_types, read_documents, read_reference, with_fields
from tests.samples import document, part


def frame(spark, *raws):
    return spark.createDataFrame([(f"/in/{k}.json", f"{k}.json", r) for k, r in enumerate(raws)], "path string, filename string, raw string")


def test_a_lone_surrogate_ends_no_migration(spark):
    parts = [part("frq"), part("frq", n=2)]
    bad, good = (json.dumps(document(*parts, question_id=str(k), metadata={"id": 1, "mapped_id": k}, statement="s", answer=a))
                 for k, a in enumerate(["<div><div>&#xD800;</div><div>b</div></div>", "<div><div>a</div><div>b</div></div>"]))
    got = {r.filename: r for r in classify(frame(spark, bad, good)).collect()}
    assert got["0.json"].outcome == fv.CONVERSION_FAILED and [e.rule_id for e in got["0.json"].errors] == ["X10"]
    assert got["1.json"].outcome == fv.CONVERTED


def test_a_lone_surrogate_ends_no_cleaning(spark, tmp_path):
    raws = ['{"s":"<p id=1>\\ud800</p>"}', '{"s":"<p id=1>&#xD800;</p>"}', '{"s":"<p id=1>x</p>"}', '{"s":"<p>y</p>"}', "{", None]
    cleaned = clean(frame(spark, *raws), "/in")
    assert [r.cleaned_json for r in cleaned.orderBy("path").collect()] == [None, None, '{"s":"<p>x</p>"}', '{"s":"<p>y</p>"}', None, None]
    sinks.write_cleaned(cleaned, str(tmp_path / "out"))
    assert sorted(r.filename for r in spark.read.parquet(str(tmp_path / "out_errors")).collect()) == ["0.json", "1.json", "4.json", "5.json"]
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_only_documents_that_need_it_change(spark):
    raws = ['{"a" : "<p>x</p>",\n "b":1.0}', '{"<p id=1>":"<P\\nid=1>x</p><p>"}', '{"a":"\\u003cp id=1>x</p>"}', '{"a":"<pre class=x>"}', '{"a":"<p/ >x"}']
    got = [r.cleaned_json for r in clean(frame(spark, *raws)).orderBy("path").collect()]
    assert got == [raws[0], '{"<p id=1>":"<p>x</p><p></p>"}', '{"a":"<p>x</p>"}', raws[3], raws[4]]


def test_deep_documents_are_not_lost(spark):
    raw = '{"a":' + "[" * 400 + '"<p id=1>x</p>"' + "]" * 400 + "}"
    assert clean(frame(spark, raw)).first().cleaned_json == raw.replace(" id=1", "")


def test_names_are_those_on_disk(spark, tmp_path):
    names = ["1 x.json", "a+b.json", "50%.json", "é.json", "%20.json"]
    for n in names:
        (tmp_path / "my docs" / "in").mkdir(parents=True, exist_ok=True)
        stem = n.removesuffix(".json")
        (tmp_path / "my docs" / "in" / n).write_text(json.dumps(document(part("frq"), question_id=stem, metadata={"id": 1, "mapped_id": stem})))
    documents = read_documents(spark, str(tmp_path / "my docs"))
    assert sorted(r.filename for r in documents.collect()) == sorted(names)
    assert {r.outcome for r in classify(documents).collect()} == {fv.CONVERTED}


def test_mirrored_paths(spark, tmp_path, monkeypatch):
    base = tmp_path / "my docs" / "in"
    for name in ("a/1 x.json", "in/é.json", "plugin/in/2.json"):
        (base / name).parent.mkdir(parents=True, exist_ok=True)
        (base / name).write_text("{}")
    want = ["a/1 x.json", "in/é.json", "plugin/in/2.json"]
    documents = read_documents(spark, str(base))
    for given in (str(base), f"{base}/", base.as_uri().replace("%20", " ")):
        assert sorted(r.rel_path for r in clean(documents, given).collect()) == want
    other = sorted(r.rel_path for r in clean(documents, "in/").collect())
    assert len(set(other)) == 3 and all(p.endswith(w) and p != w for p, w in zip(other, want))
    relative = frame(spark, "{}").withColumn("path", F.lit("bank/x/1.json"))
    assert clean(relative, "bank").first().rel_path == "x/1.json"


def test_unreadable_documents_of_the_enrichment_are_listed(spark, tmp_path):
    (tmp_path / "r.csv").write_text("base_question_id,section_id\n1,2\n")
    enriched = enrich(frame(spark, "{", '{"parts":[]}'), read_reference(spark, str(tmp_path / "r.csv")))
    sinks.write_enriched(enriched, str(tmp_path / "out"))
    assert [r.filename for r in spark.read.parquet(str(tmp_path / "out_errors")).collect()] == ["0.json"]


@pytest.mark.parametrize("text, written", [
    ("12345678901234567.0", "12345678901234567"), ("5", "5"), ("5.", None), ("-7.000", "-7"), ("1e3", "1000"), ("2.5e1", "25"), ("2.5", "2.5"),
    ("9" * 38, "9" * 38), ("1e20", "1" + "0" * 20), ("٣٫٥", None), ("٣", "3"), ("x", None), ("", None), ("0.0", "0"),
])
def test_whole_numbers_are_integers(spark, text, written):
    got = spark.createDataFrame([(text,)], "t string").selectExpr(f"to_json({json_number('t')}) AS n").first().n
    assert got == written


@pytest.mark.parametrize("number", [12345678.5, 123456789012.0, 1e-5, 1e16, 1e15, 1.5, 0.0001, 123456.789e3, 1e100, -2.5e-7, 9999999999999998.0, 1.7e308])
def test_floats_print_as_python_prints_them(spark, number):
    got = spark.createDataFrame([(repr(number),)], "t string").selectExpr("parse_json(t) AS v").selectExpr(f"{shown('v')} AS s").first().s
    assert got == repr(number)


def test_types_are_filtered_alike_with_and_without_the_skeleton(spark):
    raws = [json.dumps(document(part("frq"))), json.dumps(document(part("mcq"), part("frq", n=2))), json.dumps(document(part("mcq"))), "{", '{"parts":[null]}', '{"parts":[{}]}']
    documents = frame(spark, *raws)
    names = lambda df: sorted(r.filename for r in df.collect())
    assert names(filter_types(documents, ["frq"])) == names(filter_types(with_fields(documents), ["frq"])) == ["0.json", "1.json"]
    assert names(filter_types(documents, ["unknown"])) == ["5.json"]


def test_session_settings_are_left_alone(spark, tmp_path):
    assert spark.conf.get("spark.sql.codegen.wholeStage") == "true"


SAMPLES = os.environ.get("QUILLBANK_SAMPLES", "")


@pytest.mark.skipif(not os.path.isdir(SAMPLES), reason="QUILLBANK_SAMPLES names no folder with in/ and out/")
def test_saved_conversions(spark):
    """Saved results, files of the same name below out/, against this conversion of in/."""
    bank = {r.filename: r for r in classify(read_documents(spark, f"{SAMPLES}/in")).collect()}
    saved = list(Path(SAMPLES, "out").rglob("*.json"))
    assert saved and all(json.loads(bank[p.name].payload) == json.loads(p.read_text()) for p in saved)
