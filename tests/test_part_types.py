"""A fourteenth part type, registered from outside."""

import json

import pytest

from quillbank import fixed_values as fv
from quillbank.functions.sql import struct
from quillbank.functions.variants import field, is_filled_string, is_string, string_of
from quillbank.operators.convert import head
from quillbank.operators.issues import issues, rule
from quillbank.operators.part_types import NO, PartType, known_types, register, registered, unregister
from quillbank.plans import reports
from quillbank.plans.migrate import classify
from quillbank.sources.documents import filter_types
from tests.samples import document, part

PAIRS = PartType(
    legacy="wordPairs", new="pairs", reads=("left", "pair list"), new_keys=("left", "words"), written=["left", "[words]"],
    convert=lambda p, language, explanation: struct(
        **head(p, "pairs"), left=string_of(f"{p}.left"), words=field(f"{p}.`pair list`", "$", "array<string>"), explanation=explanation),
    checks=lambda p: issues(rule(f"NOT {is_filled_string(f'{p}.left')}", "U1", p=NO, field="left")),
    new_checks=lambda p: issues(rule(f"{is_string(f'{p}.words')}", "U2", p=NO, value=string_of(f"{p}.words"))),
    messages={"U1": "Part {p} (pairs): '{field}' must be a text", "U2": "Part {p} (pairs): one word only, '{value}'"},
)


def pairs(n=1, **changes):
    return {"n": n, "type": "wordPairs", "stem": "<p>Pair.</p>", "standalone": True, "left": "a", "pair list": ["x", "y"], **changes}


def bank(spark, *docs):
    rows = [(f"/{k}.json", f"{k}.json", json.dumps({**d, "question_id": str(k), "metadata": {"id": 1, "mapped_id": k}})) for k, d in enumerate(docs)]
    return spark.createDataFrame(rows, "path string, filename string, raw string")


DOCS = [
    document(pairs()), document(pairs(left=None)), document(pairs(**{"pair list": ["x"]})), document(part("mcq")),
    document(part("frq"), pairs(2), statement="s", answer="<div><div>1</div><div>2</div></div>"),
]


def test_a_registered_type_is_checked_converted_and_reported(spark):
    with registered(PAIRS):
        out = classify(bank(spark, *DOCS))
        got = {r.filename: r for r in out.collect()}
        errors = {(r["Filename"], r["Error Message"]) for r in reports.errors(out).collect()}
        kept = [r.filename for r in filter_types(bank(spark, *DOCS), ["wordPairs"]).collect()]
    assert [got[f"{k}.json"].outcome for k in range(5)] == [fv.CONVERTED, fv.PRE_FAILED, fv.POST_FAILED, fv.CONVERTED, fv.CONVERTED]
    assert errors == {("1.json", "Part 1 (pairs): 'left' must be a text"), ("2.json", "Part 1 (pairs): one word only, 'x'")}
    assert got["0.json"].converted_json.endswith(
        '"content":{"parts":[{"n":1,"type":"pairs","stem":"<p>Pair.</p>","left":"a","words":["x","y"],"explanation":null}]}}')
    second = json.loads(got["4.json"].converted_json)["content"]["parts"][1]
    assert list(second) == ["n", "type", "stem", "left", "words", "explanation"] and second["explanation"] == "<div>2</div>"
    assert sorted(kept) == ["0.json", "1.json", "2.json", "4.json"]


def test_without_the_registration_the_type_is_unknown(spark):
    assert "wordPairs" not in known_types()
    got = classify(bank(spark, DOCS[0])).first()
    assert got.outcome == fv.PRE_FAILED and [e.rule_id for e in got.errors] == ["V7"]


def test_names_and_rules_are_not_taken_twice():
    with pytest.raises(ValueError, match="mcq"):
        register(PartType("mcq", "m", PAIRS.convert, []))
    with pytest.raises(ValueError, match="V1"):
        register(PartType("other", "o", PAIRS.convert, [], messages={"V1": "x"}))
    with registered(PAIRS):
        register(PAIRS)
        with pytest.raises(ValueError, match="pairs"):
            register(PartType("other", "pairs", PAIRS.convert, []))
        with pytest.raises(ValueError, match="U1"):
            register(PartType("other", "o", PAIRS.convert, [], messages={"U1": "x"}))
    assert known_types() == fv.PART_TYPES
    unregister("wordPairs")
