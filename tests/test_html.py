"""HTML helpers against results worked out by hand."""

import json
import random
import re

import pytest

from quillbank.functions.html import outline_of, without_p_attributes
from quillbank.operators.clean import clean


@pytest.mark.parametrize("given, expected", [
    ("no tags", "no tags"),
    ("<p>a & b</p>", "<p>a & b</p>"),
    ('<p class="x">a</p>', "<p>a</p>"),
    ('<p id="1">a &amp; b &lt; c &quot;d&quot;</p>', '<p>a &amp; b &lt; c "d"</p>'),
    ('<p id=1><img src="b" alt="a"><br></p>', '<p><img alt="a" src="b"/><br/></p>'),
    ('<p id=1>x<p id=2>y', "<p>x<p>y</p></p>"),
    ('<div z="1" a="2" class=" b   c "><p k>x</p></div>', '<div a="2" class="b c" z="1"><p>x</p></div>'),
    ("<p id=1></p></b><i>t</p>", "<p></p><i>t</i>"),
    ("<p id=1>&eacute;&#1632;&nosuch;</p>", "<p>é٠&amp;nosuch</p>"),
    ("<p id=1> </p>\n \n<span title='say \"x\"'></span>", "<p> </p>\n<span title='say \"x\"'></span>"),
    ("<script>a<b && '<p id=1>'</script><p id=2>x</p>", "<script>a<b && '<p id=1>'</script><p>x</p>"),
    ("<!-- <p id=1> --><p id=2>x</p>", "<!-- <p id=1> --><p>x</p>"),
])
def test_strip_p_attributes(given, expected):
    assert without_p_attributes(given) == expected


@pytest.mark.parametrize("given, n_top, first, divs", [
    ("", 0, None, []),
    ("text", 0, None, []),
    ("<p>a</p> <p>b</p>", 2, "p", []),
    ("<div><div>a</div><p>x</p><div>b", 1, "div", ["<div>a</div>", "<div>b</div>"]),
])
def test_outline(given, n_top, first, divs):
    assert outline_of(given) == (n_top, first, divs, None)


def cleaned_texts(spark, raws):
    df = spark.createDataFrame([(f"/{k:04d}.json", f"{k}.json", r) for k, r in enumerate(raws)], "path string, filename string, raw string")
    return [r.cleaned_json for r in clean(df).orderBy("path").collect()]


def test_clean_document_walks_every_string(spark):
    raw = '{"b": ["<p id=1>x</p>", {"a": "<p>y</p>", "n": 1.0}], "a": null}'
    assert cleaned_texts(spark, [raw, "{"]) == ['{"b": ["<p>x</p>", {"a": "<p>y</p>", "n": 1.0}], "a": null}', None]


def plain_clean(raw):
    """Every string value by the parser of the language, all else by its own text; keys and numbers as they are."""

    def walk(v):
        if isinstance(v, str):
            return without_p_attributes(v)
        if isinstance(v, list):
            return [walk(x) for x in v]
        if isinstance(v, dict):
            return {k: walk(x) for k, x in v.items()}
        return v

    cleaned = walk(json.loads(raw))
    try:
        json.dumps(cleaned, ensure_ascii=False).encode()
    except UnicodeEncodeError:
        return None
    return cleaned


def test_cleaned_documents_equal_a_walk_of_the_parsed_ones(spark):
    rng = random.Random(5)
    pieces = ["<p id=1>", "<p>", "</p>", "<P\tclass='a'>", "\"", "\\", "/", ":", ",", "{", "}", "é", "💡", "\n", "text", " ", "<b>", "&amp;", "<p/>", "\u0001", "\\u003c"]

    def text():
        return "".join(rng.choice(pieces) for _ in range(rng.randint(0, 8)))

    def value(depth):
        kind = rng.random()
        if depth and kind < 0.3:
            return [value(depth - 1) for _ in range(rng.randint(0, 4))]
        if depth and kind < 0.6:
            return {text(): value(depth - 1) for _ in range(rng.randint(0, 4))}
        return rng.choice([None, True, 1, 2.5, text(), text(), text()])

    raws = [json.dumps(value(3), ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 1])) for _ in range(300)]
    raws += ['"<p id=1>x"', '["\\ud83d\\udca1<p id=1>x</p>", "\\ud800"]', '{"<p id=1>" : "<p id=1>x</p>"}', '["\\u003Cp id=1>x"]', "[]"]
    got = cleaned_texts(spark, raws)
    for raw, cleaned in zip(raws, got):
        expect = plain_clean(raw.replace("\\ud800", "?"))
        assert json.loads(cleaned.replace("\\ud800", "?")) == expect, raw
        if expect == json.loads(raw.replace("\\ud800", "?")):
            assert cleaned == raw


def test_long_documents_and_literals(spark):
    many = json.dumps([f"<p id={k}>x</p>" if k % 3 else "plain" for k in range(20_000)])
    long = json.dumps({"a": "\\\"" * 300_000 + "<p id=1>x</p>", "b": "y" * 1_000_000})
    got = cleaned_texts(spark, [many, long])
    assert json.loads(got[0]) == ["<p>x</p>" if k % 3 else "plain" for k in range(20_000)]
    assert json.loads(got[1]) == {"a": "\\\"" * 300_000 + "<p>x</p>", "b": "y" * 1_000_000}


def test_python_sees_fragments_only(spark):
    df = spark.createDataFrame([("/1.json", "1.json", "{}")], "path string, filename string, raw string")
    plan = clean(df)._jdf.queryExecution().executedPlan().toString()
    calls = [line for line in plan.split("\n") if "_cleaned_lists(" in line]
    assert calls and all(re.search(r"_cleaned_lists\((CASE WHEN|_gen|pythonUDF|fragments|_w)", line) for line in calls) and "_cleaned_lists(raw" not in plan


def test_very_deep_fragment():
    deep = "<div>" * 5000 + "<p id=1>x</p>"
    assert without_p_attributes(deep) == "<div>" * 5000 + "<p>x</p>" + "</div>" * 5000
