"""Leaves and parts are taken out of a document once, and tests on a value copy nothing of it."""

import pytest

from quillbank.functions import html
from quillbank.functions import variants as vs
from quillbank.operators import post_rules, pre_rules, skeleton


def test_parts_of_converted_content_are_taken_out_once():
    assert post_rules.content_issues().count("try_variant_get(root.content") == 1


def test_leaves_of_a_part_are_taken_out_once():
    assert pre_rules.frq_issues().count("$.ai_template_id") == 1
    assert skeleton.part("p").count("schema_of_variant(p.type)") == 1


def test_tests_on_a_value_neither_copy_it_nor_print_its_schema():
    for test in (vs.is_array, vs.is_filled_array, vs.is_object, vs.is_filled_object):
        assert "'variant')" not in test("v") and "schema_of_variant" not in test("v")


#: JSON text -> array, with an element, object, with a key, empty, falsy
VALUES = {
    "[]": (True, False, False, False, True, True), "[null]": (True, True, False, False, False, False),
    "[[1],[]]": (True, True, False, False, False, False), '[{"a":1},"b"]': (True, True, False, False, False, False),
    "{}": (False, False, True, False, True, True), '{"x":null}': (False, False, True, True, False, False),
    '{"x":[true],"y":{}}': (False, False, True, True, False, False), '""': (False, False, False, False, True, True),
    '" "': (False, False, False, False, True, False), '"[]"': (False, False, False, False, False, False),
    "null": (False, False, False, False, True, True), "0": (False, False, False, False, False, True),
    "false": (False, False, False, False, False, True), "1.5": (False, False, False, False, False, False),
    "": (False, False, False, False, True, True),
}


def test_shapes_of_values(spark):
    tests = (vs.is_array, vs.is_filled_array, vs.is_object, vs.is_filled_object, vs.is_empty, vs.is_falsy)
    df = spark.createDataFrame([(t,) for t in VALUES], "t string").selectExpr("t", "try_parse_json(nullif(t, '')) AS v")
    got = df.selectExpr("t", *[f"{test('v')} AS r{n}" for n, test in enumerate(tests)]).collect()
    assert {r.t: tuple(r)[1:] for r in got} == VALUES


@pytest.mark.parametrize("fragment", [
    "<div><div>a</div><div>b</div></div>", "<DIV><b>x</b> > y</Div>\n", "text", "", "<p>a<br>b</br></p></div>", "<pre> \n </pre> \n <p> </p>",
])
def test_plain_fragments_are_read_without_the_tokenizer(fragment, monkeypatch):
    read = html.write_fragment(html.read_fragment(fragment))
    with monkeypatch.context() as m:
        m.setattr(html.FragmentReader, "feed", lambda *_: pytest.fail("tokenized"))
        assert html.write_fragment(html.read_fragment(fragment)) == read
    monkeypatch.setattr(html.FragmentReader, "_read_plain", lambda *_: False)
    assert html.write_fragment(html.read_fragment(fragment)) == read


@pytest.mark.parametrize("fragment", ["<p class='a'>", "a &amp; b", "<script><b></script>", "<title><b></title>", "a < b", "<!--x-->", "<p"])
def test_other_fragments_go_to_the_tokenizer(fragment):
    assert not html.FragmentReader()._read_plain(fragment)
