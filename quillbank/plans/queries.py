"""Named queries: every operator applied to a bank derived from the given tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillbank import fixed_values as fv
from quillbank.functions import resolve as rs
from quillbank.functions.html import html_outline, strip_p_attributes
from quillbank.functions.text import normalize_text
from quillbank.functions.variants import field, is_empty, is_falsy, is_integer, shown
from quillbank.operators import convert as cv
from quillbank.operators import enrich as en
from quillbank.operators import pre_rules as pre
from quillbank.operators.clean import clean
from quillbank.plans import banks, file_queries, migrate, reports
from quillbank.sources.documents import filter_types, with_fields


def _converted(bank: DataFrame, conversion, *keep, language="'en'", explanation="CAST(NULL AS string)") -> DataFrame:
    """The typed conversion of every part: the kept columns and ``x``."""
    parts = f"transform(parts, p -> {conversion('p', language, explanation)})"
    return with_fields(bank).selectExpr(*keep, f"explode({parts}) AS x")


def _choice_rows(spark, sf_dir, part_type, conversion, columns) -> DataFrame:
    df = _converted(banks.choice_bank(spark, sf_dir, part_type), conversion, "id", language="language_code")
    return df.selectExpr("id", "x", "posexplode(x.choices) AS (pos, c)").selectExpr(
        "id", "CAST(pos AS bigint) AS pos", "c.label AS label", "c.value AS value", *columns)


def convert_mcq(spark, sf_dir):
    return _choice_rows(spark, sf_dir, "mcq", cv.mcq, [
        "c.is_correct AS is_correct", "x.correct_answer.label AS answer_label",
        "x.correct_answer.value AS answer_value"])


def convert_mrq(spark, sf_dir):
    return _choice_rows(spark, sf_dir, "mrq", cv.mrq, [
        "c.is_correct AS is_correct", "CAST(size(x.correct_answer) AS bigint) AS n_answers",
        "array_join(transform(x.correct_answer, a -> a.value), '|') AS answers"])


def convert_opinion(spark, sf_dir):
    return _choice_rows(spark, sf_dir, "opinion", cv.opinion, [])


def convert_ordering(spark, sf_dir):
    df = _converted(banks.choice_bank(spark, sf_dir, "oq"), cv.ordering, "id")
    return df.selectExpr("id", "x", "posexplode(x.items) AS (pos, c)").selectExpr(
        "id", "CAST(pos AS bigint) AS pos", "c.value AS value",
        f"{field('c.display_order', '$', 'bigint')} AS display_order",
        f"{field('c.correct_order', '$', 'bigint')} AS correct_order",
        "x.correct_answer[pos] AS answer", "x.direction AS direction")


def convert_matching(spark, sf_dir):
    df = _converted(banks.choice_bank(spark, sf_dir, "matching"), cv.matching, "id")
    row = "named_struct('side', '{0}', 'label', c.label, 'value', c.value, 'matches', {1}, 'pair', {2})"
    sides = ("concat(transform(x.items.A, (c, i) -> "
             + row.format("A", "CAST(NULL AS string)", "x.items.correct_answer[i].B")
             + "), transform(x.items.B, c -> " + row.format("B", "c.matches", "CAST(NULL AS string)") + "))")
    return df.selectExpr("id", f"inline({sides})")


def convert_gmrq(spark, sf_dir):
    df = _converted(banks.choice_bank(spark, sf_dir, "gmrq"), cv.gmrq, "id", language="language_code")
    row = "named_struct('side', '{0}', 'pos', CAST(i AS bigint), 'label', c.label, 'value', c.value, 'is_correct', c.is_correct)"
    sides = (f"concat(transform(x.items.A, (c, i) -> {row.format('A')}), "
             f"transform(x.items.B, (c, i) -> {row.format('B')}))")
    return df.selectExpr("id", "x.items.correct_answer.A AS answer_a", "x.items.correct_answer.B AS answer_b",
                         f"inline({sides})")


def convert_counting(spark, sf_dir):
    df = _converted(banks.counting_bank(spark, sf_dir), cv.counting, "id")
    return df.selectExpr(
        "id", f"{field('x.grid.rows', '$', 'bigint')} AS grid_rows",
        f"{field('x.grid.columns', '$', 'bigint')} AS grid_columns",
        f"{field('x.correct_answer', '$', 'bigint')} AS correct_answer", "x.stem AS stem")


def convert_puzzle(spark, sf_dir):
    df = _converted(banks.puzzle_bank(spark, sf_dir), cv.puzzle, "id")
    return df.selectExpr("id", "x", "posexplode(x.pieces) AS (pos, c)").selectExpr(
        "id", "CAST(pos AS bigint) AS pos",
        f"{field('c.display_order', '$', 'bigint')} AS display_order",
        f"{field('c.correct_order', '$', 'bigint')} AS correct_order", "c.src AS src",
        f"{field('x.`rows`', '$', 'string')} AS n_rows", f"{field('x.`columns`', '$', 'string')} AS n_columns",
        f"{field('x.correct_answer', '$', 'string')} AS image")


def convert_input(spark, sf_dir):
    df = _converted(banks.input_bank(spark, sf_dir), cv.input_box, "id")

    def constraint(name):
        return f"{field(f'x.correct_answer.constraints.{name}', '$', 'string')} AS {name}"
    return df.selectExpr(
        "id", f"{field('x.correct_answer.value', '$', 'double')} AS number",
        f"{field('x.correct_answer.unit', '$', 'string')} AS unit",
        "x.correct_answer.constraints.number_format AS number_format",
        constraint("type"), constraint("sign"), constraint("allow_leading_zeros"),
        constraint("remove_leading_zeros_from_normalized_form"), constraint("normalize_sign"),
        constraint("must_have_exactly_ndp"), constraint("must_have_at_least_nsf"))


def convert_gap(spark, sf_dir):
    df = _converted(banks.gap_bank(spark, sf_dir), cv.gap, "id")
    return df.selectExpr(
        "id", "x.correct_answer AS correct_answer", "CAST(size(x.gap_keys) AS bigint) AS n_keys",
        "array_join(transform(x.gap_keys, k -> k.value), '|') AS key_values",
        f"array_join(transform(x.gap_keys, k -> {field('k.correct_order', '$', 'string')}), ',', '-') AS key_orders",
        "CAST(x.gap_keys[size(x.gap_keys) - 1].display_order AS bigint) AS last_display_order")


def convert_string(spark, sf_dir):
    df = _converted(banks.turn_bank(spark, sf_dir, "string"), cv.string, "conv_id", "turn")
    return df.selectExpr(
        "conv_id", "turn", "x.stem AS stem", "x.ai_template_id AS ai_template_id",
        "array_join(x.acceptable_answers, '|') AS answers",
        "CAST(size(x.guidelines) AS bigint) AS n_guidelines",
        f"array_join(transform(x.guidelines, g -> CAST({field('g.mark', '$', 'int')} AS string)), ',') AS marks",
        f"array_join(transform(x.guidelines, g -> {field('g.comment', '$', 'string')}), ',') AS comments")


def convert_frq(spark, sf_dir):
    df = _converted(banks.turn_bank(spark, sf_dir, "frq"), cv.frq, "conv_id", "turn",
                    explanation=rs.explanation_text())
    return df.selectExpr(
        "conv_id", "turn", "x.stem AS stem", "x.ai_template_id AS ai_template_id",
        "x.acceptable_answers[0] AS answer", "x.explanation AS explanation")


def part_explanation(spark, sf_dir):
    """One explanation per line of a document, cut from one root answer."""
    df = with_fields(banks.line_bank(spark, sf_dir)).selectExpr(
        "id", "size(parts) AS n_parts", f"{rs.explanation_text()} AS explanation")
    df = df.withColumn("outline", html_outline(F.col("explanation")))
    own = rs.part_explanation("explanation", "outline.child_divs", "n_parts", "part_no")
    return df.selectExpr("id", "n_parts", "explanation", "outline",
                         "explode(sequence(1, n_parts)) AS part_no").selectExpr(
        "id", "CAST(part_no AS bigint) AS part_no", f"{own} AS part_text")


def converted_text(spark, sf_dir):
    """The whole converted document as JSON text."""
    bank = banks.counting_bank(spark, sf_dir)
    return migrate.convert(migrate.validate_pre(bank)).select("id", "converted_json")


# ---- rules and outcomes on the mixed bank ----

def _mixed(spark, sf_dir) -> DataFrame:
    return migrate.classify(banks.mixed_bank(spark, sf_dir))


def outcome_by_document(spark, sf_dir):
    return _mixed(spark, sf_dir).selectExpr(
        "id", "outcome", "CAST(size(errors) AS bigint) AS n_errors", "question_id")


def outcome_summary(spark, sf_dir):
    return reports.summary(_mixed(spark, sf_dir))


def success_rate(spark, sf_dir):
    """Converted share per part type."""
    df = _mixed(spark, sf_dir).selectExpr("outcome", f"element_at({banks._types()}, CAST(id % 13 AS int) + 1) AS part_type")
    return df.groupBy("part_type").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("outcome") == fv.CONVERTED).alias("success"),
    ).withColumn("rate", F.round(100 * F.col("success") / F.col("total"), 2))


def _rules_of(spark, sf_dir, stage):
    df = reports.errors_by_rule(_mixed(spark, sf_dir))
    return df.where(F.col("error_type") == stage).select("rule_id", "n_errors")


def pre_errors_by_rule(spark, sf_dir):
    return _rules_of(spark, sf_dir, fv.STAGE_PRE)


def conversion_errors_by_rule(spark, sf_dir):
    return _rules_of(spark, sf_dir, fv.STAGE_CONVERSION)


def errors_by_type(spark, sf_dir):
    return reports.errors_by_type(_mixed(spark, sf_dir))


def error_report(spark, sf_dir):
    """The error table without its timestamp."""
    return reports.errors(_mixed(spark, sf_dir)).selectExpr(
        "`Filename` AS filename", "`Question ID` AS question_id", "`Error Type` AS error_type", "rule_id",
        "`Error Message` AS message",
        "`Failed Field` AS failed_field", "`Actual Value` AS actual_value", "`Expected Format` AS expected_format")


def warnings_report(spark, sf_dir):
    """The warning table, without its timestamp."""
    return reports.warnings(_mixed(spark, sf_dir)).selectExpr(
        "`Filename` AS filename", "`Question ID` AS question_id", "rule_id", "`Warning Message` AS message")


def migrate_multi_part(spark, sf_dir):
    """Documents of one to five parts: outcome, rule, warnings and the whole converted text."""
    return migrate.classify(banks.several_bank(spark, sf_dir)).selectExpr(
        "id", "outcome", "array_join(transform(errors, x -> x.rule_id), ',') AS rules",
        "array_join(transform(warnings, x -> x.rule_id), ',') AS warned", "converted_json")


def choice_limit(spark, sf_dir):
    """More choices than a country allows, for the orders of even customers."""
    bank = banks.choice_bank(spark, sf_dir, "mcq").selectExpr(
        "path", "filename", "id", "CASE WHEN id % 2 = 0 THEN replace(raw, '\"country\":\"us\"', '\"country\":\"eg\"') ELSE raw END AS raw")
    found = migrate.validate_pre(bank).selectExpr("id", "explode_outer(pre) AS x").where("x IS NOT NULL")
    return found.selectExpr("id", "x.rule_id AS rule_id", "x.value AS found")


def post_errors_by_rule(spark, sf_dir):
    """New-structure checks on a converted table from elsewhere."""
    df = migrate.validate_post(banks.converted_bank(spark, sf_dir))
    return df.select(F.explode_outer("post").alias("x")).where("x IS NOT NULL").groupBy(
        F.col("x")["rule_id"].alias("rule_id")).agg(F.count(F.lit(1)).alias("n_errors"))


def filter_by_type(spark, sf_dir):
    kept = filter_types(with_fields(banks.mixed_bank(spark, sf_dir)), ["frq", "oq", "puzzle"])
    return kept.selectExpr("id", f"array_join({rs.question_types()}, ',') AS part_types",
                           f"{pre.has_parts()} AS has_parts")


ANSWER_SHAPES = [
    "'<p>a</p>'", "'<p>a</p><p>b</p>'", "'<div>a</div>'", "'text only'",
    "'<div><div>1</div><div>2</div></div>'", "'<div><div>1</div></div>'", "'<p>1</p>'",
    "'<div>1</div><div>2</div>'", "' '",
]


def answer_checks(spark, sf_dir):
    """Shape of the root answer against the number of parts: errors and warnings."""
    one = "concat('{\"n\":', n, ',\"type\":\"frq\",\"stem\":\"q\",\"standalone\":true,\"choices\":[],\"answer\":\"a\",\"ai\":{\"ai_template_id\":123456789012}}')"
    parts = f"array_join(transform(sequence(1, 1 + CAST(k % 2 AS int)), n -> {one}), ',')"
    shape = "element_at(array(" + ", ".join(ANSWER_SHAPES) + f"), CAST(id % {len(ANSWER_SHAPES)} AS int) + 1)"
    statement = "CASE WHEN k % 4 < 2 THEN ',\"statement\":\"s\"' ELSE '' END"
    extra = f"concat(',\"answer\":\"', {shape}, '\"', {statement})"
    bank = banks.as_bank(banks.orders(spark, sf_dir).selectExpr(
        "*", f"{banks.document(parts, extra)} AS raw"), "id")
    return migrate.validate_pre(bank).selectExpr(
        "id", "explode_outer(concat(pre, warnings)) AS x").where("x IS NOT NULL").selectExpr(
        "id", "x.rule_id AS rule_id", "x.value AS found")


# ---- document scalars ----

CODES = ["'\"eg\"'", "'\"us\"'", "'\"zz\"'", "'\" SA \"'", "'\"uk\"'", "'\"xx\"'", "''", "'null'", "'5'"]
LANGUAGE_CODES = ["'\"en\"'", "'\" AR\"'", "'\"zz\"'", "''", "'null'", "'\"\"'", "'7'"]


def _code_bank(spark, sf_dir, key, codes):
    """Root and metadata code from every customer's key; an empty word leaves the key out."""
    words = "array(" + ", ".join(codes) + ")"

    def member(rank):
        word = f"element_at({words}, CAST({rank} % {len(codes)} AS int) + 1)"
        return f"CASE WHEN {word} = '' THEN '' ELSE concat(',\"{key}\":', {word}) END"
    raw = (f"concat('{{\"parts\":[],\"metadata\":{{\"id\":1', {member(f'(id DIV {len(codes)})')}, '}}', "
           f"{member('id')}, '}}')")
    df = banks.table(spark, sf_dir, "customer").selectExpr("c_custkey AS id")
    return with_fields(banks.as_bank(df.selectExpr("*", f"{raw} AS raw"), "id"))


def country_resolution(spark, sf_dir):
    df = _code_bank(spark, sf_dir, "country", CODES)
    return df.selectExpr("id", f"{rs.country_code()} AS country_code").selectExpr(
        "id", "country_code", f"{rs.country_name('country_code')} AS country")


def country_choice_limit(spark, sf_dir):
    df = _code_bank(spark, sf_dir, "country", CODES)
    return df.selectExpr("id", f"{rs.limit_country_is_egypt()} AS limited")


def language_resolution(spark, sf_dir):
    df = _code_bank(spark, sf_dir, "language", LANGUAGE_CODES)
    return df.selectExpr("id", f"{rs.language_code()} AS language_code").selectExpr(
        "id", "language_code", f"{rs.language_name('language_code')} AS language_name")


def id_consistency(spark, sf_dir):
    """Mapped id as number, text, padded, wrong, null or missing."""
    text = "CAST(id AS string)"
    mapped = (f"get(array({text}, concat('\"', id, '\"'), concat('\" ', id, ' \"'), concat('\"', id + 1, '\"'), "
              "'null', '\"\"'), CAST(k % 7 AS int))")
    raw = (f"concat('{{\"parts\":[],\"metadata\":{{\"id\":', CASE WHEN k % 5 = 0 THEN '\"  \"' ELSE {text} END, "
           f"CASE WHEN k % 7 = 6 THEN '' ELSE concat(',\"mapped_id\":', {mapped}) END, "
           f"'}},\"question_id\":\"', id, '\"}}')")
    df = banks.orders(spark, sf_dir).selectExpr("id", "k")
    bank = with_fields(banks.as_bank(df.selectExpr("*", f"{raw} AS raw"), "id"))
    return bank.selectExpr("id", f"{rs.mapped_id()} AS mapped_id", f"{rs.parent_id()} AS parent_id",
                           f"get({pre.id_issues()}, 0) AS x").selectExpr(
        "id", "mapped_id", "parent_id", "x.rule_id AS rule_id", "x.value AS found")


def common_metadata(spark, sf_dir):
    """The thirteen shared columns; grade and section come as number, text or null."""
    raw = (
        "concat('{\"parts\":[{},{}],\"metadata\":{\"id\":', k, ',\"mapped_id\":', id, ',\"language\":\"fr\"},"
        "\"country\":\"', CASE WHEN id % 2 = 0 THEN 'us' ELSE 'IN' END, '\",\"question_id\":\"', id, '\","
        "\"subject\":\"', get(vals, 5), '\",\"subject_id\":', k, ',\"grade\":', "
        "element_at(array('null', '4', '\"4\"', '12345678.5', '123456789012.0', '1e-5'), CAST(k % 6 AS int) + 1), "
        "',\"grade_id\":', CASE WHEN k % 2 = 0 THEN 'true' ELSE CAST(id AS string) END, ',\"section_id\":\"', day, '\"', "
        "CASE WHEN id % 3 = 0 THEN '' ELSE ',\"source\":\"scan\"' END, '}')")
    df = banks.orders(spark, sf_dir).selectExpr("*", f"{raw} AS raw")
    fields = rs.common_metadata()
    for name in ("subject", "subject_id", "source"):
        fields[name] = field(fields[name], "$", "string")
    fields["number_of_parts"] = f"CAST({fields['number_of_parts']} AS bigint)"
    return with_fields(banks.as_bank(df, "id")).selectExpr("id", *[f"{v} AS {k}" for k, v in fields.items()])


# Numbers as JSON may write them, with their text in the reports.
FLOATS = {
    "12345678.5": "12345678.5", "123456789012.0": "123456789012.0", "1e-5": "1e-05", "0.0001": "0.0001", "1e16": "1e+16",
    "-123456789.125e-12": "-0.000123456789125", "1.5e300": "1.5e+300", "9007199254740993.0": "9007199254740992.0",
}


def value_tests(spark, sf_dir):
    """Emptiness, truth, integer test and printed form of values of every JSON type."""
    value = ("element_at(array('null', '\"\"', '\"  \"', '[]', '{}', '0', 'false', 'true', '1.0', '2.5', CAST(event_id AS string), "
             "concat('\"', event_type, '\"'), '[0]', props, " + ", ".join(f"'{n}'" for n in FLOATS) +
             f"), CAST(event_id % {14 + len(FLOATS)} AS int) + 1)")
    df = banks.table(spark, sf_dir, "events").selectExpr("event_id AS id", f"parse_json({value}) AS v")
    return df.selectExpr("id", f"{is_empty('v')} AS empty", f"{is_falsy('v')} AS falsy",
                         f"{is_integer('v')} AS whole", f"{shown('v')} AS printed")


def normalized_text(spark, sf_dir):
    return banks.table(spark, sf_dir, "documents").selectExpr(
        "doc_id", f"{normalize_text('concat(\' \\t\', text, \'\\n\\n\')')} AS normalized")


# ---- companion jobs ----

def _orders_and_items(spark, sf_dir, items="true"):
    """Orders as documents, line items as the reference table with several rows per id."""
    raw = ("concat('{\"instance\":', k, ',\"parts\":[', array_join(array_repeat('{\"type\":\"frq\"}', CAST(k % 3 AS int)), ','), "
           "'],\"metadata\":{\"note\":\"', day, '\"', CASE WHEN k % 5 = 0 THEN '' ELSE concat(',\"mapped_id\":', id) END, "
           "'},\"grade\":9}')")
    docs = banks.as_bank(banks.orders(spark, sf_dir).selectExpr("*", f"{raw} AS raw"), "id")
    reference = banks.table(spark, sf_dir, "lineitem").where(items).selectExpr(
        "CAST(l_orderkey AS string) AS base_question_id", "CAST(l_partkey AS string) AS section_id",
        "l_returnflag AS language", "CAST(l_suppkey AS string) AS subject",
        "CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE CAST(l_linenumber AS string) END AS grade",
        "l_linestatus AS country",
        "named_struct('a', l_linenumber, 'b', l_partkey, 'c', l_suppkey, 'd', l_quantity, 'e', l_extendedprice) AS file_order")
    return docs, reference


def enrich_first_match(spark, sf_dir):
    """The join of all documents."""
    return en.enrich(*_orders_and_items(spark, sf_dir)).select("id", "category", "status", "enriched_json")


def enrich_few_matches(spark, sf_dir):
    """A table of the large items only: most documents have no match and bypass the join."""
    docs, reference = _orders_and_items(spark, sf_dir, "l_quantity > 48")
    return en.enrich(docs, reference, few_matches=True).select("id", "category", "status", "enriched_json")


def category_routing(spark, sf_dir):
    """Documents per enrichment folder."""
    routed = en.with_category(banks.mixed_bank(spark, sf_dir))
    counted = routed.groupBy("category").agg(F.count_if("readable").alias("n_documents"))
    return counted.where("n_documents > 0")


def strip_p_attrs(spark, sf_dir):
    df = banks.html_lines(spark, sf_dir)
    return df.select("id", strip_p_attributes(F.col("html")).alias("html"))


def clean_documents(spark, sf_dir):
    """Whole documents with HTML in several strings; the other keys stay."""
    df = banks.html_lines(spark, sf_dir).selectExpr(
        "id", "to_json(named_struct('n', id, 'stem', html, 'list', array('<p>x</p>', html))) AS raw")
    cleaned = clean(banks.as_bank(df, "id"), "bank")
    return cleaned.selectExpr("id", "rel_path", "get_json_object(cleaned_json, '$.stem') AS stem",
                              "get_json_object(cleaned_json, '$.list[1]') AS second",
                              "CAST(get_json_object(cleaned_json, '$.n') AS bigint) AS n")


def clean_pages(spark, sf_dir):
    """Whole web pages, with attributes put on their paragraphs."""
    df = banks.table(spark, sf_dir, "pages").selectExpr(
        "page_id", "replace(html, '<p>', '<p class=\"c\">') AS html")
    return df.select("page_id", strip_p_attributes(F.col("html")).alias("html"))


QUERIES = {f.__name__: f for f in (
    convert_mcq, convert_mrq, convert_opinion, convert_ordering, convert_matching, convert_gmrq,
    convert_counting, convert_puzzle, convert_input, convert_gap, convert_string, convert_frq,
    part_explanation, converted_text, outcome_by_document, outcome_summary, success_rate,
    pre_errors_by_rule, conversion_errors_by_rule, errors_by_type, error_report, warnings_report,
    migrate_multi_part, choice_limit, post_errors_by_rule,
    filter_by_type, answer_checks, country_resolution, country_choice_limit, language_resolution,
    id_consistency, common_metadata, value_tests, normalized_text, enrich_first_match, enrich_few_matches,
    category_routing, strip_p_attrs, clean_documents, clean_pages,
)} | file_queries.QUERIES
