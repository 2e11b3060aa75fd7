"""Conversion of legacy parts, one operator per part type, as SQL expressions.

Each operator turns a part of the skeleton into a typed struct.  Lists stay
arrays in that struct.  In JSON text a list computed element by element is
written bare when it has one element and left out when it has none, as the
target format has it; ``part_text`` does that.  In the text a NULL key is left
out and a VARIANT null is kept.
"""

from quillbank import fixed_values as fv
from quillbank.functions import resolve as rs
from quillbank.functions.sql import array, case, let, lit, struct
from quillbank.functions.text import is_blank, json_number
from quillbank.functions.variants import (
    JSON_NULL, equals_number, field, is_empty, is_numeric, is_string, null_if_missing, number_of,
    shown, shown_or, string_of, text_or_json,
)
from quillbank.operators.issues import finding
from quillbank.operators.part_types import extra_types


def sorted_by(items: str, key: str) -> str:
    """Stable sort on a VARIANT key: numbers, then texts, then missing keys.

    Small sort keys carry the position, so the elements themselves are not compared.
    """
    keys = struct(missing=f"x.{key} IS NULL", number=number_of(f"x.{key}"), text=string_of(f"x.{key}"), at="at")
    return let(items, "xs",
               f"transform(sort_array(transform(xs, (x, at) -> {keys})), k -> get(xs, k.at))")


def label(language: str, latin, arabic, rank: str) -> str:
    """The rank's label; past the last one there is none."""
    return f"get(CASE WHEN {language} = 'ar' THEN {array(arabic)} ELSE {array(latin)} END, {rank})"


def head(p: str, new_type: str) -> dict:
    """The first members of every converted part."""
    return {"n": f"{p}.n", "type": lit(new_type), "stem": string_of(f"{p}.stem")}


def _displayed(p: str, language: str, with_correct=True) -> str:
    """Choices by ``fixed_order`` with their labels."""
    fields = {
        "label": label(language, fv.LABELS_LATIN, fv.LABELS_ARABIC, "j"),
        "value": string_of("c.html_content"),
    }
    if with_correct:
        fields["is_correct"] = "(c.t <=> 'key')"
    return f"transform({sorted_by(f'{p}.cs', 'fixed_order')}, (c, j) -> {struct(**fields)})"


def _correct(shown_choices: str) -> str:
    pair = struct(label="c.label", value="c.value")
    return f"transform(filter({shown_choices}, c -> c.is_correct), c -> {pair})"


def mcq(p, language, explanation):
    return let(_displayed(p, language), "shown", struct(
        **head(p, "mcq"), choices="shown", correct_answer=f"get({_correct('shown')}, 0)",
        explanation=explanation))


def mrq(p, language, explanation):
    return let(_displayed(p, language), "shown", struct(
        **head(p, "mrq"), choices="shown", correct_answer=_correct("shown"), explanation=explanation))


def opinion(p, language, explanation):
    return struct(**head(p, "opinion"), choices=_displayed(p, language, False), explanation=explanation)


def ordering(p, language, explanation):
    item = struct(value=string_of("c.html_content"), display_order="c.fixed_order", correct_order="c.correct_order")
    return struct(
        **head(p, "ordering"),
        direction=string_of(f"{p}.direction"),
        items=f"transform({sorted_by(f'{p}.cs', 'fixed_order')}, c -> {item})",
        correct_answer=f"transform({sorted_by(f'{p}.cs', 'correct_order')}, c -> {string_of('c.html_content')})",
        explanation=explanation,
    )


def _group(p: str, group: int) -> str:
    """Choices of one group by index, reduced to what labelling and pairing need."""
    chosen = f"filter({p}.cs, c -> {equals_number('c.group', group)})"
    pair = (f"CASE WHEN c.correct_order IS NOT NULL THEN coalesce(CAST({number_of('c.correct_order')} AS string), "
            f"concat('json:', to_json(c.correct_order))) END")
    item = struct(value=string_of("c.html_content"), at=number_of("c.index"), pair=pair,
                  is_correct="(c.t <=> 'key')")
    return f"transform({sorted_by(chosen, 'index')}, c -> {item})"


def _groups(p: str) -> str:
    return struct(a=_group(p, 1), b=_group(p, 2))


def matching(p, language, explanation):
    def partner(items, item):
        return f"get(filter({items}, y -> y.pair = {item}.pair), 0)"
    # the label goes to the first item carrying the partner's index
    rank = f"array_position(transform(g.a, y -> y.at), {partner('g.a', 'x')}.at)"
    items = struct(
        A="transform(g.a, (x, j) -> named_struct('value', x.value, 'label', concat('A', j + 1)))",
        B=f"transform(g.b, (x, j) -> named_struct('value', x.value, 'label', concat('B', j + 1), "
          f"'matches', concat('A', {rank})))",
        correct_answer=f"transform(g.a, x -> named_struct('A', x.value, 'B', {partner('g.b', 'x')}.value))",
    )
    return let(_groups(p), "g", struct(**head(p, "matching"), items=items, explanation=explanation))


def gmrq(p, language, explanation):
    def listed(items, latin, arabic):
        item = struct(label=label(language, latin, arabic, "j"), value="x.value", is_correct="x.is_correct")
        return f"transform({items}, (x, j) -> {item})"

    def answer(items):
        return f"get(filter({items}, x -> x.is_correct), 0).value"
    items = struct(
        A=listed("g.a", fv.LABELS_LATIN, fv.LABELS_ARABIC),
        B=listed("g.b", fv.LABELS_LATIN_SECOND, fv.LABELS_ARABIC_SECOND),
        correct_answer=struct(A=answer("g.a"), B=answer("g.b")),
    )
    return let(_groups(p), "g", struct(**head(p, "gmrq"), items=items, explanation=explanation))


def grid_side(p: str, side: int) -> str:
    return f"get(split({string_of(f'{p}.grid_size')}, '×'), {side})"


def counting(p, language, explanation):
    return struct(
        **head(p, "counting"),
        grid=struct(rows=json_number(grid_side(p, 0)), columns=json_number(grid_side(p, 1))),
        correct_answer=json_number(string_of(f"{p}.answer")),
        explanation=explanation,
    )


def _template(p: str) -> str:
    return text_or_json(field(f"{p}.ai", "$.ai_template_id"))


def frq(p, language, explanation):
    return struct(
        **head(p, "frq"), ai_template_id=_template(p),
        acceptable_answers=f"array({string_of(f'{p}.answer')})", explanation=explanation)


def guideline(g: str) -> str:
    """The usual keys first, the mark as a number, any further keys after them."""
    mark = json_number(text_or_json(field(g, "$.mark")))
    usual = ", ".join(
        struct(key=lit(name), value=value) for name, value in (
            ("student_answer", field(g, "$.student_answer")), ("mark", mark), ("comment", field(g, "$.comment"))))
    others = (f"filter(map_entries({field(g, '$', 'map<string,variant>')}), "
              f"y -> y.key NOT IN ('student_answer', 'mark', 'comment'))")
    return f"map_from_entries(concat(array({usual}), {others}))"


def string(p, language, explanation):
    return struct(
        **head(p, "string"), ai_template_id=_template(p),
        acceptable_answers=field(f"{p}.answer", "$", "array<string>"),
        guidelines=f"transform({field(f'{p}.ai', '$.guidelines', 'array<variant>')}, g -> {guideline('g')})",
        explanation=explanation)


def fill_gaps(stem: str, values: str) -> str:
    """The n-th gap span of ``stem`` replaced by a space and the n-th value, in one pass.

    Gaps beyond the last value keep their span.
    """
    cut = struct(texts=f"split({stem}, {lit(fv.GAP_SPAN)}, -1)",
                 spans=f"regexp_extract_all({stem}, {lit(fv.GAP_SPAN)}, 0)", words=values)
    before = case(
        ("n = 0", "''"),
        ("n <= size(cut.words)", "concat(' ', get(cut.words, n - 1))"),
        otherwise="get(cut.spans, n - 1)",
    )
    return let(cut, "cut", f"array_join(transform(cut.texts, (text, n) -> concat({before}, text)), '')")


def gap(p, language, explanation):
    ordered = sorted_by(f"filter({p}.ks, k -> k.correct_order IS NOT NULL)", "correct_order")
    key = struct(value=string_of("k.value"), display_order="j + 1", correct_order="k.correct_order")
    return struct(
        **head(p, "gap"),
        gap_keys=f"transform({p}.ks, (k, j) -> {key})",
        correct_answer=fill_gaps(string_of(f"{p}.stem"), f"transform({ordered}, k -> {string_of('k.value')})"),
        explanation=explanation,
    )


def number_format(value: str) -> str:
    return f"CASE WHEN {value} RLIKE '[٠-٩]' THEN 'hindi' ELSE 'arabic' END"


def input_number(value: str) -> str:
    return json_number(f"translate({value}, {lit(fv.ARABIC_INDIC)}, {lit(fv.ASCII_DIGITS)})")


def input_box(p, language, explanation):
    value, given = field(f"{p}.answer", "$.value", "string"), field(f"{p}.answer", "$.constrains")
    constraints = {
        name: f"coalesce({field(given, f'$.{name}')}, parse_json({lit(default)}))"
        for name, default in fv.CONSTRAINT_DEFAULTS.items()
    }
    return struct(
        **head(p, "input"),
        correct_answer=struct(
            value=input_number(value),
            unit=f"coalesce({field(f'{p}.answer', '$.unit')}, {JSON_NULL})",
            constraints=struct(type=field(given, "$.type"), number_format=number_format(value), **constraints),
        ),
        explanation=explanation,
    )


def puzzle(p, language, explanation):
    piece = struct(display_order="x.fixed_order", correct_order="x.correct_order", src=string_of("x.src"))
    return struct(
        **head(p, "puzzle"), rows=f"{p}.puzzleRows", columns=f"{p}.puzzleColumns",
        pieces=f"transform({sorted_by(f'{p}.pieces', 'fixed_order')}, x -> {piece})",
        correct_answer=f"{p}.puzzleImage")


# Built-in legacy part types and their conversions; further ones come from ``part_types``.
CONVERSIONS = {
    "mcq": mcq, "gmrq": gmrq, "mrq": mrq, "frq": frq, "oq": ordering, "gapText": gap, "string": string,
    "opinion": opinion, "matching": matching, "counting": counting, "puzzle": puzzle,
    "input_box": input_box, "frq_ai": frq,
}
# Keys of each converted type after n, type and stem, in output order; a key in
# brackets holds a list that is written bare when it has one element.
WRITTEN = {
    mcq: ["[choices]", "correct_answer"],
    mrq: ["[choices]", "[correct_answer]"],
    opinion: ["[choices]"],
    ordering: ["direction", "[items]", "[correct_answer]"],
    matching: {"items": ["[A]", "[B]", "[correct_answer]"]},
    gmrq: {"items": ["[A]", "[B]", "correct_answer"]},
    counting: ["grid", "correct_answer"],
    string: ["ai_template_id", "acceptable_answers", "[guidelines]"],
    frq: ["ai_template_id", "acceptable_answers"],
    gap: ["[gap_keys]", "correct_answer"],
    input_box: ["correct_answer"],
    puzzle: ["rows", "columns", "[pieces]", "correct_answer"],
}


def _members(source: str, names) -> str:
    """Members of a ``named_struct``.

    A bracketed key becomes two members of one name, of which at most one is set.
    """
    out = []
    for name in names:
        value = f"{source}.{name.strip('[]')}"
        if name.startswith("["):
            key = lit(name.strip("[]"))
            out.append(f"{key}, CASE WHEN size({value}) > 1 THEN {value} END")
            out.append(f"{key}, CASE WHEN size({value}) = 1 THEN get({value}, 0) END")
        else:
            out.append(f"{lit(name)}, {value}")
    return ", ".join(out)


def part_text(conversion, p: str, language: str, explanation: str) -> str:
    """One converted part as JSON text."""
    names = WRITTEN[conversion] if conversion in WRITTEN else next(t.written for t in extra_types() if t.convert is conversion)
    if isinstance(names, dict):
        body = ", ".join(f"{lit(k)}, named_struct({_members(f'x.{k}', v)})" for k, v in names.items())
    else:
        body = _members("x", names)
    last = "" if conversion is puzzle else f", 'explanation', {null_if_missing('x.explanation')}"
    return let(conversion(p, language, explanation), "x",
               f"to_json(named_struct('n', x.n, 'type', x.type, 'stem', x.stem, {body}{last}))")


def convert_part(p: str, language: str, explanation: str) -> str:
    """Dispatch on the legacy type; JSON text of the converted part."""
    types = {}
    for legacy, conversion in (CONVERSIONS | {t.legacy: t.convert for t in extra_types()}).items():
        types.setdefault(conversion, []).append(legacy)
    return case(*[
        (f"{p}.t IN ({', '.join(lit(t) for t in legacy)})", part_text(conversion, p, language, explanation))
        for conversion, legacy in types.items()])


def convert_parts(language="language_code", explanation="explanation", child_divs="outline.child_divs") -> str:
    """All parts of a document in order, as an array of JSON texts."""
    own = rs.part_explanation(explanation, child_divs, "size(parts)", "i + 1")
    return f"transform(parts, (p, i) -> {convert_part('p', language, own)})"


def failure_reason(p: str) -> str:
    """Why a checked part still cannot be converted, NULL if it can."""
    numbers = f"array({grid_side(p, 0)}, {grid_side(p, 1)}, {string_of(f'{p}.answer')})"
    value = input_number(field(f"{p}.answer", "$.value", "string"))
    keys = f"filter(transform({p}.cs, c -> c.correct_order), k -> k IS NOT NULL)"
    mixed = (f"size({p}.cs) > 1 AND NOT forall({keys}, k -> {is_numeric('k')}) "
             f"AND NOT forall({keys}, k -> {is_string('k')})")
    no_number = "'value is not a number'"
    return case(
        (f"{p}.t = 'counting' AND exists({numbers}, y -> {json_number('y')} IS NULL)", no_number),
        (f"{p}.t = 'input_box' AND {value} IS NULL", no_number),
        (f"{p}.t = 'oq' AND {mixed}", "'sort keys are neither all numbers nor all strings'"),
    )


def part_failures() -> str:
    """The first part that cannot be converted, as a finding."""
    found = let(failure_reason("p"), "why", case(
        ("why IS NOT NULL", finding("K8", p="i + 1", t="p.t", value="why"))))
    return f"get(array_compact(transform(parts, (p, i) -> {found})), 0)"


def metadata_failure() -> str:
    """The first missing required root field, as a finding."""
    def blank(name):
        return is_blank(shown_or(f"root.{name}", ""))
    return case(
        (f"{rs.parent_id()} IS NULL", finding("K6", value="'None'")),
        (is_empty("root.subject"), finding("K1", value=shown("root.subject"))),
        (is_empty("root.subject_id"), finding("K2", value=shown("root.subject_id"))),
        *[(blank(name), finding(rule_id, value=shown_or(f"root.{name}", "")))
          for rule_id, name in (("K3", "grade"), ("K4", "grade_id"), ("K5", "section_id"))],
    )


def late_stopper() -> str:
    """Root answer that is neither empty nor text, or of which a part cannot be written; met only when converting starts."""
    return case(
        (f"NOT {is_empty('root.answer')} AND NOT {is_string('root.answer')}", finding("X7")),
        ("size(parts) > 1 AND outline.broken", finding("X10")),
    )


def document_text(part_texts: str = "part_texts") -> str:
    """The converted document as JSON text, keys in output order."""
    head = f"to_json({struct(**rs.common_metadata(language='language_code', codes='countries'))})"
    statement = "to_json(coalesce(root.statement, CAST('' AS variant)))"
    several = f"CASE WHEN size(parts) > 1 THEN concat('\"statement\":', {statement}, ',') ELSE '' END"
    return let(head, "head", (
        f"concat(substring(head, 1, length(head) - 1), ',\"content\":{{', {several}, "
        f"'\"parts\":[', array_join({part_texts}, ','), ']}}}}')"))
