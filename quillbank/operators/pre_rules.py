"""Checks on the legacy structure, as SQL expressions over the skeleton.

``p`` names a part of the skeleton, ``i`` its 0-based position.  The rules of a
part type form one expression; a failed condition that ends the checks of its
scope keeps the later rules from being evaluated.
"""

from quillbank import fixed_values as fv
from quillbank.functions import resolve as rs
from quillbank.functions.sql import case, let, lit, lits, one_of, struct
from quillbank.functions.text import count_of, is_blank, is_digits, strip
from quillbank.functions.variants import (
    equals_number, field, integer_below, is_array, is_boolean, is_empty, is_falsy, is_filled_array,
    is_filled_object, is_filled_string, is_integer, is_none, is_numeric, is_object, is_string, kind,
    number_of, shown, string_of, type_name, variant_struct,
)
from quillbank.operators.issues import NONE, all_of, finding_of, issues, of_each, only, rule, when
from quillbank.operators.part_types import NO, extra_types, known_types
from quillbank.operators.skeleton import CHOICE_LIST_TYPES

LIST_RULE = {"mcq": "V17", "mrq": "V20", "oq": "V29", "opinion": "V53", "matching": "V55", "gmrq": "V58"}


def choice_issues(c: str = "c", j: str = "j", p: str = "p") -> str:
    """Rules shared by the choices of every type that lists choices."""
    at = {"p": NO, "e": f"{j} + 1", "t": f"{p}.t"}
    known = f"{equals_number(f'{c}.group', 1)} OR {equals_number(f'{c}.group', 2)}"
    return issues(
        rule(f"{p}.t = 'gmrq' AND NOT ({known})", "V62", **at),
        *[rule(f"{c}.`{f}` IS NULL", "V9", field=f, **at)
          for f in ("type", "html_content", "values", "unit", "index", "fixed_order")],
        rule(f"{p}.t IN ('mcq', 'mrq', 'gmrq') AND NOT {one_of(f'{c}.t', fv.CHOICE_TYPES)}", "V10",
             value=shown(f"{c}.type"), **at),
        rule(is_blank(string_of(f"{c}.html_content")), "V11", **at),
        rule(f"NOT {is_array(f'{c}.`values`')}", "V12", **at),
        rule(f"NOT {is_none(f'{c}.unit')} AND NOT {is_string(f'{c}.unit')}", "V13", **at),
        rule(integer_below(f"{c}.index", 0), "V14", **at),
        rule(integer_below(f"{c}.fixed_order", 1), "V15", **at),
        rule(f"NOT {is_empty(f'{c}.last_order')} AND NOT {is_boolean(f'{c}.last_order')}", "V16", **at),
    )


def group_count(cs: str) -> str:
    """Distinct non-null groups; 1, 1.0 and true are the same group."""
    name = (f"CASE WHEN NOT {is_none('c.group')} THEN "
            f"coalesce(CAST({number_of('c.group')} AS string), concat('text:', {shown('c.group')})) END")
    return f"size(array_distinct(array_compact(transform({cs}, c -> {name}))))"


def group_keys(cs: str, group: int) -> str:
    return f"size(filter({cs}, c -> c.t <=> 'key' AND {equals_number('c.group', group)}))"


def choice_list_issues(p: str = "p", egypt: str = "egypt") -> str:
    """mcq, mrq, oq, opinion, matching and gmrq."""
    cs, t = f"{p}.cs", f"{p}.t"
    keys = f"size(filter({cs}, c -> c.t <=> 'key'))"
    groups = f"CASE WHEN {t} IN ('matching', 'gmrq') THEN {group_count(cs)} END"
    other = f"exists({cs}, c -> NOT (c.t <=> 'distractor'))"

    def counted(types, wrong, rule_id, value):
        return rule(f"{t} IN ({lits(types)}) AND ({wrong})", rule_id, p=NO, value=value)
    first, second = group_keys(cs, 1), group_keys(cs, 2)
    own = issues(
        counted(["mcq"], f"{keys} <> 1", "V18", keys),
        counted(["mcq"], f"{egypt} AND size({cs}) > {fv.EGYPT_CHOICE_LIMIT}", "V19", f"size({cs})"),
        counted(["mrq"], f"{keys} < 2", "V21", keys),
        counted(["oq"], other, "V30", "''"),
        counted(["oq"], f"NOT {one_of(string_of(f'{p}.direction'), fv.DIRECTIONS)}", "V31", "''"),
        counted(["opinion"], other, "V54", "''"),
        counted(["matching"], f"{groups} <> 2", "V56", groups),
        counted(["matching"], other, "V57", "''"),
        counted(["gmrq"], f"{groups} <> 2", "V59", groups),
        counted(["gmrq"], f"{first} <> 1", "V60", first),
        counted(["gmrq"], f"{second} <> 1", "V61", second),
    )
    missing = case(*[(f"{t} = {lit(k)}", only(v, p=NO, t=lit(k))) for k, v in LIST_RULE.items()])
    return case((f"coalesce(size({cs}), 0) <= 0", missing),
                otherwise=all_of(own, of_each(cs, "c", "j", choice_issues())))


def _empty_choices(p: str, not_array: str, not_empty: str) -> list[str]:
    return [
        rule(f"NOT {is_array(f'{p}.choices')}", not_array, p=NO),
        rule(is_filled_array(f"{p}.choices"), not_empty, p=NO),
    ]


def frq_issues(p: str = "p") -> str:
    template, ai = "ai.template", "ai.filled"
    found = struct(template=field(f"{p}.ai", "$.ai_template_id"), filled=is_filled_object(f"{p}.ai"))
    twelve = let(shown(template), "id", f"{is_digits('id')} AND length(id) = 12")
    return let(found, "ai", issues(
        *_empty_choices(p, "V22", "V23"),
        rule(f"NOT {is_filled_string(f'{p}.answer')}", "V24", p=NO),
        rule(f"NOT {ai}", "V25", p=NO),
        rule(f"{ai} AND {is_falsy(template)}", "V26", p=NO),
        rule(f"{ai} AND {is_empty(template)}", "V27", p=NO),
        rule(f"{ai} AND NOT {is_empty(template)} AND NOT {twelve}", "V28", p=NO),
    ))


def gap_text_issues(p: str = "p") -> str:
    keys = f"{p}.ks"
    key_checks = issues(
        rule(f"NOT {is_filled_string('k.value')}", "V35", p=NO, e="j"),
        rule(f"k.correct_order IS NOT NULL AND {integer_below('k.correct_order', 1)}", "V36", p=NO, e="j"),
    )
    gaps = f"coalesce({count_of(string_of(f'{p}.stem'), fv.GAP_MARK)}, 0)"
    ordered = f"size(filter({keys}, k -> k.correct_order IS NOT NULL))"
    counts = let(gaps, "gaps", issues(
        rule("gaps = 0", "V37", p=NO),
        rule(f"gaps > 0 AND size({keys}) < gaps", "V38", p=NO, value=f"size({keys})", expected="gaps"),
        rule(f"gaps > 0 AND {ordered} <> gaps", "V39", p=NO, value=ordered, expected="gaps"),
    ))
    return all_of(
        issues(*_empty_choices(p, "V32", "V33"), rule(f"coalesce(size({keys}), 0) <= 0", "V34", p=NO)),
        when(f"size({keys}) > 0", all_of(of_each(keys, "k", "j", key_checks), counts)),
    )


def guideline_issues(g: str, j: str) -> str:
    at = {"p": NO, "e": j}
    leaves = field(g, "$", variant_struct(["student_answer", "mark", "comment"]))
    answer, mark, comment = (f"given.{f}" for f in ("student_answer", "mark", "comment"))
    printable = f"({is_string(mark)} OR {is_integer(mark)})"
    quoted = f"CASE WHEN {is_string(mark)} THEN concat('\\'', {shown(mark)}, '\\'') ELSE {shown(mark)} END"
    return case((f"NOT {is_object(g)}", only("V45", **at)), otherwise=let(leaves, "given", issues(
        rule(f"{answer} IS NULL", "V46", **at),
        rule(f"{answer} IS NOT NULL AND NOT {is_string(answer)}", "V47", **at),
        rule(f"{mark} IS NULL", "V48", **at),
        rule(f"{printable} AND NOT {one_of(shown(mark), fv.MARKS)}", "V49", value=quoted, **at),
        rule(f"{mark} IS NOT NULL AND NOT {printable}", "V50", value=type_name(mark), **at),
        rule(f"{comment} IS NULL", "V51", **at),
        rule(f"{comment} IS NOT NULL AND NOT {is_string(comment)}", "V52", **at),
    )))


def string_issues(p: str = "p") -> str:
    answer, template, guidelines = f"{p}.answer", "ai.ai_template_id", "ai.guidelines"
    not_listed = f"NOT {is_falsy(template)} AND NOT {one_of(shown(template), fv.STRING_TEMPLATE_IDS)}"
    return let(field(f"{p}.ai", "$", variant_struct(["ai_template_id", "guidelines"])), "ai", all_of(
        issues(rule(f"NOT {is_none(f'{p}.choices')}", "V40", p=NO), rule(f"NOT {is_array(answer)}", "V41", p=NO)),
        when(is_array(answer), all_of(
            of_each(field(answer, "$", "array<variant>"), "a", "j",
                    issues(rule(f"NOT {is_string('a')}", "V42", p=NO, e="j"))),
            issues(rule(not_listed, "V43", p=NO)),
        )),
        case(
            (is_array(guidelines), of_each(
                field(guidelines, "$", "array<variant>"), "g", "j", guideline_issues("g", "j"))),
            (f"NOT {is_none(guidelines)}", only("V44", p=NO)),
            otherwise=NONE,
        ),
    ))


def counting_issues(p: str = "p") -> str:
    return issues(
        *_empty_choices(p, "V63", "V64"),
        rule(f"NOT {is_digits(string_of(f'{p}.answer'))}", "V65", p=NO),
        rule(f"NOT coalesce({string_of(f'{p}.grid_size')} RLIKE {lit(fv.GRID_SIZE)}, false)", "V66", p=NO),
    )


def whole_number(v: str) -> str:
    """The value read as a whole number; 0 where it is falsy, NULL where it cannot be."""
    text = f"replace({strip(string_of(v))}, '_', '')"
    whole = lit(r"\A[+-]?[0-9]+\z")
    number = f"CASE WHEN {is_numeric(v)} THEN signum({number_of(v)}) * floor(abs({number_of(v)})) END"
    return case((is_falsy(v), "CAST(0 AS double)"), otherwise=(
        f"coalesce(CASE WHEN {text} RLIKE {whole} THEN try_cast({text} AS double) END, {number})"))


def puzzle_issues(p: str = "p") -> str:
    required = ["puzzleColumns", "puzzleImage", "puzzleImageHeight",
                "puzzleImageSplited", "puzzleImageWidth", "puzzleRows"]
    pieces = f"{p}.pieces"

    def not_digits(name, rule_id):
        v = f"{p}.{name}"
        return rule(f"NOT {is_falsy(v)} AND NOT {is_digits(shown(v))}", rule_id, p=NO, field=name)
    piece_checks = issues(
        *[rule(f"NOT {is_integer(f'x.{f}')} OR {is_falsy(f'x.{f}')}", "V74", p=NO, e="j", field=f)
          for f in ("index", "fixed_order", "correct_order")],
        rule(f"NOT {is_filled_string('x.src')}", "V75", p=NO, e="j"),
    )
    expected = f"{whole_number(f'{p}.puzzleRows')} * {whole_number(f'{p}.puzzleColumns')}"
    return all_of(
        issues(
            *_empty_choices(p, "V67a", "V67b"),
            *[rule(is_none(f"{p}.{f}"), "V68", p=NO, field=f) for f in required],
            not_digits("puzzleColumns", "V69"), not_digits("puzzleRows", "V69"),
            rule(f"NOT {is_falsy(f'{p}.puzzleImage')} AND NOT {is_string(f'{p}.puzzleImage')}", "V70", p=NO),
            not_digits("puzzleImageHeight", "V71"), not_digits("puzzleImageWidth", "V71"),
            rule(f"coalesce(size({pieces}), 0) <= 0", "V72", p=NO),
        ),
        when(f"size({pieces}) > 0", all_of(
            let(expected, "expected", issues(
                rule(f"expected > 0 AND size({pieces}) <> expected", "V73", p=NO,
                     value=f"size({pieces})", expected="CAST(expected AS decimal(38,0))"))),
            of_each(pieces, "x", "j", piece_checks),
        )),
    )


def input_box_issues(p: str = "p") -> str:
    answer, value, constrains, unit = f"{p}.answer", "given.value", "given.constrains", "given.unit"
    has_answer, has_constrains = is_filled_object(answer), is_filled_object(constrains)
    both = f"{has_answer} AND {has_constrains}"
    known = one_of(string_of(field(constrains, "$.type")), fv.CONSTRAINT_TYPES)
    return let(field(answer, "$", variant_struct(["value", "constrains", "unit"])), "given", issues(
        *_empty_choices(p, "V76a", "V76b"),
        rule(f"NOT {has_answer}", "V77a", p=NO),
        rule(f"{has_answer} AND NOT {is_filled_string(value)}", "V77b", p=NO),
        rule(f"{has_answer} AND NOT {has_constrains}", "V78a", p=NO),
        rule(f"{both} AND NOT {known}", "V78b", p=NO),
        rule(f"{both} AND NOT {is_none(unit)} AND NOT {is_string(unit)}", "V79", p=NO),
    ))


# Built-in part types and their checks; further ones come from ``part_types``.
PART_RULES = [
    (CHOICE_LIST_TYPES, choice_list_issues),
    (["frq", "frq_ai"], frq_issues),
    (["gapText"], gap_text_issues),
    (["string"], string_issues),
    (["counting"], counting_issues),
    (["puzzle"], puzzle_issues),
    (["input_box"], input_box_issues),
]


def part_issues(p: str = "p") -> str:
    """Findings of one part: the common rules, then those of its type."""
    known = one_of(f"{p}.t", known_types())
    checks = [*[(types, check()) for types, check in PART_RULES], *[([t.legacy], t.checks(p)) for t in extra_types() if t.checks]]
    return all_of(
        issues(
            *[rule(f"{p}.{f} IS NULL", "V5", p=NO, field=f) for f in ("n", "type", "stem", "standalone")],
            rule(f"NOT {equals_number(f'{p}.n', NO)}", "V6", p=NO, value=shown(f"{p}.n")),
            rule(f"NOT {known}", "V7", p=NO, value=shown(f"{p}.type")),
            rule(f"{known} AND NOT {is_filled_string(f'{p}.stem')}", "V8", p=NO),
        ),
        case(*[(f"{p}.t IN ({lits(types)})", check) for types, check in checks], otherwise=NONE),
    )


def has_parts(parts: str = "parts") -> str:
    return f"coalesce(size({parts}) > 0, false)"


def answer_issues(parts: str = "parts", outline: str = "outline") -> str:
    """A multi-part answer must be one ``<div>`` with a ``<div>`` per part."""
    n, divs = f"size({parts})", f"size({outline}.child_divs)"
    sole = f"{n} > 1 AND {outline}.n_top = 1"
    return issues(
        rule(f"{outline}.error IS NOT NULL", "V88", value=f"{outline}.error"),
        rule(f"{n} > 1 AND {outline}.n_top <> 1", "V85", value=f"{outline}.n_top"),
        rule(f"{sole} AND {outline}.first_tag <> 'div'", "V86", value=f"{outline}.first_tag"),
        rule(f"{sole} AND {outline}.first_tag = 'div' AND {divs} <> {n}", "V87", value=divs, expected=n),
    )


def structure_issues() -> str:
    """Rules of the document body; only the first applies when there are no parts."""
    return case((f"NOT {has_parts()}", only("V1")), otherwise=all_of(
        issues(rule(f"NOT {is_filled_object('root.metadata')}", "V3")),
        of_each("parts", "p", "i", part_issues()),
        answer_issues(),
    ))


def structure_warnings(parts: str = "parts", outline: str = "outline") -> str:
    n = f"size({parts})"
    return when(has_parts(parts), issues(
        rule(f"{n} > 1 AND {is_falsy('root.statement')}", "V4"),
        rule(f"{n} = 1 AND {outline}.n_top <> 1", "V83", value=f"{outline}.n_top"),
        rule(f"{n} = 1 AND {outline}.n_top = 1 AND {outline}.first_tag <> 'p'", "V84",
             value=f"{outline}.first_tag"),
    ))


BROKEN_METADATA = f"(root.metadata IS NOT NULL AND NOT {is_object('root.metadata')})"


def id_issues(filename: str = "filename") -> str:
    """Mapped id, question id and file name must agree."""
    texts = f"'mapped_id=', ids.mapped, ', question_id=', ids.question, ', filename=', ids.file"
    ids = f"named_struct('mapped', {rs.mapped_id()}, 'question', {rs.question_id()}, 'file', {rs.file_id(filename)})"
    return case(
        (BROKEN_METADATA, only("V80x", value=type_name("root.metadata"))),
        otherwise=let(ids, "ids", issues(
            rule(is_blank("ids.mapped"), "V80a"),
            rule(f"NOT {is_blank('ids.mapped')} AND NOT (ids.mapped = ids.question AND ids.mapped = ids.file)",
                 "V80b", value=f"concat({texts})"),
        )),
    )


def code_issues(language: str = "language_code", countries: str = "countries") -> str:
    """Language and country codes must be known."""
    needs_meta = f"({BROKEN_METADATA} AND {is_falsy('root.language')})"
    return issues(
        rule(needs_meta, "V81x", value=type_name("root.metadata")),
        rule(f"NOT {needs_meta} AND {language} IS NULL", "V81"),
        rule(BROKEN_METADATA, "V82x", value=type_name("root.metadata")),
        rule(f"NOT {BROKEN_METADATA} AND size({countries}) = 0", "V82"),
    )


def part_stopper(p: str = "p") -> str:
    """Rule id of what makes a part impossible to process, else NULL."""
    nested_group = f"{kind('c.group')} RLIKE '^(ARRAY|OBJECT)'"
    not_text = f"{p}.stem IS NOT NULL AND NOT {is_string(f'{p}.stem')} AND NOT {is_array(f'{p}.stem')}"
    no_number = f"({whole_number(f'{p}.puzzleRows')} IS NULL OR {whole_number(f'{p}.puzzleColumns')} IS NULL)"
    return case(
        (f"{p} IS NULL", "'X4'"),
        (f"exists({p}.cs, c -> c IS NULL)", "'X4'"),
        (f"{p}.t IN ('matching', 'gmrq') AND exists({p}.cs, c -> {nested_group})", "'X9'"),
        (f"exists({p}.ks, k -> k IS NULL)", "'X4'"),
        (f"size({p}.ks) > 0 AND {not_text}", "'X8'"),
        (f"{p}.t = 'string' AND {p}.ai IS NOT NULL AND NOT {is_object(f'{p}.ai')}", "'X5'"),
        (f"size({p}.pieces) > 0 AND {no_number}", "'X6'"),
        (f"exists({p}.pieces, x -> x IS NULL)", "'X4'"),
    )


def stopper() -> str:
    """First reason a document cannot be checked at all, as a rule id, else NULL."""
    return case(
        ("raw IS NULL", "'X11'"),
        ("wrapped IS NULL", "'X1'"),
        ("root IS NULL", "'X2'"),
        (f"{has_parts()} AND {BROKEN_METADATA}", "'X3'"),
        (has_parts(), f"get(array_compact(transform(parts, p -> {part_stopper()})), 0)"),
    )


def stopper_finding(rule_id: str) -> str:
    """The finding of a stopper rule, as an array of at most one."""
    return case((f"{rule_id} IS NOT NULL", f"array({finding_of(rule_id)})"),
                otherwise=NONE)


def pre_issues() -> str:
    """All findings on the legacy structure, in report order."""
    return all_of(structure_issues(), id_issues(), code_issues())
