"""Row-level findings: one struct per violated rule, as SQL expressions.

A rule is a predicate and the values its text needs.  Findings of a document
live in an array column; their texts are filled in once, by ``rendered``, and
they are exploded only in the report tables.
"""

from string import Formatter

from quillbank.fixed_values import REPORTED
from quillbank.functions.sql import case, lit, lookup
from quillbank.operators.part_types import messages

FINDING = "struct<rule_id:string,p:int,e:int,t:string,field:string,value:string,expected:string>"
FINDINGS = f"array<{FINDING}>"
NONE = f"CAST(array() AS {FINDINGS})"


def finding_of(rule_id: str, p="NULL", e="NULL", t="''", field="", value="''", expected="''") -> str:
    """A finding whose rule id is itself an expression."""
    return (
        f"named_struct('rule_id', {rule_id}, 'p', CAST({p} AS int), 'e', CAST({e} AS int), 't', {t}, "
        f"'field', {lit(field)}, 'value', CAST({value} AS string), 'expected', CAST({expected} AS string))"
    )


def finding(rule_id: str, **values) -> str:
    return finding_of(lit(rule_id), **values)


def rule(bad: str, rule_id: str, **values) -> str:
    """The finding where ``bad`` holds, else NULL."""
    return f"CASE WHEN {bad} THEN {finding(rule_id, **values)} END"


def issues(*rules: str) -> str:
    """All findings of the given rules, in order."""
    return f"array_compact(array({', '.join(rules)}))"


def only(rule_id: str, **values) -> str:
    return f"array({finding(rule_id, **values)})"


def of_each(items: str, element: str, index: str, check: str) -> str:
    """Findings of every element of an array."""
    return f"flatten(transform({items}, ({element}, {index}) -> {check}))"


def all_of(*groups: str) -> str:
    return f"concat({', '.join(groups)})"


def when(condition: str, findings: str) -> str:
    return case((condition, findings), otherwise=NONE)


def rendered(findings: str, stage: str) -> str:
    """Findings with their texts: the error structs of the reports."""
    known = messages()
    text = lookup(known, "x.rule_id")
    names = sorted({n for m in known.values() for _, n, _, _ in Formatter().parse(m) if n})
    for name in names:
        text = f"replace({text}, '{{{name}}}', coalesce(CAST(x.{name} AS string), 'None'))"
    failed = {k: v[0] for k, v in REPORTED.items()}
    expected = {k: v[1] for k, v in REPORTED.items()}
    return (
        f"transform({findings}, x -> named_struct('stage', {stage}, 'rule_id', x.rule_id, "
        f"'part_no', x.p, 'elem_no', x.e, 'message', {text}, "
        f"'field', coalesce({lookup(failed, 'x.rule_id')}, ''), "
        f"'actual', CASE WHEN x.rule_id IN ({', '.join(lit(k) for k in REPORTED)}) THEN x.value ELSE '' END, "
        f"'expected', coalesce({lookup(expected, 'x.rule_id')}, '')))"
    )
