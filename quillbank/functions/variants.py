"""Tests on VARIANT values that keep JSON's distinctions, as SQL expressions.

A missing key is SQL NULL, a JSON null is a non-NULL variant.  Tests return a
definite true or false for a NULL input.
"""

from quillbank.functions.sql import case, let, lit
from quillbank.functions.text import float_text, is_blank

INTEGER_KIND = lit(r"^(BIGINT|BOOLEAN|DECIMAL\((19|2[0-9]|3[0-8]),0\))$")
WIDE_INTEGER_KIND = lit(r"^(BIGINT|DECIMAL\((19|2[0-9]|3[0-8]),0\))$")
NUMBER_KIND = lit("^(BIGINT|DOUBLE|FLOAT|DECIMAL)")
NUMERIC_KIND = lit("^(BIGINT|DOUBLE|FLOAT|DECIMAL|BOOLEAN)")
JSON_NULL = "parse_json('null')"


def variant_struct(names) -> str:
    """DDL of a struct holding every named key as VARIANT."""
    return "struct<" + ",".join(f"`{n}`:variant" for n in names) + ">"


def field(v: str, path: str = "$", as_type: str = "variant") -> str:
    return f"try_variant_get({v}, '{path}', '{as_type}')"


def array_of(v: str, names) -> str:
    """``v`` as an array of structs with VARIANT leaves; a non-object element is NULL."""
    return field(v, "$", f"array<{variant_struct(names)}>")


def kind(v: str) -> str:
    return f"coalesce(schema_of_variant({v}), 'VOID')"


def is_none(v: str) -> str:
    """Missing key or JSON null."""
    return f"({v} IS NULL OR is_variant_null({v}))"


def is_string(v: str) -> str:
    return f"(schema_of_variant({v}) <=> 'STRING')"


def is_boolean(v: str) -> str:
    return f"(schema_of_variant({v}) <=> 'BOOLEAN')"


def is_integer(v: str) -> str:
    """Integer literal or boolean; ``1.0`` is not an integer."""
    return f"({kind(v)} RLIKE {INTEGER_KIND})"


def is_numeric(v: str) -> str:
    """Number or boolean."""
    return f"({kind(v)} RLIKE {NUMERIC_KIND})"


def outer_array(v: str, path: str = "$") -> str:
    """The array at ``path`` without its elements, NULL for anything else.

    No element is copied and no schema printed. A path that leads nowhere costs an exception, so ``$`` is the path to probe.
    """
    return field(v, path, "array<array<boolean>>")


def is_filled_array(v: str) -> str:
    return f"coalesce(size({outer_array(v)}) > 0, false)"


def is_array(v: str) -> str:
    return f"({outer_array(v)} IS NOT NULL)"


def is_object(v: str) -> str:
    return f"({field(v, '$', 'struct<x:array<boolean>>')} IS NOT NULL)"


def is_filled_object(v: str) -> str:
    return f"coalesce(size({field(v, '$', 'map<string,array<boolean>>')}) > 0, false)"


def string_of(v: str) -> str:
    """The text of a JSON string, NULL for anything else."""
    return f"CASE WHEN schema_of_variant({v}) = 'STRING' THEN {field(v, '$', 'string')} END"


def number_of(v: str) -> str:
    """The numeric value of a JSON number or boolean, NULL for anything else.

    Integers, by far the most, are taken as they lie; any other type is converted.
    """
    return (f"CASE WHEN schema_of_variant({v}) = 'BIGINT' THEN CAST({field(v, '$', 'bigint')} AS double) "
            f"WHEN {is_numeric(v)} THEN {field(v, '$', 'double')} END")


def is_filled_string(v: str) -> str:
    return f"coalesce({string_of(v)} <> '', false)"


def equals_number(v: str, n) -> str:
    return f"coalesce({number_of(v)} = {n}, false)"


def is_empty(v: str) -> str:
    """Null, blank string, ``[]`` or ``{}``; ``0`` and ``false`` are not empty."""
    return case(
        (f"{v} IS NULL", "true"),
        (is_string(v), is_blank(field(v, "$", "string"))),
        (is_array(v), f"NOT {is_filled_array(v)}"),
        (is_object(v), f"NOT {is_filled_object(v)}"),
        otherwise=f"is_variant_null({v})",
    )


def is_falsy(v: str) -> str:
    """Null, false, zero, ``""``, ``[]`` or ``{}``."""
    return case(
        (f"{v} IS NULL", "true"),
        (is_string(v), f"{field(v, '$', 'string')} = ''"),
        (is_array(v), f"NOT {is_filled_array(v)}"),
        (is_object(v), f"NOT {is_filled_object(v)}"),
        (is_numeric(v), f"{number_of(v)} = 0"),
        otherwise=f"is_variant_null({v})",
    )


def integer_below(v: str, bound: int) -> str:
    """True unless ``v`` is an integer of at least ``bound``."""
    return case(
        (f"schema_of_variant({v}) = 'BIGINT'", f"{field(v, '$', 'bigint')} < {bound}"),
        otherwise=f"(NOT {is_integer(v)} OR {field(v, '$', 'double')} < {bound})",
    )


def shown(v: str) -> str:
    """The value as the reports print it: ``None``, ``True``, digits, bare text."""
    text = field(v, "$", "string")
    return case(
        (is_string(v), text),
        (f"{kind(v)} = 'BIGINT'", f"CAST({field(v, '$', 'bigint')} AS string)"),
        (f"{kind(v)} = 'VOID'", "'None'"),
        (is_boolean(v), f"initcap({text})"),
        (f"{kind(v)} RLIKE {WIDE_INTEGER_KIND}", text),
        (f"{kind(v)} RLIKE {NUMBER_KIND}", float_text(field(v, "$", "double"))),
        otherwise=f"to_json({v})",
    )


def shown_or(v: str, default: str) -> str:
    """``shown`` with a default for a missing key only."""
    return f"CASE WHEN {v} IS NULL THEN {lit(default)} ELSE {shown(v)} END"


def type_name(v: str) -> str:
    """Name of the value's type as the reports print it."""
    return case(
        (f"{kind(v)} = 'VOID'", "'NoneType'"),
        (is_string(v), "'str'"),
        (is_boolean(v), "'bool'"),
        (is_integer(v), "'int'"),
        (f"{kind(v)} LIKE 'ARRAY%'", "'list'"),
        (f"{kind(v)} LIKE 'OBJECT%'", "'dict'"),
        otherwise="'float'",
    )


def text_or_json(v: str) -> str:
    """Bare text of a string, JSON text of anything else."""
    return let(v, "bare", f"coalesce({string_of('bare')}, to_json(bare))")


def null_if_missing(value: str) -> str:
    """A VARIANT that prints as JSON null where ``value`` is NULL."""
    return f"coalesce(CAST({value} AS variant), {JSON_NULL})"
