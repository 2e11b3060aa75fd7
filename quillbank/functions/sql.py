"""Small builders of Spark SQL expression text.

Rules and conversions are written as SQL expressions, because one expression
of a few hundred operators is analysed far quicker from text than from as many
single calls.  Use the results with ``functions.expr`` or in ``selectExpr``.
"""


def lit(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def lits(words) -> str:
    return ", ".join(lit(w) for w in words)


def array(words) -> str:
    return f"array({lits(words)})"


def one_of(text: str, words) -> str:
    """Membership with a definite answer for NULL."""
    return f"coalesce({text} IN ({lits(words)}), false)"


def let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, which is evaluated once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def struct(**fields: str) -> str:
    return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in fields.items()) + ")"


def case(*branches, otherwise: str = "NULL") -> str:
    """``CASE`` over ``(condition, value)`` pairs."""
    whens = " ".join(f"WHEN {c} THEN {v}" for c, v in branches)
    return f"CASE {whens} ELSE {otherwise} END"


def lookup(table: dict, key: str) -> str:
    pairs = ", ".join(f"{lit(k)}, {lit(v)}" for k, v in table.items())
    return f"try_element_at(map({pairs}), {key})"
