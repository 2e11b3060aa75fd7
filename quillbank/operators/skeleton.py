"""The typed skeleton of a legacy document: which keys are read, and their shape.

Leaves stay VARIANT so that rules can tell a missing key from a null and an
integer from a number; lists of objects become arrays of structs, once.
"""

from quillbank.functions.resolve import META_FIELDS, ROOT_FIELDS
from quillbank.functions.sql import let, lits
from quillbank.functions.variants import array_of, field, string_of, variant_struct
from quillbank.operators.part_types import with_extra

PART_FIELDS = [
    "n", "type", "stem", "standalone", "choices", "answer", "ai", "direction",
    "gap_text_keys", "grid_size", "puzzleRows", "puzzleColumns", "puzzleImage",
    "puzzleImageWidth", "puzzleImageHeight", "puzzleImageSplited",
]
CHOICE_FIELDS = [
    "type", "html_content", "values", "unit", "index", "fixed_order",
    "last_order", "group", "correct_order",
]
GAP_KEY_FIELDS = ["value", "correct_order"]
PIECE_FIELDS = ["index", "fixed_order", "correct_order", "src"]
CHOICE_LIST_TYPES = ["mcq", "mrq", "oq", "opinion", "matching", "gmrq"]


def part_fields() -> list[str]:
    """Keys of a part that are read."""
    return with_extra(PART_FIELDS, lambda t: t.reads)


def root(doc: str = "doc", at: str = "$") -> str:
    """Root keys as a struct; NULL unless the document is an object."""
    return field(doc, at, variant_struct(ROOT_FIELDS))


def meta(doc: str = "doc", at: str = "$") -> str:
    """Metadata keys as a struct; NULL unless metadata is an object."""
    return field(doc, f"{at}.metadata", variant_struct(META_FIELDS))


def part(p: str) -> str:
    """A part's leaves, its type as text (``t``), and the list its type uses.

    ``cs`` are the choices, each with its type as text, ``ks`` the gap keys and
    ``pieces`` the puzzle pieces; a list element that is no object is NULL.
    """
    def listed(name, names, types):
        return f"CASE WHEN t IN ({lits(types)}) THEN {array_of(f'{p}.{name}', names)} END"
    choices = (
        f"transform({listed('choices', CHOICE_FIELDS, CHOICE_LIST_TYPES)}, c -> CASE WHEN c IS NOT NULL THEN "
        f"named_struct('t', {string_of('c.type')}, " + ", ".join(f"'{f}', c.`{f}`" for f in CHOICE_FIELDS) + ") END)"
    )
    leaves = ", ".join(f"'{f}', {p}.`{f}`" for f in part_fields())
    filled = (
        f"named_struct({leaves}, 't', t, "
        f"'cs', {choices}, "
        f"'ks', {listed('gap_text_keys', GAP_KEY_FIELDS, ['gapText'])}, "
        f"'pieces', {listed('puzzleImageSplited', PIECE_FIELDS, ['puzzle'])})"
    )
    return f"CASE WHEN {p} IS NOT NULL THEN {let(string_of(f'{p}.type'), 't', filled)} END"


def parts(doc: str = "doc", at: str = "$") -> str:
    """The parts as an array of structs; NULL unless ``parts`` is an array."""
    leaves = field(doc, f"{at}.parts", f"array<{variant_struct(part_fields())}>")
    return f"transform({leaves}, p -> {part('p')})"
