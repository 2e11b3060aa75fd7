"""Document-level scalars: codes, ids and the shared metadata columns.

``root`` and ``meta`` are names of struct columns with VARIANT leaves, see
``ROOT_FIELDS`` and ``META_FIELDS``; ``meta`` is NULL where the document has no
metadata object.  Everything returns SQL expression text.
"""

from quillbank import fixed_values as fv
from quillbank.functions.sql import case, let, lit, lookup, one_of
from quillbank.functions.text import is_blank, normalize_text, strip
from quillbank.functions.variants import is_empty, is_falsy, shown_or, string_of

ROOT_FIELDS = [
    "metadata", "statement", "answer", "section_id", "language", "subject",
    "subject_id", "grade", "grade_id", "country", "question_id", "source",
]
META_FIELDS = ["id", "mapped_id", "language", "country"]


def language_name(code: str) -> str:
    return lookup(fv.LANGUAGES, code)


def country_name(code: str) -> str:
    return lookup(fv.COUNTRIES, code)


def _known(value: str, table: dict) -> str:
    """Lower-cased, stripped code if it is in the table, else NULL."""
    return let(strip(f"lower({string_of(value)})"), "code", f"CASE WHEN {one_of('code', table)} THEN code END")


def language_code(root: str = "root", meta: str = "meta") -> str:
    """A truthy root value is used even if it is wrong; metadata is no fallback for it."""
    chosen = f"CASE WHEN {is_falsy(f'{root}.language')} THEN {meta}.language ELSE {root}.language END"
    return let(chosen, "given", _known("given", fv.LANGUAGES))


def country_codes(root: str = "root", meta: str = "meta") -> str:
    """The valid codes, root first."""
    return (f"array_compact(array({_known(f'{root}.country', fv.COUNTRIES)}, "
            f"{_known(f'{meta}.country', fv.COUNTRIES)}))")


def country_code(root: str = "root", meta: str = "meta", codes: str | None = None) -> str:
    """``eg`` anywhere wins, then a real country over one ``zz``, then the first."""
    return let(codes or country_codes(root, meta), "codes", case(
        ("array_contains(codes, 'eg')", "'eg'"),
        ("size(codes) = 2 AND size(filter(codes, c -> c = 'zz')) = 1", "get(filter(codes, c -> c <> 'zz'), 0)"),
        otherwise="get(codes, 0)",
    ))


def limit_country_is_egypt(root: str = "root", meta: str = "meta", codes: str | None = None) -> str:
    """Whether the choice limit applies; an unknown country is not Egypt."""
    return f"coalesce(array_contains({codes or country_codes(root, meta)}, 'eg'), false)"


def mapped_id(meta: str = "meta") -> str:
    return strip(shown_or(f"{meta}.mapped_id", ""))


def question_id(root: str = "root") -> str:
    return strip(shown_or(f"{root}.question_id", ""))


def file_id(filename: str = "filename") -> str:
    return strip(f"replace({filename}, '.json', '')")


def parent_id(meta: str = "meta") -> str:
    """NULL where it is blank."""
    return let(strip(shown_or(f"{meta}.id", "")), "id", f"CASE WHEN NOT {is_blank('id')} THEN id END")


def source(root: str = "root") -> str:
    """The default stands in for a missing key only; JSON null stays."""
    return f"coalesce({root}.source, CAST({lit(fv.DEFAULT_SOURCE)} AS variant))"


def question_types(parts: str = "parts", text: bool = False) -> str:
    """Type of every part, ``unknown`` where the key is missing; ``text`` for parts without ``t``."""
    own = string_of("p.type") if text else "p.t"
    return f"transform({parts}, p -> CASE WHEN p.type IS NULL THEN 'unknown' ELSE {own} END)"


def common_metadata(
        root: str = "root", meta: str = "meta", parts: str = "parts", language: str | None = None, codes: str | None = None) -> dict:
    """The thirteen shared columns of a converted document, in output order.

    ``language`` and ``codes`` name the document's language code and country codes where they are there already.
    """
    language, country = language or language_code(root, meta), country_code(root, meta, codes)
    return {
        "question_id": mapped_id(meta),
        "parent_id": parent_id(meta),
        "language_code": language,
        "language": language_name(language),
        "country_code": country,
        "country": country_name(country),
        "subject": f"{root}.subject",
        "subject_id": f"{root}.subject_id",
        "grade": shown_or(f"{root}.grade", ""),
        "grade_id": shown_or(f"{root}.grade_id", ""),
        "number_of_parts": f"size({parts})",
        "section_id": shown_or(f"{root}.section_id", ""),
        "source": source(root),
    }


def explanation_text(answer: str = "root.answer") -> str:
    """The normalised root answer, NULL where it is empty or not a string."""
    return f"CASE WHEN NOT {is_empty(answer)} THEN {normalize_text(string_of(answer))} END"


def part_explanation(explanation: str, child_divs: str, n_parts: str, position: str) -> str:
    """Whole text for a single part, else the child ``<div>`` of the part's rank."""
    return f"CASE WHEN {n_parts} = 1 THEN {explanation} ELSE get({child_divs}, {position} - 1) END"
