"""Part types beyond the built-in ones: what a user registers, and what the rules and conversions ask for.

    PAIRS = PartType(
        legacy="pairs", new="pairs", reads=("left", "right"), new_keys=("left", "right"), written=["left", "right"],
        convert=lambda p, language, explanation: struct(
            **head(p, "pairs"), left=string_of(f"{p}.left"), right=string_of(f"{p}.right"), explanation=explanation),
        checks=lambda p: issues(rule(f"NOT {is_filled_string(f'{p}.left')}", "U1", p=NO, field="left")),
        messages={"U1": "Part {p} (pairs): '{field}' must be a text"},
    )
    register(PAIRS)

From then on documents with such parts pass through ``classify``, the reports and the type filter like all others.
Expressions are SQL text: ``p`` names a part of the skeleton and, in checks, ``i`` its 0-based position.  Registration
belongs to the driver's process and counts for the frames that are built after it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field as dataclass_field

from quillbank import fixed_values as fv

#: The number of the part that a finding is about.
NO = "i + 1"


@dataclass(frozen=True)
class PartType:
    """A legacy part type with its conversion and its rules.

    ``convert(p, language, explanation)`` gives a struct with ``n, type, stem`` first and ``explanation``; ``written`` names its
    further keys in output order, a key in brackets being a list that is written bare when it has one element.  ``reads`` are
    legacy keys of a part and ``new_keys`` keys of a converted part that the expressions need besides the usual ones.
    ``checks`` and ``new_checks`` give the findings on the legacy and on the converted part; ``messages`` has the text for each
    of their rule ids.
    """

    legacy: str
    new: str
    convert: Callable[[str, str, str], str]
    written: list[str] | dict[str, list[str]]
    reads: tuple[str, ...] = ()
    new_keys: tuple[str, ...] = ()
    checks: Callable[[str], str] | None = None
    new_checks: Callable[[str], str] | None = None
    messages: dict[str, str] = dataclass_field(default_factory=dict)


_REGISTERED: dict[str, PartType] = {}


def register(part_type: PartType) -> None:
    """Adds a type.  Names of other types and ids of other rules are refused."""
    others = [t for t in _REGISTERED.values() if t.legacy != part_type.legacy]
    if part_type.legacy in fv.PART_TYPES or any(t.new == part_type.new for t in others):
        raise ValueError(f"there is a part type of this name: {part_type.legacy!r}, written as {part_type.new!r}")
    taken = set(fv.MESSAGES).union(*[t.messages for t in others])
    if doubled := sorted(taken & set(part_type.messages)):
        raise ValueError(f"there are rules of these ids: {doubled}")
    _REGISTERED[part_type.legacy] = part_type


def unregister(legacy: str) -> None:
    """Takes a registered type away again."""
    _REGISTERED.pop(legacy, None)


@contextmanager
def registered(part_type: PartType) -> Iterator[PartType]:
    """A type for the frames built inside the block."""
    register(part_type)
    try:
        yield part_type
    finally:
        unregister(part_type.legacy)


def extra_types() -> list[PartType]:
    return list(_REGISTERED.values())


def known_types() -> list[str]:
    """All legacy types, the built-in ones first."""
    return [*fv.PART_TYPES, *_REGISTERED]


def messages() -> dict[str, str]:
    """The texts of all rules."""
    return {**fv.MESSAGES, **{k: v for t in _REGISTERED.values() for k, v in t.messages.items()}}


def with_extra(names: list[str], extra: Callable[[PartType], tuple[str, ...]]) -> list[str]:
    """Keys that are read always, and those that registered types ask for."""
    return list(dict.fromkeys([*names, *[k for t in _REGISTERED.values() for k in extra(t)]]))
