"""Text expressions: Unicode-aware whitespace, digits and numbers."""

import unicodedata

from quillbank.functions.sql import case, let, lit

# Unicode whitespace plus the four ASCII separators.
SPACE = r"[\s\x1C-\x1F]"

# Every decimal digit of Unicode: blocks of ten from each zero.
_ZEROS = [c for c in range(128, 0x110000) if unicodedata.decimal(chr(c), None) == 0]
OTHER_DIGITS = "".join(chr(z + d) for z in _ZEROS for d in range(10))
PLAIN_DIGITS = "0123456789" * len(_ZEROS)


def strip(text: str) -> str:
    left = f"regexp_replace({text}, {lit(f'(?U)^{SPACE}+')}, '')"
    return f"regexp_replace({left}, {lit(f'(?U){SPACE}+\\z')}, '')"


def is_blank(text: str) -> str:
    """Null counts as blank."""
    return f"coalesce({text} RLIKE {lit(f'(?U)\\A{SPACE}*\\z')}, true)"


def normalize_text(text: str) -> str:
    """Collapse every whitespace run to one space and trim the ends."""
    return f"trim(regexp_replace({text}, {lit(f'(?U){SPACE}+')}, ' '))"


def is_digits(text: str) -> str:
    pattern = r"(?U)^\d+$"
    return f"coalesce({text} RLIKE {lit(pattern)}, false)"


def count_of(text: str, mark: str) -> str:
    """Non-overlapping occurrences of ``mark``."""
    return f"((length({text}) - length(replace({text}, {lit(mark)}, ''))) DIV {len(mark)})"


def ascii_digits(text: str) -> str:
    """Digits of any script as 0-9; text that is ASCII is left alone."""
    ascii_only = r"\A\p{ASCII}*\z"
    return (f"CASE WHEN {text} RLIKE {lit(ascii_only)} THEN {text} "
            f"ELSE translate({text}, {lit(OTHER_DIGITS)}, {lit(PLAIN_DIGITS)}) END")


def json_number(text: str) -> str:
    """A number in text form as VARIANT, NULL where it is not one.

    Whole values come out as integers, digit by digit as they are written, up to
    the 38 digits an integer of a VARIANT can have; larger ones are doubles.
    """
    whole, decimal = lit(r"\A-?[0-9]+(\.0*)?\z"), lit(r"\A-?[0-9]+(\.[0-9]+)?([Ee][-+]?[0-9]+)?\z")
    number = "try_cast(x AS double)"
    integer = f"try_cast(CASE WHEN x RLIKE {whole} THEN substring_index(x, '.', 1) WHEN rint({number}) = {number} THEN x END AS decimal(38,0))"
    return (
        f"get(transform(array({ascii_digits(text)}), x -> CASE WHEN x RLIKE {decimal} "
        f"THEN coalesce(CAST({integer} AS variant), CAST({number} AS variant)) END), 0)"
    )


def float_text(number: str) -> str:
    """A double as Python prints it: plain from 1e-4 to 1e16, else with an exponent of two digits or more.

    The digits are those the JVM finds; below 1e-320 they can be more than Python's.
    """
    plain = r"rtrim('0', CAST(CAST(s AS decimal(38,21)) AS string))"
    exponent = "CAST(substring_index(s, 'E', -1) AS int)"
    scientific = (f"concat(regexp_replace(substring_index(s, 'E', 1), '[.]0$', ''), 'e', CASE WHEN {exponent} < 0 THEN '-' ELSE '+' END, "
                  f"lpad(CAST(abs({exponent}) AS string), greatest(2, length(CAST(abs({exponent}) AS string))), '0'))")
    return let(f"CAST({number} AS string)", "s", case(
        ("s NOT LIKE '%E%'", "CASE WHEN s LIKE '%Infinity' THEN replace(s, 'Infinity', 'inf') ELSE lower(s) END"),
        (f"{exponent} BETWEEN -4 AND 15", f"regexp_replace({plain}, '[.]$', '.0')"),
        otherwise=scientific,
    ))
