"""Text checks and guarded parsing, as null-safe Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from musterline.fixed_values import DATE_SHAPE_PATTERN, EMAIL_PATTERN

# Every character Python's ``str.strip`` removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The same characters as a regular expression class.
_SPACE = r"[\x09-\x0d\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]*"
_DIGITS = r"[0-9]+(?:_[0-9]+)*"
_INTEGER = rf"[+-]?{_DIGITS}"
_EXPONENT = rf"(?:[eE][+-]?{_DIGITS})?"
_LOOSE_NUMBER = rf"[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS}){_EXPONENT}"
_PLAIN_NUMBER = r"[+-]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"
_REAL_DATE = r"(?!0000)[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"


def _matched(text: Column, pattern: str) -> Column:
    """The text without surrounding white space if all of it matches, else an empty string.

    One regular expression both checks and trims, so the text is named once in the plan; guards
    of the form "when it matches, cast it" would multiply in every rule built on top of them.
    """
    return F.regexp_extract(text, f"^{_SPACE}({pattern}){_SPACE}$", 1)


def strip(text: Column) -> Column:
    """Trim all Unicode white space; ``trim`` alone removes blanks only."""
    return F.btrim(text, F.lit(WHITESPACE))


def is_true(predicate: Column) -> Column:
    """A predicate that answers false, never null."""
    return F.coalesce(predicate, F.lit(False))


def is_blank(text: Column) -> Column:
    """Null counts as blank."""
    return ~is_true(F.length(strip(text)) > 0)


def valid_email(text: Column) -> Column:
    return is_true(strip(text).rlike("(?U)" + EMAIL_PATTERN))


def valid_date_shape(text: Column) -> Column:
    """Digits and dashes in the right places; 2024-99-99 passes."""
    return is_true(strip(text).rlike(DATE_SHAPE_PATTERN))


def parse_date(text: Column) -> Column:
    """A real calendar date, month and day possibly unpadded; null otherwise."""
    return _matched(text, _REAL_DATE).try_cast("date")


def valid_date(text: Column) -> Column:
    return parse_date(text).isNotNull()


def parse_integer(text: Column, to: str = "bigint") -> Column:
    """Integer text with optional sign and digit groups; null for anything else."""
    return F.replace(_matched(text, _INTEGER), F.lit("_"), F.lit("")).try_cast(to)


def parse_number(text: Column, digit_groups: bool = True) -> Column:
    """Number text as a double; null for anything else, ``nan``, ``inf`` and ``5d`` included."""
    digits = _matched(text, _LOOSE_NUMBER if digit_groups else _PLAIN_NUMBER)
    return F.replace(digits, F.lit("_"), F.lit("")).try_cast("double")


def finite(number: Column) -> Column:
    """The number, or null when it is NaN or infinite (NaN is no less than infinity)."""
    return F.when(F.abs(number) < F.lit(float("inf")), number)
