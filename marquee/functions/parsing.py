"""Text to number. What does not parse becomes null; nothing throws under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# `try_cast` alone is too lenient ("8.5d") and too strict ("1_000"), so the accepted
# spellings are written out: blanks around, a sign, single underscores between digits.
SPACE = r"\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_BLANK = rf"[{SPACE}]*"
_DIGITS = r"[0-9](?:_?[0-9])*"
_INTEGER = rf"^{_BLANK}[+-]?{_DIGITS}{_BLANK}$"
_FLOAT = (
    rf"^{_BLANK}[+-]?(?:(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?"
    rf"|(?i:nan|inf|infinity)){_BLANK}$"
)
# Dropped before the cast: blanks, underscores, and the sign of a NaN.
_FILLER = rf"[{SPACE}_]|[+-](?=[nN])"


def column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _number(text: Column, spelling: str, kind: str) -> Column:
    return F.when(
        text.rlike(spelling), F.regexp_replace(text, _FILLER, "").try_cast(kind)
    )


def _integer(text: Column) -> Column:
    return _number(text, _INTEGER, "bigint")


def parse_rating(text: Column | str) -> Column:
    """Score text such as "8.5" to double; "N/A", blank or other text to null."""
    return _number(column(text), _FLOAT, "double")


def parse_votes(text: Column | str) -> Column:
    """Vote count text with thousands commas to bigint."""
    return _integer(F.replace(column(text), F.lit(","), F.lit("")))


def parse_integer(text: Column | str) -> Column:
    return _integer(column(text)).try_cast("int")


def parse_metascore(text: Column | str) -> Column:
    return parse_integer(text)


def year_from_date(text: Column | str) -> Column:
    """Year of a date text: its first four characters, if they are an integer."""
    return _integer(F.substring(column(text), 1, 4)).try_cast("int")


def parse_percent(text: Column | str) -> Column:
    return parse_rating(F.replace(column(text), F.lit("%"), F.lit("")))


def first_integer(text: Column | str, thousands: bool = False) -> Column:
    """First run of digits; with `thousands`, commas count as part of the run."""
    run = F.regexp_extract(column(text), "([0-9,]+)" if thousands else "([0-9]+)", 1)
    return F.replace(run, F.lit(","), F.lit("")).try_cast("bigint")


def year_in_text(text: Column | str) -> Column:
    """First year of the 1900s or 2000s anywhere in the text."""
    return F.regexp_extract(column(text), "((?:19|20)[0-9]{2})", 1).try_cast("int")


def parenthesized_year(text: Column | str) -> Column:
    return F.regexp_extract(column(text), r"\(([0-9]{4})\)", 1).try_cast("int")
