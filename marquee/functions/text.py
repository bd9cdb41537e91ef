"""Text shaping: truncation, slugs, serialized lists, stamps."""

from __future__ import annotations

import string
import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column, functions as F

from ..schemas import FILE_STAMP, MAX_TEXT
from .parsing import SPACE, column

# Control characters that cannot occur in a folded text's table entry.
_PAIR, _ENTRY = "\x02", "\x01"


def blank_to_null(text: Column | str) -> Column:
    return F.nullif(column(text), F.lit(""))


def truncate_text(
    text: Column | str, limit: int = MAX_TEXT, suffix: str = "...", suffix_outside: bool = False
) -> Column:
    """Cut text over `limit`. The suffix counts towards it unless `suffix_outside`."""
    text = column(text)
    kept = limit if suffix_outside else limit - len(suffix)
    if kept < 0:
        raise ValueError("limit is shorter than the suffix")
    return F.when(F.length(text) <= limit, text).otherwise(
        F.concat(F.substring(text, 1, kept), F.lit(suffix))
    )


def truncate_or_null(text: Column | str, limit: int = MAX_TEXT) -> Column:
    return truncate_text(blank_to_null(text), limit)


@lru_cache(maxsize=1)
def _ascii_projection() -> tuple[dict[str, str], dict[str, str]]:
    """Characters whose compatibility decomposition has ASCII in it: one character, or more."""
    single, several = {}, {}
    for code in range(128, sys.maxunicode + 1):
        char = chr(code)
        if not unicodedata.decomposition(char):
            continue
        folded = unicodedata.normalize("NFKD", char).encode("ascii", "ignore").decode()
        if folded:
            (single if len(folded) == 1 else several)[char] = folded
    return single, several


@lru_cache(maxsize=None)
def _expanding_class(gap: int) -> str:
    """Pattern for the characters that fold to several, as ranges that bridge small gaps:
    a long list of single characters is slow to test, and a false hit only costs time."""
    ranges: list[list[int]] = []
    for code in sorted(map(ord, _ascii_projection()[1])):
        if ranges and code - ranges[-1][1] <= (gap if code > 0x2000 else 16):
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    return "[" + "".join(f"{chr(low)}-{chr(high)}" for low, high in ranges) + "]"


def ascii_fold(text: Column | str) -> Column:
    """NFKD-decompose and drop what is not ASCII.

    The per-character table makes this a JVM expression; plain ASCII text skips it, and the
    character-by-character path runs only where a ligature, fraction or the like occurs.
    """
    text = column(text)
    single, several = _ascii_projection()
    table = F.str_to_map(
        F.lit(_ENTRY.join(f"{char}{_PAIR}{folded}" for char, folded in several.items())),
        F.lit(_ENTRY),
        F.lit(_PAIR),
    )
    expanded = F.array_join(
        F.transform(
            F.regexp_extract_all(text, F.lit("(?s)(.)"), F.lit(1)),
            # Only characters beyond ASCII are looked up.
            lambda char: F.when(char < "\x80", char).otherwise(F.coalesce(F.element_at(table, char), char)),
        ),
        "",
    )
    # Few ranges rule out most Latin text before the exact ones are tried.
    expands = text.rlike(_expanding_class(gap=sys.maxunicode)) & text.rlike(_expanding_class(gap=16))
    spelled = F.when(expands, expanded).otherwise(text)
    folded = F.regexp_replace(
        F.translate(spelled, "".join(single), "".join(single.values())), r"[^\x00-\x7F]", ""
    )
    return F.when(text.rlike(r"[^\x00-\x7F]"), folded).otherwise(text)


def title_slug(title: Column | str, sep: str = "-") -> Column:
    """URL form of a title. Separator runs are joined before other marks go, so "A & B"
    keeps two separators. One translation then lowers letters and drops the marks."""
    joined = F.regexp_replace(ascii_fold(title), r"[ \t\n\r\f\x0B\x1c-\x1f_\-]+", sep)
    kept = string.ascii_lowercase + string.digits + string.ascii_uppercase + sep
    marks = "".join(chr(code) for code in range(128) if chr(code) not in kept)
    plain = F.translate(joined, string.ascii_uppercase + marks, string.ascii_lowercase)
    return F.btrim(plain, F.lit(sep))


def strip_word(text: Column | str, word: str = "Ratings") -> Column:
    """The text without `word`, trimmed: an audience count kept as text."""
    return F.regexp_replace(
        F.replace(column(text), F.lit(word), F.lit("")), rf"^[{SPACE}]+|[{SPACE}]+$", ""
    )


def ratings_json(ratings: Column | str, empty: str | None = None) -> Column:
    """A rating list as JSON text; `empty` stands for an absent or empty list."""
    ratings = column(ratings)
    return F.when(F.size(ratings) > 0, F.to_json(ratings)).otherwise(F.lit(empty))


def file_stamp(moment: Column | str) -> Column:
    return F.date_format(column(moment), FILE_STAMP)
