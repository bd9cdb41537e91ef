"""Column functions; each takes a column or its name and returns a column."""

from .parsing import (
    first_integer,
    parse_integer,
    parse_metascore,
    parse_percent,
    parse_rating,
    parse_votes,
    parenthesized_year,
    year_from_date,
    year_in_text,
)
from .text import (
    ascii_fold,
    blank_to_null,
    file_stamp,
    ratings_json,
    strip_word,
    title_slug,
    truncate_or_null,
    truncate_text,
)

__all__ = [
    "ascii_fold",
    "blank_to_null",
    "file_stamp",
    "first_integer",
    "parse_integer",
    "parse_metascore",
    "parse_percent",
    "parse_rating",
    "parse_votes",
    "parenthesized_year",
    "ratings_json",
    "strip_word",
    "title_slug",
    "truncate_or_null",
    "truncate_text",
    "year_from_date",
    "year_in_text",
]
