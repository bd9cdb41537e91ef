"""Filters, validation, and keeping failed rows apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import blank_to_null
from ..schemas import RATING_RANGE, YEAR_RANGE, YEAR_TOLERANCE
from .conform import field


def filter_by_rating(
    df: DataFrame, rating: str = "omdb_imdb_rating",
    low: float = RATING_RANGE[0], high: float = RATING_RANGE[1],
) -> DataFrame:
    """Closed interval; rows without a rating are dropped."""
    return df.filter(F.col(rating).between(low, high))


def with_score(df: DataFrame, score: str) -> DataFrame:
    return df.filter(F.col(score).isNotNull())


def years_agree(left: Column | str, right: Column | str, tolerance: int = YEAR_TOLERANCE) -> Column:
    left, right = (F.col(c) if isinstance(c, str) else c for c in (left, right))
    return F.abs(left.cast("bigint") - right.cast("bigint")) <= tolerance


def record_errors(
    df: DataFrame,
    required: dict[str, str] | None = None,
    rating: str = "omdb_imdb_rating",
    year: str = "year",
    rating_range: tuple[float, float] = RATING_RANGE,
    year_range: tuple[int, int] = YEAR_RANGE,
) -> Column:
    """Messages for what is wrong with a record, in a fixed order; empty if nothing is.

    `required` maps a message's field name to the column that holds it. A column that the
    records lack is missing if it is required; an absent rating or year is not checked, nor
    is a rating that is no number.
    """
    required = required or {"title": "title", "imdb_id": "imdb_id"}
    checks = [
        F.when(blank_to_null(field(df, name)).isNull(), F.lit(f"Missing required field: {label}"))
        for label, name in required.items()
    ]
    for name, label, (low, high) in ((rating, "rating", rating_range), (year, "year", year_range)):
        value = field(df, name, "double")
        wrong = ((value < low) | (value > high)) & ~F.isnan(value.cast("double"))
        checks.append(F.when(wrong, F.concat(F.lit(f"Invalid {label} value: "), value.cast("string"))))
    return F.array_compact(F.array(*checks))


def validate(df: DataFrame, **fields) -> DataFrame:
    return df.withColumn("errors", record_errors(df, **fields))


def split_failed(df: DataFrame, errors: str = "errors") -> tuple[DataFrame, DataFrame]:
    """Good rows without the error column, and the quarantined rows with it."""
    failed = F.size(errors) > 0
    return df.filter(~failed).drop(errors), df.filter(failed)


def abort_on_error(df: DataFrame, errors: str = "errors") -> DataFrame:
    """Strict mode: the job fails with a record's messages. A filter, so that dropping the
    error column later does not drop the check."""
    text = F.array_join(errors, "; ")
    failed = F.raise_error(text).cast("boolean")
    return df.filter(F.when(F.size(errors) > 0, failed).otherwise(F.lit(True)))


def error_counts(df: DataFrame, errors: str = "errors") -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.size(errors) > 0).alias("errors")
    )
