"""Projections onto the fixed tables, and the fallbacks that feed them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import (
    blank_to_null,
    parse_metascore,
    parse_rating,
    parse_votes,
    ratings_json,
    truncate_or_null,
    truncate_text,
    year_from_date,
)
from ..schemas import OMDB_FIELDS, RATINGS_TYPE, TABLES
from .lookup import Lookup, lookup_join

PARSERS = {"rating": parse_rating, "votes": parse_votes, "metascore": parse_metascore}


def field(df: DataFrame, name: str, kind: str = "string") -> Column:
    """The column, or a typed null where the records lack it."""
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def conform(df: DataFrame, fields) -> DataFrame:
    """Exactly these columns, in order and type; absent or unfitting values are null."""
    kinds = dict(df.dtypes)
    return df.select(
        *(
            (field(df, name, kind) if kinds.get(name, kind) == kind
             else F.col(name).try_cast(kind)).alias(name)
            for name, kind in fields
        )
    )


def select_as(df: DataFrame, **columns: str) -> DataFrame:
    """Projection with new names: `new=old`."""
    return df.select(*(F.col(old).alias(new) for new, old in columns.items()))


def stamp(df: DataFrame, source: str, run_at: str) -> DataFrame:
    """Lineage of one run. The run's time is an argument, so a rerun gives the same rows."""
    return df.withColumns({"data_source": F.lit(source), "processed_at": F.lit(run_at)})


def title_or(df: DataFrame, *names: str) -> Column:
    """First of the title columns that is not empty."""
    return F.coalesce(*(blank_to_null(field(df, name)) for name in names))


def known_year(df: DataFrame, year: str = "year", date: str = "release_date") -> Column:
    """The year, else the year of the release date; zero counts as missing."""
    return F.coalesce(
        F.nullif(field(df, year, "int"), F.lit(0)),
        F.nullif(year_from_date(field(df, date)), F.lit(0)),
    )


def merge_records(base: DataFrame, enhancement: DataFrame, keys: list[str]) -> DataFrame:
    """Base records overwritten by the enhancement wherever that has a value."""
    renamed = enhancement.select(
        *(F.col(c).alias(c if c in keys else f"_new_{c}") for c in enhancement.columns)
    )
    joined = lookup_join(base, keys, Lookup(renamed))
    added = [c for c in enhancement.columns if c not in base.columns]
    shared = set(enhancement.columns) - set(added) - set(keys)
    return joined.select(
        *(F.coalesce(f"_new_{c}", c).alias(c) if c in shared else c for c in base.columns),
        *(F.col(f"_new_{c}").alias(c) for c in added),
    )


def omdb_fields(responses: DataFrame) -> DataFrame:
    """Accepted responses with typed, prefixed fields, keyed by `imdb_id`."""
    typed = (
        (PARSERS[kind](name) if kind in PARSERS else F.col(name)).alias(target)
        for name, target, kind in OMDB_FIELDS
    )
    return responses.filter(F.col("Response") == "True").select(
        F.col("imdbID").alias("imdb_id"), *typed
    )


def _project(movies: DataFrame, table: str, run_at: str, values: dict[str, Column]) -> DataFrame:
    shared = {
        # An empty id would meet every other empty one in the tables' joins.
        "imdb_id": blank_to_null(field(movies, "imdb_id")),
        "created_at": F.lit(run_at), "updated_at": F.lit(run_at),
    }
    chosen = {**shared, **values}
    fields = TABLES[table]
    shaped = movies.select(
        *(chosen.get(name, field(movies, name, kind)).alias(name) for name, kind in fields)
    )
    return conform(shaped, fields)


def to_tmdb_table(movies: DataFrame, run_at: str) -> DataFrame:
    return _project(movies, "tmdb_movies", run_at, {
        "tmdb_id": F.coalesce(field(movies, "tmdb_id", "int"), field(movies, "id", "int")),
        "year": known_year(movies),
        "overview": truncate_or_null(field(movies, "overview")),
        "data_source": F.lit("tmdb"),
    })


def _omdb_values(movies: DataFrame) -> dict[str, Column]:
    """Table fields that hold the `omdb_` field of the same name."""
    held = {
        target.removeprefix("omdb_"): field(movies, target)
        for _, target, kind in OMDB_FIELDS
        if target != "omdb_title" and kind != "list"
    }
    return {**held, "year": known_year(movies)}


def to_omdb_table(movies: DataFrame, run_at: str) -> DataFrame:
    return _project(movies, "omdb_movies", run_at, {
        **_omdb_values(movies),
        "plot": truncate_or_null(field(movies, "omdb_plot")),
        "ratings": ratings_json(field(movies, "omdb_ratings", RATINGS_TYPE), empty="[]"),
        "data_source": F.lit("omdb"),
    })


def to_single_table(movies: DataFrame, run_at: str) -> DataFrame:
    """The single-source form of `omdb_movies`: year from the release date alone, own source
    and enrichment time kept, and over-long text cut with the mark outside the limit."""
    shaped = _project(movies, "omdb_movies", run_at, {
        **_omdb_values(movies),
        "year": year_from_date(field(movies, "release_date")),
        "ratings": ratings_json(field(movies, "omdb_ratings", RATINGS_TYPE)),
        "data_source": F.coalesce(field(movies, "data_source"), F.lit("tmdb")),
        "created_at": F.coalesce(blank_to_null(field(movies, "omdb_enhanced_at")), F.lit(run_at)),
    })
    return shaped.select(
        *(
            truncate_text(name, suffix_outside=True).alias(name) if kind == "string" else name
            for name, kind in shaped.dtypes
        )
    )


def _to_scores(movies: DataFrame, table: str, prefix: str, source: str, run_at: str) -> DataFrame:
    score = f"{prefix}_critic_score"
    scored = movies.filter(field(movies, score).isNotNull())
    scores = ("critic_score", "critic_count", "user_score", "user_count")
    return _project(scored, table, run_at, {
        "tmdb_id": F.coalesce(field(movies, "tmdb_id", "int"), field(movies, "id", "int")),
        "year": known_year(movies),
        "data_source": F.lit(source),
        **{name: field(movies, f"{prefix}_{name}") for name in scores},
    })


def to_metacritic_table(movies: DataFrame, run_at: str) -> DataFrame:
    """Only movies with a critic score have a row."""
    return _to_scores(movies, "metacritic_ratings", "metacritic", "metacritic", run_at)


def to_rotten_tomatoes_table(movies: DataFrame, run_at: str) -> DataFrame:
    """Only movies with a critic score have a row."""
    return _to_scores(movies, "rotten_tomatoes_ratings", "rt", "rottentomatoes", run_at)


PROJECTIONS = {
    "tmdb_movies": to_tmdb_table,
    "omdb_movies": to_omdb_table,
    "metacritic_ratings": to_metacritic_table,
    "rotten_tomatoes_ratings": to_rotten_tomatoes_table,
}
