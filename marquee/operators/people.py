"""Cast and crew: credits, rankings, filmographies and collaboration.

A person is an id; where a credit has none, the name stands in. Column `key` holds it, `person`
the name to show.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..schemas import CAST_TYPE, CREW_TYPE
from .analysis import split_names
from .conform import field
from .ranking import top

# Gender codes of cast entries and job names of crew entries.
GENDER_ROLES = {1: "actress", 2: "actor"}
JOB_ROLES = {"Director": "director", "Writer": "writer", "Producer": "producer"}
ROLES = ("actor", "actress", "director", "writer", "producer")


def _role(value: Column, roles: dict, other: str | None) -> Column:
    named = F.lit(other)
    for code, role in roles.items():
        named = F.when(value == code, F.lit(role)).otherwise(named)
    return named


_ENTRIES = "array<struct<key:string,person:string,role:string>>"


def _named(movies: DataFrame, column: str, role: str) -> Column:
    """Entries from a comma list of names; none where it is absent."""
    present = next((c for c in (f"omdb_{column}", column) if c in movies.columns), None)
    if present is None:
        return F.array().cast(_ENTRIES)
    names = F.filter(split_names(present), lambda x: x != "N/A")
    return F.transform(
        names, lambda x: F.struct(x.alias("key"), x.alias("person"), F.lit(role).alias("role"))
    )


def _listed(movies: DataFrame, column: str, kind: str, role) -> Column:
    """Entries from a serialized list; null where there is none."""
    return F.transform(
        F.from_json(field(movies, column), kind),
        lambda x: F.struct(
            F.coalesce(F.concat(F.lit("#"), x["id"].cast("string")), x["name"]).alias("key"),
            x["name"].alias("person"), role(x).alias("role"),
        ),
    ).cast(_ENTRIES)


def _cast_entries(movies: DataFrame, column: str, genders: dict[int, str]) -> Column:
    listed = _listed(movies, column, CAST_TYPE, lambda x: _role(x["gender"], genders, "actor"))
    return F.coalesce(listed, _named(movies, "actors", "actor"))


def _crew_entries(movies: DataFrame, column: str, jobs: dict[str, str]) -> Column:
    listed = _listed(movies, column, CREW_TYPE, lambda x: _role(x["job"], jobs, "crew"))
    names = F.concat(_named(movies, "director", "director"), _named(movies, "writer", "writer"))
    return F.coalesce(listed, names)


def _rows(movies: DataFrame, movie: str, keep: tuple[str, ...], entries: Column) -> DataFrame:
    return movies.select(movie, *keep, F.inline(entries)).filter(F.col("person").isNotNull())


def cast_credits(
    movies: DataFrame, movie: str = "tmdb_id", keep: tuple[str, ...] = (),
    cast: str = "cast_data", genders: dict[int, str] = GENDER_ROLES,
) -> DataFrame:
    """One row per movie and cast member. Without a serialized list the names of the comma
    list `actors` stand in; an entry of unknown gender has the role "actor"."""
    return _rows(movies, movie, keep, _cast_entries(movies, cast, genders))


def crew_credits(
    movies: DataFrame, movie: str = "tmdb_id", keep: tuple[str, ...] = (),
    crew: str = "crew_data", jobs: dict[str, str] = JOB_ROLES,
) -> DataFrame:
    """One row per movie, crew member and job. Without a serialized list the names of
    `director` and `writer` stand in; other jobs than the named ones are "crew"."""
    return _rows(movies, movie, keep, _crew_entries(movies, crew, jobs))


def director_credits(
    movies: DataFrame, movie: str = "tmdb_id", crew: str = "crew_data"
) -> DataFrame:
    """One row per movie and director: those of the crew, else those of the comma list."""
    listed = F.filter(
        _listed(movies, crew, CREW_TYPE, lambda x: _role(x["job"], JOB_ROLES, "crew")),
        lambda x: x["role"] == "director",
    )
    entries = F.when(F.size(listed) > 0, listed).otherwise(_named(movies, "director", "director"))
    return _rows(movies, movie, (), entries)


def credits(movies: DataFrame, movie: str = "tmdb_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """Cast and crew rows in one pass over the movies."""
    entries = F.concat(
        _cast_entries(movies, "cast_data", GENDER_ROLES),
        _crew_entries(movies, "crew_data", JOB_ROLES),
    )
    return _rows(movies, movie, keep, entries)


def appearances(credit_rows: DataFrame, movie: str) -> DataFrame:
    """Each person once per movie; credits without a movie connect nobody. Rows are distributed by
    movie, which serves what follows: the size of a movie, and a join on it."""
    rows = credit_rows.filter(F.col(movie).isNotNull()).select(movie, "key", "person").repartition(movie)
    return rows.groupBy(movie, "key").agg(F.min("person").alias("person"))


def top_people(
    credit_rows: DataFrame, k: int, rating: str, role: Column | None = None
) -> DataFrame:
    """People with most credits, and the mean rating of them."""
    rows = credit_rows if role is None else credit_rows.filter(role)
    return top(
        rows.groupBy("key").agg(
            F.min("person").alias("person"), F.count(F.lit(1)).alias("credits"),
            F.avg(rating).alias("avg_rating"),
        ), k, "credits", "person", "key",
    )


def person_ratings(credit_rows: DataFrame, rating: str, at_least: int = 1) -> DataFrame:
    """Mean rating of everyone with enough rated credits."""
    rated = credit_rows.groupBy("key").agg(
        F.min("person").alias("person"), F.avg(rating).alias("avg_rating"),
        F.count(rating).alias("credits"),
    )
    return rated.filter(F.col("credits") >= at_least)


def cast_summary(credit_rows: DataFrame, role: str = "role") -> DataFrame:
    """Distinct people and appearances per role. People are reduced to one row per role
    before they are counted, so no distinct count fans the rows out."""
    return (
        credit_rows.groupBy(role, "key").agg(F.count(F.lit(1)).alias("n"))
        .groupBy(role).agg(F.count(F.lit(1)).alias("people"), F.sum("n").alias("appearances"))
    )


def cast_totals(
    credit_rows: DataFrame, movie: str = "tmdb_id", role: str = "role"
) -> DataFrame:
    """The summary as one row of totals. Networks are counted as movies that connect at
    least two cast members."""
    cast = ("actor", "actress")
    # One reading of the credits answers both questions. A movie connects two people if the least
    # and the greatest of its cast differ; two hashes stand for a key, as numbers sort in place.
    in_cast = F.col(role).isin(*cast)
    marks = (F.xxhash64("key"), F.xxhash64(F.lit("second"), "key"))
    rows = credit_rows.select(
        movie, "key", role, *(F.when(in_cast, mark).alias(f"m{i}") for i, mark in enumerate(marks)))
    differ = (F.min("m0") != F.max("m0")) | (F.min("m1") != F.max("m1"))
    counted = rows.groupingSets([[role, "key"], [movie]], role, "key", movie).agg(
        F.grouping(movie).alias("by_role"), F.count(F.lit(1)).alias("n"), F.coalesce(differ, F.lit(False)).alias("connects"))
    by_role = F.col("by_role") == 1
    per_role = counted.groupBy(F.when(by_role, F.col(role)).otherwise("network").alias(role)).agg(
        F.count_if(by_role | F.col("connects")).alias("people"), F.sum(F.when(by_role, F.col("n"))).alias("appearances"))

    def of(value: str, *roles: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col(role).isin(*roles), F.col(value))), F.lit(0))

    return per_role.agg(
        *(of("people", name).alias(f"total_{name}{'es' if name == 'actress' else 's'}")
          for name in ROLES),
        of("appearances", *cast).alias("total_cast_appearances"),
        F.coalesce(
            F.sum(F.when(~F.col(role).isin(*cast, "network"), F.col("appearances"))), F.lit(0)
        ).alias("total_crew_appearances"),
        of("people", "network").alias("total_collaboration_networks"),
    )


def filmographies(credit_rows: DataFrame, movie: str, *columns: str) -> DataFrame:
    """Movies of each person: one row per credit, so that no person's list has to fit one row.
    Lists are gathered by person and sorted within their part; the rebalance divides a part
    that is too large."""
    listed = credit_rows.select("key", "person", *columns, movie).distinct()
    return listed.hint("rebalance", "key").sortWithinPartitions("key", *columns, movie)


def collaboration_strength(credit_rows: DataFrame, movie: str) -> DataFrame:
    """Per person: movies, and appearances of others next to theirs.

    This is each node's weighted degree in the network of people who share a movie, summed
    from the movies' sizes without listing a pair: the size of a movie is counted in the
    window over its distinct people, and the sums are shuffled by person.
    """
    people = F.count(F.lit(1)).over(Window.partitionBy(movie)) - 1
    # by name too, so that the large aggregate hashes; a person has few names
    by_name = appearances(credit_rows, movie).withColumn("others", people).groupBy("key", "person").agg(
        F.count(F.lit(1)).alias("movies"), F.sum("others").alias("shared"), F.max("others").alias("most"))
    return by_name.groupBy("key").agg(
        F.min("person").alias("person"), F.sum("movies").alias("movies"),
        F.sum("shared").alias("shared_appearances"), F.max("most").alias("most_partners"),
    )


def leader_network(credit_rows: DataFrame, movie: str, k: int = 10) -> DataFrame:
    """All partners of the k people with most movies, with the number of shared movies.

    The leaders' movies number at most k per movie, so the work stays within k times the
    credits; the partner side of a crowded movie is divided by the adaptive skew join.
    """
    seen = appearances(credit_rows, movie)
    films = seen.groupBy("key").agg(
        F.min("person").alias("leader"), F.count(F.lit(1)).alias("movies")
    )
    leaders = top(films, k, "movies", "leader", "key").select(F.col("key").alias("leader_key"), "leader")
    led = seen.select(movie, F.col("key").alias("leader_key")).join(leaders, "leader_key")
    return (
        led.join(seen, movie)
        .filter(F.col("leader_key") != F.col("key"))
        .groupBy("leader_key", "leader", "key")
        .agg(F.min("person").alias("partner"), F.count(F.lit(1)).alias("shared_movies"))
        .withColumnRenamed("key", "partner_key")
    )


def director_network(cast_rows: DataFrame, director_rows: DataFrame, movie: str) -> DataFrame:
    """Director and cast member pairs with the number of movies they share. Each movie has a
    few directors, so that the pairs are a small multiple of the credits. They are grouped by their
    two keys alone: one shuffle, of rows that map tasks have sorted and reduced."""
    directors = appearances(director_rows, movie).select(
        movie, F.col("key").alias("director_key"), F.col("person").alias("director")
    )
    pairs = appearances(cast_rows, movie).join(directors, movie)
    return pairs.groupBy("director_key", "key").agg(
        F.min("director").alias("director"), F.min("person").alias("person"), F.count(F.lit(1)).alias("shared_movies"),
    )
