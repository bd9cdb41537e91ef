"""Reports: of one set of movies, of several files, of cast and crew."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import people
from ..operators.analysis import category_tops, median, rated, split_names, top_movies


def categories(movies: DataFrame, k: int = 10) -> DataFrame:
    """Top genres, directors and countries in one pass. Genres are split; director and
    country texts count whole."""
    return category_tops(
        movies, k,
        genre_distribution=split_names("omdb_genre"),
        director_stats=F.array("omdb_director"),
        country_stats=F.array("omdb_country"),
    )


def analysis_report(movies: DataFrame, k: int = 10) -> dict:
    """The report as a nested object. Only its own lines reach the driver: single rows of
    totals and k rows per list. Totals, years and ratings are one aggregate."""
    tops = categories(movies, k).orderBy("section", "rank").collect()
    value = rated("omdb_imdb_rating")
    row = movies.agg(
        F.count(F.lit(1)).alias("total_movies"),
        F.struct(F.min("year").alias("min"), F.max("year").alias("max"), F.avg("year").alias("avg")).alias("year_range"),
        F.struct(
            F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.min(value).alias("min"),
            F.max(value).alias("max"),
        ).alias("rating_stats"),
    ).first().asDict(recursive=True)
    middle = movies.sparkSession.range(1).select(median(movies, "omdb_imdb_rating")).first()[0]
    ratings = row["rating_stats"]
    return {
        "total_movies": row["total_movies"],
        "year_range": row["year_range"],
        "rating_stats": {"mean": ratings["mean"], "median": middle, **{n: ratings[n] for n in ("std", "min", "max")}},
        "genre_distribution": _listed(tops, "genre_distribution"),
        "top_movies": [r.asDict() for r in top_movies(movies, k).collect()],
        "director_stats": _listed(tops, "director_stats"),
        "country_stats": _listed(tops, "country_stats"),
    }


def _listed(tops, section: str) -> dict:
    return {row["value"]: row["movies"] for row in tops if row["section"] == section}


def file_statistics(movies: DataFrame, file: str, rating: str = "omdb_imdb_rating") -> DataFrame:
    """One row per input file: movies, rated ones, and their mean, least and best rating."""
    value = rated(rating)
    return movies.groupBy(file).agg(
        F.count(F.lit(1)).alias("movies"), F.count(value).alias("rated"), F.avg(value).alias("avg_rating"),
        F.min(value).alias("min_rating"), F.max(value).alias("max_rating"),
    )


def summary_report(movies: DataFrame, file: str, rating: str = "omdb_imdb_rating") -> dict:
    """The summary of several files: their statistics and the mean of their means. One row per
    file reaches the driver."""
    files = [row.asDict() for row in file_statistics(movies, file, rating).orderBy(file).collect()]
    means = [row["avg_rating"] for row in files if row["avg_rating"] is not None]
    return {
        "files_processed": files,
        "total_movies": sum(row["movies"] for row in files),
        "average_rating": sum(means) / len(means) if means else None,
        "total_ratings_analyzed": len(means),
    }


def cast_report(movies: DataFrame, k: int = 10, rating: str = "omdb_imdb_rating", movie: str = "tmdb_id") -> dict:
    """Totals of cast and crew, and the people with most credits of each role."""
    rows = people.credits(movies, movie, keep=(rating,) if rating in movies.columns else ())
    if rating not in movies.columns:
        rows = rows.withColumn(rating, F.lit(None).cast("double"))
    report = people.cast_totals(rows, movie).first().asDict()
    for role in ("actor", "actress", "director", "writer"):
        best = people.top_people(rows, k, rating, F.col("role") == role).collect()
        report[f"top_{role}{'es' if role == 'actress' else 's'}"] = [row.asDict() for row in best]
    return report
