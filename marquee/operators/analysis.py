"""Descriptive statistics of a film catalogue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .ranking import top, top_per_group


def rated(value: Column | str) -> Column:
    """A rating; one that is no number counts as none."""
    value = F.col(value) if isinstance(value, str) else value
    return F.when(~F.isnan(value.cast("double")), value)


def total(df: DataFrame, name: str = "total_movies") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def year_range(df: DataFrame, year: str = "year") -> DataFrame:
    return df.agg(
        F.min(year).alias("min"), F.max(year).alias("max"), F.avg(year).alias("avg")
    )


#: The middle ranks are looked for among the values between two approximate quantiles. Their ranks
#: are off by at most one in `ACCURACY`; the margin is ten times that.
ACCURACY, MARGIN = 100_000, 0.0001


def median(df: DataFrame, value: str) -> Column:
    """Exact median as a value that is found when the plan runs; the middle two are averaged.

    Two approximate quantiles bracket the middle. The values below are counted, those between them
    are counted by value, and cumulative counts tell where both middle ranks lie: one task sees a
    few thousandths of the distinct values at most, whatever the table holds.
    """
    v = F.col("v")
    values = df.select(rated(value).cast("double").alias("v")).filter(v.isNotNull())
    ends = values.agg(F.percentile_approx(v, [0.5 - MARGIN, 0.5 + MARGIN], ACCURACY)).scalar()
    low, high = F.get(ends, F.lit(0)), F.get(ends, F.lit(1))
    whole = values.agg(F.struct(F.count(F.lit(1)).alias("all"), F.count_if(v < low).alias("below"))).scalar()
    between = values.filter((v >= low) & (v <= high)).groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    last = whole["below"] + F.sum("n").over(Window.orderBy("v"))
    ranked = between.select("v", "n", last.alias("last"), whole["all"].alias("all")).withColumn("first", F.col("last") - F.col("n"))

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("first") <= rank) & (rank < F.col("last")), v))

    lower, upper = at(F.floor((F.col("all") - 1) / 2)), at(F.floor(F.col("all") / 2))
    return ranked.agg(((lower + upper) / 2).alias("median")).scalar()


def rating_stats(df: DataFrame, rating: str = "omdb_imdb_rating") -> DataFrame:
    """Mean, median, sample standard deviation and extremes."""
    value = rated(rating)
    return df.agg(
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    ).select("mean", median(df, rating).alias("median"), "std", "min", "max")


def split_names(text: Column | str, sep: str = ", ") -> Column:
    """The items of a comma list; none for an absent one."""
    text = F.col(text) if isinstance(text, str) else text
    items = F.split(text, sep)
    return F.filter(F.coalesce(items, F.array().cast("array<string>")), lambda x: x != "")


def category_counts(df: DataFrame, **sections: Column) -> DataFrame:
    """Rows per value for several categories at once: `section=array of values`.

    One scan and one pre-aggregated shuffle serve all categories.
    """
    def tagged(section: str, values: Column) -> Column:
        label = F.lit(section).alias("section")
        return F.transform(values, lambda value: F.struct(label, value.alias("value")))

    rows = F.concat(*(tagged(section, values) for section, values in sections.items()))
    return (
        df.select(F.inline(rows))
        .filter(F.col("value").isNotNull())
        .groupBy("section", "value")
        .agg(F.count(F.lit(1)).alias("movies"))
    )


def category_tops(df: DataFrame, k: int = 10, **sections: Column) -> DataFrame:
    """The k most frequent values of each category."""
    return top_per_group(category_counts(df, **sections), k, "section", "movies", "value")


def genre_distribution(df: DataFrame, genre: Column | str = "omdb_genre", k: int = 10) -> DataFrame:
    """Most frequent genres; a movie counts for each of its genres."""
    return category_tops(df, k, genre=split_names(genre)).select(
        F.col("value").alias("genre"), "movies"
    )


def value_counts(df: DataFrame, value: str, k: int = 10) -> DataFrame:
    """Most frequent whole values (directors, country lists); "N/A" is a value."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(value)
    return top(counts.agg(F.count(F.lit(1)).alias("movies")), k, "movies", value)


def top_movies(
    df: DataFrame, k: int = 10, rating: str = "omdb_imdb_rating",
    columns: tuple[str, ...] = ("title", "omdb_imdb_rating", "year"), tie: str = "tmdb_id",
) -> DataFrame:
    return top(df.filter(rated(rating).isNotNull()), k, rating, tie).select(*columns)


def mean_of_file_means(df: DataFrame, rating: str, file: str) -> DataFrame:
    """Unweighted mean of the files' mean ratings, and how many files have one."""
    means = df.groupBy(file).agg(F.avg(rated(rating)).alias("mean"))
    return means.agg(
        F.avg("mean").alias("average_rating"), F.count("mean").alias("total_ratings_analyzed")
    )


def file_totals(df: DataFrame, file: str) -> DataFrame:
    """Movies per input file: the processed-files list, one row each."""
    return df.groupBy(file).agg(F.count(F.lit(1)).alias("movies"))


def run_totals(df: DataFrame, file: str, failed: Column | None = None) -> DataFrame:
    """Files, movies, and whether no row of the run is `failed`."""
    bad = F.count_if(F.lit(False) if failed is None else failed)
    return df.groupBy(file).agg(F.count(F.lit(1)).alias("movies"), bad.alias("failed")).agg(
        F.count(F.lit(1)).alias("files_processed"),
        F.coalesce(F.sum("movies"), F.lit(0)).alias("total_movies"),
        (F.coalesce(F.sum("failed"), F.lit(0)) == 0).alias("success"),
    )


def coverage(df: DataFrame, **hits: Column) -> DataFrame:
    """Row total, and rows for which each condition holds."""
    return df.agg(
        F.count(F.lit(1)).alias("total_movies"),
        *(F.count_if(hit).alias(name) for name, hit in hits.items()),
    )


def enrichment_coverage(movies: DataFrame) -> DataFrame:
    """How many movies each source enriched."""
    held = {
        "omdb_enhanced": "omdb_title",
        "metacritic_enhanced": "metacritic_critic_score",
        "rotten_tomatoes_enhanced": "rt_critic_score",
    }
    return coverage(movies, **{
        name: (F.col(c).isNotNull() & (F.col(c).cast("string") != "")) if c in movies.columns
        else F.lit(False)
        for name, c in held.items()
    })


def performance(
    df: DataFrame, group: Column | str, rating: str, name: str = "value"
) -> DataFrame:
    """Movies, mean and best rating per group (genre, year)."""
    group = F.col(group) if isinstance(group, str) else group
    return df.groupBy(group.alias(name)).agg(
        F.count(F.lit(1)).alias("movies"),
        F.avg(rated(rating)).alias("avg_rating"),
        F.max(rated(rating)).alias("max_rating"),
    )


def genre_performance(df: DataFrame, genre: Column | str, rating: str) -> DataFrame:
    items = df.select(F.explode(split_names(genre)).alias("genre"), rating)
    return performance(items, "genre", rating, "genre")


def year_performance(df: DataFrame, year: Column | str, rating: str) -> DataFrame:
    return performance(df, year, rating, "year")
