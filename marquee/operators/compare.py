"""Ratings of one movie across the sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


#: A key is heavy if it holds this share of a table, and more rows than this; so at most 1,000 are.
HEAVY_SHARE, HEAVY_ROWS = 0.001, 1_000
#: Parts into which the rows of a heavy key are dealt.
PARTS = 64


def left_join_evenly(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join in which a key that fills much of `right` is met by many tasks.

    The rows of a heavy key are dealt out by the partition that they come from, and the left rows
    of that key, and of no other, go to every part. They do have a match, in one part at least, so
    those without one there are left out.
    """
    size = right.agg(F.count(F.lit(1))).scalar()
    counts = right.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    limit = F.greatest(size * HEAVY_SHARE, F.lit(float(HEAVY_ROWS)))
    heavy = F.broadcast(counts.filter(F.col("_n") > limit).select("_key", F.lit(True).alias("_heavy")))  # 1,000 rows at most

    def marked(rows: DataFrame) -> DataFrame:
        return rows.join(heavy, F.col(key) == F.col("_key"), "left").drop("_key")

    dealt = F.when(F.col("_heavy"), F.pmod(F.spark_partition_id(), F.lit(PARTS))).otherwise(0)
    rows = marked(right).withColumn("_part", dealt).withColumn("_matched", F.lit(True)).drop("_heavy")
    everywhere = F.explode(F.sequence(F.lit(0), F.when(F.col("_heavy"), PARTS - 1).otherwise(0)))
    both = marked(left).withColumn("_part", everywhere).join(rows, [key, "_part"], "left")
    return both.filter(F.col("_heavy").isNull() | F.col("_matched").isNotNull()).drop("_part", "_heavy", "_matched")


def compare_sources(
    tmdb: DataFrame, omdb: DataFrame, metacritic: DataFrame, rotten_tomatoes: DataFrame,
    min_votes: int = 500,
) -> DataFrame:
    """The four tables side by side for movies with enough votes. As in SQL, a source with
    several rows for a movie repeats it. An empty id is none: it matches no row, and movies
    without one are spread by the partition they come from."""
    scores = ("tmdb_id", F.col("critic_score"))
    filled = F.coalesce(F.col("imdb_id") != "", F.lit(False))
    # No id starts with this character.
    spread = F.concat(F.lit("\0"), F.spark_partition_id().cast("string"))
    movies = tmdb.filter(F.col("vote_count") > min_votes).select(
        "tmdb_id", F.when(filled, F.col("imdb_id")).otherwise(spread).alias("imdb_id"), "title",
        F.col("vote_average").alias("tmdb_rating"))
    both = left_join_evenly(movies, omdb.filter(filled).select("imdb_id", "imdb_rating"), "imdb_id")
    both = left_join_evenly(both, metacritic.select(scores[0], scores[1].alias("metacritic_score")), "tmdb_id")
    return left_join_evenly(both, rotten_tomatoes.select(scores[0], scores[1].alias("rt_score")), "tmdb_id").select(
        "title", "tmdb_rating", "imdb_rating", "metacritic_score", "rt_score")


# The top of each source's scale.
SCALES = {"tmdb_rating": 10, "imdb_rating": 10, "metacritic_score": 100, "rt_score": 100}


def _pairs() -> list[tuple[str, str]]:
    names = list(SCALES)
    return [(a, b) for i, a in enumerate(names) for b in names[i + 1:]]


def rescale(compared: DataFrame) -> DataFrame:
    """All ratings on 0 to 100, as doubles."""
    return compared.withColumns(
        {name: F.col(name).cast("double") * (100 / scale) for name, scale in SCALES.items()}
    )


def rating_differences(compared: DataFrame) -> DataFrame:
    """Difference between each two sources, per movie."""
    return rescale(compared).select(
        "title", *((F.col(a) - F.col(b)).alias(f"{a}_vs_{b}") for a, b in _pairs())
    )


def correlation(a: str, b: str) -> Column:
    """Pearson's coefficient over rows with both values; null where one does not vary,
    which the built-in function takes for a division error."""
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    spread = F.stddev_pop(F.when(both, F.col(a))) * F.stddev_pop(F.when(both, F.col(b)))
    return F.try_divide(F.covar_pop(a, b), spread)


def source_agreement(compared: DataFrame) -> DataFrame:
    """Per pair of sources: movies both rate, mean difference and correlation."""
    measures = []
    for a, b in _pairs():
        both = F.col(a).isNotNull() & F.col(b).isNotNull()
        measures.append(F.struct(
            F.lit(a).alias("source_a"), F.lit(b).alias("source_b"),
            F.count_if(both).alias("movies"),
            F.avg(F.col(a) - F.col(b)).alias("mean_difference"),
            correlation(a, b).alias("correlation"),
        ))
    return rescale(compared).agg(F.array(*measures).alias("pairs")).select(F.inline("pairs"))
