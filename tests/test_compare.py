import pytest
from pyspark.sql import functions as F

from marquee.operators import compare


def tables(spark):
    tmdb = spark.createDataFrame(
        [(1, "tt1", "A", 8.0, 900), (2, "tt2", "B", 6.0, 501), (3, "", "C", 5.0, 500), (4, None, "D", 7.0, 999)],
        "tmdb_id int, imdb_id string, title string, vote_average double, vote_count int",
    )
    omdb = spark.createDataFrame([("tt1", 8.5), ("tt2", 6.1), ("", 1.0), (None, 2.0)], "imdb_id string, imdb_rating double")
    critics = spark.createDataFrame([(1, 80.0), (1, 81.0), (4, 50.0)], "tmdb_id int, critic_score double")
    tomatoes = spark.createDataFrame([(2, 70.0)], "tmdb_id int, critic_score double")
    return tmdb, omdb, critics, tomatoes


def test_four_sources_side_by_side(spark):
    rows = compare.compare_sources(*tables(spark)).collect()
    assert sorted(map(tuple, rows), key=str) == sorted([
        ("A", 8.0, 8.5, 80.0, None), ("A", 8.0, 8.5, 81.0, None),
        ("B", 6.0, 6.1, None, 70.0), ("D", 7.0, None, 50.0, None),
    ], key=str)


def test_differences_and_agreement(spark):
    compared = compare.compare_sources(*tables(spark))
    b = compare.rating_differences(compared).filter("title = 'B'").first()
    assert b.tmdb_rating_vs_imdb_rating == pytest.approx(-1.0)
    assert b.imdb_rating_vs_rt_score == pytest.approx(-9.0)
    assert b.metacritic_score_vs_rt_score is None
    pairs = {(r.source_a, r.source_b): r for r in compare.source_agreement(compared).collect()}
    assert len(pairs) == 6
    both = pairs["tmdb_rating", "imdb_rating"]
    assert both.movies == 3 and both.correlation == pytest.approx(1.0)
    assert both.mean_difference == pytest.approx((-5 - 5 - 1) / 3)
    assert pairs["metacritic_score", "rt_score"][2:] == (0, None, None)
    # One common movie does not vary.
    assert pairs["tmdb_rating", "rt_score"].movies == 1
    assert pairs["tmdb_rating", "rt_score"].correlation is None


def test_a_hot_movie_is_met_by_many_tasks(spark, settings):
    """One movie has a third of all scores, and no session option is set for it."""
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    left = spark.range(2_000).selectExpr("CAST(id AS INT) AS tmdb_id", "concat('t', id) AS title")
    scores = spark.range(0, 30_000, 1, 16).selectExpr(
        "CAST(IF(id % 3 = 0, 7, id % 1999) AS INT) AS tmdb_id", "CAST(id AS DOUBLE) AS score")
    joined = compare.left_join_evenly(left, scores, "tmdb_id")
    assert joined.columns == ["tmdb_id", "title", "score"]
    assert sorted(map(tuple, joined.collect()), key=str) == sorted(
        map(tuple, left.join(scores, "tmdb_id", "left").select("tmdb_id", "title", "score").collect()), key=str)
    settings(spark__sql__adaptive__coalescePartitions__enabled="false", spark__sql__shuffle__partitions="40")
    tasks = joined.groupBy(F.spark_partition_id().alias("p")).count().orderBy(F.desc("count")).collect()
    assert tasks[0]["count"] < 0.2 * 30_001 and sum(r["count"] for r in tasks) == joined.count()


def test_keys_without_a_value_and_empty_tables(spark):
    left = spark.createDataFrame([(None, "a"), (1, "b"), (1, "b")], "k int, t string")
    right = spark.createDataFrame([(None, 1.0), (1, 2.0), (2, 3.0)], "k int, s double")
    rows = [(None, "a", None), (1, "b", 2.0), (1, "b", 2.0)]
    assert sorted(map(tuple, compare.left_join_evenly(left, right, "k").collect()), key=str) == sorted(rows, key=str)
    assert compare.left_join_evenly(left, right.limit(0), "k").count() == 3
