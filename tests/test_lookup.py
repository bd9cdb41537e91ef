import random

import pytest
from pyspark.sql import functions as F

from marquee.operators import enrich
from marquee.operators.lookup import Lookup, lookup_join, one_per_key

FIELDS = {"critic_score": "score", "user_count": "users"}


def test_left_rows_are_kept_once(spark):
    left = spark.createDataFrame(
        [(1, "a"), (2, "a"), (3, ""), (4, None), (5, "z"), (6, "b")], "id int, key string"
    )
    right = spark.createDataFrame(
        [("a", 2), ("a", 1), ("", 7), (None, 8), ("b", None), ("b", 5)], "key string, value int"
    )
    got = {r.id: r.value for r in lookup_join(left, ["key"], Lookup(right)).collect()}
    assert got == {1: 1, 2: 1, 3: None, 4: None, 5: None, 6: None}
    assert {(r.key, r.value) for r in one_per_key(right, ["key"]).collect()} == {
        ("a", 1), ("", 7), (None, 8), ("b", None)
    }


def test_preference_and_gate(spark):
    left = spark.createDataFrame([(1, 10), (2, 20), (3, None)], "id int, key bigint")
    right = spark.createDataFrame(
        [(10, 2, 1.0), (10, 1, None), (20, 1, 5.0), (20, 0, 6.0)], "key bigint, rank int, score double"
    )
    rows = Lookup(right, {"score": "score"}, ("rank",), gate="score")
    got = {r.id: r.score for r in lookup_join(left, ["key"], rows).collect()}
    assert got == {1: None, 2: 6.0, 3: None}


def test_two_lookups_share_one_shuffle_of_the_left_side(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    left = spark.range(1000).withColumn("key", F.col("id") % 10)
    a = spark.range(10).select(F.col("id").alias("key"), (F.col("id") * 2).alias("double"))
    b = spark.range(5, 15).select(F.col("id").alias("key"), (F.col("id") * 3).alias("triple"))
    joined = lookup_join(left, ["key"], Lookup(a), Lookup(b))
    rows = joined.filter("id in (3, 7)").orderBy("id").collect()
    assert [(r.double, r.triple) for r in rows] == [(6, None), (14, 21)]
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 1


def test_names_taken_twice_are_refused(spark):
    left = spark.range(3).withColumn("value", F.lit(1))
    right = spark.range(3).withColumn("value", F.lit(2))
    with pytest.raises(ValueError):
        lookup_join(left, ["id"], Lookup(right))
    with pytest.raises(ValueError):
        lookup_join(spark.range(3), ["id"], Lookup(right, {"value": "v"}, gate="other"))


def test_a_frequent_key_is_split(spark, settings):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="50KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="50KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    )
    left = spark.range(0, 200_000, 1, 16).select(
        "id", F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("key")
    )
    right = left.select("key", F.length("key").alias("size"))
    joined = lookup_join(left, ["key"], Lookup(right))
    assert joined.agg(F.count("size"), F.count("id")).first()[:] == (200_000, 200_000)
    joined.write.format("noop").mode("overwrite").save()
    final = joined.select("id", "size")
    final.collect()
    assert "skew=true" in final._jdf.queryExecution().executedPlan().toString()


def test_rows_without_a_key_are_spread(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1",
             spark__sql__adaptive__coalescePartitions__enabled="false")
    left = spark.range(0, 8000, 1, 16).withColumn("key", F.lit(None).cast("string"))
    right = spark.createDataFrame([("a", 1)], "key string, value int")
    joined = lookup_join(left, ["key"], Lookup(right))
    sizes = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(sizes) > 3 and max(r["count"] for r in sizes) < 4000


def pages(seed, n, titled):
    random.seed(seed)
    rows = []
    for _ in range(n):
        base = random.choice(["a--b", "zed", "x_1990", "amelie", "zed_1991"])
        slug = base.replace("-", "_") if titled else base
        if titled and random.random() < 0.4:
            slug += f"_{random.randint(1988, 1996)}"
        rows.append((
            slug, random.choice(["A & B", "Zed", "Amélie", "Other", None]),
            random.choice([None, *range(1986, 1999)]), random.random() < 0.8,
            random.choice([None, 10.0, 55.5, 90.0]), random.randint(1, 5),
        ))
    return rows


PAGE = "slug string, title string, year int, has_scorecard boolean, critic_score double, user_count int"
TITLES = ["A & B", "Zed", "Amélie", "", None, "X 1990", "zed  1991"]
SLUGS = {"A & B": "a--b", "Zed": "zed", "Amélie": "amelie", "X 1990": "x-1990", "zed  1991": "zed-1991"}


def least(rows):
    """Best of (preference..., score, users); a missing score sorts first."""
    return min(rows, key=lambda r: (*r[:-2], r[-2] is not None, r[-2] or 0, r[-1]))


def test_title_year_against_brute_force(spark):
    rows = pages(1, 60, titled=False)
    movies = [(i, t, y) for i, (t, y) in enumerate((t, y) for t in TITLES for y in [None, 0, *range(1985, 2000)])]
    expected = {}
    for i, title, year in movies:
        near = [
            (abs(p[2] - year), p[2], p[4], p[5])
            for p in rows
            if title and year and p[2] is not None and p[0] == SLUGS[title] and abs(p[2] - year) <= 3
        ]
        best = least(near) if near else None
        expected[i] = best[-2:] if best and best[-2] is not None else (None, None)
    got = enrich.enrich_by_title_year(
        spark.createDataFrame(movies, "id int, title string, year int"),
        spark.createDataFrame(rows, PAGE).select("slug", "year", "critic_score", "user_count"), FIELDS,
    )
    assert {r.id: (r.score, r.users) for r in got.collect()} == expected
    assert any(score for score, _ in expected.values())


def test_candidates_against_brute_force(spark):
    rows = pages(2, 80, titled=True)
    movies = [(i, t, y) for i, (t, y) in enumerate((t, y) for t in TITLES for y in [None, *range(1985, 2000)])]
    reads = {"A & B": "a__b", "Zed": "zed", "Amélie": "amelie", "Other": "other", None: None}
    expected = {}
    for i, title, year in movies:
        found = []
        if title and year:
            slug = SLUGS[title].replace("-", "_")
            for p in rows:
                if not p[3] or p[2] is None or abs(p[2] - year) > 3:
                    continue
                for rank, hit in enumerate((p[0] == slug, p[0] == f"{slug}_{year}", reads[p[1]] == slug)):
                    if hit:
                        found.append((rank, abs(p[2] - year), p[2], p[4], p[5]))
        best = least(found) if found else None
        expected[i] = best[-2:] if best and best[-2] is not None else (None, None)
    got = enrich.enrich_by_candidates(
        spark.createDataFrame(movies, "id int, title string, year int"),
        spark.createDataFrame(rows, PAGE), FIELDS,
    )
    assert {r.id: (r.score, r.users) for r in got.collect()} == expected


def test_a_page_may_state_several_years(spark):
    movies = spark.createDataFrame([(1, "Zed", 1990), (2, "Zed", 2000), (3, "Zed", 2010)], "id int, title string, year int")
    rows = spark.createDataFrame([("zed", [1991, 2010], 70.0, 3)], "slug string, years array<int>, critic_score double, user_count int")
    got = enrich.enrich_by_candidates(movies, rows, FIELDS)
    assert {r.id: r.score for r in got.collect()} == {1: 70.0, 2: None, 3: 70.0}


def test_page_slug_with_the_other_mark_answers_no_title(spark):
    movies = spark.createDataFrame([(1, "A B", 1990)], "id int, title string, year int")
    rows = spark.createDataFrame([("a-b", 1990, 70.0, 3)], "slug string, year int, critic_score double, user_count int")
    assert enrich.enrich_by_candidates(movies, rows, FIELDS).first().score is None
    assert enrich.enrich_by_title_year(movies, rows, FIELDS).first().score == 70.0


def test_a_title_shared_by_most_movies_and_pages(spark, settings):
    """Half of both sides has one slug; the join stays within the movies and is split."""
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="50KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="50KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    )
    title = F.when(F.col("id") % 2 == 0, F.lit("Untitled")).otherwise(F.concat(F.lit("T "), "id"))
    movies = spark.range(0, 100_000, 1, 16).select("id", title.alias("title"), F.lit(1990).alias("year"))
    rows = spark.range(0, 50_000, 1, 8).select(
        F.lower(F.regexp_replace(title, " ", "-")).alias("slug"), (1980 + F.col("id") % 20).cast("int").alias("year"),
        F.col("id").cast("double").alias("critic_score"), F.lit(1).alias("user_count"),
    )
    got = enrich.enrich_by_title_year(movies, rows, FIELDS)
    result = got.filter("title = 'Untitled'").groupBy("score").count().collect()
    # The nearest year is the movies' own, and its least score is that of page 10.
    assert [tuple(r) for r in result] == [(10.0, 50_000)]
    counted = got.select("id", "score")
    assert len(counted.collect()) == 100_000
    assert "skew=true" in counted._jdf.queryExecution().executedPlan().toString()


def test_registered_sources_and_title_fallback(spark):
    movies = spark.createDataFrame(
        [(1, "tt1", "", None, "1990-05-01"), (2, "", "Zed", 1990, None)],
        "tmdb_id int, imdb_id string, title string, year int, release_date string",
    )
    omdb = spark.createDataFrame(
        [("tt1", "True", "Zed", "8.5", "1,234", "80"), ("tt2", "False", "No", "1", "1", "1")],
        "imdbID string, Response string, Title string, imdbRating string, imdbVotes string, Metascore string",
    )
    from marquee.operators.conform import conform
    from marquee.schemas import OMDB_RESPONSE

    critics = spark.createDataFrame(
        [("zed", 1992, 61.0, 1, 7.0, 2)],
        "slug string, year int, critic_score double, critic_count int, user_score double, user_count int",
    )
    got = enrich.enrich_all(movies, "now", conform(omdb, OMDB_RESPONSE), critics).orderBy("tmdb_id").collect()
    assert [r.omdb_imdb_votes for r in got] == [1234, None]
    assert [r.omdb_enhanced_at for r in got] == ["now", None]
    assert [r.metacritic_critic_score for r in got] == [61.0, 61.0]
    assert [r.metacritic_data_source for r in got] == ["metacritic", "metacritic"]
    with pytest.raises(ValueError):
        enrich.register_source(enrich.ScoreSource("x", "telepathy"))


def test_unique_lookup(spark, settings):
    left = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("", 4), ("a", 5), ("c", 6)], "key string, n int")
    right = spark.createDataFrame(
        [("a", 1.0, "x"), ("b", None, "y"), (None, 9.0, "z"), (None, 8.0, "z"), ("", 7.0, "z")], "key string, score double, plot string")
    found = lookup_join(left, ["key"], Lookup(right, gate="score", unique=True))
    plain = lookup_join(left, ["key"], Lookup(right, gate="score"))
    assert sorted(map(str, found.collect())) == sorted(map(str, plain.collect()))
    with pytest.raises(ValueError, match="repeats"):
        lookup_join(left, ["key"], Lookup(right.unionAll(right), unique=True))
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    plan = found.select("n", "score")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "Aggregate" not in plan
