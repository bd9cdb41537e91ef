import json
import random
import statistics

import pytest
from pyspark.sql import functions as F

from marquee.operators import analysis, ranking
from marquee.plans.report import analysis_report, cast_report, summary_report

# Published rows of the ten-film set; the five-film set is rows 1, 2, 4, 5, 6.
TEN = [
    ("The Shawshank Redemption", 9.3, 1994), ("The Godfather", 9.2, 1972), ("The Dark Knight", 9.1, 2008),
    ("The Godfather Part II", 9.0, 1974), ("Schindler's List", 9.0, 1993), ("12 Angry Men", 9.0, 1957),
    ("Spirited Away", 8.6, 2001), ("The Green Mile", 8.6, 1999), ("Parasite", 8.5, 2019),
    ("Dilwale Dulhania Le Jayenge", 8.0, 1995),
]
FIVE = [TEN[i] for i in (0, 1, 3, 4, 5)]
SCHEMA = "tmdb_id int, title string, omdb_imdb_rating double, year int"


def films(spark, rows):
    return spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], SCHEMA)


@pytest.mark.parametrize("rows, years, stats", [
    (TEN, (1957, 2019, 1991.2), (8.83, 9.0, 0.39735234853828266, 8.0, 9.3)),
    (FIVE, (1957, 1994, 1978.0), (9.1, 9.0, 0.14142135623730961, 9.0, 9.3)),
])
def test_published_statistics(spark, rows, years, stats):
    df = films(spark, rows)
    assert analysis.total(df).first().total_movies == len(rows)
    assert analysis.year_range(df).first()[:] == pytest.approx(years, abs=1e-9)
    assert analysis.rating_stats(df).first()[:] == pytest.approx(stats, abs=1e-9)


def test_published_top_movies(spark):
    shuffled = films(spark, TEN).orderBy(F.rand(3))
    assert [tuple(r) for r in analysis.top_movies(shuffled, 10).collect()] == TEN


def test_mean_of_file_means(spark):
    means = {"a": [8.226], "b": [8.412], "c": [8.83], "d": [9.0, 9.2], "e": [9.1], "f": [None]}
    rows = [(f, v) for f, values in means.items() for v in values]
    df = spark.createDataFrame(rows, "file string, rating double")
    row = analysis.mean_of_file_means(df, "rating", "file").first()
    assert row.average_rating == pytest.approx(8.7336, abs=1e-9)
    assert row.total_ratings_analyzed == 5


def test_even_median_and_empty(spark):
    df = spark.createDataFrame([(4.0,), (1.0,), (3.0,), (2.0,), (None,)], "r double")
    assert analysis.rating_stats(df, "r").first().median == 2.5
    assert analysis.rating_stats(df.filter("r > 9"), "r").first()[:] == (None,) * 5


@pytest.mark.parametrize("kind", ["spread", "ties", "constant", "two blocks"])
def test_median_of_many_values(spark, kind):
    random.seed(kind)
    for n in (1000, 1001):
        values = {
            "spread": [random.gauss(0, 1) for _ in range(n)],
            "ties": [random.choice([8.1, 8.2, 8.3]) for _ in range(n)],
            "constant": [7.0] * n,
            "two blocks": [1.0] * (n // 2) + [2.0] * (n - n // 2),
        }[kind]
        random.shuffle(values)
        df = spark.createDataFrame([(v,) for v in values], "r double")
        assert df.select(analysis.median(df, "r")).first()[0] == statistics.median(values)


def test_median_reads_its_input_once(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    df = spark.range(5_000).selectExpr("cast(id % 77 as double) as r").mapInArrow(counted, "r double")
    assert df.select(analysis.median(df, "r")).first()[0] == 38
    # one job counts the values; the check itself reads its rows once more
    assert read.value <= 3 * 5_000


def test_a_rating_that_is_no_number_is_none(spark):
    df = films(spark, [("A", float("nan"), 1990), ("B", 8.0, 1991), ("C", 6.0, 1992)])
    assert analysis.rating_stats(df).first()[:] == (7.0, 7.0, 2**0.5, 6.0, 8.0)
    assert [r.title for r in analysis.top_movies(df).collect()] == ["B", "C"]
    assert analysis.year_performance(df, "year", "omdb_imdb_rating").filter("year = 1990").first()[1:] == (1, None, None)


def test_categories_count_each_section_apart(spark):
    rows = [("Drama, Crime", "A, B", "N/A"), ("Drama", "A, B", "Japan, United States"), (None, None, "N/A"), ("", "C", None)]
    df = spark.createDataFrame(rows, "genre string, director string, country string")
    counts = analysis.category_counts(
        df, genre=analysis.split_names("genre"), director=F.array("director"), country=F.array("country")
    )
    assert {tuple(r) for r in counts.collect()} == {
        ("genre", "Drama", 2), ("genre", "Crime", 1), ("director", "A, B", 2), ("director", "C", 1),
        ("country", "N/A", 2), ("country", "Japan, United States", 1),
    }
    tops = analysis.category_tops(df, 1, genre=analysis.split_names("genre"), country=F.array("country"))
    assert {(r.section, r.value) for r in tops.collect()} == {("genre", "Drama"), ("country", "N/A")}


def test_report_shape(spark):
    df = films(spark, TEN).withColumns({
        "omdb_genre": F.lit("Drama, Crime"), "omdb_director": F.lit("X"), "omdb_country": F.lit("N/A")
    })
    report = analysis_report(df)
    assert list(report) == [
        "total_movies", "year_range", "rating_stats", "genre_distribution", "top_movies",
        "director_stats", "country_stats",
    ]
    assert report["genre_distribution"] == {"Crime": 10, "Drama": 10}
    assert report["top_movies"][0] == {"title": TEN[0][0], "omdb_imdb_rating": 9.3, "year": 1994}
    assert report["country_stats"] == {"N/A": 10}
    json.dumps(report)


def test_summary_of_files(spark):
    df = films(spark, TEN).withColumn("file", F.when(F.col("year") < 1980, "old").otherwise("new"))
    report = summary_report(df.unionByName(df.limit(1).withColumns({"file": F.lit("none"), "omdb_imdb_rating": F.lit(None).cast("double")})), "file")
    assert [(f["file"], f["movies"], f["rated"]) for f in report["files_processed"]] == [("new", 7, 7), ("none", 1, 0), ("old", 3, 3)]
    assert report["total_movies"] == 11 and report["total_ratings_analyzed"] == 2
    old, new = [9.2, 9.0, 9.0], [9.3, 9.1, 9.0, 8.6, 8.6, 8.5, 8.0]
    assert report["average_rating"] == pytest.approx((sum(old) / 3 + sum(new) / 7) / 2)


def test_cast_report(spark):
    cast = json.dumps([{"id": 1, "name": "A", "gender": 2}, {"id": 2, "name": "B", "gender": 1}])
    crew = json.dumps([{"id": 3, "name": "D", "job": "Director"}])
    df = spark.createDataFrame([(1, cast, crew, 8.0), (2, cast, crew, 6.0)], "tmdb_id int, cast_data string, crew_data string, omdb_imdb_rating double")
    report = cast_report(df)
    assert report["total_actors"] == 1 and report["total_collaboration_networks"] == 2
    assert report["top_directors"] == [{"key": "#3", "person": "D", "credits": 2, "avg_rating": 7.0}]
    assert report["top_writers"] == []
    assert cast_report(df.drop("omdb_imdb_rating"))["top_actors"][0]["avg_rating"] is None


def test_totals_and_coverage(spark):
    df = spark.createDataFrame(
        [("a", "T", 5.0, None), ("a", "", None, 3.0), ("b", None, None, None)],
        "file string, omdb_title string, metacritic_critic_score double, rt_critic_score double",
    )
    assert analysis.run_totals(df, "file").first()[:] == (2, 3, True)
    assert analysis.enrichment_coverage(df).first()[:] == (3, 1, 1, 1)
    assert analysis.enrichment_coverage(df.drop("rt_critic_score")).first()[:] == (3, 1, 1, 0)


def test_performance(spark):
    df = spark.createDataFrame([("Drama, Crime", 8.0, 1990), ("Drama", 6.0, 1991), (None, 1.0, 1990)], "g string, r double, y int")
    by_genre = {tuple(r) for r in analysis.genre_performance(df, "g", "r").collect()}
    assert by_genre == {("Drama", 2, 7.0, 8.0), ("Crime", 1, 8.0, 8.0)}
    by_year = {tuple(r) for r in analysis.year_performance(df, "y", "r").collect()}
    assert by_year == {(1990, 2, 4.5, 8.0), (1991, 1, 6.0, 6.0)}


def test_sort_is_total_and_counts_missing_as_zero(spark):
    df = spark.createDataFrame([(3, 5.0), (1, None), (2, 0.0), (4, 5.0), (5, 9.0)], "tmdb_id int, omdb_imdb_rating double")
    assert [r.tmdb_id for r in ranking.sort_by_rating(df).collect()] == [5, 3, 4, 1, 2]
    assert [r.tmdb_id for r in ranking.sort_by_rating(df, descending=False).collect()] == [1, 2, 3, 4, 5]


@pytest.mark.parametrize("n", [1, 7, 200, 5000])
def test_first_per_group_keeps_the_first(spark, n):
    df = spark.range(3000).select(
        (F.col("id") * 37 % 3000).alias("ordinal"), F.when(F.col("id") % 3 == 0, "small").otherwise("large").alias("file")
    )
    kept = ranking.first_per_group(df, n, "file", "ordinal").collect()
    for name in ("small", "large"):
        every = sorted(r.ordinal for r in df.filter(F.col("file") == name).collect())
        assert sorted(r.ordinal for r in kept if r.file == name) == every[:n]
    assert ranking.first_per_group(df, 0, "file", "ordinal").count() == 3000
    assert ranking.first_per_group(df, None, "file", "ordinal").count() == 3000


@pytest.mark.parametrize("n", [1, 40, 1_000, 2_500, 9_000])
def test_first_of_files_over_blocks(spark, n):
    """Blocks of 100 rows; only that which is cut is ranked."""
    df = spark.range(3_000).selectExpr(
        "id", "IF(id % 3 = 0, 'small', 'large') AS source_file",
        "named_struct('block', (id * 37 % 3000) div 100 * 1000, 'row', id * 37 % 3000) AS ordinal")
    kept = ranking.first_of_files(df, n)
    assert kept.columns == df.columns
    for name in ("small", "large"):
        every = sorted(r.id * 37 % 3000 for r in df.collect() if r.source_file == name)
        assert sorted(r.id * 37 % 3000 for r in kept.collect() if r.source_file == name) == every[:n]
    assert ranking.first_of_files(df, None).count() == ranking.first_of_files(df, 0).count() == 3_000


def test_concat_keeps_duplicates_and_fills_columns(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x")], "id int, a string")
    b = spark.createDataFrame([(1, "y")], "id int, b string")
    assert sorted(map(str, ranking.concat_all(a, b).collect())) == sorted([
        "Row(id=1, a='x', b=None)", "Row(id=1, a='x', b=None)", "Row(id=1, a=None, b='y')"
    ])
