import json
import uuid

import pytest

from marquee.operators.conform import conform
from marquee.plans.ingest import comprehensive_ingest, single_source_ingest
from marquee.schemas import OMDB_RESPONSE
from marquee.sources import tables

RUN = ("2025-08-21T12:58:04", "20250821_125804")


@pytest.fixture
def world(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "tmdb_a.json").write_text(json.dumps([
        {"id": 1, "imdb_id": "tt1", "title": "Zed", "release_date": "1990-01-01", "vote_count": 900, "vote_average": 8.1},
        {"id": 2, "imdb_id": "", "title": "Amélie", "release_date": "2001-04-25", "vote_count": 5},
        {"id": 3, "imdb_id": "tt3", "title": "", "year": 2010},
    ]))
    (raw / "tmdb_b.json").write_text(json.dumps([{"id": 4, "imdb_id": "tt9", "title": "None"}]))
    omdb = conform(spark.createDataFrame(
        [("tt1", "True", "Zed", "Drama, Crime", "8.5", "1,234"), ("tt3", "True", "Third", "N/A", "N/A", "N/A")],
        "imdbID string, Response string, Title string, Genre string, imdbRating string, imdbVotes string",
    ), OMDB_RESPONSE)
    critics = spark.createDataFrame(
        [("zed", 1991, 70.0, 1, 7.0, 2), ("third", 2012, 50.0, 1, 7.0, 2), ("amelie", 1990, 90.0, 1, 7.0, 2)],
        "slug string, year int, critic_score double, critic_count int, user_score double, user_count int",
    )
    tomatoes = spark.createDataFrame(
        [("amelie_2001", "x", 2001, True, 89.0, 4, 95.0, "1k+")],
        "slug string, title string, year int, has_scorecard boolean, critic_score double, critic_count int, "
        "user_score double, user_count string",
    )
    database = f"i{uuid.uuid4().hex[:10]}"
    tables.create_all_tables(spark, database)
    return raw, str(tmp_path / "out"), omdb, critics, tomatoes, database


def test_comprehensive(spark, world):
    raw, out, omdb, critics, tomatoes, database = world
    result = comprehensive_ingest(
        spark, str(raw), out, *RUN, omdb=omdb, metacritic=critics, rotten_tomatoes=tomatoes, database=database
    )
    assert result.success and all(t.ok for t in result.tables.values())
    assert {tuple(r) for r in result.inserted.collect()} == {
        ("tmdb_movies", 4, None), ("omdb_movies", 4, None), ("metacritic_ratings", 2, None), ("rotten_tomatoes_ratings", 1, None)}
    written = result.output_files.collect()
    assert sum(r.movies for r in written) == 4 and all("output=comprehensive_enhanced_tmdb_" in r.path for r in written)
    assert result.totals.first()[:] == (2, 4, True)
    assert result.statistics.first()[:] == (4, 2, 2, 1)
    assert result.errors.first()[:] == (4, 2)
    counts = {r.table_name: r.row_count for r in tables.table_rows(spark, database).collect()}
    assert counts == {"tmdb_movies": 4, "omdb_movies": 4, "metacritic_ratings": 2, "rotten_tomatoes_ratings": 1}
    years = {r.tmdb_id: r.year for r in tables.read_table(spark, "tmdb_movies", database).collect()}
    assert years == {1: 1990, 2: 2001, 3: 2010, 4: None}
    saved = spark.read.json(f"{out}/files")
    assert saved.count() == 4
    assert {r.output for r in saved.select("output").distinct().collect()} == {
        "comprehensive_enhanced_tmdb_a_20250821_125804", "comprehensive_enhanced_tmdb_b_20250821_125804"
    }


def test_comprehensive_goes_on_after_malformed_input(spark, world):
    raw, out, omdb, critics, tomatoes, database = world
    (raw / "tmdb_c.json").write_text('[{"id": 5')
    result = comprehensive_ingest(spark, str(raw), out, *RUN, omdb=omdb, database=database)
    assert not result.success and result.malformed.count() == 1
    assert result.totals.first()[:] == (2, 4, False)
    assert all(t.ok for t in result.tables.values())


@pytest.mark.parametrize("left_out", ["omdb", "metacritic", "rotten_tomatoes", "all"])
def test_every_stage_is_optional(spark, world, left_out):
    raw, out, omdb, critics, tomatoes, database = world
    sources = {"omdb": omdb, "metacritic": critics, "rotten_tomatoes": tomatoes}
    used = {n: s for n, s in sources.items() if n != left_out and left_out != "all"}
    result = comprehensive_ingest(spark, str(raw), out, *RUN, database=database, **used)
    assert result.success and result.errors.first().total == 4
    assert {r.table_name: r.rows for r in result.inserted.collect()}["tmdb_movies"] == 4


def test_a_failed_table_is_told(spark, world):
    raw, out, omdb, _, _, database = world
    spark.sql(f"DROP TABLE {database}.omdb_movies")
    result = comprehensive_ingest(spark, str(raw), out, *RUN, omdb=omdb, database=database)
    assert not result.success and not result.totals.first().success
    assert "omdb_movies" in {r.table_name: r.error for r in result.inserted.collect()}["omdb_movies"]


def test_limit_is_per_file(spark, world):
    raw, out, omdb, critics, tomatoes, database = world
    result = comprehensive_ingest(spark, str(raw), out, *RUN, omdb=omdb, max_movies=1, database=database)
    assert sorted(r.id for r in result.movies.collect()) == [1, 4]
    assert {r.source_file.rsplit("/", 1)[1]: r.movies for r in result.files.collect()} == {"tmdb_a.json": 1, "tmdb_b.json": 1}


def test_single_source(spark, world):
    raw, out, omdb, _, _, database = world
    result = single_source_ingest(spark, str(raw), out, *RUN, omdb, database=database)
    assert result.success and [(n, t.rows) for n, t in result.tables.items()] == [("omdb_movies", 4)]
    rows = {r.imdb_id: r for r in tables.read_table(spark, "omdb_movies", database).collect()}
    assert len(rows) == 4
    assert (rows["tt1"].year, rows["tt1"].genre, rows["tt1"].imdb_votes, rows["tt1"].data_source) == (1990, "Drama, Crime", 1234, "tmdb")
    assert rows["tt3"].year is None and rows["tt9"].omdb_title is None


def test_single_source_stops_at_malformed_input(spark, world):
    raw, out, omdb, _, _, database = world
    (raw / "tmdb_c.json").write_text('[{"id": 5')
    with pytest.raises(Exception):
        single_source_ingest(spark, str(raw), out, *RUN, omdb, database=database)


def test_single_source_strict_records(spark, world):
    raw, out, omdb, _, _, database = world
    with pytest.raises(Exception, match="Missing required field"):
        single_source_ingest(spark, str(raw), out, *RUN, omdb, database=database, strict_records=True)
