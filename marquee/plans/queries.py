"""One registered query per operator, over whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import (
    file_stamp,
    first_integer,
    parenthesized_year,
    parse_metascore,
    parse_percent,
    parse_rating,
    parse_votes,
    ratings_json,
    strip_word,
    title_slug,
    truncate_or_null,
    truncate_text,
    year_from_date,
    year_in_text,
)
from ..operators import analysis, compare, conform, enrich, people, quality, ranking
from ..schemas import TABLES
from ..sources import files, pages, tables
from . import standins
from .report import categories, file_statistics as statistics_by_file
from .standins import RUN_AT, RUN_STAMP, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, digits) for name in names})


def _doubles(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("double") for name in names})


def _plain(df: DataFrame) -> DataFrame:
    """All columns: decimals as doubles, lists of values as text, lists of records as JSON."""
    def shown(name: str, kind: str):
        if kind.startswith("decimal"):
            return F.col(name).cast("double")
        if kind.startswith("array<struct"):
            return F.to_json(name)
        if kind.startswith("array"):
            return F.array_join(F.col(name).cast("array<string>"), "|")
        return F.col(name)

    return df.select(*(shown(name, kind).alias(name) for name, kind in df.dtypes))


def _moment(name: str):
    """A time as text, as files without time zones hold it."""
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss")


# Scans, sources and sinks


EVENT_FIELDS = (
    ("event_id", "bigint"), ("user_id", "bigint"), ("moment", "string"), ("event_type", "string"),
    ("value", "double"), ("props", "string"),
)


def _events(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("moment", _moment("ts")).drop("ts")


def _read_back(events: DataFrame) -> DataFrame:
    return events.withColumn("k", F.from_json("props", "k int")["k"]).drop("props")


@query
def json_round_trip(spark, sf_dir):
    folder = files.shared_dir(spark, "events")
    _events(spark, sf_dir).write.json(folder)
    return _read_back(files.read_movie_files(spark, folder, "part-*", EVENT_FIELDS, lines=True))


def _array_files(spark, sf_dir, cut: bool) -> str:
    """A JSON array file for each 500 events; with `cut`, each third one lacks its end."""
    folder = files.shared_dir(spark, "arrays")
    part = F.floor(F.col("event_id") / 500)
    records = F.concat(F.lit("["), F.array_join(F.collect_list(F.to_json(F.struct(*(n for n, _ in EVENT_FIELDS)))), ","))
    end = F.when((F.col("part") % 3 == 0) & F.lit(cut), F.lit("")).otherwise(F.lit("]"))
    arrays = _events(spark, sf_dir).groupBy(part.alias("part")).agg(records.alias("value"))
    arrays.select("part", F.concat("value", end).alias("value")).write.partitionBy("part").text(folder)
    return folder


@query
def array_files(spark, sf_dir):
    folder = _array_files(spark, sf_dir, cut=False)
    return _read_back(files.read_movie_files(spark, folder, "part=*/part-*", EVENT_FIELDS))


@query
def malformed_array_files(spark, sf_dir):
    folder, staged = _array_files(spark, sf_dir, cut=True), files.shared_dir(spark, "staged")
    files.read_movie_files(spark, folder, "part=*/part-*", EVENT_FIELDS, strict=False).write.parquet(staged)
    good, bad = files.split_malformed(spark.read.parquet(staged))
    return good.agg(
        F.lit("parsed").alias("kind"), F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids")
    ).unionByName(bad.agg(
        F.lit("malformed").alias("kind"), F.count(F.lit(1)).alias("n"), F.lit(None).cast("bigint").alias("ids")
    ))


@query
def split_array_files(spark, sf_dir):
    """Array files read in ranges of a few kilobytes."""
    folder = _array_files(spark, sf_dir, cut=False)
    return _read_back(files.read_records(
        spark, folder, "part=*/part-*", EVENT_FIELDS, keep_raw=False, range_bytes=1 << 14).drop("source_file", "ordinal"))


@query
def malformed_records(spark, sf_dir):
    """Of an array that is cut off, only the last record is malformed: events by file and kind."""
    folder, staged = _array_files(spark, sf_dir, cut=True), files.shared_dir(spark, "staged")
    files.read_records(
        spark, folder, "part=*/part-*", EVENT_FIELDS, strict=False, range_bytes=1 << 14).write.parquet(staged)
    good, bad = files.split_malformed(spark.read.parquet(staged))
    cut = bad.select(F.from_json(files.CORRUPT, "event_id bigint")["event_id"].alias("event_id"), F.lit(1).alias("cut"))
    both = good.select("event_id", F.lit(0).alias("cut")).unionByName(cut)
    return both.groupBy(F.floor(F.col("event_id") / 500).alias("part")).agg(
        F.sum(1 - F.col("cut")).alias("parsed"), F.sum("cut").alias("malformed"), F.sum("event_id").alias("ids"))


@query
def scan_table(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return ranking.first_rows(orders, 10, "o_orderkey").withColumn("o_orderdate", _moment("o_orderdate"))


@query
def snapshot_records(spark, sf_dir):
    folder = files.shared_dir(spark, "snapshot")
    standins.omdb(spark, sf_dir).write.json(folder)
    return _plain(conform.omdb_fields(files.read_snapshot(spark, folder)))


@query
def page_fields(spark, sf_dir):
    return pages.extract(table(spark, sf_dir, "pages"), [
        pages.Rule("lang", (pages.Step("html"),), attribute="lang"),
        pages.Rule("title", (pages.Step("title"),)),
        pages.Rule("first_link", (pages.Step("nav"), pages.Step("a")), attribute="href"),
        pages.Rule("tracked", (pages.Step("script"),), pattern=r"track\(([0-9]+)\)", kind="int"),
    ])


@query
def metacritic_pages(spark, sf_dir):
    crawled = standins.metacritic_html(spark, sf_dir)
    return pages.extract_metacritic(crawled).select(
        "page_id", pages.slug_of_url("url", "movie").alias("slug"), "year",
        "critic_score", "critic_count", "user_score", "user_count",
    )


@query
def rotten_tomatoes_pages(spark, sf_dir):
    crawled = standins.rotten_tomatoes_html(spark, sf_dir)
    return pages.extract_rotten_tomatoes(crawled).select(
        "page_id", pages.slug_of_url("url", "m").alias("slug"),
        F.array_join("years", "|").alias("years"), "has_scorecard",
        "critic_score", "critic_count", "user_score", "user_count",
    )


def _sunk_events(spark, sf_dir) -> str:
    folder = files.shared_dir(spark, "enhanced")
    origin = F.concat(F.lit("/raw/"), "event_type", F.lit(".json"))
    return files.write_enhanced(_events(spark, sf_dir).withColumn("source_file", origin), folder, RUN_STAMP)


@query
def enhanced_files(spark, sf_dir):
    kinds = ", ".join(f"{name} {kind}" for name, kind in (*EVENT_FIELDS, ("output", "string")))
    return spark.read.schema(kinds).json(_sunk_events(spark, sf_dir))


@query
def enhanced_raw_keys(spark, sf_dir):
    """Events as records with keys that no typed field has: these come back beside the fields."""
    folder, out = files.shared_dir(spark, "raw"), files.shared_dir(spark, "enhanced")
    kept = F.struct("event_id", "event_type", "moment", F.struct(
        "value", F.array("user_id", F.col("event_id") * 2).alias("ids")).alias("extra"), F.col("props").alias("note"))
    _events(spark, sf_dir).select(F.to_json(kept).alias("value")).write.text(folder)
    typed = files.read_records(spark, folder, "part-*", EVENT_FIELDS[:1] + EVENT_FIELDS[3:4], lines=True)
    stamped = typed.withColumns({"event_type": F.upper("event_type"), "source_file": F.lit("/raw/events.json")})
    files.write_enhanced(stamped.drop("ordinal"), out, RUN_STAMP)
    kinds = "event_id bigint, event_type string, moment string, extra struct<value:double,ids:array<bigint>>, note string"
    return spark.read.schema(kinds).json(f"{out}/*").select(
        "event_id", "event_type", "moment", "extra.value", F.array_join(F.col("extra.ids").cast("array<string>"), "|").alias("ids"), "note")


@query
def output_files(spark, sf_dir):
    written = files.output_files(spark, _sunk_events(spark, sf_dir), RUN_STAMP)
    name = F.regexp_extract("path", "output=([^/]+)/", 1)
    return written.groupBy(name.alias("output")).agg(F.sum("movies").alias("movies"))


def _new_database(spark: SparkSession, **options) -> str:
    """The four tables in a database of their own, in the shared folder; the result of a query
    reads them, so they stay with the session."""
    database = f"stage_{uuid.uuid4().hex[:12]}"
    folder = files.shared_dir(spark, database)
    tables.create_all_tables(spark, database, location=folder, **options)
    return database


@query
def table_round_trip(spark, sf_dir):
    database = _new_database(spark)
    tables.append(
        conform.to_tmdb_table(standins.movies(spark, sf_dir), RUN_AT), "tmdb_movies", database
    )
    return _plain(tables.read_table(spark, "tmdb_movies", database))


@query
def bounded_files(spark, sf_dir):
    """Rows of a table whose files hold 50 at most, and whether they do."""
    database = _new_database(spark, max_records_per_file=50)
    tables.append(conform.to_tmdb_table(standins.movies(spark, sf_dir), RUN_AT), "tmdb_movies", database)
    sizes = spark.table(f"{database}.tmdb_movies").groupBy("_metadata.file_path").agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(
        F.sum("n").alias("row_count"), (F.max("n") <= 50).alias("within_bound"), (F.count(F.lit(1)) > 1).alias("several")
    )


@query
def deduped_rows(spark, sf_dir):
    """One row per id; movies without one are no repeats of each other."""
    database = _new_database(spark)
    keyed = standins.movies(spark, sf_dir).select(
        F.expr("case when genres[0] <> '5' then imdb_id end").alias("imdb_id"), "tmdb_id")
    tables.append(keyed, "tmdb_movies", database, dedupe_keys=["imdb_id"])
    return tables.read_table(spark, "tmdb_movies", database).select("imdb_id", "tmdb_id")


def _enriched(spark, sf_dir) -> DataFrame:
    return enrich.enrich_all(
        standins.movies(spark, sf_dir), RUN_AT, standins.omdb(spark, sf_dir),
        standins.metacritic(spark, sf_dir), standins.rotten_tomatoes(spark, sf_dir),
    )


def _staged(spark, sf_dir) -> str:
    """The enriched movies as files, from which all tables are filled."""
    staged = files.shared_dir(spark, "staged")
    with files.shuffles_freed(spark):
        _enriched(spark, sf_dir).write.option("compression", "zstd").parquet(staged)
    return staged


def _written_tables(spark, sf_dir) -> tuple[str, dict[str, tables.Inserted]]:
    """A database with the enriched movies in all four tables, and what the insert told."""
    database, staged = _new_database(spark), _staged(spark, sf_dir)
    done = tables.insert_all(spark.read.parquet(staged), RUN_AT, database, strict=True)
    files.drop_dir(spark, staged)
    return database, done


@query
def insert_all_tables(spark, sf_dir):
    return tables.table_rows(spark, _written_tables(spark, sf_dir)[0])


@query
def inserted_counts(spark, sf_dir):
    _, done = _written_tables(spark, sf_dir)
    return spark.createDataFrame([(name, t.rows) for name, t in done.items()], "table_name string, rows bigint")


def _written_twice(spark, sf_dir, table: str) -> DataFrame:
    """A table after two equal runs of the insert into all four, the second of which adds nothing."""
    database, staged = _new_database(spark), _staged(spark, sf_dir)
    for _ in range(2):
        tables.insert_all(spark.read.parquet(staged), RUN_AT, database, strict=True, once=True)
    files.drop_dir(spark, staged)
    return tables.read_table(spark, table, database)


@query
def repeated_tmdb_inserts(spark, sf_dir):
    return _plain(_written_twice(spark, sf_dir, "tmdb_movies"))


@query
def repeated_omdb_inserts(spark, sf_dir):
    return _plain(_written_twice(spark, sf_dir, "omdb_movies"))


@query
def repeated_metacritic_inserts(spark, sf_dir):
    return _doubles(_written_twice(spark, sf_dir, "metacritic_ratings"), "critic_score", "user_score")


@query
def repeated_rotten_tomatoes_inserts(spark, sf_dir):
    return _doubles(_written_twice(spark, sf_dir, "rotten_tomatoes_ratings"), "critic_score", "user_score")


@query
def table_columns(spark, sf_dir):
    """The columns that the catalog has, with the rows of their table."""
    database, _ = _written_tables(spark, sf_dir)
    rows = tables.table_rows(spark, database).select("table_name", "row_count")
    return tables.table_info(spark, database).join(rows, "table_name")


# Projections


@query
def tmdb_rows(spark, sf_dir):
    documents = conform.select_as(
        table(spark, sf_dir, "documents"), tmdb_id="doc_id", imdb_id="source", title="lang", overview="text"
    )
    return _plain(conform.to_tmdb_table(documents, RUN_AT))


def _with_omdb(spark, sf_dir) -> DataFrame:
    return enrich.enrich_all(standins.movies(spark, sf_dir), RUN_AT, standins.omdb(spark, sf_dir))


@query
def omdb_rows(spark, sf_dir):
    return _plain(conform.to_omdb_table(_with_omdb(spark, sf_dir), RUN_AT))


@query
def metacritic_rows(spark, sf_dir):
    rows = conform.to_metacritic_table(_enriched(spark, sf_dir), RUN_AT)
    return _doubles(rows, "critic_score", "user_score")


@query
def rotten_tomatoes_rows(spark, sf_dir):
    rows = conform.to_rotten_tomatoes_table(_enriched(spark, sf_dir), RUN_AT)
    return _doubles(rows, "critic_score", "user_score")


@query
def single_table_rows(spark, sf_dir):
    return _plain(conform.to_single_table(_with_omdb(spark, sf_dir), RUN_AT))


@query
def conformed_rows(spark, sf_dir):
    fields = (
        ("o_orderstatus", "string"), ("o_orderkey", "int"), ("tagline", "string"),
        ("o_totalprice", "decimal(12,2)"), ("o_orderpriority", "int"),
    )
    return _doubles(conform.conform(table(spark, sf_dir, "orders"), fields), "o_totalprice")


@query
def stamped_rows(spark, sf_dir):
    return conform.stamp(table(spark, sf_dir, "orders").select("o_orderkey"), "tmdb", RUN_AT)


@query
def stamped_columns(spark, sf_dir):
    """All other columns pass."""
    orders = table(spark, sf_dir, "orders").withColumn("o_orderdate", _moment("o_orderdate"))
    return conform.stamp(orders, "tmdb", RUN_AT)


@query
def titles_and_years(spark, sf_dir):
    movies = _with_omdb(spark, sf_dir)
    return movies.select(
        "tmdb_id", conform.known_year(movies).alias("known_year"),
        conform.title_or(movies, "title", "omdb_title").alias("known_title"),
    )


@query
def merged_records(spark, sf_dir):
    base = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    newer = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.when(F.col("l_returnflag") != "R", F.col("l_extendedprice")).alias("o_totalprice"),
        "l_quantity",
    )
    return conform.merge_records(base, newer, ["o_orderkey"])


@query
def renamed_columns(spark, sf_dir):
    return conform.select_as(table(spark, sf_dir, "orders"), movie="o_orderkey", tmdb_rating="o_totalprice")


# Filters and validation


@query
def rating_filter(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    return quality.filter_by_rating(parts, "p_retailprice", 950.0, 1000.0)


@query
def scored_rows(spark, sf_dir):
    records = conform.omdb_fields(standins.omdb(spark, sf_dir))
    return quality.with_score(records, "omdb_imdb_rating").select("imdb_id", "omdb_imdb_rating")


@query
def top_rated(spark, sf_dir):
    movies = standins.movies(spark, sf_dir).filter("vote_count > 1000")
    best = ranking.top(movies, 20, "vote_average", "tmdb_id")
    return _doubles(best.select("title", "vote_average", "vote_count"), "vote_average")


def _checked(spark, sf_dir) -> DataFrame:
    customers = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey",
        "nullif(c_mktsegment, 'BUILDING') as name",
        "case when c_mktsegment in ('BUILDING', 'MACHINERY') then '' else c_name end as code",
        "cast(floor(c_acctbal / 500) as double) as rating",
        "1890 + c_nationkey * 6 as year",
    )
    return quality.validate(
        customers, required={"title": "name", "imdb_id": "code"}, rating="rating"
    )


@query
def record_errors(spark, sf_dir):
    return _checked(spark, sf_dir).select("c_custkey", F.array_join("errors", "; ").alias("messages"))


@query
def accepted_movies(spark, sf_dir):
    movies = _with_omdb(spark, sf_dir)
    title, year = conform.title_or(movies, "title", "omdb_title"), conform.known_year(movies)
    return movies.filter(title.isNotNull() & year.isNotNull()).select("tmdb_id")


@query
def near_years(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").alias("ordered"))
    shipped = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), F.year("l_shipdate").alias("shipped")
    )
    return (
        shipped.join(orders, "o_orderkey")
        .filter(quality.years_agree("ordered", "shipped"))
        .groupBy(F.abs(F.col("ordered") - F.col("shipped")).alias("gap"))
        .agg(F.count(F.lit(1)).alias("pairs"))
    )


@query
def quarantined_rows(spark, sf_dir):
    _, failed = quality.split_failed(_checked(spark, sf_dir))
    return failed.select("c_custkey", F.array_join("errors", "; ").alias("messages"))


@query
def error_counts(spark, sf_dir):
    return quality.error_counts(_checked(spark, sf_dir))


# Joins


@query
def enrich_by_key(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment", "c_acctbal"
    )
    return enrich.enrich_by_key(orders, customers, "o_custkey", unique=True)


@query
def enrich_by_title_year(spark, sf_dir):
    return enrich.enrich_by_title_year(
        standins.movies(spark, sf_dir), standins.metacritic(spark, sf_dir), enrich.METACRITIC.fields
    ).select("tmdb_id", *enrich.METACRITIC.fields.values())


@query
def enrich_by_candidates(spark, sf_dir):
    return enrich.enrich_by_candidates(
        standins.movies(spark, sf_dir), standins.rotten_tomatoes(spark, sf_dir),
        enrich.ROTTEN_TOMATOES.fields,
    ).select("tmdb_id", *enrich.ROTTEN_TOMATOES.fields.values())


@query
def enrich_all_sources(spark, sf_dir):
    return _plain(_enriched(spark, sf_dir))


@query
def registered_source(spark, sf_dir):
    def ledger(customers: DataFrame) -> DataFrame:
        return customers.selectExpr(
            "concat('tt', lpad(cast(c_custkey as string), 7, '0')) as imdb_id",
            "case when c_acctbal >= 0 then c_acctbal end as amount",
        )

    enrich.register_source(enrich.ScoreSource(
        name="ledger", match="id", fields={"amount": "balance"}, extractor=ledger, gate="amount", unique=True,
        labels={"balance_source": "ledger"}, enhanced_at="balance_at",
    ))
    movies = standins.movies(spark, sf_dir).select("tmdb_id", "imdb_id")
    return enrich.enrich(movies, RUN_AT, {"ledger": table(spark, sf_dir, "customer")}).drop("imdb_id")


def _omdb_table(spark, sf_dir) -> DataFrame:
    return conform.omdb_fields(standins.omdb(spark, sf_dir)).select(
        "imdb_id", F.col("omdb_imdb_rating").alias("imdb_rating")
    )


def _score_tables(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Several critic rows per movie, and an audience row for some movies."""
    return (
        table(spark, sf_dir, "lineitem").selectExpr(
            "cast(l_orderkey as int) as tmdb_id", "l_quantity as critic_score"
        ),
        table(spark, sf_dir, "customer").selectExpr(
            "cast(c_custkey as int) as tmdb_id", "c_acctbal as critic_score"
        ),
    )


@query
def compare_sources(spark, sf_dir):
    compared = compare.compare_sources(
        standins.movies(spark, sf_dir), _omdb_table(spark, sf_dir), *_score_tables(spark, sf_dir)
    )
    return _doubles(compared, "tmdb_rating")


@query
def compare_sources_sql(spark, sf_dir):
    critics, tomatoes = _score_tables(spark, sf_dir)
    return _doubles(spark.sql(
        """SELECT tm.title, tm.vote_average AS tmdb_rating, om.imdb_rating,
             mr.critic_score AS metacritic_score, rt.critic_score AS rt_score
           FROM {tmdb_movies} tm
           LEFT JOIN {omdb_movies} om ON tm.imdb_id = om.imdb_id
           LEFT JOIN {metacritic_ratings} mr ON tm.tmdb_id = mr.tmdb_id
           LEFT JOIN {rotten_tomatoes_ratings} rt ON tm.tmdb_id = rt.tmdb_id
           WHERE tm.vote_count > 500""",
        tmdb_movies=standins.movies(spark, sf_dir), omdb_movies=_omdb_table(spark, sf_dir),
        metacritic_ratings=critics, rotten_tomatoes_ratings=tomatoes,
    ), "tmdb_rating")


@query
def compare_written_tables(spark, sf_dir):
    """The comparison over the tables that a run wrote, movies without an id among them."""
    database, _ = _written_tables(spark, sf_dir)
    compared = compare.compare_sources(*(tables.read_table(spark, name, database) for name in TABLES))
    return _doubles(compared, *compared.columns[1:])


def _compared(spark, sf_dir) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    critics = orders.selectExpr(
        "cast(o_orderkey as int) as tmdb_id",
        "case when o_orderstatus <> 'P' then cast(floor(o_totalprice / 5000) as double) end as critic_score",
    )
    tomatoes = orders.selectExpr(
        "cast(o_orderkey as int) as tmdb_id",
        "case when o_orderpriority <> '2-HIGH' then cast(o_custkey % 101 as double) end as critic_score",
    )
    return compare.compare_sources(
        standins.movies(spark, sf_dir), _omdb_table(spark, sf_dir), critics, tomatoes
    )


@query
def rating_differences(spark, sf_dir):
    differences = compare.rating_differences(_compared(spark, sf_dir))
    return _rounded(differences, 4, *differences.columns[1:])


@query
def source_agreement(spark, sf_dir):
    agreement = compare.source_agreement(_compared(spark, sf_dir))
    return _rounded(agreement, 4, "mean_difference", "correlation")


KEPT = ("title", "year", "omdb_imdb_rating")


def _credits(spark, sf_dir) -> DataFrame:
    return people.credits(standins.films(spark, sf_dir), keep=KEPT)


def _cast(spark, sf_dir) -> DataFrame:
    return people.cast_credits(standins.films(spark, sf_dir), keep=KEPT)


def _crew(spark, sf_dir) -> DataFrame:
    return people.crew_credits(standins.films(spark, sf_dir), keep=KEPT)


@query
def leader_network(spark, sf_dir):
    return people.leader_network(_cast(spark, sf_dir), "tmdb_id")


@query
def collaboration_strength(spark, sf_dir):
    return people.collaboration_strength(_cast(spark, sf_dir), "tmdb_id")


@query
def director_network(spark, sf_dir):
    directors = people.director_credits(standins.films(spark, sf_dir))
    return people.director_network(_cast(spark, sf_dir), directors, "tmdb_id")


# Aggregations


@query
def total_movies(spark, sf_dir):
    return analysis.total(table(spark, sf_dir, "orders"))


@query
def year_range(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year"))
    return _rounded(analysis.year_range(orders), 6, "avg")


@query
def rating_stats(spark, sf_dir):
    stats = analysis.rating_stats(table(spark, sf_dir, "orders"), "o_totalprice")
    return _rounded(stats, 3, "mean", "median", "std")


@query
def genre_distribution(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    return analysis.genre_distribution(parts, F.replace("p_name", F.lit(" "), F.lit(", ")))


@query
def director_stats(spark, sf_dir):
    return analysis.value_counts(table(spark, sf_dir, "lineitem"), "l_suppkey")


def _records(spark, sf_dir) -> DataFrame:
    return conform.omdb_fields(standins.omdb(spark, sf_dir))


@query
def country_stats(spark, sf_dir):
    return analysis.value_counts(_records(spark, sf_dir), "omdb_country")


@query
def report_categories(spark, sf_dir):
    return categories(_records(spark, sf_dir))


@query
def mean_of_file_means(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return _rounded(
        analysis.mean_of_file_means(orders, "o_totalprice", "o_orderpriority"), 3, "average_rating"
    )


@query
def file_statistics(spark, sf_dir):
    return _rounded(statistics_by_file(table(spark, sf_dir, "orders"), "o_orderpriority", "o_totalprice"), 3, "avg_rating")


@query
def run_totals(spark, sf_dir):
    return analysis.run_totals(table(spark, sf_dir, "events"), "event_type", F.col("value") < 0)


@query
def file_totals(spark, sf_dir):
    return analysis.file_totals(table(spark, sf_dir, "events"), "event_type")


@query
def coverage(spark, sf_dir):
    return analysis.coverage(
        table(spark, sf_dir, "lineitem"),
        omdb_enhanced=F.col("l_returnflag") == "A",
        metacritic_enhanced=F.col("l_discount") > 0.05,
    )


@query
def enrichment_coverage(spark, sf_dir):
    return analysis.enrichment_coverage(_enriched(spark, sf_dir))


def _top_people(rows: Query, role: str) -> Query:
    def run(spark, sf_dir):
        best = people.top_people(
            rows(spark, sf_dir), 10, "omdb_imdb_rating", F.col("role") == role
        )
        return _rounded(best, 6, "avg_rating")

    return run


QUERIES["top_actors"] = _top_people(_cast, "actor")
QUERIES["top_actresses"] = _top_people(_cast, "actress")
QUERIES["top_directors"] = _top_people(_crew, "director")
QUERIES["top_writers"] = _top_people(_crew, "writer")


@query
def genre_performance(spark, sf_dir):
    parts = table(spark, sf_dir, "part").withColumn("genre_text", F.replace("p_name", F.lit(" "), F.lit(", ")))
    return _rounded(analysis.genre_performance(parts, "genre_text", "p_retailprice"), 4, "avg_rating")


@query
def year_performance(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return _rounded(
        analysis.year_performance(orders, F.year("o_orderdate"), "o_totalprice"), 3, "avg_rating"
    )


@query
def person_ratings(spark, sf_dir):
    rated = people.person_ratings(_cast(spark, sf_dir), "omdb_imdb_rating")
    return _rounded(rated, 6, "avg_rating")


@query
def cast_summary(spark, sf_dir):
    return people.cast_summary(_credits(spark, sf_dir))


@query
def cast_totals(spark, sf_dir):
    return people.cast_totals(_credits(spark, sf_dir))


@query
def cast_filmographies(spark, sf_dir):
    return people.filmographies(_cast(spark, sf_dir), "tmdb_id", "year", "title")


@query
def crew_filmographies(spark, sf_dir):
    return people.filmographies(_crew(spark, sf_dir), "tmdb_id", "year", "title")


# Sorts, limits, top-k, set operations


@query
def sorted_by_rating(spark, sf_dir):
    return ranking.sort_by_rating(_records(spark, sf_dir), tie="imdb_id").select("imdb_id", "omdb_imdb_rating")


@query
def top_movies(spark, sf_dir):
    return analysis.top_movies(
        table(spark, sf_dir, "part"), 10, "p_retailprice",
        ("p_name", "p_retailprice", "p_size"), "p_partkey",
    )


@query
def first_of_files(spark, sf_dir):
    """The first 25 lines of a file for each type of event."""
    folder = files.shared_dir(spark, "events")
    ordered = _events(spark, sf_dir).repartition("event_type").sortWithinPartitions("event_type", "event_id")
    ordered.withColumn("kind", F.col("event_type")).write.partitionBy("kind").json(folder)
    read = files.read_movie_files(spark, folder, "kind=*/part-*", EVENT_FIELDS, lines=True, with_origin=True)
    return ranking.first_of_files(read, 25).select("event_id", "event_type")


@query
def first_per_file(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_type", "event_id", "value")
    return ranking.first_per_group(events, 25, "event_type", "event_id")


@query
def concatenated_files(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    by_status = [orders.filter(F.col("o_orderstatus") == s).drop("o_orderstatus") for s in "FOP"]
    return ranking.concat_all(
        by_status[0], by_status[1].drop("o_custkey"), by_status[2].drop("o_totalprice")
    )


# Scalar functions


@query
def parsed_scores(spark, sf_dir):
    texts = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey",
        "case when c_acctbal < 0 then 'N/A' else concat(' ', cast(c_acctbal as string)) end as a",
        "case when c_acctbal < 0 then '' else format_number(floor(c_acctbal * 10), 0) end as b",
        "case when c_acctbal >= 5000 then cast(floor(c_acctbal / 100) as string) "
        "else concat(cast(floor(c_acctbal / 100) as string), '.5') end as c",
    )
    return texts.select(
        "c_custkey", parse_rating("a").alias("rating"), parse_votes("b").alias("votes"),
        parse_metascore("c").alias("metascore"),
    )


@query
def years_from_dates(spark, sf_dir):
    texts = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "case o_orderstatus when 'P' then 'unknown' else cast(cast(o_orderdate as date) as string) end as d",
    )
    return texts.select("o_orderkey", year_from_date("d").alias("year"))


@query
def cut_texts(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        truncate_text("text").alias("inside"),
        truncate_text("text", suffix_outside=True).alias("outside"),
        truncate_or_null(F.when(F.col("lang") == "en", "").otherwise(F.col("text")), 50).alias("or_null"),
    )


@query
def title_slugs(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", title_slug("text").alias("dash"), title_slug("text", "_").alias("line")
    )


@query
def counts_in_text(spark, sf_dir):
    texts = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "concat(' ', cast(floor(o_totalprice / 5000) as string), '% ') as p",
        "concat('Based on ', format_number(floor(o_totalprice), 0), ' Reviews') as c",
        "concat(' ', format_number(floor(o_totalprice), 0), '+ Ratings ') as a",
    )
    return texts.select(
        "o_orderkey", parse_percent("p").alias("percent"), first_integer("c").alias("first_run"),
        first_integer("c", thousands=True).alias("whole_run"), strip_word("a").alias("audience"),
    )


@query
def years_in_text(spark, sf_dir):
    texts = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "concat('No. ', o_orderkey, ' of ', date_format(cast(o_orderdate as date), 'dd.MM.yyyy')) as t",
        "concat('Sold (', case when o_orderstatus = 'O' then 'n/a' else cast(year(o_orderdate) as string) end, ')') as b",
    )
    return texts.select(
        "o_orderkey", year_in_text("t").alias("year"), parenthesized_year("b").alias("bracketed")
    )


@query
def rating_lists(spark, sf_dir):
    lists = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey",
        "case when c_acctbal >= 0 then array(named_struct('Source', 'Balance', 'Value', c_name)) end as r",
    )
    return lists.select(
        "c_custkey", ratings_json("r", "[]").alias("ratings"), ratings_json("r").alias("or_null")
    )


@query
def file_stamps(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", file_stamp("ts").alias("stamp"))


@query
def name_lists(spark, sf_dir):
    names = analysis.split_names(F.col("p_name"), " ")
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.size(names).alias("words"), F.array_join(names, "|").alias("names")
    )
