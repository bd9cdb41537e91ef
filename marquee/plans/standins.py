"""Film-shaped views of the star-schema test tables.

Every row of a table becomes one record, so the operators meet whole tables under the column
names they have in use. `oracle.py` states the same views in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RUN_AT = "2025-08-21T12:58:04"
RUN_STAMP = "20250821_125804"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _spread_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in as many partitions as the session shuffles to: the narrow rows are moved
    before each becomes a page, whose walk takes far longer than the move."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return table(spark, sf_dir, "orders").repartition(partitions, "o_orderkey")


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as movies. A third has an empty id, a fifth an empty title, and the year is
    given, zero or missing by status."""
    return table(spark, sf_dir, "orders").selectExpr(
        "cast(o_orderkey as int) as tmdb_id",
        "case when o_orderstatus = 'P' then '' "
        "else concat('tt', lpad(cast(o_custkey as string), 7, '0')) end as imdb_id",
        "case when o_orderpriority = '1-URGENT' then '' "
        "else concat('Étude & ', o_orderpriority, ' ', o_custkey) end as title",
        "cast(cast(o_orderdate as date) as string) as release_date",
        "case o_orderstatus when 'F' then year(o_orderdate) when 'O' then 0 end as year",
        "cast(floor(o_totalprice / 50) / 1000 as decimal(10,3)) as vote_average",
        "cast(floor(o_totalprice / 100) as int) as vote_count",
        "split(o_orderpriority, '-') as genres",
        "concat('original ', o_orderkey) as original_title",
        "concat('overview ', o_orderkey, ' ', repeat('x', cast(o_orderkey % 1200 as int))) as overview",
        "concat('tagline ', o_orderkey) as tagline",
        "concat('status ', o_orderstatus) as status",
        "cast(o_orderkey % 300 as int) as runtime",
        "o_orderkey * 1000 as budget",
        "o_orderkey * 3000 as revenue",
        "cast(o_orderkey % 1000 as decimal(10,4)) as popularity",
        "array(cast(o_custkey as int), 7) as genre_ids",
        "concat('language ', o_orderkey % 5) as original_language",
        "array(concat('company ', o_custkey), 'second') as production_companies",
        "array(concat('country ', o_custkey)) as production_countries",
        "array(concat('spoken ', o_custkey)) as spoken_languages",
        "concat('cast ', o_orderkey) as cast_data",
        "concat('crew ', o_orderkey) as crew_data",
        "concat('backdrop ', o_orderkey) as backdrop_path",
        "concat('poster ', o_orderkey) as poster_path",
        "concat('home ', o_orderkey) as homepage",
        "concat('external ', o_orderkey) as external_ids",
    )


def omdb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as OMDb responses, all values as text."""
    return table(spark, sf_dir, "customer").selectExpr(
        "concat('tt', lpad(cast(c_custkey as string), 7, '0')) as imdbID",
        "case when c_mktsegment = 'MACHINERY' then 'False' else 'True' end as Response",
        "c_name as Title",
        "concat('rated ', c_nationkey) as Rated",
        "concat('released ', c_custkey) as Released",
        "concat(c_custkey % 200, ' min') as Runtime",
        "concat(c_mktsegment, ', NATION_', c_nationkey) as Genre",
        "concat('Director ', c_nationkey) as Director",
        "concat('Writer ', c_nationkey) as Writer",
        "concat('Actor ', c_custkey, ', Actor ', c_nationkey) as Actors",
        "repeat(c_name, 80) as Plot",
        "concat('Language ', c_nationkey) as Language",
        "case when c_nationkey = 7 then 'N/A' else concat('NATION_', c_nationkey, ', WORLD') end as Country",
        "concat('awards ', c_custkey) as Awards",
        "concat('poster ', c_custkey) as Poster",
        "array(named_struct('Source', 'Balance', 'Value', c_name)) as Ratings",
        "case when c_acctbal < 0 then 'N/A' "
        "else cast(cast(floor(c_acctbal / 100) as double) / 10 as string) end as imdbRating",
        "case when c_acctbal < 0 then 'N/A' else format_number(floor(c_acctbal * 10), 0) end as imdbVotes",
        "case when c_acctbal < 0 then 'N/A' else cast(floor(c_acctbal / 100) as string) end as Metascore",
        "concat('box office ', c_custkey) as BoxOffice",
        "concat('production ', c_custkey) as Production",
        "concat('website ', c_custkey) as Website",
    )


def metacritic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as Metacritic snapshot rows: several years per slug, some without a score."""
    return table(spark, sf_dir, "orders").selectExpr(
        "case when o_orderpriority = '1-URGENT' then concat('customer', lpad(cast(o_custkey as string), 9, '0')) "
        "else concat('etude--', replace(lower(o_orderpriority), ' ', '-'), '-', o_custkey) end as slug",
        "year(o_orderdate) + case o_orderstatus when 'P' then 2 when 'O' then 5 else 0 end as year",
        "case when o_totalprice >= 60000 then cast(floor(o_totalprice / 5000) as double) end as critic_score",
        "cast(floor(o_totalprice / 1000) as int) as critic_count",
        "cast(floor(o_totalprice / 500) as double) / 100 as user_score",
        "cast(floor(o_totalprice / 10) as int) as user_count",
    )


def rotten_tomatoes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as Rotten Tomatoes snapshot rows, found by slug, by slug and year, or by title."""
    return table(spark, sf_dir, "orders").selectExpr(
        "case o_orderpriority "
        "when '1-URGENT' then concat('customer', lpad(cast(o_custkey as string), 9, '0')) "
        "when '2-HIGH' then concat('etude__2_high_', o_custkey) "
        "when '3-MEDIUM' then concat('etude__3_medium_', o_custkey, '_', year(o_orderdate)) "
        "when '4-NOT SPECIFIED' then concat('page_', o_orderkey) "
        "else concat('etude__5_low_', o_custkey) end as slug",
        "case when o_orderpriority in ('4-NOT SPECIFIED', '5-LOW') "
        "then concat('Etude & ', o_orderpriority, ' ', o_custkey) else 'Unrelated' end as title",
        "year(o_orderdate) + case o_orderstatus when 'P' then 2 when 'O' then 5 else 0 end as year",
        "o_totalprice >= 50000 as has_scorecard",
        "case when o_totalprice >= 60000 then cast(floor(o_totalprice / 5000) as double) end as critic_score",
        "cast(floor(o_totalprice / 1000) as int) as critic_count",
        "cast(floor(o_totalprice / 5200) as double) as user_score",
        "concat(cast(floor(o_totalprice / 10) as string), '+') as user_count",
    )


def metacritic_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as crawled Metacritic pages."""
    return _spread_orders(spark, sf_dir).selectExpr(
        "o_orderkey as page_id",
        "concat('https://scores.example/movie/order-', o_orderkey, '/?ref=', o_custkey) as url",
        "concat('<!DOCTYPE html><html><head><title>', o_orderpriority, '</title></head><body>"
        "<div data-testid=\"hero-metadata\"><ul><li><span> ', year(o_orderdate), ' </span></li>"
        "<li><span>2 h</span></li></ul></div>"
        "<div data-testid=\"critic-score-info\"><p>Score<br></p><a data-testid=\"critic-path\" href=\"/c\">"
        "<span>Based on ', format_number(floor(o_totalprice), 0), ' Critic Reviews</span></a>"
        "<div class=\"c-siteReviewScore big\"><span>', "
        "case when o_orderstatus = 'P' then 'tbd' else cast(floor(o_totalprice / 5000) as string) end, "
        "'</span></div></div>"
        "<div class=\"box\" data-testid=\"user-score-info\"><a data-testid=\"user-path\">"
        "<span>Based on ', format_number(floor(o_totalprice), 0), ' User Ratings</span></a>', "
        "case when o_orderstatus = 'O' then '' else concat('<div class=\"c-siteReviewScore\"><span>', "
        "cast(cast(floor(o_totalprice / 5000) as double) / 10 as string), '</span></div>') end, "
        "'</div></body></html>') as html",
    )


def rotten_tomatoes_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as crawled Rotten Tomatoes pages."""
    return _spread_orders(spark, sf_dir).selectExpr(
        "o_orderkey as page_id",
        "concat('https://tomatoes.example/m/order_', o_orderkey, '/') as url",
        "concat('<html><body><rt-text slot=\"metadataProp\">Drama</rt-text>"
        "<rt-text slot=\"metadataProp\">Released ', cast(o_orderdate as date), '</rt-text>', "
        "case when o_orderstatus = 'P' then '<section>' else '<div class=\"wide media-scorecard\">' end, "
        "'<rt-text slot=\"criticsScore\">', cast(floor(o_totalprice / 5000) as string), '%</rt-text>"
        "<rt-link slot=\"criticsReviews\"> ', cast(floor(o_totalprice / 1000) as string), ' Reviews </rt-link>"
        "<rt-link slot=\"audienceReviews\">', format_number(floor(o_totalprice), 0), '+ Ratings</rt-link>', "
        "case when o_orderstatus = 'O' then '' else '<rt-text slot=\"audienceScore\">77%</rt-text>' end, "
        "case when o_orderstatus = 'P' then '</section>' else '</div>' end, "
        "'</body></html>') as html",
    )


def films(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as films with serialized cast and crew; an order is one movie id. Several
    suppliers share a name, and most films have two directors."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey as tmdb_id",
        "concat('Film ', l_orderkey) as title",
        "year(l_shipdate) as year",
        "l_quantity / 5 as omdb_imdb_rating",
        "concat('Director ', l_orderkey % 97) as director",
        "concat('[{\"id\":', l_suppkey, ',\"name\":\"Supplier ', l_suppkey % 7, '\",\"gender\":', "
        "case l_returnflag when 'A' then 2 when 'N' then 1 else 0 end, ',\"order\":0},"
        "{\"id\":', 1000000000 + l_partkey, ',\"name\":\"Part ', l_partkey, '\",\"gender\":1,\"order\":1}]') as cast_data",
        "concat('[{\"id\":', l_suppkey, ',\"name\":\"Supplier ', l_suppkey % 7, '\",\"job\":\"', "
        "case l_linestatus when 'F' then 'Director' else 'Writer' end, '\"},"
        "{\"name\":\"Director ', l_orderkey % 97, '\",\"job\":\"Director\"},"
        "{\"id\":', 1000000000 + l_partkey, ',\"name\":\"Part ', l_partkey, '\",\"job\":\"Producer\"}]') as crew_data",
    )
