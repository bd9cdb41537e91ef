"""The registered queries in SQL, written on their own against the test tables."""

from __future__ import annotations

from ..schemas import TABLES

MOVIES = """movies AS (
  SELECT o_orderkey::INT AS tmdb_id,
    CASE WHEN o_orderstatus = 'P' THEN '' ELSE 'tt' || lpad(o_custkey::VARCHAR, 7, '0') END AS imdb_id,
    CASE WHEN o_orderpriority = '1-URGENT' THEN ''
      ELSE 'Étude & ' || o_orderpriority || ' ' || o_custkey END AS title,
    strftime(o_orderdate, '%Y-%m-%d') AS release_date,
    CASE o_orderstatus WHEN 'F' THEN year(o_orderdate)::INT WHEN 'O' THEN 0 END AS year,
    year(o_orderdate)::INT AS known_year,
    floor(o_totalprice / 50) / 1000 AS vote_average,
    floor(o_totalprice / 100)::INT AS vote_count,
    replace(o_orderpriority, '-', '|') AS genres,
    'original ' || o_orderkey AS original_title,
    'overview ' || o_orderkey || ' ' || repeat('x', (o_orderkey % 1200)::INT) AS overview,
    'tagline ' || o_orderkey AS tagline, 'status ' || o_orderstatus AS status,
    (o_orderkey % 300)::INT AS runtime, o_orderkey * 1000 AS budget, o_orderkey * 3000 AS revenue,
    (o_orderkey % 1000)::DOUBLE AS popularity, o_custkey || '|7' AS genre_ids,
    'language ' || (o_orderkey % 5) AS original_language,
    'company ' || o_custkey || '|second' AS production_companies,
    'country ' || o_custkey AS production_countries, 'spoken ' || o_custkey AS spoken_languages,
    'cast ' || o_orderkey AS cast_data, 'crew ' || o_orderkey AS crew_data,
    'backdrop ' || o_orderkey AS backdrop_path, 'poster ' || o_orderkey AS poster_path,
    'home ' || o_orderkey AS homepage, 'external ' || o_orderkey AS external_ids,
    o_orderpriority, o_custkey
  FROM orders)"""

OMDB = """omdb AS (
  SELECT 'tt' || lpad(c_custkey::VARCHAR, 7, '0') AS imdb_id, c_name AS omdb_title,
    c_mktsegment || ', NATION_' || c_nationkey AS omdb_genre,
    'Director ' || c_nationkey AS omdb_director,
    CASE WHEN c_nationkey = 7 THEN 'N/A' ELSE 'NATION_' || c_nationkey || ', WORLD' END AS omdb_country,
    CASE WHEN c_acctbal >= 0 THEN floor(c_acctbal / 100) / 10 END AS omdb_imdb_rating,
    CASE WHEN c_acctbal >= 0 THEN floor(c_acctbal * 10)::BIGINT END AS omdb_imdb_votes,
    CASE WHEN c_acctbal >= 0 THEN floor(c_acctbal / 100)::INT END AS omdb_metascore,
    'rated ' || c_nationkey AS omdb_rated, 'released ' || c_custkey AS omdb_released,
    (c_custkey % 200) || ' min' AS omdb_runtime, 'Writer ' || c_nationkey AS omdb_writer,
    'Actor ' || c_custkey || ', Actor ' || c_nationkey AS omdb_actors, repeat(c_name, 80) AS omdb_plot,
    'Language ' || c_nationkey AS omdb_language, 'awards ' || c_custkey AS omdb_awards,
    'poster ' || c_custkey AS omdb_poster, '[{"Source":"Balance","Value":"' || c_name || '"}]' AS omdb_ratings,
    'box office ' || c_custkey AS omdb_box_office, 'production ' || c_custkey AS omdb_production,
    'website ' || c_custkey AS omdb_website
  FROM customer WHERE c_mktsegment <> 'MACHINERY')"""

METACRITIC = """metacritic AS (
  SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN 'customer' || lpad(o_custkey::VARCHAR, 9, '0')
      ELSE 'etude--' || replace(lower(o_orderpriority), ' ', '-') || '-' || o_custkey END AS slug,
    year(o_orderdate)::INT + CASE o_orderstatus WHEN 'P' THEN 2 WHEN 'O' THEN 5 ELSE 0 END AS page_year,
    CASE WHEN o_totalprice >= 60000 THEN floor(o_totalprice / 5000) END AS critic_score,
    floor(o_totalprice / 1000)::INT AS critic_count,
    floor(o_totalprice / 500) / 100 AS user_score,
    floor(o_totalprice / 10)::INT AS user_count
  FROM orders)"""

TOMATOES = """tomatoes AS (
  SELECT CASE o_orderpriority
      WHEN '1-URGENT' THEN 'customer' || lpad(o_custkey::VARCHAR, 9, '0')
      WHEN '2-HIGH' THEN 'etude__2_high_' || o_custkey
      WHEN '3-MEDIUM' THEN 'etude__3_medium_' || o_custkey || '_' || year(o_orderdate)::INT
      WHEN '4-NOT SPECIFIED' THEN 'page_' || o_orderkey
      ELSE 'etude__5_low_' || o_custkey END AS slug,
    CASE WHEN o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW')
      THEN 'etude__' || regexp_replace(lower(o_orderpriority), '[ -]', '_', 'g') || '_' || o_custkey
      ELSE 'unrelated' END AS title_slug,
    year(o_orderdate)::INT + CASE o_orderstatus WHEN 'P' THEN 2 WHEN 'O' THEN 5 ELSE 0 END AS page_year,
    o_totalprice >= 50000 AS has_scorecard,
    CASE WHEN o_totalprice >= 60000 THEN floor(o_totalprice / 5000) END AS critic_score,
    floor(o_totalprice / 1000)::INT AS critic_count,
    floor(o_totalprice / 5200) AS user_score,
    floor(o_totalprice / 10)::BIGINT || '+' AS user_count
  FROM orders)"""

# Movies with the slugs of the title, or of the OMDb title where that is empty.
TITLED = """titled AS (
  SELECT m.tmdb_id, m.known_year, o.omdb_title, o.omdb_imdb_rating,
    CASE WHEN m.title <> '' THEN 'etude--' || replace(lower(m.o_orderpriority), ' ', '-') || '-' || m.o_custkey
      ELSE lower(replace(o.omdb_title, '#', '')) END AS dash_slug,
    CASE WHEN m.title <> '' THEN 'etude__' || regexp_replace(lower(m.o_orderpriority), '[ -]', '_', 'g') || '_' || m.o_custkey
      ELSE lower(replace(o.omdb_title, '#', '')) END AS line_slug
  FROM movies m LEFT JOIN omdb o USING (imdb_id))"""

BY_TITLE_YEAR = """by_title_year AS (
  SELECT tmdb_id, critic_score AS metacritic_critic_score, critic_count AS metacritic_critic_count,
    user_score AS metacritic_user_score, user_count AS metacritic_user_count
  FROM (
    SELECT t.tmdb_id, p.*, row_number() OVER (PARTITION BY t.tmdb_id
      ORDER BY abs(p.page_year - t.known_year), p.page_year, p.critic_score NULLS FIRST,
        p.critic_count, p.user_score, p.user_count) AS n
    FROM titled t JOIN metacritic p ON p.slug = t.dash_slug AND abs(p.page_year - t.known_year) <= 3)
  WHERE n = 1 AND critic_score IS NOT NULL)"""

BY_CANDIDATES = """candidates AS (
  SELECT tmdb_id, known_year, 1 AS rank, line_slug AS slug, NULL AS title_slug FROM titled
  UNION ALL SELECT tmdb_id, known_year, 2, line_slug || '_' || known_year, NULL FROM titled
  UNION ALL SELECT tmdb_id, known_year, 3, NULL, line_slug FROM titled),
by_candidates AS (
  SELECT tmdb_id, critic_score AS rt_critic_score, critic_count AS rt_critic_count,
    user_score AS rt_user_score, user_count AS rt_user_count
  FROM (
    SELECT tmdb_id, critic_score, critic_count, user_score, user_count,
      row_number() OVER (PARTITION BY tmdb_id ORDER BY rank, abs(page_year - known_year), page_year,
        critic_score NULLS FIRST, critic_count, user_score, user_count) AS n
    FROM (
      SELECT c.tmdb_id, c.known_year, c.rank, p.* FROM candidates c JOIN tomatoes p ON p.slug = c.slug
      UNION ALL
      SELECT c.tmdb_id, c.known_year, c.rank, p.* FROM candidates c JOIN tomatoes p ON p.title_slug = c.title_slug)
    WHERE has_scorecard AND abs(page_year - known_year) <= 3)
  WHERE n = 1 AND critic_score IS NOT NULL)"""

# Several suppliers share a name; a director without an id goes by the name.
CREDITS = """credits AS (
  SELECT l_orderkey AS tmdb_id, '#' || l_suppkey AS key, 'Supplier ' || (l_suppkey % 7) AS person,
    CASE l_returnflag WHEN 'N' THEN 'actress' ELSE 'actor' END AS role,
    l_quantity / 5 AS rating, year(l_shipdate)::INT AS year FROM lineitem
  UNION ALL
  SELECT l_orderkey, '#' || (1000000000 + l_partkey), 'Part ' || l_partkey, 'actress', l_quantity / 5,
    year(l_shipdate)::INT FROM lineitem
  UNION ALL
  SELECT l_orderkey, '#' || l_suppkey, 'Supplier ' || (l_suppkey % 7),
    CASE l_linestatus WHEN 'F' THEN 'director' ELSE 'writer' END, l_quantity / 5, year(l_shipdate)::INT FROM lineitem
  UNION ALL
  SELECT l_orderkey, 'Director ' || (l_orderkey % 97), 'Director ' || (l_orderkey % 97), 'director', l_quantity / 5,
    year(l_shipdate)::INT FROM lineitem
  UNION ALL
  SELECT l_orderkey, '#' || (1000000000 + l_partkey), 'Part ' || l_partkey, 'producer', l_quantity / 5,
    year(l_shipdate)::INT FROM lineitem),
seen AS (
  SELECT DISTINCT tmdb_id, key, person FROM credits WHERE role IN ('actor', 'actress'))"""


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


_RUN = "'2025-08-21T12:58:04'"

SQL: dict[str, str] = {}

# Scans, sources and sinks
_MOMENT = "strftime({}, '%Y-%m-%d %H:%M:%S')"
SQL["json_round_trip"] = f"""SELECT event_id, user_id, {_MOMENT.format('ts')} AS moment, event_type, value,
  (props->>'$.k')::INT AS k FROM events"""
SQL["array_files"] = SQL["json_round_trip"]
SQL["malformed_array_files"] = """SELECT 'parsed' AS kind, count(*) AS n, sum(event_id)::BIGINT AS ids
  FROM events WHERE event_id // 500 % 3 <> 0
  UNION ALL SELECT 'malformed', count(DISTINCT event_id // 500), NULL FROM events WHERE event_id // 500 % 3 = 0"""
SQL["split_array_files"] = SQL["json_round_trip"]
SQL["malformed_records"] = """SELECT event_id // 500 AS part, (count(*) - (event_id // 500 % 3 = 0)::INT)::BIGINT AS parsed,
  (event_id // 500 % 3 = 0)::BIGINT AS malformed, sum(event_id)::BIGINT AS ids FROM events GROUP BY event_id // 500"""
SQL["enhanced_raw_keys"] = f"""SELECT event_id, upper(event_type) AS event_type, {_MOMENT.format('ts')} AS moment, value,
  user_id || '|' || event_id * 2 AS ids, props AS note FROM events"""
SQL["scan_table"] = f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, {_MOMENT.format('o_orderdate')} AS o_orderdate,
  o_orderpriority FROM orders ORDER BY o_orderkey LIMIT 10"""
SQL["snapshot_records"] = _with(OMDB) + "SELECT * FROM omdb"
SQL["page_fields"] = """SELECT page_id, url, split_part(split_part(html, '<html lang="', 2), '"', 1) AS lang,
  replace(replace(replace(replace(split_part(split_part(html, '<title>', 2), '</title>', 1),
    '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&') AS title,
  nullif(split_part(split_part(split_part(split_part(html, '<nav>', 2), '</nav>', 1), '<a href="', 2), '"', 1), '') AS first_link,
  split_part(split_part(html, ';track(', 2), ')', 1)::INT AS tracked
  FROM pages"""
SQL["metacritic_pages"] = """SELECT o_orderkey AS page_id, 'order-' || o_orderkey AS slug, year(o_orderdate)::INT AS year,
  CASE WHEN o_orderstatus <> 'P' THEN floor(o_totalprice / 5000) END AS critic_score,
  regexp_extract(format('{:,}', floor(o_totalprice)::BIGINT), '[0-9]+')::BIGINT AS critic_count,
  CASE WHEN o_orderstatus <> 'O' THEN floor(o_totalprice / 5000) / 10 END AS user_score,
  floor(o_totalprice)::BIGINT AS user_count
  FROM orders"""
SQL["rotten_tomatoes_pages"] = """SELECT o_orderkey AS page_id, 'order_' || o_orderkey AS slug,
  year(o_orderdate)::INT::VARCHAR AS years,
  o_orderstatus = 'F' AS has_scorecard,
  CASE WHEN o_orderstatus <> 'P' THEN floor(o_totalprice / 5000) END AS critic_score,
  CASE WHEN o_orderstatus <> 'P' THEN floor(o_totalprice / 1000)::BIGINT END AS critic_count,
  CASE WHEN o_orderstatus = 'F' THEN 77.0::DOUBLE END AS user_score,
  CASE WHEN o_orderstatus <> 'P' THEN format('{:,}', floor(o_totalprice)::BIGINT) || '+' END AS user_count
  FROM orders"""
SQL["enhanced_files"] = f"""SELECT 'enhanced_' || event_type || '_20250821_125804' AS output, event_id, user_id,
  {_MOMENT.format('ts')} AS moment, event_type, value, props FROM events"""
SQL["output_files"] = """SELECT 'enhanced_' || event_type || '_20250821_125804' AS output, count(*) AS movies
  FROM events GROUP BY event_type"""
_TMDB = f"""SELECT tmdb_id, nullif(imdb_id, '') AS imdb_id, title, original_title, release_date, known_year AS year,
  CASE WHEN length(overview) <= 1000 THEN overview ELSE overview[1:997] || '...' END AS overview, tagline, status,
  runtime, budget, revenue, popularity, vote_average::DOUBLE AS vote_average, vote_count, genres, genre_ids,
  original_language, production_companies, production_countries, spoken_languages, cast_data, crew_data,
  backdrop_path, poster_path, homepage, external_ids, 'tmdb' AS data_source, {_RUN} AS created_at,
  {_RUN} AS updated_at FROM movies"""
SQL["table_round_trip"] = _with(MOVIES) + _TMDB
SQL["bounded_files"] = _with(MOVIES) + """SELECT count(*) AS row_count, true AS within_bound, true AS several FROM movies"""
SQL["deduped_rows"] = _with(MOVIES) + """, keyed AS (
  SELECT CASE WHEN o_orderpriority <> '5-LOW' THEN imdb_id END AS imdb_id, tmdb_id FROM movies)
SELECT imdb_id, min(tmdb_id) AS tmdb_id FROM keyed WHERE imdb_id <> '' GROUP BY imdb_id
UNION ALL SELECT imdb_id, tmdb_id FROM keyed WHERE coalesce(imdb_id, '') = ''"""
SQL["insert_all_tables"] = _with(MOVIES, OMDB, METACRITIC, TOMATOES, TITLED, BY_TITLE_YEAR, BY_CANDIDATES) + """
SELECT 'tmdb_movies' AS table_name, 30 AS column_count, count(*) AS row_count FROM movies
UNION ALL SELECT 'omdb_movies', 26, count(*) FROM movies
UNION ALL SELECT 'metacritic_ratings', 10, count(*) FROM by_title_year
UNION ALL SELECT 'rotten_tomatoes_ratings', 10, count(*) FROM by_candidates"""
SQL["inserted_counts"] = f"SELECT table_name, row_count AS rows FROM ({SQL['insert_all_tables']})"
_COLUMNS = ", ".join(
    f"('{table}', {place}, '{name}', '{kind}', {str(name == 'year').lower()})"
    for table, fields in TABLES.items()
    for place, (name, kind) in enumerate([f for f in fields if f[0] != "year"] + [f for f in fields if f[0] == "year"], 1)
)
SQL["table_columns"] = f"""SELECT c.*, r.row_count
  FROM (VALUES {_COLUMNS}) c(table_name, place, column_name, data_type, is_partition)
  JOIN ({SQL['insert_all_tables']}) r USING (table_name)"""

# Projections
_NO_FIELDS = ", ".join(
    f"NULL AS {name}" for name, _ in TABLES["tmdb_movies"]
    if name not in ("tmdb_id", "imdb_id", "title", "overview", "data_source", "created_at", "updated_at")
)
SQL["tmdb_rows"] = f"""SELECT doc_id::INT AS tmdb_id, source AS imdb_id, lang AS title, {_NO_FIELDS},
  CASE WHEN text = '' THEN NULL WHEN length(text) <= 1000 THEN text ELSE text[1:997] || '...' END AS overview,
  'tmdb' AS data_source, {_RUN} AS created_at, {_RUN} AS updated_at FROM documents"""
_KEPT_TEXTS = ", ".join(
    f"o.omdb_{name} AS {name}" for name in
    ("rated", "released", "runtime", "genre", "director", "writer", "actors", "language", "country", "awards", "poster",
     "box_office", "production", "website")
)
_OMDB_ROW = f"""SELECT nullif(m.imdb_id, '') AS imdb_id, m.title, m.known_year AS year, o.omdb_title, {_KEPT_TEXTS},
  o.omdb_imdb_rating::DOUBLE AS imdb_rating, o.omdb_imdb_votes::INT AS imdb_votes, o.omdb_metascore AS metascore,
  {_RUN} AS updated_at, {_RUN} AS created_at, """
SQL["omdb_rows"] = _with(MOVIES, OMDB) + _OMDB_ROW + """
  CASE WHEN length(o.omdb_plot) <= 1000 THEN o.omdb_plot ELSE o.omdb_plot[1:997] || '...' END AS plot,
  coalesce(o.omdb_ratings, '[]') AS ratings, 'omdb' AS data_source
  FROM movies m LEFT JOIN omdb o USING (imdb_id)"""
ENRICHED = (MOVIES, OMDB, METACRITIC, TOMATOES, TITLED, BY_TITLE_YEAR, BY_CANDIDATES)
SQL["metacritic_rows"] = _with(*ENRICHED) + f"""SELECT tmdb_id, nullif(m.imdb_id, '') AS imdb_id, m.title, m.known_year AS year,
  metacritic_critic_score::DOUBLE AS critic_score, metacritic_critic_count AS critic_count,
  round(metacritic_user_score * 10 + 1e-6) / 10 AS user_score, metacritic_user_count AS user_count,
  'metacritic' AS data_source, {_RUN} AS created_at
  FROM movies m JOIN by_title_year USING (tmdb_id)"""
SQL["rotten_tomatoes_rows"] = _with(*ENRICHED) + f"""SELECT tmdb_id, nullif(m.imdb_id, '') AS imdb_id, m.title, m.known_year AS year,
  rt_critic_score::DOUBLE AS critic_score, rt_critic_count AS critic_count,
  rt_user_score::DOUBLE AS user_score, rt_user_count AS user_count,
  'rottentomatoes' AS data_source, {_RUN} AS created_at
  FROM movies m JOIN by_candidates USING (tmdb_id)"""
SQL["single_table_rows"] = _with(MOVIES, OMDB) + _OMDB_ROW + """
  CASE WHEN length(o.omdb_plot) <= 1000 THEN o.omdb_plot ELSE o.omdb_plot[1:1000] || '...' END AS plot,
  o.omdb_ratings AS ratings, 'tmdb' AS data_source
  FROM movies m LEFT JOIN omdb o USING (imdb_id)"""
SQL["conformed_rows"] = """SELECT o_orderstatus, o_orderkey::INT AS o_orderkey, NULL::VARCHAR AS tagline,
  o_totalprice AS o_totalprice, TRY_CAST(o_orderpriority AS INT) AS o_orderpriority FROM orders"""
SQL["stamped_columns"] = f"""SELECT * REPLACE ({_MOMENT.format('o_orderdate')} AS o_orderdate), 'tmdb' AS data_source,
  {_RUN} AS processed_at FROM orders"""
SQL["stamped_rows"] = f"""SELECT o_orderkey, 'tmdb' AS data_source, {_RUN} AS processed_at FROM orders"""
SQL["titles_and_years"] = _with(MOVIES, OMDB) + """SELECT m.tmdb_id, m.known_year,
  coalesce(nullif(m.title, ''), o.omdb_title) AS known_title FROM movies m LEFT JOIN omdb o USING (imdb_id)"""
SQL["merged_records"] = """SELECT o_orderkey, o_orderstatus, coalesce(price, o_totalprice) AS o_totalprice, l_quantity
  FROM orders LEFT JOIN (
    SELECT l_orderkey, price, l_quantity, row_number() OVER (PARTITION BY l_orderkey
      ORDER BY price NULLS FIRST, l_quantity) AS n
    FROM (SELECT *, CASE WHEN l_returnflag <> 'R' THEN l_extendedprice END AS price FROM lineitem))
  ON l_orderkey = o_orderkey AND n = 1"""
SQL["renamed_columns"] = """SELECT o_orderkey AS movie, o_totalprice AS tmdb_rating FROM orders"""

# Filters and validation
SQL["rating_filter"] = "SELECT p_partkey, p_retailprice FROM part WHERE p_retailprice BETWEEN 950 AND 1000"
SQL["scored_rows"] = _with(OMDB) + "SELECT imdb_id, omdb_imdb_rating FROM omdb WHERE omdb_imdb_rating IS NOT NULL"
SQL["top_rated"] = _with(MOVIES) + """SELECT title, vote_average, vote_count FROM movies WHERE vote_count > 1000
  ORDER BY vote_average DESC, tmdb_id LIMIT 20"""
CHECKED = """checked AS (
  SELECT c_custkey, concat_ws('; ',
    CASE WHEN c_mktsegment = 'BUILDING' THEN 'Missing required field: title' END,
    CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'Missing required field: imdb_id' END,
    CASE WHEN c_acctbal < 0 OR floor(c_acctbal / 500) > 10
      THEN 'Invalid rating value: ' || floor(c_acctbal / 500) END,
    CASE WHEN 1890 + c_nationkey * 6 NOT BETWEEN 1900 AND 2030
      THEN 'Invalid year value: ' || (1890 + c_nationkey * 6) END) AS messages
  FROM customer)"""
SQL["record_errors"] = _with(CHECKED) + "SELECT c_custkey, messages FROM checked"
SQL["accepted_movies"] = _with(MOVIES, OMDB) + """SELECT m.tmdb_id FROM movies m LEFT JOIN omdb o USING (imdb_id)
  WHERE coalesce(nullif(m.title, ''), o.omdb_title) IS NOT NULL AND m.known_year IS NOT NULL"""
SQL["near_years"] = """SELECT abs(year(o_orderdate)::INT - year(l_shipdate)::INT) AS gap, count(*) AS pairs
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey
  WHERE abs(year(o_orderdate)::INT - year(l_shipdate)::INT) <= 3 GROUP BY 1"""
SQL["quarantined_rows"] = _with(CHECKED) + "SELECT c_custkey, messages FROM checked WHERE messages <> ''"
SQL["error_counts"] = _with(CHECKED) + """SELECT count(*) AS total, count(*) FILTER (messages <> '') AS errors FROM checked"""

# Joins
SQL["enrich_by_key"] = """SELECT o_orderkey, o_custkey, c_name, c_mktsegment, c_acctbal
  FROM orders LEFT JOIN customer ON c_custkey = o_custkey"""
SQL["enrich_by_title_year"] = _with(*ENRICHED[:3], TITLED, BY_TITLE_YEAR) + """SELECT m.tmdb_id,
  metacritic_critic_score, metacritic_critic_count, metacritic_user_score, metacritic_user_count
  FROM movies m LEFT JOIN by_title_year t ON t.tmdb_id = m.tmdb_id AND m.title <> ''"""
SQL["enrich_by_candidates"] = _with(MOVIES, OMDB, TOMATOES, TITLED, BY_CANDIDATES) + """SELECT m.tmdb_id,
  rt_critic_score, rt_critic_count, rt_user_score, rt_user_count
  FROM movies m LEFT JOIN by_candidates t ON t.tmdb_id = m.tmdb_id AND m.title <> ''"""
SQL["enrich_all_sources"] = _with(*ENRICHED) + f"""SELECT m.* EXCLUDE (known_year, o_orderpriority, o_custkey),
  o.* EXCLUDE (imdb_id), CASE WHEN o.omdb_title IS NOT NULL THEN {_RUN} END AS omdb_enhanced_at,
  t.* EXCLUDE (tmdb_id), CASE WHEN t.tmdb_id IS NOT NULL THEN 'metacritic' END AS metacritic_data_source,
  CASE WHEN t.tmdb_id IS NOT NULL THEN {_RUN} END AS metacritic_enhanced_at,
  c.* EXCLUDE (tmdb_id), CASE WHEN c.tmdb_id IS NOT NULL THEN 'rottentomatoes' END AS rt_data_source,
  CASE WHEN c.tmdb_id IS NOT NULL THEN {_RUN} END AS rt_enhanced_at
  FROM movies m LEFT JOIN omdb o ON o.imdb_id = m.imdb_id LEFT JOIN by_title_year t ON t.tmdb_id = m.tmdb_id
  LEFT JOIN by_candidates c ON c.tmdb_id = m.tmdb_id"""
SQL["registered_source"] = _with(MOVIES) + f"""SELECT m.tmdb_id, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance,
  CASE WHEN c_acctbal >= 0 THEN 'ledger' END AS balance_source,
  CASE WHEN c_acctbal >= 0 THEN {_RUN} END AS balance_at
  FROM movies m LEFT JOIN customer ON m.imdb_id = 'tt' || lpad(c_custkey::VARCHAR, 7, '0')"""
COMPARED = """compared AS (
  SELECT tm.tmdb_id, tm.title, tm.vote_average AS tmdb_rating, om.omdb_imdb_rating AS imdb_rating,
    mr.critic_score AS metacritic_score, rt.critic_score AS rt_score
  FROM movies tm LEFT JOIN omdb om ON tm.imdb_id = om.imdb_id
  LEFT JOIN (SELECT o_orderkey AS tmdb_id,
    CASE WHEN o_orderstatus <> 'P' THEN floor(o_totalprice / 5000) END AS critic_score FROM orders) mr
    ON tm.tmdb_id = mr.tmdb_id
  LEFT JOIN (SELECT o_orderkey AS tmdb_id,
    CASE WHEN o_orderpriority <> '2-HIGH' THEN (o_custkey % 101)::DOUBLE END AS critic_score FROM orders) rt
    ON tm.tmdb_id = rt.tmdb_id
  WHERE tm.vote_count > 500)"""
SQL["compare_sources"] = _with(MOVIES, OMDB) + """SELECT tm.title, tm.vote_average AS tmdb_rating,
  om.omdb_imdb_rating AS imdb_rating, mr.l_quantity AS metacritic_score, rt.c_acctbal AS rt_score
  FROM movies tm LEFT JOIN omdb om ON tm.imdb_id = om.imdb_id
  LEFT JOIN lineitem mr ON tm.tmdb_id = mr.l_orderkey
  LEFT JOIN customer rt ON tm.tmdb_id = rt.c_custkey
  WHERE tm.vote_count > 500"""
SQL["compare_sources_sql"] = SQL["compare_sources"]
SQL["compare_written_tables"] = _with(*ENRICHED) + """SELECT m.title, m.vote_average AS tmdb_rating, om.rating AS imdb_rating,
  t.metacritic_critic_score AS metacritic_score, c.rt_critic_score AS rt_score
  FROM movies m
  LEFT JOIN (SELECT m.imdb_id, o.omdb_imdb_rating AS rating FROM movies m LEFT JOIN omdb o USING (imdb_id)
    WHERE m.imdb_id <> '') om USING (imdb_id)
  LEFT JOIN by_title_year t ON t.tmdb_id = m.tmdb_id LEFT JOIN by_candidates c ON c.tmdb_id = m.tmdb_id
  WHERE m.vote_count > 500"""
SQL["rating_differences"] = _with(MOVIES, OMDB, COMPARED) + """SELECT title,
  round(tmdb_rating * 10 - imdb_rating * 10, 4) AS tmdb_rating_vs_imdb_rating,
  round(tmdb_rating * 10 - metacritic_score, 4) AS tmdb_rating_vs_metacritic_score,
  round(tmdb_rating * 10 - rt_score, 4) AS tmdb_rating_vs_rt_score,
  round(imdb_rating * 10 - metacritic_score, 4) AS imdb_rating_vs_metacritic_score,
  round(imdb_rating * 10 - rt_score, 4) AS imdb_rating_vs_rt_score,
  round(metacritic_score - rt_score, 4) AS metacritic_score_vs_rt_score
  FROM compared"""
_PAIR = """SELECT '{a}' AS source_a, '{b}' AS source_b, count({a} + {b}) AS movies,
  round(avg({a} * {x} - {b} * {y}), 4) AS mean_difference, round(corr({a}, {b}), 4) AS correlation FROM compared"""
_SCALE = {"tmdb_rating": 10, "imdb_rating": 10, "metacritic_score": 1, "rt_score": 1}
SQL["source_agreement"] = _with(MOVIES, OMDB, COMPARED) + " UNION ALL ".join(
    _PAIR.format(a=a, b=b, x=_SCALE[a], y=_SCALE[b])
    for i, a in enumerate(_SCALE) for b in list(_SCALE)[i + 1:]
)
_LEADERS = """leaders AS (
  SELECT key AS leader_key, person AS leader FROM seen GROUP BY key, person ORDER BY count(*) DESC, person, key LIMIT 10)"""
SQL["leader_network"] = _with(CREDITS, _LEADERS) + """SELECT leader_key, leader, b.key AS partner_key, b.person AS partner,
  count(*) AS shared_movies
  FROM leaders JOIN seen a ON a.key = leader_key JOIN seen b ON b.tmdb_id = a.tmdb_id AND b.key <> leader_key
  GROUP BY ALL"""
SQL["collaboration_strength"] = _with(CREDITS) + """SELECT key, person, count(*) AS movies,
  sum(people - 1)::BIGINT AS shared_appearances, max(people - 1) AS most_partners
  FROM seen JOIN (SELECT tmdb_id, count(*) AS people FROM seen GROUP BY tmdb_id) USING (tmdb_id)
  GROUP BY key, person"""
SQL["director_network"] = _with(CREDITS) + """SELECT d.key AS director_key, d.person AS director, seen.key, seen.person,
  count(*) AS shared_movies
  FROM seen JOIN (SELECT DISTINCT tmdb_id, key, person FROM credits WHERE role = 'director') d USING (tmdb_id)
  GROUP BY ALL"""

# Aggregations
SQL["total_movies"] = "SELECT count(*) AS total_movies FROM orders"
SQL["year_range"] = """SELECT min(year(o_orderdate)::INT) AS min, max(year(o_orderdate)::INT) AS max,
  round(avg(year(o_orderdate)::INT), 6) AS avg FROM orders"""
SQL["rating_stats"] = """SELECT round(avg(o_totalprice), 3) AS mean, round(median(o_totalprice), 3) AS median,
  round(stddev_samp(o_totalprice), 3) AS std, min(o_totalprice) AS min, max(o_totalprice) AS max FROM orders"""
SQL["genre_distribution"] = """SELECT genre, count(*) AS movies
  FROM (SELECT unnest(string_split(p_name, ' ')) AS genre FROM part)
  GROUP BY genre ORDER BY movies DESC, genre LIMIT 10"""
SQL["director_stats"] = """SELECT l_suppkey, count(*) AS movies FROM lineitem GROUP BY l_suppkey
  ORDER BY movies DESC, l_suppkey LIMIT 10"""
SQL["country_stats"] = _with(OMDB) + """SELECT omdb_country, count(*) AS movies FROM omdb GROUP BY omdb_country
  ORDER BY movies DESC, omdb_country LIMIT 10"""
SQL["report_categories"] = _with(OMDB) + """SELECT section, value, movies, rank::INT AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY section ORDER BY movies DESC, value) AS rank FROM (
    SELECT section, value, count(*) AS movies FROM (
      SELECT 'genre_distribution' AS section, unnest(string_split(omdb_genre, ', ')) AS value FROM omdb
      UNION ALL SELECT 'director_stats', omdb_director FROM omdb
      UNION ALL SELECT 'country_stats', omdb_country FROM omdb)
    GROUP BY section, value)) WHERE rank <= 10"""
SQL["mean_of_file_means"] = """SELECT round(avg(mean), 3) AS average_rating, count(mean) AS total_ratings_analyzed
  FROM (SELECT avg(o_totalprice) AS mean FROM orders GROUP BY o_orderpriority)"""
SQL["file_statistics"] = """SELECT o_orderpriority, count(*) AS movies, count(o_totalprice) AS rated,
  round(avg(o_totalprice), 3) AS avg_rating, min(o_totalprice) AS min_rating, max(o_totalprice) AS max_rating
  FROM orders GROUP BY o_orderpriority"""
SQL["run_totals"] = """SELECT count(DISTINCT event_type) AS files_processed, count(*) AS total_movies,
  count(*) FILTER (value < 0) = 0 AS success FROM events"""
SQL["file_totals"] = "SELECT event_type, count(*) AS movies FROM events GROUP BY event_type"
SQL["coverage"] = """SELECT count(*) AS total_movies, count(*) FILTER (l_returnflag = 'A') AS omdb_enhanced,
  count(*) FILTER (l_discount > 0.05) AS metacritic_enhanced FROM lineitem"""
SQL["enrichment_coverage"] = _with(*ENRICHED) + """SELECT count(*) AS total_movies, count(o.omdb_title) AS omdb_enhanced,
  count(t.tmdb_id) AS metacritic_enhanced, count(c.tmdb_id) AS rotten_tomatoes_enhanced
  FROM movies m LEFT JOIN omdb o USING (imdb_id) LEFT JOIN by_title_year t ON t.tmdb_id = m.tmdb_id
  LEFT JOIN by_candidates c ON c.tmdb_id = m.tmdb_id"""
for _key, _roles in {
    "top_actors": "'actor'", "top_actresses": "'actress'", "top_directors": "'director'",
    "top_writers": "'writer'",
}.items():
    SQL[_key] = _with(CREDITS) + f"""SELECT key, person, count(*) AS credits, round(avg(rating), 6) AS avg_rating
  FROM credits WHERE role IN ({_roles}) GROUP BY key, person ORDER BY credits DESC, person, key LIMIT 10"""
SQL["genre_performance"] = """SELECT genre, count(*) AS movies, round(avg(p_retailprice), 4) AS avg_rating,
  max(p_retailprice) AS max_rating
  FROM (SELECT unnest(string_split(p_name, ' ')) AS genre, p_retailprice FROM part) GROUP BY genre"""
SQL["year_performance"] = """SELECT year(o_orderdate)::INT AS year, count(*) AS movies,
  round(avg(o_totalprice), 3) AS avg_rating, max(o_totalprice) AS max_rating FROM orders GROUP BY 1"""
SQL["person_ratings"] = _with(CREDITS) + """SELECT key, person, round(avg(rating), 6) AS avg_rating, count(*) AS credits
  FROM credits WHERE role IN ('actor', 'actress') GROUP BY key, person"""
SQL["cast_summary"] = _with(CREDITS) + """SELECT role, count(DISTINCT key) AS people, count(*) AS appearances
  FROM credits GROUP BY role"""
SQL["cast_totals"] = _with(CREDITS) + """SELECT
  count(DISTINCT key) FILTER (role = 'actor') AS total_actors,
  count(DISTINCT key) FILTER (role = 'actress') AS total_actresses,
  count(DISTINCT key) FILTER (role = 'director') AS total_directors,
  count(DISTINCT key) FILTER (role = 'writer') AS total_writers,
  count(DISTINCT key) FILTER (role = 'producer') AS total_producers,
  count(*) FILTER (role IN ('actor', 'actress')) AS total_cast_appearances,
  count(*) FILTER (role NOT IN ('actor', 'actress')) AS total_crew_appearances,
  (SELECT count(*) FROM (SELECT tmdb_id FROM seen GROUP BY tmdb_id HAVING count(*) > 1))
    AS total_collaboration_networks
  FROM credits"""
SQL["cast_filmographies"] = _with(CREDITS) + """SELECT DISTINCT key, person, year, 'Film ' || tmdb_id AS title, tmdb_id FROM credits
  WHERE role IN ('actor', 'actress')"""
SQL["crew_filmographies"] = _with(CREDITS) + """SELECT DISTINCT key, person, year, 'Film ' || tmdb_id AS title, tmdb_id FROM credits
  WHERE role NOT IN ('actor', 'actress')"""

# Sorts, limits, top-k, set operations
SQL["sorted_by_rating"] = _with(OMDB) + "SELECT imdb_id, omdb_imdb_rating FROM omdb"
SQL["top_movies"] = "SELECT p_name, p_retailprice, p_size FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 10"
SQL["first_of_files"] = """SELECT event_id, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS n FROM events) WHERE n <= 25"""
SQL["first_per_file"] = """SELECT event_type, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS n FROM events) WHERE n <= 25"""
SQL["concatenated_files"] = """SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'
  UNION ALL SELECT o_orderkey, NULL, o_totalprice FROM orders WHERE o_orderstatus = 'O'
  UNION ALL SELECT o_orderkey, o_custkey, NULL FROM orders WHERE o_orderstatus = 'P'"""

# Scalar functions
SQL["parsed_scores"] = """SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS rating,
  CASE WHEN c_acctbal >= 0 THEN floor(c_acctbal * 10)::BIGINT END AS votes,
  CASE WHEN c_acctbal >= 5000 THEN floor(c_acctbal / 100)::INT END AS metascore FROM customer"""
SQL["years_from_dates"] = """SELECT o_orderkey,
  CASE WHEN o_orderstatus <> 'P' THEN year(o_orderdate)::INT END AS year FROM orders"""
SQL["cut_texts"] = """SELECT doc_id, CASE WHEN length(text) <= 1000 THEN text ELSE text[1:997] || '...' END AS inside,
  CASE WHEN length(text) <= 1000 THEN text ELSE text[1:1000] || '...' END AS outside,
  CASE WHEN lang = 'en' THEN NULL WHEN length(text) <= 50 THEN text ELSE text[1:47] || '...' END AS or_null
  FROM documents"""
SQL["title_slugs"] = r"""SELECT doc_id,
  trim(regexp_replace(regexp_replace(folded, '[\s_-]+', '-', 'g'), '[^a-z0-9-]', '', 'g'), '-') AS dash,
  trim(regexp_replace(regexp_replace(folded, '[\s_-]+', '_', 'g'), '[^a-z0-9_]', '', 'g'), '_') AS line
  FROM (SELECT doc_id, lower(regexp_replace(strip_accents(text), '[^\x00-\x7F]', '', 'g')) AS folded
    FROM documents)"""
SQL["counts_in_text"] = """SELECT o_orderkey, floor(o_totalprice / 5000) AS percent,
  regexp_extract(format('{:,}', floor(o_totalprice)::BIGINT), '[0-9]+')::BIGINT AS first_run,
  floor(o_totalprice)::BIGINT AS whole_run, format('{:,}', floor(o_totalprice)::BIGINT) || '+' AS audience FROM orders"""
SQL["years_in_text"] = """SELECT o_orderkey,
  TRY_CAST(regexp_extract('No. ' || o_orderkey || ' of ' || strftime(o_orderdate, '%d.%m.%Y'),
    '(?:19|20)[0-9]{2}') AS INT) AS year,
  CASE WHEN o_orderstatus <> 'O' THEN year(o_orderdate)::INT END AS bracketed FROM orders"""
SQL["rating_lists"] = """SELECT c_custkey, CASE WHEN c_acctbal >= 0
    THEN '[{"Source":"Balance","Value":"' || c_name || '"}]' ELSE '[]' END AS ratings,
  CASE WHEN c_acctbal >= 0 THEN '[{"Source":"Balance","Value":"' || c_name || '"}]' END AS or_null FROM customer"""
SQL["file_stamps"] = "SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') AS stamp FROM events"
SQL["name_lists"] = """SELECT p_partkey, len(string_split(p_name, ' '))::INT AS words,
  replace(p_name, ' ', '|') AS names FROM part"""
for _name, _rows in (("tmdb", "table_round_trip"), ("omdb", "omdb_rows"), ("metacritic", "metacritic_rows"),
                     ("rotten_tomatoes", "rotten_tomatoes_rows")):
    SQL[f"repeated_{_name}_inserts"] = SQL[_rows]
