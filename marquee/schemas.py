"""Table layouts, source fields and limits."""

from __future__ import annotations

# --- Fixed values: table and column names, order and types, as users query them. ---

TMDB_MOVIES = (
    ("tmdb_id", "int"), ("imdb_id", "string"), ("title", "string"), ("original_title", "string"),
    ("release_date", "string"), ("year", "int"), ("overview", "string"), ("tagline", "string"),
    ("status", "string"), ("runtime", "int"), ("budget", "bigint"), ("revenue", "bigint"),
    ("popularity", "decimal(10,4)"), ("vote_average", "decimal(10,3)"), ("vote_count", "int"),
    ("genres", "array<string>"), ("genre_ids", "array<int>"), ("original_language", "string"),
    ("production_companies", "array<string>"), ("production_countries", "array<string>"),
    ("spoken_languages", "array<string>"), ("cast_data", "string"), ("crew_data", "string"),
    ("backdrop_path", "string"), ("poster_path", "string"), ("homepage", "string"),
    ("external_ids", "string"), ("data_source", "string"), ("created_at", "string"),
    ("updated_at", "string"),
)

OMDB_MOVIES = (
    ("imdb_id", "string"), ("title", "string"), ("year", "int"), ("omdb_title", "string"),
    ("rated", "string"), ("released", "string"), ("runtime", "string"), ("genre", "string"),
    ("director", "string"), ("writer", "string"), ("actors", "string"), ("plot", "string"),
    ("language", "string"), ("country", "string"), ("awards", "string"), ("poster", "string"),
    ("ratings", "string"), ("imdb_rating", "decimal(10,1)"), ("imdb_votes", "int"),
    ("metascore", "int"), ("box_office", "string"), ("production", "string"),
    ("website", "string"), ("data_source", "string"), ("created_at", "string"),
    ("updated_at", "string"),
)

METACRITIC_RATINGS = (
    ("tmdb_id", "int"), ("imdb_id", "string"), ("title", "string"), ("year", "int"),
    ("critic_score", "decimal(10,1)"), ("critic_count", "int"), ("user_score", "decimal(10,1)"),
    ("user_count", "int"), ("data_source", "string"), ("created_at", "string"),
)

# As above, but the audience count is text such as "25,000+".
ROTTEN_TOMATOES_RATINGS = tuple(
    (name, "string" if name == "user_count" else kind) for name, kind in METACRITIC_RATINGS
)

TABLES = {
    "tmdb_movies": TMDB_MOVIES,
    "omdb_movies": OMDB_MOVIES,
    "metacritic_ratings": METACRITIC_RATINGS,
    "rotten_tomatoes_ratings": ROTTEN_TOMATOES_RATINGS,
}

# Raw movie files carry the table's own fields plus `id`, an older name of `tmdb_id`.
RAW_MOVIE = (("id", "int"),) + tuple(
    field for field in TMDB_MOVIES if field[0] not in ("data_source", "created_at", "updated_at")
)

# Response field, enriched field, parser of its text ("text" keeps it as it is).
OMDB_FIELDS = (
    ("Title", "omdb_title", "text"),
    ("Rated", "omdb_rated", "text"),
    ("Released", "omdb_released", "text"),
    ("Runtime", "omdb_runtime", "text"),
    ("Genre", "omdb_genre", "text"),
    ("Director", "omdb_director", "text"),
    ("Writer", "omdb_writer", "text"),
    ("Actors", "omdb_actors", "text"),
    ("Plot", "omdb_plot", "text"),
    ("Language", "omdb_language", "text"),
    ("Country", "omdb_country", "text"),
    ("Awards", "omdb_awards", "text"),
    ("Poster", "omdb_poster", "text"),
    ("Ratings", "omdb_ratings", "list"),
    ("imdbRating", "omdb_imdb_rating", "rating"),
    ("imdbVotes", "omdb_imdb_votes", "votes"),
    ("Metascore", "omdb_metascore", "metascore"),
    ("BoxOffice", "omdb_box_office", "text"),
    ("Production", "omdb_production", "text"),
    ("Website", "omdb_website", "text"),
)

RATINGS_TYPE = "array<struct<Source:string,Value:string>>"
CAST_TYPE = "array<struct<id:bigint,name:string,gender:int,order:int>>"
CREW_TYPE = "array<struct<id:bigint,name:string,job:string>>"

YEAR_TOLERANCE = 3
MAX_TEXT = 1000
RATING_RANGE = (0.0, 10.0)
YEAR_RANGE = (1900, 2030)
FILE_STAMP = "yyyyMMdd_HHmmss"
RAW_FILE_GLOB = "tmdb_*.json"

# --- End of fixed values. ---

OMDB_RESPONSE = (
    (("imdbID", "string"), ("Response", "string"))
    + tuple((name, RATINGS_TYPE if kind == "list" else "string") for name, _, kind in OMDB_FIELDS)
)


def ddl(fields) -> str:
    """Column list as a DDL string, as readers and CREATE TABLE take it."""
    return ", ".join(f"`{name}` {kind}" for name, kind in fields)
