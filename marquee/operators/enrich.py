"""Enrichment of movies from snapshots of the scoring sources. Every movie survives."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field as setting

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import title_slug
from ..schemas import YEAR_TOLERANCE
from .conform import field, known_year, omdb_fields, title_or
from .lookup import Lookup, check_names, gated, lookup_join, table_join, union_all

_SLUG, _YEAR, _SPAN = "_slug", "_year", "_span"


def enrich_by_key(
    movies: DataFrame, records: DataFrame, key: str = "imdb_id", unique: bool = False
) -> DataFrame:
    """Columns of the record with the movie's id; a movie without id or record keeps nulls.
    `unique` records must not repeat an id."""
    return lookup_join(movies, [key], Lookup(records, unique=unique))


@dataclass(frozen=True)
class PageLookup:
    """Pages as entries: a slug, the years `_first` to `_last` it answers, the year `_stated`,
    the `_rank` of the rule, and fields. `tolerance` bounds the distance of those years."""

    entries: DataFrame
    fields: dict[str, str]
    tolerance: int
    gate: str | None


def _stated_years(pages: DataFrame, year: str) -> DataFrame:
    """One row per page and year it states; a long, so that no tolerance overflows."""
    if "years" in pages.columns:
        return pages.withColumn("_stated", F.explode(F.col("years").cast("array<bigint>")))
    return pages.withColumn("_stated", F.col(year).cast("bigint")).filter("_stated is not null")


def _dashed(slug: Column, sep: str) -> Column:
    """The slug with dashes, so that all sources share one key. One with a dash of its own
    answers no title if the source joins words by another mark."""
    if sep == "-":
        return slug
    return F.when(~F.contains(slug, F.lit("-")), F.translate(slug, sep, "-"))


def title_year_lookup(
    pages: DataFrame,
    fields: dict[str, str],
    sep: str = "-",
    tolerance: int = YEAR_TOLERANCE,
    gate: str | None = "critic_score",
    slug: str = "slug",
    page_year: str = "year",
) -> PageLookup:
    """Pages that answer their slug in the years around the one they state. Of several
    pages the nearest year wins."""
    entries = _stated_years(pages, page_year).select(
        _dashed(F.col(slug), sep).alias(_SLUG), F.lit(1).alias("_rank"),
        (F.col("_stated") - tolerance).alias("_first"),
        (F.col("_stated") + tolerance).alias("_last"), "_stated", *fields,
    )
    return PageLookup(entries, fields, tolerance, gate)


def candidates_lookup(
    pages: DataFrame,
    fields: dict[str, str],
    sep: str = "_",
    tolerance: int = YEAR_TOLERANCE,
    gate: str | None = "critic_score",
    slug: str = "slug",
    page_title: str = "title",
    page_year: str = "year",
    scorecard: str = "has_scorecard",
) -> PageLookup:
    """Pages under each title slug and the years they answer, with the rank of the rule.

    A movie takes the first of three candidates that has a scorecard and a near year: the
    page at its slug, the page at slug plus year, the page whose own title reads the same.
    Turned round, the rules give entries whose least rank is the answer, so movies need no
    copy per candidate and no ranking window.
    """
    usable = pages.filter(F.col(scorecard)) if scorecard in pages.columns else pages
    parts = rf"^(.*){sep}([0-9]{{4}})$"
    # Computed once per page, before the rules refer to them several times.
    keyed = _stated_years(usable, page_year).select(
        "_stated", *fields,
        _dashed(F.col(slug), sep).alias("_own"),
        _dashed(F.regexp_extract(F.col(slug), parts, 1), sep).alias("_undated"),
        F.regexp_extract(F.col(slug), parts, 2).try_cast("bigint").alias("_dated"),
        title_slug(field(pages, page_title)).alias("_read"),
    )
    low, high = F.col("_stated") - tolerance, F.col("_stated") + tolerance
    dated = F.col("_dated")

    def rule(rank: int, key: str, first: Column, last: Column) -> Column:
        return F.struct(
            F.col(key).alias(_SLUG), F.lit(rank).alias("_rank"),
            first.alias("_first"), last.alias("_last"),
        )

    rules = F.array(
        rule(1, "_own", low, high),
        F.when(dated.between(low, high), rule(2, "_undated", dated, dated)),
        F.when(~F.col("_read").eqNullSafe(F.col("_own")), rule(3, "_read", low, high)),
    )
    entries = keyed.select("_stated", *fields, F.inline(rules))
    return PageLookup(entries, fields, tolerance, gate)


def match_titles(
    movies: DataFrame, *lookups: PageLookup, title: Column | None = None, year: Column | None = None
) -> DataFrame:
    """Join movies with a title and a year to the best entry of each lookup.

    Years are cut into spans as long as the widest range, so that an entry belongs to two
    spans at most and the range condition becomes an equality of slug and span. Entries of
    one slug, rule and year are reduced to one first; what is left of a slug in a span is a
    short list by construction, from which each movie picks by its own year. A slug shared
    by many movies and many pages therefore never pairs them all.
    """
    title = title if title is not None else title_or(movies, "title", "omdb_title")
    year = year if year is not None else known_year(movies)
    names = [list(lookup.fields.values()) for lookup in lookups]
    check_names(movies, [name for each in names for name in each])
    for lookup in lookups:
        if lookup.gate and lookup.gate not in lookup.fields:
            raise ValueError(f"the gate column must be among the fields: {lookup.gate}")
    width = 2 * max(lookup.tolerance for lookup in lookups) + 1

    def span(of: str) -> Column:
        return F.floor(F.col(of) / width)

    def packed(i: int) -> DataFrame:
        row = F.struct(*(F.col(old).alias(new) for old, new in lookups[i].fields.items()))
        place = ("_rank", "_first", "_last", "_stated")
        entries = lookups[i].entries.filter(F.col(_SLUG) != "")
        return (
            entries.groupBy(_SLUG, *place).agg(F.min(row).alias("row"))
            .withColumn(_SPAN, F.explode(F.sequence(span("_first"), span("_last"))))
            .select(_SLUG, _SPAN, F.struct(*place, "row").alias(f"_found{i}"))
        )

    each = range(len(lookups))
    lists = [F.collect_list(f"_found{i}").alias(f"_found{i}") for i in each]
    keyed = movies.withColumns({_SLUG: title_slug(title), _YEAR: year.cast("bigint")})
    joined = table_join(
        keyed.withColumn(_SPAN, span(_YEAR)), union_all([packed(i) for i in each]),
        [_SLUG, _SPAN], *lists,
    )

    def best(i: int) -> Column:
        near = F.filter(f"_found{i}", lambda x: F.col(_YEAR).between(x["_first"], x["_last"]))
        return F.array_min(F.transform(near, lambda x: F.struct(
            x["_rank"], F.abs(x["_stated"] - F.col(_YEAR)).alias("gap"), x["_stated"], x["row"]
        )))["row"]

    # One projection finds the row, the next reads its fields.
    found = joined.select(*movies.columns, *(best(i).alias(f"_best{i}") for i in each))
    read = (
        gated(F.col(f"_best{i}"), names[i], lookups[i].fields.get(lookups[i].gate)) for i in each
    )
    return found.select(*movies.columns, *(column for columns in read for column in columns))


def enrich_by_title_year(
    movies: DataFrame, pages: DataFrame, fields: dict[str, str], **options
) -> DataFrame:
    """Page with the movie's title slug and a year within the tolerance; `fields` maps page
    columns to the columns added. Options are those of `title_year_lookup`."""
    return match_titles(movies, title_year_lookup(pages, fields, **options))


def enrich_by_candidates(
    movies: DataFrame, pages: DataFrame, fields: dict[str, str], **options
) -> DataFrame:
    """First fitting of a movie's candidate pages. Options are those of `candidates_lookup`."""
    return match_titles(movies, candidates_lookup(pages, fields, **options))


@dataclass(frozen=True)
class ScoreSource:
    """How one source's snapshot is read and matched.

    `match` is "id", "title_year" or "candidates"; `extractor` turns the raw snapshot (say
    crawled pages) into matchable rows. A snapshot by id may be declared `unique`.
    """

    name: str
    match: str
    fields: dict[str, str] = setting(default_factory=dict)
    extractor: Callable[[DataFrame], DataFrame] = lambda df: df
    sep: str = "-"
    gate: str | None = "critic_score"
    key: str = "imdb_id"
    labels: dict[str, str] = setting(default_factory=dict)
    enhanced_at: str | None = None
    unique: bool = False

    @property
    def hit(self) -> str:
        return f"_hit_{self.name}"

    def lookup(self, snapshot: DataFrame) -> Lookup | PageLookup:
        rows = self.extractor(snapshot).withColumn(self.hit, F.lit(True))
        fields = self.fields or {c: c for c in rows.columns if c not in (self.key, self.hit)}
        fields = {**fields, self.hit: self.hit}
        if self.match == "id":
            return Lookup(rows, fields, gate=self.gate, unique=self.unique)
        build = title_year_lookup if self.match == "title_year" else candidates_lookup
        return build(rows, fields, sep=self.sep, gate=self.gate)

    def marked(self, movies: DataFrame, run_at: str) -> DataFrame:
        marks = dict(self.labels)
        if self.enhanced_at:
            marks[self.enhanced_at] = run_at
        return movies.withColumns(
            {name: F.when(F.col(self.hit), F.lit(text)) for name, text in marks.items()}
        ).drop(self.hit)


SOURCES: dict[str, ScoreSource] = {}


def register_source(source: ScoreSource) -> ScoreSource:
    if source.match not in ("id", "title_year", "candidates"):
        raise ValueError(f"unknown match kind: {source.match}")
    SOURCES[source.name] = source
    return source


OMDB = register_source(ScoreSource(
    name="omdb", match="id", extractor=omdb_fields, gate=None, enhanced_at="omdb_enhanced_at",
))

METACRITIC = register_source(ScoreSource(
    name="metacritic", match="title_year", sep="-",
    fields={name: f"metacritic_{name}"
            for name in ("critic_score", "critic_count", "user_score", "user_count")},
    labels={"metacritic_data_source": "metacritic"}, enhanced_at="metacritic_enhanced_at",
))

ROTTEN_TOMATOES = register_source(ScoreSource(
    name="rottentomatoes", match="candidates", sep="_",
    fields={name: f"rt_{name}"
            for name in ("critic_score", "critic_count", "user_score", "user_count")},
    labels={"rt_data_source": "rottentomatoes"}, enhanced_at="rt_enhanced_at",
))


def enrich(movies: DataFrame, run_at: str, snapshots: dict[str, DataFrame]) -> DataFrame:
    """Enrichment by registered sources, `name: snapshot`. Sources by id come first, since
    their title stands in for a missing one; those by title then share one join."""
    chosen = [SOURCES[name] for name in snapshots]
    for source in chosen:
        if source.match == "id":
            movies = lookup_join(movies, [source.key], source.lookup(snapshots[source.name]))
            movies = source.marked(movies, run_at)
    titled = [source for source in chosen if source.match != "id"]
    if titled:
        movies = match_titles(movies, *(source.lookup(snapshots[source.name]) for source in titled))
    for source in titled:
        movies = source.marked(movies, run_at)
    return movies


def enrich_all(
    movies: DataFrame,
    run_at: str,
    omdb: DataFrame | None = None,
    metacritic: DataFrame | None = None,
    rotten_tomatoes: DataFrame | None = None,
) -> DataFrame:
    """The three sources; one without a snapshot is left out."""
    snapshots = {"omdb": omdb, "metacritic": metacritic, "rottentomatoes": rotten_tomatoes}
    return enrich(movies, run_at, {n: s for n, s in snapshots.items() if s is not None})
