"""Ingestion runs, from raw movie files to enriched files and tables."""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.analysis import enrichment_coverage, file_totals, run_totals
from ..operators.conform import field, stamp, to_single_table
from ..operators.enrich import enrich_all
from ..operators.quality import abort_on_error, error_counts, validate
from ..operators.ranking import first_of_files
from ..sources.files import CORRUPT, output_files, read_movie_files, split_malformed, write_enhanced
from ..sources.tables import DATABASE, Inserted, append, insert_all


@dataclass(frozen=True)
class IngestResult:
    """What one run did. The frames read the run's written output: `files` counts movies by
    input file, `output_files` by file written, `inserted` by table with the error of one
    that failed."""

    movies: DataFrame
    malformed: DataFrame
    totals: DataFrame
    files: DataFrame
    output_files: DataFrame
    statistics: DataFrame
    errors: DataFrame
    inserted: DataFrame
    tables: dict[str, Inserted]
    success: bool


def _raw(spark, folder, max_movies, run_at, lines, strict) -> DataFrame:
    movies = read_movie_files(spark, folder, lines=lines, strict=strict, with_origin=True)
    return stamp(first_of_files(movies, max_movies), "tmdb", run_at)


def _written(
    spark: SparkSession, enriched: DataFrame, output: str, run_stamp: str, prefix: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The enriched movies and the malformed rows, written once and read back: later steps
    start from the files, so losing an executor does not bring the joins back."""
    staged = os.path.join(output, "staged", f"{prefix}_{run_stamp}")
    enriched.withColumn(CORRUPT, field(enriched, CORRUPT)).write.mode("error").parquet(staged)
    movies, malformed = split_malformed(spark.read.parquet(staged))
    folder = write_enhanced(movies.drop("ordinal"), os.path.join(output, "files"), run_stamp, prefix)
    return movies, malformed, output_files(spark, folder, run_stamp, prefix)


def _result(
    movies: DataFrame, malformed: DataFrame, written: DataFrame, tables: dict[str, Inserted]
) -> IngestResult:
    success = all(t.ok for t in tables.values()) and malformed.isEmpty()
    inserted = movies.sparkSession.createDataFrame(
        [(name, t.rows, t.error) for name, t in tables.items()], "table_name string, rows bigint, error string"
    )
    return IngestResult(
        movies=movies,
        malformed=malformed,
        totals=run_totals(movies, "source_file").withColumn("success", F.lit(success)),
        files=file_totals(movies, "source_file"),
        output_files=written,
        inserted=inserted,
        statistics=enrichment_coverage(movies),
        errors=error_counts(validate(movies)),
        tables=tables,
        success=success,
    )


def comprehensive_ingest(
    spark: SparkSession,
    folder: str,
    output: str,
    run_at: str,
    run_stamp: str,
    omdb: DataFrame | None = None,
    metacritic: DataFrame | None = None,
    rotten_tomatoes: DataFrame | None = None,
    max_movies: int | None = None,
    database: str = DATABASE,
    lines: bool = False,
    prefix: str = "comprehensive_enhanced",
    once: bool = False,
) -> IngestResult:
    """All sources into files and the four tables. Malformed input is set apart, a movie
    that no source knows stays as it is, and a failing table does not stop the others. With
    `once`, tables get no row again that this run (`run_at`) has written before."""
    raw = _raw(spark, folder, max_movies, run_at, lines, strict=False)
    enriched = enrich_all(raw, run_at, omdb, metacritic, rotten_tomatoes)
    movies, malformed, written = _written(spark, enriched, output, run_stamp, prefix)
    return _result(movies, malformed, written, insert_all(movies, run_at, database, once=once))


def single_source_ingest(
    spark: SparkSession,
    folder: str,
    output: str,
    run_at: str,
    run_stamp: str,
    omdb: DataFrame,
    max_movies: int | None = None,
    database: str = DATABASE,
    lines: bool = False,
    strict_records: bool = False,
    prefix: str = "enhanced",
) -> IngestResult:
    """Key lookups only, into `omdb_movies`. The first malformed file ends the run; with
    `strict_records`, so does the first record that fails validation."""
    raw = _raw(spark, folder, max_movies, run_at, lines, strict=True)
    enriched = enrich_all(raw, run_at, omdb)
    if strict_records:
        enriched = abort_on_error(validate(enriched)).drop("errors")
    movies, malformed, written = _written(spark, enriched, output, run_stamp, prefix)
    rows = append(to_single_table(movies, run_at), "omdb_movies", database)
    return _result(movies, malformed, written, {"omdb_movies": Inserted(rows)})
