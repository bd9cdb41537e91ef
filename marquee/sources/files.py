"""Movie files, snapshots and JSON output."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..schemas import OMDB_RESPONSE, RAW_FILE_GLOB, RAW_MOVIE, ddl
from .arrays import RANGE_BYTES, array_records

CORRUPT = "_corrupt_record"
#: The unread text of a movie, beside its typed fields.
RAW = "raw"


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the checkpoint folder that all machines share. Where the session
    names none, as in tests, and has no other machine, a temporary folder becomes its setting."""
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context._jsc.sc().isLocal():
            raise ValueError("spark.checkpoint.dir must name a shared folder")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="marquee-"))
        base = context.getCheckpointDir()
    return os.path.join(base, f"{purpose}-{uuid.uuid4().hex}")


def drop_dir(spark: SparkSession, folder: str) -> None:
    """Delete a folder of `shared_dir` that nothing reads any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def session_settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Session options for a block, after which they are as before."""
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def shuffles_freed(spark: SparkSession):
    """Queries that start and end in this block delete their shuffle files at their end. Else these
    stay until the driver's memory is collected, so those of several large writes add up on disk."""
    return session_settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def read_movie_files(
    spark: SparkSession,
    folder: str,
    glob: str = RAW_FILE_GLOB,
    fields=RAW_MOVIE,
    lines: bool = False,
    strict: bool = True,
    with_origin: bool = False,
) -> DataFrame:
    """All matching JSON files with an explicit schema; no match is an error.

    A file is one JSON array, or JSON lines with `lines`; one task reads an array file, see
    `read_records` for large ones. `strict` fails on malformed input; otherwise it is kept in
    `_corrupt_record`. `with_origin` adds `source_file` and `ordinal`, which sorts rows as
    the file has them.
    """
    schema = ddl(fields) if strict else f"{ddl(fields)}, {CORRUPT} string"
    movies = (
        spark.read.schema(schema)
        .option("multiLine", not lines)
        .option("mode", "FAILFAST" if strict else "PERMISSIVE")
        .json(os.path.join(folder, glob))
    )
    if not with_origin:
        return movies
    place = F.struct(
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return movies.select("*", F.col("_metadata.file_path").alias("source_file"), place.alias("ordinal"))


def read_records(
    spark: SparkSession,
    folder: str,
    glob: str = RAW_FILE_GLOB,
    fields=RAW_MOVIE,
    lines: bool = False,
    strict: bool = True,
    keep_raw: bool = True,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """The same files in splits, array files too, record by record.

    Typed fields come with `source_file`, `ordinal` and, with `keep_raw`, the record's text in
    `raw`, from which `write_enhanced` takes the keys that have no typed field. A file is not
    rejected for one bad record: that record, or the piece that the file cuts off, is an error if
    `strict` and else stands in `_corrupt_record`.
    """
    path = os.path.join(folder, glob)
    if lines:
        place = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
        records = spark.read.text(path).select(
            F.col("_metadata.file_path").alias("source_file"), place.alias("ordinal"), F.col("value").alias("record"),
            F.lit(True).alias("whole"),
        ).where(F.trim("record") != "")
    else:
        place = F.struct((F.col("place") - F.col("place") % range_bytes).alias("block"), F.col("place").alias("row"))
        records = array_records(spark, path, range_bytes).select("source_file", place.alias("ordinal"), "record", "whole")
    typed = F.from_json("record", f"{ddl(fields)}, {CORRUPT} string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    parsed = records.select("*", typed.alias("typed"))
    bad = ~F.col("whole") | F.col("typed").isNull() | F.col(f"typed.{CORRUPT}").isNotNull() | ~F.startswith(F.col("record"), F.lit("{"))
    if strict:
        message = F.concat(F.lit("malformed record in "), F.col("source_file"), F.lit(": "), F.substring("record", 1, 200))
        kept = parsed.where(F.when(bad, F.raise_error(message).cast("boolean")).otherwise(True))
        extra = []
    else:
        kept, extra = parsed, [F.when(bad, F.col("record")).alias(CORRUPT)]
    values = [F.when(~bad, F.col("typed")[name]).alias(name) for name, _ in fields] if not strict else [
        F.col("typed")[name].alias(name) for name, _ in fields]
    raw = [F.when(~bad, F.col("record")).alias(RAW)] if keep_raw else []
    return kept.select(*values, *extra, *raw, "source_file", "ordinal")


def with_raw_keys(typed: Column, raw: Column) -> Column:
    """JSON of a record's typed fields, and of those keys of its raw text, nested ones as they are,
    that no field with a value has."""
    known = F.to_json(typed)
    names = F.coalesce(F.json_object_keys(known), F.array().cast("array<string>"))
    others = F.map_filter(F.from_json(raw, "map<string,variant>"), lambda key, _: ~F.array_contains(names, key))
    tail = F.substr(F.to_json(others), F.lit(2))
    return F.when(F.coalesce(F.size(others), F.lit(0)) <= 0, known).when(F.size(names) == 0, F.concat(F.lit("{"), tail)).otherwise(
        F.concat(F.substr(known, F.lit(1), F.length(known) - 1), F.lit(","), tail))


def split_malformed(movies: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of a tolerant read: the parsed ones, and the raw text of the others. Pass the
    written read (as the ingestion runs do), since Spark refuses to scan raw files for the
    malformed text alone."""
    bad = F.col(CORRUPT).isNotNull()
    kept = [c for c in ("source_file", CORRUPT) if c in movies.columns]
    return movies.filter(~bad).drop(CORRUPT), movies.filter(bad).select(*kept)


def read_snapshot(spark: SparkSession, path: str, fields=OMDB_RESPONSE, format: str = "json") -> DataFrame:
    """Bulk snapshot of a source that is addressed by key: one response per row."""
    return spark.read.schema(ddl(fields)).format(format).load(path)


def read_pages(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    """Crawled pages: `url` and `html`."""
    return spark.read.format(format).load(path).select("url", "html")


def file_stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+?)(?:\.[^./]*)?$", 1)


def write_enhanced(
    movies: DataFrame,
    folder: str,
    run_stamp: str,
    prefix: str = "enhanced",
    origin: str = "source_file",
    format: str = "json",
    max_records_per_file: int = 0,
) -> str:
    """Write movies to a folder `output=<prefix>_<input stem>_<stamp>` per input file.

    One job writes all of them. Rows are gathered by input file, and the rebalance divides
    a large one among several tasks. The commit protocol publishes files only when done. Movies
    that carry their raw text keep all its keys in JSON files.
    """
    name = F.concat(F.lit(f"{prefix}_"), file_stem(F.col(origin)), F.lit(f"_{run_stamp}"))
    if RAW in movies.columns and format == "json":
        fields = F.struct(*(F.col(f"`{c}`") for c in movies.columns if c != RAW))
        rows, format = movies.select(with_raw_keys(fields, F.col(RAW)).alias("value"), name.alias("output")), "text"
    else:
        rows = movies.withColumn("output", name)
    (
        rows.hint("rebalance", "output")
        .write.partitionBy("output")
        .option("maxRecordsPerFile", max_records_per_file)
        .format(format)
        .mode("append")
        .save(folder)
    )
    return folder


def output_files(
    spark: SparkSession, folder: str, run_stamp: str, prefix: str = "enhanced", format: str = "json"
) -> DataFrame:
    """The files that a run of `write_enhanced` wrote, with their movies."""
    path = os.path.join(folder, f"output={prefix}_*_{run_stamp}")
    reader = spark.read.format(format)
    rows = (reader.schema("id bigint") if format == "json" else reader).load(path)
    return rows.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("movies"))
