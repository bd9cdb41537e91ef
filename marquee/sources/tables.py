"""The four year-partitioned tables: create, append, scan, inspect."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ..operators.conform import PROJECTIONS, conform
from ..operators.lookup import one_per_key
from ..schemas import TABLES, ddl
from .files import session_settings, shuffles_freed

DATABASE = "movies_stage"
_PIECE = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
#: What a task writes at a time to a table whose files are bounded: each small file takes its time.
BOUNDED_PIECE = "8MB"


def create_database(spark: SparkSession, database: str = DATABASE, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")


def create_table(
    spark: SparkSession, table: str, database: str = DATABASE, format: str = "parquet",
    location: str | None = None, max_records_per_file: int | None = None,
) -> None:
    """One table, unless it exists. `max_records_per_file` bounds each file that is written."""
    place = f" LOCATION '{location}/{table}'" if location else ""
    bound = f" OPTIONS (maxRecordsPerFile '{max_records_per_file}')" if max_records_per_file else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {database}.{table} ({ddl(TABLES[table])}) "
        f"USING {format}{bound} PARTITIONED BY (year){place}"
    )


def create_all_tables(
    spark: SparkSession, database: str = DATABASE, format: str = "parquet",
    location: str | None = None, max_records_per_file: int | None = None,
) -> DataFrame:
    create_database(spark, database, location)
    for table in TABLES:
        create_table(spark, table, database, format, location, max_records_per_file)
    return table_info(spark, database)


def read_table(spark: SparkSession, table: str, database: str = DATABASE) -> DataFrame:
    """The table with its columns in declared order (the partition column is stored last)."""
    return spark.table(f"{database}.{table}").select(*(name for name, _ in TABLES[table]))


def _marks(columns: list[str]) -> list:
    """Two 64-bit hashes that stand for a row."""
    return [F.xxhash64(*columns).alias("_m1"), F.xxhash64(F.lit("second"), *columns).alias("_m2")]


def _year_sums(rows: DataFrame, columns: list[str]) -> set[tuple]:
    """Year, number of rows and the exact sums of their marks, which stand for the rows of a year."""
    sums = (F.sum(mark.cast("decimal(20,0)")) for mark in _marks(columns))
    return {tuple(r) for r in rows.groupBy("year").agg(F.count(F.lit(1)), *sums).collect()}


def _of_years(years: set) -> Column:
    named = F.col("year").isin(sorted(y for y in years if y is not None))
    return named | F.col("year").isNull() if None in years else named


def not_yet_in(rows: DataFrame, table: str, database: str = DATABASE) -> DataFrame:
    """Rows that the table does not have, all columns alike.

    Since the time of the run is one of them, these are the rows that an earlier attempt of the
    same run did not write. Only the years of the batch are read, of those the rows of its runs.
    Rows are moved only where they must be compared: not if the table has none of these runs, and
    not for a year of which it has just the rows of the batch.
    """
    columns = [name for name, _ in TABLES[table]]
    found = rows.select("year", "created_at").distinct().collect()  # one for each run and partition of the table
    runs = sorted({r.created_at for r in found if r.created_at is not None})
    in_runs = F.col("created_at").isin(runs) if all(r.created_at is not None for r in found) else F.lit(True)
    years = {r.year for r in found}
    held = spark_table(rows.sparkSession, table, database).filter(_of_years(years) & in_runs)
    if held.isEmpty():
        return rows
    whole = {year for year, *_ in _year_sums(rows, columns) & _year_sums(held, columns)}
    if whole == years:
        return rows.limit(0)
    if whole:
        rows, held = rows.filter(_of_years(years - whole)), held.filter(_of_years(years - whole))
    held = held.select(F.col("year").alias("_year"), *_marks(columns))
    named = rows.select("*", *(m.alias(f"_own{i}") for i, m in enumerate(_marks(columns))))
    same = F.col("year").eqNullSafe(F.col("_year")) & (F.col("_own0") == F.col("_m1")) & (F.col("_own1") == F.col("_m2"))
    return named.join(held, same, "left_anti").drop("_own0", "_own1")


def spark_table(spark: SparkSession, table: str, database: str) -> DataFrame:
    """The table as it is now, whatever this session has read of it before."""
    spark.catalog.refreshTable(f"{database}.{table}")
    return spark.table(f"{database}.{table}")


def _pieces(spark: SparkSession, table: str, database: str) -> dict[str, str]:
    """Settings of a write: smaller pieces where the table bounds its files, unless the session names a size."""
    stored = spark.sql(f"DESCRIBE TABLE EXTENDED {database}.{table}").filter("col_name = 'Storage Properties'").collect()
    bounded = any("maxrecordsperfile" in r.data_type.lower() for r in stored)
    return {_PIECE: BOUNDED_PIECE} if bounded and spark.conf.get(_PIECE, None) is None else {}


def append(
    rows: DataFrame, table: str, database: str = DATABASE, dedupe_keys: list[str] | None = None,
    once: bool = False,
) -> int:
    """Add rows in one distributed write, and tell how many.

    Rows are gathered by year so that a year has few files; the rebalance divides a large
    year, sooner where the table bounds its files. Appending twice duplicates rows, as an INSERT
    does, unless `once` leaves out those that the same run has written before; `dedupe_keys` keeps
    one row per key of this batch, and all rows without one. The rows are counted by the write.
    """
    if dedupe_keys:
        rows = one_per_key(rows, dedupe_keys)
    shaped = conform(rows, TABLES[table])
    stored = [name for name, _ in TABLES[table] if name != "year"] + ["year"]
    written = Observation()
    spark = rows.sparkSession
    with shuffles_freed(spark), session_settings(spark, _pieces(spark, table, database)):
        if once:
            shaped = not_yet_in(shaped, table, database)
        gathered = shaped.select(*stored).hint("rebalance", "year")
        gathered.observe(written, F.count(F.lit(1)).alias("rows")).write.insertInto(f"{database}.{table}")
    return written.get["rows"]


@dataclass(frozen=True)
class Inserted:
    """Rows added to a table, or why none were."""

    rows: int = 0
    error: str | None = None

    @property
    def ok(self) -> bool:
        return self.error is None


def insert_all(
    movies: DataFrame, run_at: str, database: str = DATABASE, strict: bool = False,
    tables: tuple[str, ...] = tuple(TABLES), once: bool = False,
) -> dict[str, Inserted]:
    """Project movies onto each table and append; tells what became of each table.

    The input is read once per table, so pass a written or cheap DataFrame rather than a
    long plan. Not atomic: one table's failure leaves the others written. With `once` a run may
    be repeated: each table gets what it lacks.
    """
    done = {}
    for table in tables:
        try:
            done[table] = Inserted(append(PROJECTIONS[table](movies, run_at), table, database, once=once))
        except Exception as error:
            if strict:
                raise
            done[table] = Inserted(error=f"{type(error).__name__}: {error}")
    return done


def table_info(spark: SparkSession, database: str = DATABASE) -> DataFrame:
    """Tables of the database with their columns and types, from the catalog."""
    rows = [
        (table.name, place, column.name, column.dataType, column.isPartition)
        for table in spark.catalog.listTables(database)
        for place, column in enumerate(spark.catalog.listColumns(f"{database}.{table.name}"), 1)
    ]
    return spark.createDataFrame(
        rows, "table_name string, place int, column_name string, data_type string, is_partition boolean"
    )


def table_rows(spark: SparkSession, database: str = DATABASE) -> DataFrame:
    """Number of columns and rows of each of the four tables that exists."""
    counts = [
        spark.table(f"{database}.{table}").agg(
            F.lit(table).alias("table_name"),
            F.lit(len(spark.catalog.listColumns(f"{database}.{table}"))).alias("column_count"),
            F.count(F.lit(1)).alias("row_count"),
        )
        for table in TABLES
        if spark.catalog.tableExists(f"{database}.{table}")
    ]
    first, *others = counts
    for other in others:
        first = first.unionByName(other)
    return first
