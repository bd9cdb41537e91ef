"""Reading tables, cutting plans with written tables, and settings that operators share."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..sources.files import shared_dir

ROWS_PER_BATCH = 500
#: Rows that may be sent to every executor; each such table here has rows of under 100 bytes.
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """`df` written to the shared folder and read again: the plan is cut, and a lost executor
    costs nothing that was done before."""
    spark = df.sparkSession
    folder = shared_dir(spark, purpose)
    df.write.option("compression", "zstd").parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def drop_stored(df: DataFrame) -> None:
    """Delete the files of a table from `stored` that nothing reads any more."""
    spark = df.sparkSession
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    for file in {os.path.dirname(f) for f in df.inputFiles()}:
        path = hadoop.Path(file)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def small_batches(spark: SparkSession) -> None:
    """Python workers get a few hundred rows at a time: whole texts may be long. A smaller
    setting of the session stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= ROWS_PER_BATCH:
        spark.conf.set(name, str(ROWS_PER_BATCH))


def sent_if_small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """`df` marked for a broadcast join if a count proves that it is small; else the join
    shuffles. `df` should be stored or cheap."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def packed(docs: DataFrame, **named: str) -> DataFrame:
    """The rows of `docs` as one column `row` beside the named columns, so that no name of a column
    can clash with those that an operator adds."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), *(
        F.col(f"`{column}`").alias(name) for name, column in named.items()
    ))


def unpacked(rows: DataFrame, docs: DataFrame, **replaced: Column) -> DataFrame:
    """The columns of `docs` again, some of them replaced."""
    return rows.select(*(
        (replaced[c] if c in replaced else F.col("row")[c]).alias(c) for c in docs.columns
    ))


def text_key(text: Column) -> tuple[Column, Column]:
    """Two 64-bit hashes that stand for a text."""
    return F.xxhash64(text), F.xxhash64(F.lit("second"), text)


def fold_of(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo the folds; null for a null id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds))
