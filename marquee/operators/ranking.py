"""Sorts, limits and top-k lists. Ties are broken by a key, since rows carry no input order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def sort_by_rating(
    df: DataFrame, rating: str = "omdb_imdb_rating", tie: str = "tmdb_id", descending: bool = True
) -> DataFrame:
    """Total order by rating, a missing one counting as zero. The tie column also lets the
    range shuffle divide the rows of one frequent rating."""
    value = F.coalesce(F.col(rating), F.lit(0))
    return df.orderBy(value.desc() if descending else value.asc(), tie)


def top(df: DataFrame, k: int, by: str, *ties: str) -> DataFrame:
    """The k highest rows; rows without a value are not ranked."""
    return df.filter(F.col(by).isNotNull()).orderBy(F.col(by).desc(), *ties).limit(k)


def first_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    return df.orderBy(*order).limit(n)


def first_per_group(df: DataFrame, n: int | None, group: str, *order: str) -> DataFrame:
    """First n rows of every group (file); 0 or None keeps all.

    The first ranking runs in slices of a group, as many as the session shuffles to, so that
    each task of it gets a share of a large group and hands on n rows at most. Spark limits
    ranks in the map tasks too; where n is above its bound for that, the slices do the work.
    """
    if not n:
        return df
    split = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slices = Window.partitionBy(group, "_slice").orderBy(*order)
    whole = Window.partitionBy(group).orderBy(*order)
    return (
        df.withColumn("_slice", F.pmod(F.xxhash64(*order), F.lit(split)))
        .withColumn("_n", F.row_number().over(slices))
        .filter(F.col("_n") <= n)
        .withColumn("_n", F.row_number().over(whole))
        .filter(F.col("_n") <= n)
        .drop("_slice", "_n")
    )


def first_of_files(df: DataFrame, n: int | None, file: str = "source_file", ordinal: str = "ordinal") -> DataFrame:
    """First n rows of every file, by an `ordinal` of (block, row); 0 or None keeps all.

    Rows are counted by file and block, and the counts before a block tell whether it is kept, cut
    or dropped. Only the rows of blocks that are cut, one for each file, are ranked, each block by
    itself; all others are judged where they lie.
    """
    if not n:
        return df
    block = F.col(f"{ordinal}.block")
    counts = df.groupBy(F.col(file).alias("_file"), block.alias("_block")).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_rows").over(earlier), F.lit(0))
    wanted = counts.withColumn("_left", n - before).filter(F.col("_left") > 0)
    same = F.col(file).eqNullSafe(F.col("_file")) & block.eqNullSafe(F.col("_block"))
    marked = df.join(wanted, same)
    whole = marked.filter(F.col("_rows") <= F.col("_left")).select(*df.columns)
    rank = F.row_number().over(Window.partitionBy(file, "_block").orderBy(ordinal))
    cut = marked.filter(F.col("_rows") > F.col("_left")).withColumn("_rank", rank)
    return whole.unionByName(cut.filter(F.col("_rank") <= F.col("_left")).select(*df.columns))


def top_per_group(df: DataFrame, k: int, group: str, by: str, *ties: str) -> DataFrame:
    """The k highest rows of every group with their rank, from few groups and pre-counted rows."""
    ranked = Window.partitionBy(group).orderBy(F.col(by).desc(), *ties)
    return df.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)


def concat_all(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of all inputs, duplicates kept; columns one input lacks are null there."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first
