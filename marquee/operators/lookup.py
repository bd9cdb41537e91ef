"""Left lookups that stay right and even-sized when keys repeat or are missing."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Lookup:
    """Rows to look up. `fields` maps their columns to the names they get; by default all
    but the keys. `prefer` orders the rows of a key: the least one is taken, and counts as
    found only if its `gate` column has a value. `unique` says that no key repeats, which is
    checked; such rows are joined as they are."""

    rows: DataFrame
    fields: dict[str, str] | None = None
    prefer: tuple[str, ...] = ()
    gate: str | None = None
    unique: bool = False

    def named(self, keys: list[str]) -> dict[str, str]:
        fields = self.fields or {c: c for c in self.rows.columns if c not in keys}
        if self.gate and self.gate not in fields:
            raise ValueError(f"the gate column must be among the fields: {self.gate}")
        return fields


def _usable(df: DataFrame, keys: list[str]) -> Column:
    """True where every key has a value; an empty string counts as none."""
    kinds = dict(df.dtypes)
    filled = (
        F.coalesce(F.col(key) != "", F.lit(False)) if kinds[key] == "string"
        else F.col(key).isNotNull()
        for key in keys
    )
    return reduce(and_, filled)


def one_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """The least row of every key, and every row without one.

    A minimum of structs, so map tasks reduce a repeated key before the shuffle and a rerun
    picks the same row. Rows in which a part of the key is null or empty are no duplicates
    of each other.
    """
    others = [name for name in df.columns if name not in keys]
    keyed = df.filter(_usable(df, keys)).groupBy(*keys).agg(F.min(F.struct(*others)).alias("row"))
    return keyed.select(*keys, "row.*").unionByName(df.filter(~_usable(df, keys)))


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def table_join(left: DataFrame, entries: DataFrame, keys: list[str], *found: Column) -> DataFrame:
    """Left join to the entries reduced to one row per key by the aggregates `found`.

    `_spread` is part of the join key. Left rows without a key cannot match; it divides them
    by the partition they come from, so they do not meet in one task. It also makes Spark
    shuffle the reduced rows for the join itself, which the adaptive skew join needs in order
    to split a key that fills much of the left side. The right side is broadcast only if its
    size is under the session's threshold.
    """
    table = entries.filter(_usable(entries, keys)).groupBy(*keys).agg(
        *found,
        # A plain constant would be optimized out of the join key.
        F.min(F.lit(0)).alias("_spread"),
    )
    spread = F.when(_usable(left, keys), F.lit(0)).otherwise(F.spark_partition_id() + 1)
    return left.withColumn("_spread", spread).join(table, [*keys, "_spread"], "left")


def unique_join(left: DataFrame, keys: list[str], lookup: Lookup) -> DataFrame:
    """Left join to rows of which no key repeats: one shuffle of each side, and columns that
    nobody reads are not read. A job over the keys alone fails if one repeats.

    `_spread` divides left rows without a key, as in `table_join`.
    """
    fields = lookup.named(keys)
    check_names(left, list(fields.values()))
    rows = lookup.rows.filter(_usable(lookup.rows, keys))
    if not rows.groupBy(*keys).count().filter("count > 1").isEmpty():
        raise ValueError(f"a key of a lookup declared unique repeats: {', '.join(keys)}")
    if lookup.gate:
        rows = rows.filter(F.col(lookup.gate).isNotNull())
    # Always 0, but no constant that would be optimized out of the join key.
    zero = F.pmod(F.xxhash64(*keys), F.lit(1)).cast("int")
    table = rows.select(*keys, zero.alias("_spread"), *(F.col(old).alias(new) for old, new in fields.items()))
    spread = F.when(_usable(left, keys), F.lit(0)).otherwise(F.spark_partition_id() + 1)
    joined = left.withColumn("_spread", spread).join(table, [*keys, "_spread"], "left")
    return joined.select(*left.columns, *fields.values())


def gated(row: Column, names: list[str], gate: str | None) -> list[Column]:
    """Fields of a found row, null unless its gate has a value."""
    if gate:
        row = F.when(row[gate].isNotNull(), row)
    return [row[name].alias(name) for name in names]


def check_names(left: DataFrame, new: list[str]) -> None:
    taken = sorted(set(left.columns) & set(new))
    if taken or len(set(new)) < len(new):
        raise ValueError(f"columns named twice: {taken or new}")


def lookup_join(left: DataFrame, keys: list[str], *lookups: Lookup) -> DataFrame:
    """Left join to one row per key of each lookup, so the left row count never changes.

    All lookups on the same keys share one shuffle of the left side. Their rows are reduced
    to one per key first, which also bounds a key that repeats on both sides.
    """
    for lookup in (x for x in lookups if x.unique):
        left = unique_join(left, keys, lookup)
    lookups = tuple(x for x in lookups if not x.unique)
    if not lookups:
        return left
    names = [lookup.named(keys) for lookup in lookups]
    check_names(left, [name for fields in names for name in fields.values()])

    def packed(i: int) -> DataFrame:
        rows, fields, prefer = lookups[i].rows, names[i], lookups[i].prefer
        row = F.struct(*(F.col(old).alias(name) for old, name in fields.items()))
        return rows.select(*keys, F.struct(*prefer, row.alias("row")).alias(f"_found{i}"))

    each = range(len(lookups))
    least = [F.min(f"_found{i}").alias(f"_found{i}") for i in each]
    joined = table_join(left, union_all([packed(i) for i in each]), keys, *least)
    found = (
        gated(F.col(f"_found{i}.row"), list(names[i].values()), names[i].get(lookups[i].gate))
        for i in each
    )
    return joined.select(*left.columns, *(column for columns in found for column in columns))
