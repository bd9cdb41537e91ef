"""Shards of near equal bytes that keep equal texts together: a minimax contiguous partition.

All rows of a text are one atomic group. Groups stand in the order of a hash of the text, which
every row knows by itself: no join tells a row its shard, and a shard is a fair sample of all
sources. A binary search finds the least capacity with which a greedy pass over the sizes of the
groups in order needs no more shards than there are. The shards are cut within that capacity, each
next to an even share of what is left, so that a huge group does not leave others empty.

The sizes never come to the driver. It holds a grid of cumulative sizes at certain hashes, at first
4,096 of them. A place inside a cell of several groups counts as if a group ended there, which can
only make the capacity smaller; so the search runs on the grid, and those cells that it touched are
divided further by a sum over the table of groups. Once it touches only ends of groups the answer
is exact. Each round takes a few cells for each shard, whatever the table holds.

Cases: a null text has the size 1 and is in one group with empty ones. Null ids and repeated ids are
rows like others; slots go by id (null first), then by the hash. Fewer groups than shards leave the
last shards empty, and an empty table gives an empty result. Two texts of one hash (60 bits) share a
shard, which breaks no rule. Columns of any name are kept by `sharded`, which replaces columns that
have the names it is asked to add.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from dataclasses import dataclass
from functools import reduce
from itertools import accumulate
from operator import add

from pyspark.sql import Column, DataFrame, functions as F

from .common import stored
from .numbering import numbered

SHARDS = 8
KEY_BITS = 60
CELL_BITS = 12
LAW = "bytes"


def key_of(text: Column) -> Column:
    """The first 60 bits of the text's md5; a null text is like an empty one."""
    digest = F.md5(F.coalesce(text, F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("long")


def size_of(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


@dataclass(frozen=True)
class Cell:
    """Hashes from `low` on that agree but for `bits` bits, and the groups there."""

    low: int
    bits: int
    size: int
    groups: int


def divided(groups: DataFrame, cells: list[Cell]) -> list[Cell]:
    """Each cell cut into 4,096; those without groups are left out."""
    at = F.lit(None)
    for number, cell in enumerate(cells):
        inside = F.col("key").between(cell.low, cell.low + (1 << cell.bits) - 1)
        at = F.when(inside, F.lit(number)).otherwise(at)
    low, bits = (F.element_at(F.array(*(F.lit(getattr(c, x)) for c in cells)), F.col("at") + 1) for x in ("low", "bits"))
    rest = F.greatest(bits - CELL_BITS, F.lit(0)).cast("int")
    rows = groups.select("key", "size", at.cast("int").alias("at")).where(F.col("at").isNotNull()).groupBy(
        "at", F.call_function("shiftright", F.col("key") - low, rest).alias("part")
    ).agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).collect()  # at most 4,096 for a cell
    return [
        Cell(cells[r.at].low + (r.part << (b := max(cells[r.at].bits - CELL_BITS, 0))), b, r["size"], r.n) for r in rows
    ]


class Grid:
    """Cumulative sizes at the ends of cells. `touched` gathers the cells of several groups that an
    answer fell into."""

    def __init__(self, cells: list[Cell]):
        self.cells = sorted(cells, key=lambda c: c.low)
        self.ends = [0, *accumulate(c.size for c in self.cells)]
        self.total = self.ends[-1]
        self.touched: set[int] = set()

    def _inside(self, size: int) -> bool:
        """Whether there may be an end of a group at a size that is no end of a cell."""
        number = bisect_left(self.ends, size) - 1
        if self.ends[number + 1] == size or self.cells[number].groups == 1:
            return False
        self.touched.add(number)
        return True

    def up_to(self, size: int) -> int:
        """The last end of a group that is not beyond `size`."""
        if size >= self.total:
            return self.total
        return size if self._inside(size) else self.ends[bisect_right(self.ends, size) - 1]

    def from_(self, size: int) -> int:
        """The first end of a group that is not below `size`."""
        if size <= 0:
            return 0
        return size if self._inside(size) else self.ends[bisect_left(self.ends, size)]


def fits(grid: Grid, capacity: int, shards: int) -> bool:
    end = 0
    for _ in range(shards):
        end = grid.up_to(end + capacity)
    return end == grid.total


def least_capacity(grid: Grid, shards: int) -> int:
    low, high = 0, grid.total
    while low < high:
        middle = (low + high) // 2
        if fits(grid, middle, shards):
            high = middle
        else:
            low = middle + 1
    return low


def cuts(grid: Grid, capacity: int, shards: int) -> list[int]:
    """The size up to each cut. No shard exceeds the capacity; a cut is next to an even share of
    what is left, but leaves no more than the shards after it can take."""
    earliest = [grid.total]
    for _ in range(shards - 1):
        earliest.append(grid.from_(earliest[-1] - capacity))
    earliest.reverse()
    found = [0]
    for number in range(shards - 1):
        last = found[-1]
        most, share = grid.up_to(last + capacity), last + (grid.total - last) // (shards - number)
        below, above = grid.up_to(share), grid.from_(share)
        near = below if share - below <= above - share and below > last else above
        found.append(max(earliest[number], min(most, near)))
    return found[1:]


@dataclass(frozen=True)
class Plan:
    """Rows whose hash is not below the n-th bound are in shard n or a later one."""

    capacity: int
    bounds: list[int]

    def shard(self, key: Column) -> Column:
        return reduce(add, [(key >= F.lit(b)).cast("int") for b in self.bounds], F.lit(0)).cast("int")


def minimax(groups: DataFrame, shards: int = SHARDS) -> Plan:
    """The cuts for groups (key, size) with distinct keys of 60 bits."""
    if shards < 1:
        raise ValueError("there must be a shard")
    grid = Grid(divided(groups, [Cell(0, KEY_BITS, 0, 0)]))
    while True:
        capacity = least_capacity(grid, shards)
        grid.touched.clear()
        fits(grid, capacity, shards)
        ends = cuts(grid, capacity, shards)
        if not grid.touched:
            break
        split = [grid.cells[i] for i in grid.touched]
        grid = Grid([c for i, c in enumerate(grid.cells) if i not in grid.touched] + divided(groups, split))
    bounds = []
    for end in ends:
        number = bisect_left(grid.ends, end)  # the cell that begins there
        bounds.append(grid.cells[number].low if number < len(grid.cells) else 1 << KEY_BITS)
    return Plan(capacity, bounds)


def described(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, key, size, text_crc32, place) of each row, written; the texts are read once."""
    whole = F.col(f"`{text}`")
    return stored(docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), key_of(whole).alias("key"), size_of(whole).alias("size"),
        F.crc32(F.coalesce(whole, F.lit("")).cast("binary")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("place"),
    ), "sizes")


def plan_of(rows: DataFrame, shards: int = SHARDS) -> Plan:
    """The cuts for rows (key, size). Copies are added up before the shuffle."""
    return minimax(stored(rows.groupBy("key").agg(F.sum("size").alias("size")), "groups"), shards)


def digest(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of each row."""
    rows = described(docs, doc_id, text)
    plan = plan_of(rows, shards)
    placed = numbered(rows.withColumn("shard", plan.shard(F.col("key"))), "shard", ["doc_id", "key", "place"], "slot")
    return placed.select(
        F.col("doc_id").alias(doc_id), "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def sharded(docs: DataFrame, *, text: str = "text", shards: int = SHARDS, into: str = "shard") -> DataFrame:
    """`docs` with the shard of each row, as for a write partitioned by it. Texts are not moved."""
    whole = F.col(f"`{text}`")
    sizes = stored(docs.select(key_of(whole).alias("key"), size_of(whole).alias("size")), "sizes")
    return docs.withColumn(into, plan_of(sizes, shards).shard(key_of(whole)))


#: crc32 of a list of bytes in DuckDB: the table of remainders, then one step for each byte.
CRC_TABLE = """
SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, i:
  CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, n)) AS t
"""


def crc_sql(text: str) -> str:
    """crc32 of a text, in a query that has CRC_TABLE's column t."""
    octets = f"list_transform(regexp_extract_all(hex({text}), '..'), lambda h: ('0x' || h)::BIGINT)"
    return (f"xor(list_reduce({octets}, lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8), 4294967295::BIGINT), "
            "4294967295::BIGINT)")


SQL = f"""
WITH RECURSIVE crc AS MATERIALIZED ({CRC_TABLE}),
docs AS MATERIALIZED (
  SELECT doc_id, coalesce(text, '') AS whole, ('0x' || substr(md5(coalesce(text, '')), 1, {KEY_BITS // 4}))::BIGINT AS key,
    strlen(coalesce(text, '')) + 1 AS size
  FROM documents
), groups AS MATERIALIZED (
  SELECT key, sum(sum(size)) OVER (ORDER BY key)::BIGINT AS upto FROM docs GROUP BY key
), ends AS MATERIALIZED (SELECT upto FROM groups UNION ALL SELECT 0),
total AS MATERIALIZED (SELECT max(upto) AS n FROM ends),
search AS (
  SELECT 0::BIGINT AS low, n AS high, 0 AS j, 0::BIGINT AS reached, n FROM total
  UNION ALL
  SELECT CASE WHEN j = {SHARDS} AND reached < n THEN (low + high) // 2 + 1 ELSE low END,
    CASE WHEN j = {SHARDS} AND reached = n THEN (low + high) // 2 ELSE high END,
    CASE WHEN j = {SHARDS} THEN 0 ELSE j + 1 END,
    CASE WHEN j = {SHARDS} THEN 0 ELSE (SELECT max(upto) FROM ends WHERE upto <= reached + (low + high) // 2) END, n
  FROM search WHERE low < high
), capacity AS MATERIALIZED (SELECT low AS c, n FROM search WHERE low = high),
back AS (
  SELECT {SHARDS} AS j, n AS earliest, c FROM capacity
  UNION ALL
  SELECT j - 1, (SELECT min(upto) FROM ends WHERE upto >= greatest(earliest - c, 0)), c FROM back WHERE j > 1
), forward AS (
  SELECT 0 AS j, 0::BIGINT AS reached, c, n FROM capacity
  UNION ALL
  SELECT j + 1, (
    SELECT greatest(earliest, least(
      (SELECT max(upto) FROM ends WHERE upto <= reached + c),
      CASE WHEN share - below <= above - share AND below > reached THEN below ELSE above END))
    FROM (SELECT reached + (n - reached) // ({SHARDS} - j) AS share,
        (SELECT max(upto) FROM ends WHERE upto <= reached + (n - reached) // ({SHARDS} - j)) AS below,
        (SELECT min(upto) FROM ends WHERE upto >= reached + (n - reached) // ({SHARDS} - j)) AS above,
        (SELECT earliest FROM back WHERE back.j = forward.j + 1) AS earliest)
  ), c, n FROM forward WHERE j < {SHARDS} - 1
), placed AS (
  SELECT docs.*, (SELECT count(*) FROM forward WHERE j > 0 AND reached < g.upto)::INTEGER AS shard
  FROM docs JOIN groups g USING (key)
)
SELECT doc_id, size, CASE WHEN whole = '' THEN 0 ELSE {crc_sql('whole')} END AS text_crc32, '{LAW}' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, key) - 1 AS slot,
  NULL::INTEGER AS grown_shard
FROM placed, crc
"""
