"""Short codes for vectors: each of four parts is replaced by the index of its nearest codebook entry,
and the codebooks are learned by Lloyd's rounds over dual trees.

Components become integers, so every result is exact. Vectors are written once as blocks; in each,
each part has a balanced tree over its points (halved at the widest side, told by the order of the
points alone). The 256 entries of a part have a tree too. A round walks both at once: bounds of the
distance between two boxes prune pairs of nodes; a node for which one entry is left is assigned as a
whole, with its cached sum; leaves that stay uncertain compare integer distances. A task adds up
what it assigned, so that a round hands on 1,024 rows a task and 1,024 rows to the driver.

Cases: a vector that is null or has a null, infinite or NaN component is left out, as is one of
another length than the vector with the least id. A null id is the largest; equal ids are ordered by
their components. If four does not divide the length, the last part is filled up with zeros; fewer
vectors than entries make smaller codebooks. Scaled components beyond 2 ** 96 count as that, and an
error beyond the largest long as that. Ties go to the lower index. An empty table gives an empty
result. Null labels are one label. Columns of other names take no part.
"""

from __future__ import annotations

import hashlib
import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from .common import sent_if_small, stored

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
LEAF = 64
#: Vectors of a block, and at most so many components.
BLOCK, BLOCK_VALUES = 4_096, 262_144
LARGEST = 2.0**96
MOST = 2**63 - 1


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Integers, as doubles that hold them exactly."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(vectors.astype(np.float64) * SCALE), -LARGEST, LARGEST)


def halves(n: int, leaf: int) -> list[np.ndarray]:
    """The bounds of the nodes of a balanced tree over n points, by level from the root."""
    levels = [np.array([0, n])]
    while n > leaf << (len(levels) - 1):
        b = levels[-1]
        levels.append(np.sort(np.concatenate((b, (b[:-1] + b[1:]) // 2))))
    return levels


def ordered(points: np.ndarray, leaf: int) -> np.ndarray:
    """An order of the points in which the nodes of `halves` are boxes cut at their widest side."""
    order = np.arange(len(points))
    for bounds, finer in zip(halves(len(points), leaf), halves(len(points), leaf)[1:]):
        for first, last, middle in zip(bounds[:-1], bounds[1:], finer[1::2]):
            if last - first > 1 and points.shape[1]:
                inside = points[order[first:last]]
                side = int(np.argmax(inside.max(0) - inside.min(0)))
                order[first:last] = order[first:last][np.argsort(inside[:, side], kind="stable")]
    return order


@dataclass
class Tree:
    """Points in tree order, and the boxes of the nodes by level."""

    points: np.ndarray
    bounds: list[np.ndarray]
    low: list[np.ndarray]
    high: list[np.ndarray]

    @classmethod
    def over(cls, points: np.ndarray, leaf: int) -> Tree:
        bounds = halves(len(points), leaf)
        low, high = ([f.reduceat(points, b[:-1], axis=0) for b in bounds] for f in (np.minimum, np.maximum))
        return cls(points, bounds, low, high)


def _pruned(points: Tree, entries: Tree, p_level: int, e_level: int, p: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Which pairs of nodes may hold a nearest entry; a little slack covers rounding."""
    pl, ph = points.low[p_level][p], points.high[p_level][p]
    el, eh = entries.low[e_level][e], entries.high[e_level][e]
    gap = np.maximum(0, np.maximum(el - ph, pl - eh))
    far = np.maximum(ph - el, eh - pl)
    least, most = np.einsum("ij,ij->i", gap, gap), np.einsum("ij,ij->i", far, far)
    bound = np.full(len(points.bounds[p_level]) - 1, np.inf)
    np.minimum.at(bound, p, most)
    return least * (1 - 1e-9) <= bound[p] * (1 + 1e-9)


def _exact(*arrays: np.ndarray) -> list[np.ndarray]:
    """The arrays as doubles, if those hold all squared distances between them, else as integers
    of any size."""
    largest = max((float(np.abs(x).max()) for x in arrays if x.size), default=0.0)
    if 4 * arrays[0].shape[1] * largest**2 < 2**53:
        return [x.astype(np.float64) for x in arrays]
    return [as_integers(x) for x in arrays]


def _distances(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances, exactly."""
    points, entries = _exact(points, entries)
    if points.dtype == object:
        return ((points[:, None] - entries[None]) ** 2).sum(2)
    return (points**2).sum(1)[:, None] - 2 * (points @ entries.T) + (entries**2).sum(1)


def as_integers(values: np.ndarray) -> np.ndarray:
    return np.array([int(v) for v in values.ravel()], object).reshape(values.shape)


def assigned(points: Tree, entries: Tree, order: np.ndarray):
    """Yield (first, last, entry) of nodes that go to one entry as a whole, and (first, last, entry
    of each point) of uncertain leaves. `order` tells the index of each entry of the tree."""
    p, e = np.zeros(1, np.int64), np.zeros(1, np.int64)
    p_level, e_level = 0, 0
    while True:
        keep = _pruned(points, entries, p_level, e_level, p, e)
        p, e = p[keep], e[keep]
        bottom = e_level == len(entries.bounds) - 1
        if bottom:
            alone = np.bincount(p, minlength=len(points.bounds[p_level]) - 1)[p] == 1
            for node, entry in zip(p[alone], e[alone]):
                first, last = points.bounds[p_level][node : node + 2]
                yield int(first), int(last), int(order[entries.bounds[-1][entry]])
            p, e = p[~alone], e[~alone]
        if not len(p):
            return
        if bottom and p_level == len(points.bounds) - 1:
            break
        if not bottom:
            p, e, e_level = np.repeat(p, 2), np.repeat(2 * e, 2) + np.tile([0, 1], len(e)), e_level + 1
        if p_level < len(points.bounds) - 1:
            p, e, p_level = np.repeat(2 * p, 2) + np.tile([0, 1], len(p)), np.repeat(e, 2), p_level + 1
        full = (np.diff(points.bounds[p_level])[p] > 0) & (np.diff(entries.bounds[e_level])[e] > 0)
        p, e = p[full], e[full]
    e = entries.bounds[-1][e]  # the entry in each node
    by = np.lexsort((order[e], p))
    p, e = p[by], e[by]
    starts = np.flatnonzero(np.concatenate(([True], p[1:] != p[:-1])))
    for first_pair, last_pair in zip(starts, [*starts[1:], len(p)]):
        first, last = points.bounds[p_level][p[first_pair] : p[first_pair] + 2]
        left = e[first_pair:last_pair]  # in the order of their indexes: the first least one counts
        nearest = np.argmin(_distances(points.points[first:last], entries.points[left]), axis=1)
        yield int(first), int(last), order[left][nearest]


def _trees(codebooks: list[list[list[int]]]) -> list[tuple[Tree, np.ndarray]]:
    """The tree over the entries of each part, and their indexes in its order."""
    trees = []
    for book in codebooks:
        values = np.array(book, object).reshape(len(book), -1)
        if values.size and max(abs(int(v)) for v in values.ravel()) < 2**53:
            values = values.astype(np.float64)
        order = ordered(values.astype(np.float64), 1)
        tree = Tree.over(values[order].astype(np.float64), 1)
        tree.points = values[order]  # exact, whatever their size
        trees.append((tree, order))
    return trees


def blocks_of(vectors: DataFrame, length: int) -> DataFrame:
    """Written blocks (ids, labels, kind, orders, points): points of each part in tree order."""
    width = -(-length // PARTS)
    size = max(1, min(BLOCK, BLOCK_VALUES // max(1, width * PARTS)))

    def block(ids, labels, rows):
        whole = np.zeros((len(rows), width * PARTS))
        whole[:, :length] = rows
        kind = "<f4" if not whole.size or np.abs(whole).max() < 2**24 else "<f8"
        parts = [whole[:, i * width : (i + 1) * width] for i in range(PARTS)]
        orders = [ordered(part, LEAF) for part in parts]
        points = [part[order].astype(kind).tobytes() for part, order in zip(parts, orders)]
        return pa.RecordBatch.from_arrays([
            *(pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (ids, labels)), pa.array([kind]),
            pa.array([[o.astype("<i4").tobytes() for o in orders]], pa.list_(pa.binary())),
            pa.array([points], pa.list_(pa.binary())),
        ], names=["ids", "labels", "kind", "orders", "points"])

    def build(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, size):
                part = batch.slice(first, size)
                flat = part.column("vector").flatten().to_numpy(zero_copy_only=False)
                yield block(part.column("id"), part.column("label"), scaled(flat.reshape(part.num_rows, length)))

    types = {n: vectors.schema[n].dataType.simpleString() for n in ("id", "label")}
    return stored(vectors.mapInArrow(
        build, f"ids array<{types['id']}>, labels array<{types['label']}>, kind string, orders array<binary>, points array<binary>"
    ), "blocks")


def _read(batches):
    """(ids, labels, orders, points) of each block; ids and labels as they lie in Arrow."""
    for batch in batches:
        for row in range(batch.num_rows):
            kind = batch.column("kind")[row].as_py()
            ids, labels = batch.column("ids")[row].values, batch.column("labels")[row].values
            points = []
            for held in batch.column("points")[row].as_py():
                flat = np.frombuffer(held, kind).astype(np.float64)
                points.append(flat.reshape(len(ids), len(flat) // len(ids)))
            yield ids, labels, [np.frombuffer(o, "<i4") for o in batch.column("orders")[row].as_py()], points


def _sums(points: Tree, entries: Tree, order: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(entry, points that go there, their sum) for the points of a tree: whole nodes by their
    cached sums, those of uncertain leaves gathered by entry."""
    values = points.points
    largest = float(np.abs(values).max()) if values.size else 0.0
    if largest * len(values) >= 2**53:
        values = as_integers(values)
    cached = np.concatenate((np.zeros((1, values.shape[1]), values.dtype), np.cumsum(values, axis=0)))
    whole, of, rows = [], [], []
    for first, last, entry in assigned(points, entries, order):
        if isinstance(entry, int):
            whole.append((entry, last - first, cached[last] - cached[first]))
        else:
            of.append(entry)
            rows.append(np.arange(first, last))
    of, rows = np.concatenate([np.zeros(0, np.int64), *of]), np.concatenate([np.zeros(0, np.int64), *rows])
    by = np.argsort(of, kind="stable")
    entry, starts, count = np.unique(of[by], return_index=True, return_counts=True)
    sums = np.add.reduceat(values[rows[by]], starts, axis=0) if len(starts) else np.zeros((0, values.shape[1]))
    return (
        np.concatenate((entry, np.array([w[0] for w in whole], np.int64))),
        np.concatenate((count, np.array([w[1] for w in whole], np.int64))),
        np.concatenate((sums, np.array([w[2] for w in whole], values.dtype).reshape(len(whole), -1 if whole else values.shape[1]))),
    )


def _round(blocks: DataFrame, codebooks: list[list[list[int]]]) -> list[list[list[int]]]:
    """The codebooks after one round: each entry becomes the mean of its parts, rounded down."""
    spark = blocks.sparkSession
    sent = spark.sparkContext.broadcast(codebooks)
    width = len(codebooks[0][0])

    def sums(batches):
        trees = _trees(sent.value)
        count = np.zeros((PARTS, len(sent.value[0])), np.int64)
        total = np.zeros((PARTS, len(sent.value[0]), width), object)
        for _, _, _, points in _read(batches):
            for part, (values, (tree, order)) in enumerate(zip(points, trees)):
                entry, n, sums = _sums(Tree.over(values, LEAF), tree, order)
                np.add.at(count[part], entry, n)
                np.add.at(total[part], entry, as_integers(sums))
        part, entry = np.nonzero(count)
        yield pa.RecordBatch.from_arrays([
            pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(count[part, entry], pa.int64()),
            pa.array([[str(v) for v in total[p, e]] for p, e in zip(part, entry)], pa.list_(pa.string())),
        ], names=["part", "entry", "n", "sums"])

    parts = blocks.select("ids", "labels", "kind", "orders", "points").mapInArrow(
        sums, "part int, entry int, n long, sums array<string>")
    means = parts.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*(
        F.sum(F.get("sums", F.lit(i)).cast("decimal(38,0)")) for i in range(width)
    )).cast("array<string>").alias("sums"))
    new = [[list(entry) for entry in book] for book in codebooks]
    for row in means.collect():  # one for each entry
        new[row.part][row.entry] = [int(s) // row.n for s in row.sums]
    sent.unpersist()
    return new


def _vectors(rows: DataFrame, vec_id: str, label: str, embedding: str) -> DataFrame:
    """(id, label, vector) of the rows whose vector is whole."""
    vector = F.col(f"`{embedding}`")
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return rows.select(
        F.col(f"`{vec_id}`").alias("id"), F.col(f"`{label}`").alias("label"), vector.alias("vector")
    ).where(vector.isNotNull() & whole)


def _first(vectors: DataFrame) -> list:
    order = (F.col("id").asc_nulls_last(), F.col("vector"))
    return vectors.select("id", "vector").orderBy(*order).limit(ENTRIES).collect()


def learned(vectors: DataFrame) -> tuple[DataFrame, list[list[list[int]]]] | None:
    """The written blocks and the codebooks of vectors (id, label, vector); null if there are none."""
    first = _first(vectors)
    if not first:
        return None
    length = len(first[0].vector)
    vectors = vectors.where(F.size("vector") == length)
    if any(len(r.vector) != length for r in first):
        first = _first(vectors)
    width = -(-length // PARTS)
    values = np.zeros((len(first), PARTS * width))
    values[:, :length] = scaled(np.array([r.vector for r in first], np.float64).reshape(len(first), length))
    codebooks = [
        [[int(v) for v in row[i * width : (i + 1) * width]] for row in values] for i in range(PARTS)
    ]
    blocks = blocks_of(vectors, length)
    for _ in range(ROUNDS):
        codebooks = _round(blocks, codebooks)
    return blocks, codebooks


def encoded(blocks: DataFrame, codebooks: list[list[list[int]]]) -> DataFrame:
    """(id, label, code, error) of each vector of the blocks."""
    sent = blocks.sparkSession.sparkContext.broadcast(codebooks)

    def encode(batches):
        trees = _trees(sent.value)
        digits = np.array([f"{i:02x}" for i in range(len(sent.value[0]))], object)
        for ids, labels, orders, points in _read(batches):
            codes, error = np.empty((PARTS, len(ids)), np.int64), np.zeros(len(ids), object)
            for part, (values, back, (tree, order)) in enumerate(zip(points, orders, trees)):
                nearest = np.empty(len(ids), np.int64)
                for first, last, entry in assigned(Tree.over(values, LEAF), tree, order):
                    nearest[first:last] = entry
                codes[part, back] = nearest
                book = np.array(sent.value[part], object).reshape(len(sent.value[part]), -1)
                mine, theirs = _exact(values, book[nearest])
                error[back] += as_integers(((mine - theirs) ** 2).sum(1))
            yield pa.RecordBatch.from_arrays([
                ids, labels, pa.array(digits[codes].sum(0), pa.string()),
                pa.array([min(int(e), MOST) for e in error], pa.int64()),
            ], names=["id", "label", "code", "error"])

    types = {n: blocks.schema[f"{n}s"].dataType.elementType.simpleString() for n in ("id", "label")}
    return blocks.mapInArrow(encode, f"id {types['id']}, label {types['label']}, code string, error long")


def _sha256(codebooks: list[list[list[int]]]) -> str:
    numbers = ",".join(str(v) for book in codebooks for entry in book for v in entry)
    return hashlib.sha256(numbers.encode()).hexdigest()


def held_long(total: Column) -> Column:
    return F.least(total, F.lit(MOST).cast("decimal(38,0)")).cast("long")


def digest(
    rows: DataFrame, *, vec_id: str = "vec_id", label: str = "label", embedding: str = "embedding"
) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of each row that is kept."""
    found = learned(_vectors(rows, vec_id, label, embedding))
    if not found:
        return rows.limit(0).select(F.col(f"`{vec_id}`"), *(
            F.lit(None).cast(kind).alias(name) for name, kind in
            (("code", "string"), ("error", "long"), ("label_error", "long"), ("codebooks_sha256", "string"))
        ))
    blocks, codebooks = found
    codes = stored(encoded(blocks, codebooks), "codes")
    sums = codes.groupBy("label").agg(held_long(F.sum(F.col("error").cast("decimal(38,0)"))).alias("label_error"))
    return codes.join(
        sent_if_small(stored(sums.withColumnRenamed("label", "_label"), "labels")), F.col("label").eqNullSafe(F.col("_label"))
    ).select(F.col("id").alias(vec_id), "code", "error", "label_error", F.lit(_sha256(codebooks)).alias("codebooks_sha256"))


def _sql() -> str:
    parts = [f"""kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v,
    row_number() OVER (ORDER BY vec_id, embedding) - 1 AS r
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
long AS (SELECT r, len(v) // {PARTS} AS width, unnest(v) AS x, generate_subscripts(v, 1) - 1 AS place FROM kept),
points AS MATERIALIZED (SELECT r, place // width AS part, place % width AS pos, x FROM long),
c0 AS MATERIALIZED (SELECT part, r AS entry, pos, x FROM points WHERE r < {ENTRIES})"""]
    for k in range(ROUNDS + 1):
        parts.append(f"""d{k} AS MATERIALIZED (
  SELECT r, part, min(d * {ENTRIES} + entry) AS best FROM (
    SELECT r, part, entry, sum((p.x - c.x) * (p.x - c.x))::BIGINT AS d FROM points p JOIN c{k} c USING (part, pos) GROUP BY ALL)
  GROUP BY ALL)""")
        if k < ROUNDS:
            parts.append(f"""c{k + 1} AS MATERIALIZED (
  SELECT part, entry, pos, coalesce(mean, x) AS x FROM c{k} LEFT JOIN (
    SELECT part, best % {ENTRIES} AS entry, pos, (s - ((s % n) + n) % n) // n AS mean FROM (
      SELECT part, best % {ENTRIES} AS best, pos, sum(x)::BIGINT AS s, count(*) AS n
      FROM points JOIN d{k} USING (r, part) GROUP BY ALL)
  ) USING (part, entry, pos))""")
    return "WITH " + ",\n".join(parts) + f""",
coded AS (SELECT r, string_agg(printf('%02x', best % {ENTRIES}), '' ORDER BY part) AS code, sum(best // {ENTRIES})::BIGINT AS error
  FROM d{ROUNDS} GROUP BY r)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
  (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, entry, pos)) FROM c{ROUNDS}) AS codebooks_sha256
FROM kept JOIN coded USING (r)"""


SQL = _sql()

cloudpickle.register_pickle_by_value(sys.modules[__name__])
