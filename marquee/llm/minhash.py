"""Near-duplicate documents by an LSH forest of MinHash signatures.

A document is the set of its word shingles. Documents with equal sets are one node from the start.
A signature has `DEPTH` values for each of `TREES` trees. For each tree, all nodes are sorted by
its values; a node meets the neighbours on both sides with whom it shares the longest prefix, at
least `LEAST_DEPTH` values. In a crowded region the nearest nodes share many values, in a sparse one
few: depth follows the data. Orders are range-partitioned, so that one region may lie in many tasks;
rows at the ends of partitions are compared in a second, small pass.

Candidates whose signatures agree too little are put aside; the rest are confirmed on full sets
that are read again from the texts. First the best candidate of each node is confirmed, then every
one whose ends are not yet in one group, so that no candidate is left out. Groups are the connected
components of the links.

A crowded region may hold more nodes with the same least prefix than a window. Its nodes, unless
they are one group by then, go an exact way: each is entered under its first shingles, rare ones
first, so many that two sets of the wanted similarity share one of them; those that meet there and
are long enough to be alike are confirmed, first with the smallest of each shingle, then all whose
ends are still in different groups. So a pair that shares the least prefix in any tree is not missed.

Chances: two sets of similarity 0.8 share three given values with 0.51; they miss each other in
twelve trees with 0.0002, and more alike ones far less. Between signatures that agree in less than
`ROUGH` of the values and a similarity of 0.8 lie four standard deviations.

Cases: a null text, or one without words, has no shingles and belongs to no group but its own. A
text with fewer words than a shingle is one shingle. Rows without an id take part; the least id of
a group is taken over the others. Rows with equal ids are rows of their own. An empty table gives
an empty result. Columns of other names are kept, whatever they are called.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from .common import drop_stored, packed, sent_if_small, small_batches, stored, text_key, unpacked
from .components import components, extended
from .words import SEED, byte_tables, chunks, mix, release, word_hashes

TREES, DEPTH, LEAST_DEPTH = 12, 10, 3
NEIGHBOURS = 4
ROUGH = 0.65
#: Counts by which shingles are ordered from rare to common; any fixed order gives the same links.
BUCKETS = 1 << 18


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The different shingles of each text as 64-bit numbers, sorted, and the offsets between texts."""
    space, numbers = byte_tables()
    hashes, rows, _, _ = word_hashes(data, offsets, space, numbers)
    n = len(offsets) - 1
    counts = np.bincount(rows, minlength=n)
    begins = np.concatenate(([0], np.cumsum(counts)))
    factors = np.random.default_rng(SEED + 1).integers(1, 2**63, words + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    place = np.arange(len(hashes)) - begins[rows]
    first = (place <= counts[rows] - words) | (place == 0)
    starts = np.flatnonzero(first)
    total = np.zeros(len(starts), np.uint64)
    for j in range(words):
        at = starts + j
        there = at < begins[rows[starts] + 1]
        total += np.where(there, hashes[np.minimum(at, max(len(hashes) - 1, 0))] * factors[j], factors[words])
    sets, of = mix(total), rows[starts]
    order = np.lexsort((sets, of))
    sets, of = sets[order], of[order]
    fresh = np.ones(len(sets), bool)
    fresh[1:] = (sets[1:] != sets[:-1]) | (of[1:] != of[:-1])
    sets, of = sets[fresh], of[fresh]
    return sets, np.concatenate(([0], np.cumsum(np.bincount(of, minlength=n))))


def signatures(sets: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """The least value of each of TREES * DEPTH hash functions over each set that has members."""
    random = np.random.default_rng(SEED + 2)
    a = random.integers(0, 2**63, TREES * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = random.integers(0, 2**63, TREES * DEPTH, dtype=np.uint64)
    out = np.empty((len(begins), TREES * DEPTH), np.uint32)
    for i in range(TREES * DEPTH):
        out[:, i] = np.minimum.reduceat((sets * a[i] + b[i]) >> np.uint64(32), begins)
    return out


def _signed(words: int):
    def run(batches):
        for batch in batches:
            for first, last, data, offsets in chunks(batch.column("text")):
                sets, begins = shingle_sets(data, offsets, words)
                sizes = np.diff(begins)
                full = np.flatnonzero(sizes)
                nodes = np.zeros((len(full), 2), "<u8")
                marks = np.zeros((len(full), TREES * DEPTH), np.uint32)
                if len(full):
                    at = begins[:-1][full]
                    nodes[:, 0] = np.add.reduceat(mix(sets), at)
                    nodes[:, 1] = np.add.reduceat(mix(sets ^ np.uint64(SEED)), at)
                    marks = signatures(sets, at)
                place = np.full(last - first, -1)
                place[full] = np.arange(len(full))
                big = marks.astype(">u4")
                yield pa.RecordBatch.from_arrays([
                    *(batch.column(c).slice(first, last - first) for c in ("id", "k1", "k2")),
                    pa.array(sizes, pa.int64()),
                    pa.array([nodes[i].tobytes() if i >= 0 else None for i in place], pa.binary()),
                    pa.array([big[i].tobytes() if i >= 0 else None for i in place], pa.binary()),
                ], names=["id", "k1", "k2", "n", "node", "marks"])
        release()

    return run


def _neighbours(batches):
    """Pairs of near rows of a sorted partition, and the rows at its ends."""
    tail, seen, ends = None, 0, []

    def row_batch(a, b, rows):
        n = len(a) + len(rows)
        none = [None] * len(a)
        return pa.RecordBatch.from_arrays([
            pa.array(a + [None] * len(rows), pa.binary()), pa.array(b + [None] * len(rows), pa.binary()),
            pa.array(none + [r[0] for r in rows], pa.int32()), pa.array(none + [r[1] for r in rows], pa.binary()),
            pa.array(none + [r[2] for r in rows], pa.binary()),
        ], names=["a", "b", "tree", "path", "node"]) if n else None

    for batch in batches:
        rows = list(zip(*(batch.column(c).to_pylist() for c in ("tree", "path", "node"))))
        if not rows:
            continue
        if seen < NEIGHBOURS:
            ends += rows[: NEIGHBOURS - seen]
        seen += len(rows)
        whole = (tail or []) + rows
        old = len(whole) - len(rows)
        prefix = np.array([t.to_bytes(4, "big") + p[: 4 * LEAST_DEPTH] for t, p, _ in whole])
        a, b = [], []
        for lag in range(1, NEIGHBOURS + 1):
            same = np.flatnonzero(prefix[lag:] == prefix[:-lag]) + lag
            for j in same[same >= old]:
                x, y = whole[j - lag][2], whole[j][2]
                if x != y:
                    a.append(min(x, y))
                    b.append(max(x, y))
        tail = whole[-NEIGHBOURS:]
        if a:
            yield row_batch(a, b, [])
    ends += (tail or [])
    if ends:
        yield row_batch([], [], ends)
    release()


PAIRS = "a binary, b binary, tree int, path binary, node binary"


def candidates(nodes: DataFrame) -> DataFrame:
    """(a, b): pairs of nodes that are neighbours in one of the sorted orders."""
    trees = F.array(*(F.substring("marks", 1 + 4 * DEPTH * t, 4 * DEPTH) for t in range(TREES)))
    order = ("tree", "path", "node")
    rows = nodes.select("node", F.posexplode(trees).alias("tree", "path")).select(*order)
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    near = stored(ordered.mapInArrow(_neighbours, PAIRS), "neighbours")
    # twice NEIGHBOURS rows of each partition
    ends = near.where("node IS NOT NULL").select(*order).distinct().repartitionByRange(1, *order).sortWithinPartitions(*order)
    across = ends.mapInArrow(_neighbours, PAIRS)
    found = stored(near.unionAll(across).where("a IS NOT NULL").select("a", "b").distinct(), "candidates")
    drop_stored(near)
    return found


def crowded(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """(node, root): nodes that share the least prefix of a tree with more nodes than a window
    holds, if not all of these are in one group; root is a hash."""
    runs = F.array(*(
        F.xxhash64(F.lit(t), F.substring("marks", 1 + 4 * DEPTH * t, 4 * LEAST_DEPTH)) for t in range(TREES)
    ))
    rows = (
        nodes.select("node", runs.alias("runs")).join(roots, "node", "left")
        .select("node", F.xxhash64(F.coalesce("root", "node")).alias("root"), F.explode("runs").alias("run"))
    )
    full = stored(
        rows.groupBy("run").agg(F.count(F.lit(1)).alias("size"), F.min("root").alias("low"), F.max("root").alias("high"))
        .where((F.col("size") > NEIGHBOURS + 1) & (F.col("low") < F.col("high"))).select("run"),
        "runs",
    )
    found = stored(rows.join(sent_if_small(full), "run").select("node", "root").distinct(), "crowded")
    drop_stored(full)
    return found


def _bucket(shingles: np.ndarray) -> np.ndarray:
    return (shingles & np.uint64(BUCKETS - 1)).astype(np.int64)


def _counted(batches):
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        total += np.bincount(_bucket(np.frombuffer(b"".join(batch.column("members").to_pylist()), "<u8")), minlength=BUCKETS)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["bucket", "n"])


def _first_shingles(common: np.ndarray, percent: int):
    """Two sets of the similarity share at least one of these; `rest` counts the shingles from there on."""
    def run(batches):
        for batch in batches:
            first, of, sizes, rests = [], [], [], []
            for i, members in enumerate(batch.column("members").to_pylist()):
                s = np.frombuffer(members, "<u8")
                n = len(s)
                k = n - -(-percent * n // 100) + 1
                first.append(s[np.lexsort((s, common[_bucket(s)]))][:k])
                of.append(np.full(k, i))
                sizes.append(np.full(k, n))
                rests.append(n - np.arange(k))
            if not first:
                continue
            rows = pa.array(np.concatenate(of))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate(first).astype(np.uint64).view(np.int64)), batch.column("node").take(rows),
                batch.column("root").take(rows), pa.array(np.concatenate(sizes), pa.int64()),
                pa.array(np.concatenate(rests), pa.int64()),
            ], names=["g", "node", "root", "n", "rest"])
        release()

    return run


def _meeting(some: DataFrame, others: DataFrame, percent: int, once: bool) -> DataFrame:
    """(a, b): nodes of different groups that meet under a shingle and are long enough to be alike
    if it is the first that they share."""
    x, y = (d.select("g", *(F.col(c).alias(c + s) for c in ("node", "root", "n", "rest"))) for d, s in ((some, "1"), (others, "2")))
    apart = F.col("root1") < F.col("root2") if once else F.col("root1") != F.col("root2")
    enough = F.least("rest1", "rest2") * F.lit(100 + percent) >= F.lit(percent) * (F.col("n1") + F.col("n2"))
    alike = F.lit(100) * F.least("n1", "n2") >= F.lit(percent) * F.greatest("n1", "n2")
    return x.join(y, "g").where(apart & alike & enough).select(
        F.least("node1", "node2").alias("a"), F.greatest("node1", "node2").alias("b")).distinct()


def _divided(rows: DataFrame) -> DataFrame:
    """(g, hub): shingles that nodes of different groups hold, and the smallest of these nodes."""
    return (
        rows.groupBy("g").agg(F.min("root").alias("low"), F.max("root").alias("high"),
                              F.min(F.struct("n", "node", "root", "rest")).alias("hub"))
        .where("low < high").select("g", "hub")
    )


def exactly_grouped(crowd: DataFrame, members: DataFrame, roots: DataFrame, confirm, percent: int) -> DataFrame:
    """The components `roots` joined by links between nodes of `crowd` (node, root), so many that no
    pair of the similarity lies in different components."""
    counts = members.mapInArrow(_counted, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    common = np.zeros(BUCKETS, np.int64)  # at most BUCKETS rows
    common[counts.column("bucket").to_numpy()] = counts.column("n").to_numpy()
    kinds = "g long, node binary, root long, n long, rest long"
    rows = stored(members.join(crowd, "node").mapInArrow(_first_shingles(common, percent), kinds), "first-shingles")
    hubs = _divided(rows).select("g", "hub.*")
    near = confirm(stored(_meeting(rows, hubs, percent, once=False), "met-hubs"), members)
    after = stored(extended(roots, near), "after-hubs")
    fresh = (
        rows.drop("root").join(after, "node", "left")
        .select("g", "node", F.xxhash64(F.coalesce("root", "node")).alias("root"), "n", "rest")
    )
    fresh = stored(fresh, "first-shingles")
    left = stored(fresh.join(_divided(fresh).select("g"), "g"), "divided")
    far = confirm(stored(_meeting(left, left, percent, once=True), "met"), members)
    all_ = stored(extended(after, far), "roots")
    for done in (rows, fresh, left, after):
        drop_stored(done)
    return all_


def _agreeing(batches):
    for batch in batches:
        x, y = (
            np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, TREES * DEPTH) for c in ("ma", "mb")
        )
        yield pa.RecordBatch.from_arrays(
            [batch.column("a"), batch.column("b"), pa.array((x == y).mean(1), pa.float64())], names=["a", "b", "agree"])


def _confirmed(percent: int):
    def run(batches):
        for batch in batches:
            good = []
            for x, y in zip(batch.column("sa").to_pylist(), batch.column("sb").to_pylist()):
                x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(good, pa.bool_()))
        release()

    return run


def _sets(words: int):
    def run(batches):
        for batch in batches:
            for first, last, data, offsets in chunks(batch.column("text")):
                sets, begins = shingle_sets(data, offsets, words)
                yield pa.RecordBatch.from_arrays([
                    batch.column("node").slice(first, last - first),
                    pa.array([sets[i:j].astype("<u8").tobytes() for i, j in zip(begins[:-1], begins[1:])], pa.binary()),
                ], names=["node", "members"])
        release()

    return run


def groups(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80,
) -> DataFrame:
    """(id, k1, k2, n_shingles, component) for each row; k1 and k2 are the hashes of the text."""
    small_batches(docs.sparkSession)
    whole = F.coalesce(F.col(text), F.lit(""))
    k1, k2 = text_key(whole)
    source = docs.select(F.col(doc_id).alias("id"), k1.alias("k1"), k2.alias("k2"), whole.alias("text"))
    kinds = dict(source.dtypes)
    signed = stored(source.mapInArrow(
        _signed(words), f"id {kinds['id']}, k1 long, k2 long, n long, node binary, marks binary"), "signed")

    nodes = stored(
        signed.where("node IS NOT NULL").groupBy("node")
        .agg(F.min(F.struct(F.col("id").isNull(), "id", "k1", "k2", "n", "marks")).alias("r"))
        .select("node", "r.id", "r.k1", "r.k2", "r.n", "r.marks"),
        "nodes",
    )
    sides = [nodes.select(F.col("node").alias(s), F.col("n").alias("n" + s), F.col("marks").alias("m" + s)) for s in "ab"]
    alike = F.lit(100) * F.least("na", "nb") >= F.lit(percent) * F.greatest("na", "nb")
    met = candidates(nodes)
    pairs = stored(
        met.join(sides[0], "a").join(sides[1], "b").where(alike).select("a", "b", "ma", "mb")
        .mapInArrow(_agreeing, "a binary, b binary, agree double").where(F.col("agree") >= percent / 80 * ROUGH),
        "pairs",
    )

    def sets_of(wanted: DataFrame) -> DataFrame:
        asked = stored(nodes.join(wanted, "node").select("node", "id", "k1", "k2"), "wanted")
        keys = sent_if_small(asked.toDF("node", "i", "h1", "h2"))
        found = stored(
            source.join(keys, F.col("id").eqNullSafe(F.col("i")) & (F.col("k1") == F.col("h1")) & (F.col("k2") == F.col("h2")))
            .select("node", "text").dropDuplicates(["node"]).mapInArrow(_sets(words), "node binary, members binary"),
            "members",
        )
        drop_stored(asked)
        return found

    members = sets_of(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())

    def confirm(some: DataFrame, members: DataFrame = members) -> DataFrame:
        full = some.select("a", "b").join(members.toDF("a", "sa"), "a").join(members.toDF("b", "sb"), "b")
        return stored(full.select("a", "b", "sa", "sb").mapInArrow(_confirmed(percent), "a binary, b binary"), "links")

    both = pairs.select("a", "b", "agree", F.explode(F.array("a", "b")).alias("node"))
    best = both.groupBy("node").agg(F.max(F.struct("agree", "a", "b")).alias("p")).select("p.a", "p.b").distinct()
    best = stored(best, "best")
    links = confirm(best)
    found = stored(components(links), "found")
    part = [found.toDF(s, "root_" + s) for s in "ab"]
    rest = (
        pairs.join(best, ["a", "b"], "left_anti").join(part[0], "a", "left").join(part[1], "b", "left")
        .where(~F.coalesce(F.col("root_a") == F.col("root_b"), F.lit(False)))
    )
    more = confirm(rest)
    roots = stored(extended(found, more), "roots")
    crowd = crowded(nodes, roots)
    if not crowd.isEmpty():
        drop_stored(members)
        members = sets_of(crowd.select("node"))
        before, roots = roots, exactly_grouped(crowd, members, roots, confirm, percent)
        drop_stored(before)

    named = nodes.select("node", "id").join(roots, "node", "left").select("node", "id", F.coalesce("root", "node").alias("root"))
    least = named.groupBy("root").agg(F.min("id").alias("component"))
    labels = stored(named.join(least, "root").select("node", "component"), "labels")
    for done in (met, pairs, members, best, links, more, found, roots, crowd, nodes):
        drop_stored(done)
    return signed.select("id", "k1", "k2", "n", "node").join(labels, "node", "left").select(
        "id", "k1", "k2", F.col("n").alias("n_shingles"),
        F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component")).alias("component"),
    )


def digest(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", words: int = 4, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): kept says that the row has the id of its group."""
    return groups(docs, doc_id=doc_id, text=text, words=words, percent=percent).select(
        F.col("id").alias(doc_id), "n_shingles", F.col("component").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"),
    )


def one_of_each(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group, with its columns: that of the least id. Of equal rows, and of
    rows without an id in a group that has none, one stays."""
    found = groups(docs, doc_id=doc_id, text=text, words=words, percent=percent)
    grouped = found.where(F.col("id").eqNullSafe(F.col("component")))
    first = stored(grouped.select("id", "k1", "k2").distinct(), "kept").withColumnRenamed("id", "of")
    key1, key2 = text_key(F.coalesce(F.col("text"), F.lit("")))
    rows = packed(docs, id=doc_id, text=text).select("row", "id", key1.alias("key1"), key2.alias("key2"))
    same = F.col("id").eqNullSafe(F.col("of")) & (F.col("key1") == F.col("k1")) & (F.col("key2") == F.col("k2"))
    return unpacked(rows.join(first, same, "left_semi").dropDuplicates(["id", "key1", "key2"]), docs)


#: The same groups by all pairs, for small tables.
SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'),
    lambda x: x <> '') AS w
  FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s
  FROM words
), shingles AS (
  SELECT doc_id, unnest(s) AS g FROM sets
), shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
  FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM shared JOIN sets a ON a.doc_id = x JOIN sets b ON b.doc_id = y
  WHERE 100 * n >= 80 * (len(a.s) + len(b.s) - n)
), reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.doc_id, e.y FROM reached r JOIN (SELECT x, y FROM links UNION ALL SELECT y, x FROM links) e ON e.x = r.other
)
SELECT doc_id, len(s) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) USING (doc_id)
"""


cloudpickle.register_pickle_by_value(sys.modules[__name__])
