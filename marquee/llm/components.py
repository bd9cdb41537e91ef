"""Connected components of links between nodes, by large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from .common import drop_stored, stored


#: Neighbours from which a node is a hub, and parts into which its rows are divided.
HUB, SALTS = 100_000, 64


def _state(edges: DataFrame, purpose: str) -> tuple[DataFrame, tuple[int, int]]:
    """The written edges, and what the write saw: their count, and a hash that no number of them
    makes too large."""
    seen = Observation()
    held = stored(edges.observe(
        seen, F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("mark")), purpose)
    return held, (seen.get["n"], seen.get["mark"])


def _beside_least(rows: DataFrame, of: DataFrame, n: int) -> DataFrame:
    """`rows` (u, v) with the least neighbour m that u has in `of` (u, v), made of `n` edges.

    The rows of a hub are dealt out by a salt, and its least neighbour goes to each part. So many
    neighbours make a hub that at most 20,000 nodes are one, whatever the number of edges is; fewer
    edges than a hub has cannot make one.
    """
    least = of.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("degree"))
    many = max(HUB, n // 10_000)
    if n <= many:
        return rows.join(least, "u").select("u", "v", "m")
    hubs = F.broadcast(least.where(F.col("degree") > many).select(F.col("u").alias("hub")))
    salted = rows.join(hubs, F.col("u") == F.col("hub"), "left").select(
        "u", "v", F.when(F.col("hub").isNotNull(), F.pmod(F.xxhash64("v"), F.lit(SALTS))).otherwise(0).cast("int").alias("salt"))
    spread = least.select("u", "m", F.explode(F.sequence(
        F.lit(0), F.when(F.col("degree") > many, SALTS - 1).otherwise(0))).alias("salt"))
    return salted.join(spread, ["u", "salt"]).select("u", "v", "m")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for each node of `links` (a, b); root is the least node that it reaches.

    In a large star, the larger neighbours of a node are linked to the least node it sees; in a
    small star, the smaller ones. Each round is written out; the number of rounds grows with the
    logarithm of the longest path. Hubs are divided. Nulls and links of a node with itself say nothing.
    """
    edges, state = _state(
        links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "edges",
    )
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = stored(
            _beside_least(both.where("v > u"), both, state[0])
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct(),
            "large",
        )
        small, after = _state(
            _beside_least(large, large, state[0]).select(F.explode(F.array(
                F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v"))
            )).alias("e")).select("e.*").where("u <> v").distinct(),
            "small",
        )
        drop_stored(edges)
        drop_stored(large)
        edges = small
        if after == state:
            break
        state = after
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        roots.select("node", F.col("node").alias("root"))
    )


def extended(found: DataFrame, links: DataFrame) -> DataFrame:
    """The components (node, root) of the links behind `found`, a written result of `components`,
    and of more `links` (a, b): these are taken between the roots, so that few are left."""
    side = {s: found.select(F.col("node").alias(s), F.col("root").alias(f"root_{s}")) for s in "ab"}
    between = links.select("a", "b").join(side["a"], "a", "left").join(side["b"], "b", "left").select(
        F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b"))
    joined = components(between).select(F.col("node").alias("at"), F.col("root").alias("to"))
    old = found.join(joined, F.col("root") == F.col("at"), "left").select("node", F.coalesce("to", "root").alias("root"))
    fresh = joined.join(found, F.col("at") == F.col("node"), "left_anti")
    return old.unionAll(fresh.select(F.col("at").alias("node"), F.col("to").alias("root")))
