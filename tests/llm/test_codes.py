import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from support import rows

from marquee.llm import codes

SCHEMA = "vec_id long, embedding array<double>, label int"


def by_hand(table):
    """Rows of the digest, by plain loops over integers of any size."""
    kept = [
        (i, v, label) for i, v, label in table
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    length = len(kept[0][1])
    kept = [r for r in kept if len(r[1]) == length]
    width = -(-length // 4)
    whole = [[math.floor(x * 1024) for x in v] + [0] * (4 * width - length) for _, v, _ in kept]
    parts = [[tuple(v[p * width:(p + 1) * width]) for p in range(4)] for v in whole]
    books = [[v[p] for v in parts[:256]] for p in range(4)]

    def nearest(point, book):
        return min((sum((a - b) ** 2 for a, b in zip(point, entry)), k) for k, entry in enumerate(book))

    for _ in range(4):
        for p in range(4):
            groups = defaultdict(list)
            for v in parts:
                groups[nearest(v[p], books[p])[1]].append(v[p])
            books[p] = [
                tuple(sum(x) // len(groups[k]) for x in zip(*groups[k])) if k in groups else entry
                for k, entry in enumerate(books[p])
            ]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    found = [[nearest(v[p], books[p]) for p in range(4)] for v in parts]
    errors = [sum(d for d, _ in f) for f in found]
    by_label = defaultdict(int)
    for (_, _, label), e in zip(kept, errors):
        by_label[label] += min(e, 2**63 - 1)
    return sorted((
        (i, "".join(f"{k:02x}" for _, k in f), min(e, 2**63 - 1), min(by_label[label], 2**63 - 1), sha)
        for (i, _, label), f, e in zip(kept, found, errors)
    ), key=str)


def vectors(n, length, seed, spread=1.0, centres=None):
    draw = random.Random(seed)
    homes = [[draw.uniform(-2, 2) for _ in range(length)] for _ in range(centres or n)]
    return [
        (i, [x + draw.gauss(0, spread) for x in homes[i % len(homes)]], draw.choice([None, 0, 1, 2])) for i in range(n)
    ]


def checked(spark, table):
    got = codes.digest(spark.createDataFrame(table, SCHEMA))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert rows(got) == by_hand(table)


def test_against_brute_force(spark):
    checked(spark, vectors(400, 16, 1))


def test_odd_rows(spark):
    table = vectors(330, 8, 2, 0.05, 12)
    table += [(400, None, 1), (401, [1.0] * 7 + [None], 1), (402, [math.nan] * 8, 1), (403, [-math.inf] * 8, 2),
              (404, [0.5] * 4, 2), (405, [], 2), (None, [0.25] * 8, None), (None, [0.25] * 8, None),
              (7, [0.125] * 8, 0), (7, [0.125] * 8, 0), (-5, [-0.0001] * 8, 1)]
    checked(spark, table)


def test_few_vectors_and_parts_that_are_filled_up(spark):
    checked(spark, vectors(9, 6, 3))
    checked(spark, [(1, [], None), (2, [], 3)])


def test_no_vector(spark):
    for table in ([], [(1, None, 1), (2, [math.nan], None)]):
        got = codes.digest(spark.createDataFrame(table, SCHEMA))
        assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
        assert got.collect() == []


def test_integers_beyond_doubles(spark):
    table = vectors(20, 8, 4) + [(30, [1e9] * 8, 1), (31, [1e9 + 1] * 8, 1), (32, [-3e14] * 8, 2), (33, [3e20] * 8, 2)]
    checked(spark, table)


def test_largest_components_do_not_fail(spark):
    got = codes.digest(spark.createDataFrame([(i, [1e308 * (i % 2)] * 4, 1) for i in range(300)], SCHEMA))
    assert {r.error for r in got.collect()} == {0}


def test_nodes_are_assigned_whole(monkeypatch):
    """Tight clusters: whole nodes go to one entry, and the result is that of all distances."""
    monkeypatch.setattr(codes, "LEAF", 4)
    points = codes.scaled(np.array([v for _, v, _ in vectors(2_000, 3, 5, 0.001, 8)]))
    book = [[int(x) for x in p] for p in points[:16]]
    [(tree, order)] = codes._trees([book])
    back = codes.ordered(points, codes.LEAF)
    found, whole = np.full(len(points), -1), 0
    for first, last, entry in codes.assigned(codes.Tree.over(points[back], codes.LEAF), tree, order):
        assert (found[first:last] == -1).all()
        found[first:last] = entry
        whole += (last - first) * isinstance(entry, int)
    every = ((points[back][:, None] - np.array(book, float)[None]) ** 2).sum(2)
    assert (found == every.argmin(1)).all() and whole > 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(-4, 4), st.integers(-4, 4)), min_size=1, max_size=40),
       st.lists(st.tuples(st.integers(-4, 4), st.integers(-4, 4)), min_size=1, max_size=9), st.integers(1, 5))
def test_ties_go_to_the_lower_index(points, book, leaf):
    points = np.array(points, float)
    [(tree, order)] = codes._trees([[list(e) for e in book]])
    back = codes.ordered(points, leaf)
    entry, count, sums = codes._sums(codes.Tree.over(points[back], leaf), tree, order)
    want = ((points[:, None] - np.array(book, float)[None]) ** 2).sum(2).argmin(1)
    for k in range(len(book)):
        assert count[entry == k].sum() == (want == k).sum()
        assert (sums[entry == k].sum(0) == points[want == k].sum(0)).all()


def test_columns_of_other_names(spark):
    table = vectors(40, 4, 6)
    plain = spark.createDataFrame(table, SCHEMA)
    named = plain.selectExpr("vec_id AS id", "embedding AS code", "label AS error", "1 AS vector", "2 AS kind", "'x' AS sums")
    got = codes.digest(named, vec_id="id", label="error", embedding="code")
    assert got.columns[0] == "id" and rows(got) == by_hand(table)


@pytest.mark.parametrize("block", [1, 7, 4_096])
def test_blocks_of_any_size(spark, monkeypatch, block):
    monkeypatch.setattr(codes, "BLOCK", block)
    checked(spark, vectors(60, 4, 7))
