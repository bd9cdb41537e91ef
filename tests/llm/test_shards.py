import hashlib
import random
import zlib
from bisect import bisect_left
from collections import Counter, defaultdict
from itertools import accumulate

import pytest
from hypothesis import given, settings, strategies as st
from support import clashing, documents, rows

from marquee.llm import shards


def key(text):
    return int(hashlib.md5((text or "").encode()).hexdigest()[:15], 16)


def size(text):
    return len((text or "").encode()) + 1


def least_by_hand(sizes, n):
    """The least capacity that greedy filling does with, by trying sums of neighbours."""
    def fits(capacity):
        used, room = 0, 0
        for s in sizes:
            if s > capacity:
                return False
            if s > room:
                used, room = used + 1, capacity
            room -= s
        return used <= n
    ends = [0, *accumulate(sizes)]
    return min((b - a for i, a in enumerate(ends) for b in ends[i + 1:] if fits(b - a)), default=0)


def by_hand(docs, n=8):
    """(capacity, cut sizes) and the rows of the digest."""
    groups = defaultdict(int)
    for _, text in docs:
        groups[key(text)] += size(text)
    keys = sorted(groups)
    sizes = [groups[k] for k in keys]
    ends = [0, *accumulate(sizes)]
    capacity, total = least_by_hand(sizes, n), ends[-1]
    earliest = [total]
    for _ in range(n - 1):
        earliest.append(min(e for e in ends if e >= earliest[-1] - capacity))
    earliest.reverse()
    cut = [0]
    for j in range(n - 1):
        most, share = max(e for e in ends if e <= cut[-1] + capacity), cut[-1] + (total - cut[-1]) // (n - j)
        below, above = max(e for e in ends if e <= share), min(e for e in ends if e >= share)
        near = below if share - below <= above - share and below > cut[-1] else above
        cut.append(max(earliest[j], min(most, near)))
    shard = {k: sum(e > c for c in cut[1:]) for k, e in zip(keys, ends[1:])}
    out, slots = [], Counter()
    for i, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, key(d[1]))):
        s = shard[key(text)]
        out.append((i, size(text), zlib.crc32((text or "").encode()), "bytes", s, slots[s], None))
        slots[s] += 1
    return capacity, sorted(out, key=str)


DOCS = [(i, f"text {i} " * (i % 7)) for i in range(40)] + [
    (40, None), (41, ""), (None, "no id"), (None, "no id"), (7, "the same id"), (42, "é" * 30), (43, "é" * 30),
]


def test_against_brute_force(spark):
    got = shards.digest(documents(spark, DOCS))
    assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    assert rows(got) == by_hand(DOCS)[1]


def test_one_text_in_a_third_of_all_rows_and_a_long_one(spark):
    docs = [(i, "the same text" if i % 3 == 0 else f"text {i}") for i in range(600)] + [(600, "long " * 40_000)]
    capacity, want = by_hand(docs)
    got = rows(shards.digest(documents(spark, docs)))
    assert got == want
    held = Counter()
    for row in got:
        held[row[4]] += row[1]
    assert max(held.values()) == capacity and len(held) == 8


def test_few_groups_and_none(spark):
    assert shards.digest(documents(spark, [])).collect() == []
    docs = [(i, "x") for i in range(5)] + [(9, "y")]
    assert rows(shards.digest(documents(spark, docs))) == by_hand(docs)[1]


def test_cells_are_divided_until_the_answer_is_exact(spark):
    """Hashes that agree in their first 36 bits lie in one cell for three rounds."""
    draw = random.Random(3)
    keys = sorted({(5 << 24) + draw.randrange(1 << 24) for _ in range(300)})
    sizes = [draw.randrange(1, 500) for _ in keys]
    plan = shards.minimax(spark.createDataFrame(list(zip(keys, sizes)), "key long, size long"), 8)
    assert plan.capacity == least_by_hand(sizes, 8)
    held = Counter()
    for k, s in zip(keys, sizes):
        held[sum(k >= b for b in plan.bounds)] += s
    assert max(held.values()) <= plan.capacity and set(held) == set(range(8))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=14), st.integers(1, 6))
def test_search_and_cuts(sizes, n):
    grid = shards.Grid([shards.Cell(i, 0, s, 1) for i, s in enumerate(sizes)])
    capacity = shards.least_capacity(grid, n)
    assert capacity == least_by_hand(sizes, n)
    ends = [0, *shards.cuts(grid, capacity, n), grid.total]
    assert not grid.touched and set(ends) <= set(grid.ends)
    assert all(0 <= b - a <= capacity for a, b in zip(ends, ends[1:]))
    assert all(bisect_left(grid.ends, e) < len(grid.ends) for e in ends)


def test_texts_and_columns(spark):
    table = clashing(spark, DOCS)
    got = shards.sharded(table)
    assert got.columns == [*table.columns, "shard"]
    want = Counter((i, s) for i, _, _, _, s, _, _ in by_hand(DOCS)[1])
    assert Counter((r.doc_id, r.shard) for r in got.collect()) == want
    assert {r.row for r in got.collect()} == {f"row-{i}" for i, _ in DOCS}


def test_a_shard_less_is_refused(spark):
    with pytest.raises(ValueError):
        shards.digest(documents(spark, DOCS), shards=0)
