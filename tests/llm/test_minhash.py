import random
import re
from collections import Counter, defaultdict

import pytest
from support import HAVE_TABLES, SF_LARGER, clashing, documents, rows

from marquee.llm import components, minhash
from marquee.llm.queries import QUERIES

LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text, words):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))) if w else frozenset()


def by_hand(docs, words=4, percent=80):
    sets = [shingles(t, words) for _, t in docs]
    holders, shared = defaultdict(list), Counter()
    first = {}
    for n, s in enumerate(sets):
        if s and first.setdefault(s, n) == n:
            for g in s:
                holders[g].append(n)
    for ns in holders.values():
        for i, a in enumerate(ns):
            shared.update((a, b) for b in ns[i + 1 :])
    root = list(range(len(docs)))
    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for n, s in enumerate(sets):
        if s:
            root[find(n)] = find(first[s])
    for (a, b), both in shared.items():
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            root[find(b)] = find(a)
    least = {}
    for n, (i, _) in enumerate(docs):
        if i is not None:
            least[find(n)] = min(i, least.get(find(n), i))
    return sorted(((i, len(sets[n]), least.get(find(n)) if sets[n] else i, (least.get(find(n)) if sets[n] else i) == i)
                   for n, (i, _) in enumerate(docs)), key=str)


def corpus(seed, copies=12):
    """Texts, copies of them with a few other words, and copies of copies."""
    r = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    docs = []
    for _ in range(12):
        text = [r.choice(words) for _ in range(r.randint(3, 160))]
        for _ in range(r.randint(1, copies)):
            copy = [w if r.random() > r.choice([0, 0.01, 0.03, 0.08]) else r.choice(words) for w in text]
            docs.append(" ".join(copy))
            if r.random() < 0.3:
                text = copy
    r.shuffle(docs)
    return list(enumerate(docs))


ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "one two"), (5, "ONE  two"), (6, "one"), (None, "one two"), (7, "A long text. " * 20_000),
       (8, "a long text. " * 20_000), (9, "a b c d e f g h"), (9, "a b c d e f g h"), (9, "something else with the same id"), (None, "alone here")]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force(spark, seed):
    docs = [(100 + i, t) for i, t in corpus(seed)] + ODD
    assert rows(minhash.digest(documents(spark, docs))) == by_hand(docs)


def test_five_words_and_other_columns(spark):
    docs = [(100 + i, t) for i, t in corpus(4)] + ODD
    table = clashing(spark, docs)
    kept = minhash.one_of_each(table)
    assert kept.columns == table.columns
    want = sorted({i for i, _, _, k in by_hand(docs, words=5) if k and i is not None})
    assert sorted({r.doc_id for r in kept.collect() if r.doc_id is not None}) == want


def test_many_copies_of_one_text(spark):
    text = " ".join(f"w{i}" for i in range(60))
    docs = [(i, text if i % 3 else f"{text} end{i % 5}") for i in range(400)] + [(1_000, "other words are here now")]
    assert rows(minhash.digest(documents(spark, docs))) == by_hand(docs)


def test_crowded_region(spark):
    """On each boilerplate two short texts are near copies of each other; longer texts on it, that
    are near copies of none, stand between them in every order."""
    r = random.Random(5)
    fresh = iter(range(10**6))
    docs, want = [], {}
    for region in range(4):
        common = [f"c{region}_{i}" for i in range(203)]
        for i, own in enumerate([24, 24] + [60] * 700):
            doc = 1_000 * region + i
            docs.append((doc, " ".join(common + [f"x{next(fresh)}" for _ in range(own)])))
            want[doc] = 1_000 * region if own == 24 else doc
    short, other, long = (shingles(t, 4) for _, t in docs[:3])
    assert 100 * len(short & other) >= 80 * len(short | other) and 100 * len(short & long) < 75 * len(short | long)
    r.shuffle(docs)
    assert {r.doc_id: r.component_id for r in minhash.digest(documents(spark, docs)).collect()} == want


def test_empty_table(spark):
    assert minhash.digest(documents(spark, [])).collect() == []
    assert minhash.one_of_each(documents(spark, [])).collect() == []


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (None, 3), (200, 150), (300, 150), (300, 250)]
    found = {r.node: r.root for r in components.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 150: 150, 200: 150, 250: 150, 300: 150}
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_more_links_join_components(spark):
    r = random.Random(4)
    some, more = ([(r.randrange(90), r.randrange(90)) for _ in range(n)] for n in (40, 25))
    def found(links):
        return components.components(spark.createDataFrame(links, "a long, b long"))
    want = rows(found(some + more))
    first = components.stored(found(some), "test")
    both = components.extended(first, spark.createDataFrame(more, "a long, b long"))
    alone = {x for x, _ in want}
    assert [x for x in rows(both) if x[0] in alone] == want
    assert all(a == b for a, b in rows(both) if a not in alone)
    assert rows(components.extended(first, spark.createDataFrame([], "a long, b long"))) == rows(first)


def test_state_of_many_links(spark):
    """A sum of 40-bit hashes would not fit for so many."""
    edges = spark.range(20_000_000).selectExpr("id AS v", "id + 1 AS u")
    held, (count, mark) = components._state(edges, "test")
    assert count == held.count() == 20_000_000 and mark != components._state(edges.where("v <> 77"), "test")[1][1]


def test_hubs_are_divided(spark, monkeypatch):
    monkeypatch.setattr(components, "HUB", 20)
    monkeypatch.setattr(components, "SALTS", 4)
    r = random.Random(9)
    links = [(5, 1_000 + i) for i in range(300)] + [(1_299, 3_000 + i) for i in range(100)] + [(3_050, 2)]
    links += [(9_000 + r.randrange(40), 9_000 + r.randrange(40)) for _ in range(60)]
    root = {}
    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for a, b in links:
        if a != b:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    found = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {x: find(x) for x in root}


@pytest.mark.skipif(not HAVE_TABLES, reason="no test tables")
def test_registered_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_LARGER}/documents.parquet").select("doc_id", "text").collect()]
    assert rows(QUERIES["op1_near_duplicates"](spark, SF_LARGER)) == by_hand(docs)
