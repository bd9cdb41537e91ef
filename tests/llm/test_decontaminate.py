import re

import pytest
from support import HAVE_TABLES, SF, clashing, documents, rows

from marquee.llm import decontaminate
from marquee.llm.queries import QUERIES

WORD = re.compile(r"[0-9]+(?:[.,][0-9]+)*|[^\W\d_]+(?:['’][^\W\d_]+)*|[%$€£°]")
ITEM = "A train leaves Lyon at 9 and goes 120 km in 2 hours, how fast does it go on the way?"


def tokens(text):
    """(value, canonical) of each token."""
    out = []
    for m in WORD.finditer(text or ""):
        raw, before = m.group(), text[max(0, m.start() - 2) : m.start()]
        name = (len(before) == 2 and before[1] == " " and (before[0].isalnum() or before[0] in ",;")
                and raw[0].isupper() and raw[1:2].islower())
        value = raw.lower()
        kind = ("#number" if raw[0].isdigit() else "#name" if name
                else "#unit" if value in decontaminate.UNITS else value)
        out.append((value, kind))
    return out


def by_hand(docs, items, window=decontaminate.WINDOW, gap=decontaminate.GAP):
    """Every window of the texts against every window of the items, by templates and word for word."""
    found = set()
    read = [(item, tokens(body)) for item, body in items if item is not None and tokens(body)]
    index = {}
    for number, (_, t) in enumerate(read):
        n = min(len(t), window)
        for j in range(len(t) - n + 1):
            index.setdefault((True, *(v for v, _ in t[j : j + n])), []).append((number, j))
            kinds = [k for _, k in t[j : j + n]]
            if sum(not k.startswith("#") for k in kinds) >= decontaminate.MIN_LITERAL:
                index.setdefault((False, *kinds), []).append((number, j))
    lengths = {min(len(t), window) for _, t in read}
    for doc, text in docs:
        d, hits = tokens(text), {}
        for n in lengths:
            for i in range(len(d) - n + 1):
                for exact in (True, False):
                    for number, j in index.get((exact, *(x[not exact] for x in d[i : i + n])), ()):
                        if min(len(read[number][1]), window) == n:
                            hits.setdefault(number, {}).setdefault((i - j, exact), set()).update(range(j, j + n))
        for number, diagonals in hits.items():
            item, t = read[number]
            kept = []
            for (shift, exact), places in diagonals.items():
                pairs = [(t[p][0], d[p + shift][0], p) for p in places if t[p][1].startswith("#")]
                if exact or len({a for a, _, _ in pairs}) == len({(a, b) for a, b, _ in pairs}):
                    kept.append((shift, exact, places, set() if exact else {p for a, b, p in pairs if a != b}))
            kept.sort(key=lambda x: x[0])
            chains = []
            for one in kept:
                if not chains or one[0] - chains[-1][-1][0] > gap:
                    chains.append([])
                chains[-1].append(one)
            needed, best = min(len(t), decontaminate.MIN_COVERED), None
            for chain in chains:
                covered = set().union(*(p for _, exact, p, _ in chain if not exact))
                if len(covered) < needed:
                    covered = set().union(*(p for _, _, p, _ in chain))
                changes = set().union(*(c for *_, c in chain))
                if len(covered) >= needed:
                    best = max(best or (0, 0), (len(covered), -len(changes)))
            if best:
                found.add((doc, item, best[0], -best[1]))
    return sorted(found, key=str)


def bench(spark, items):
    return spark.createDataFrame(items, "item_id bigint, text string")


DOCS = [
    (1, f"Before. {ITEM} After."), (2, ITEM.upper()), (3, ITEM.replace("120", "340").replace("Lyon", "Paris")),
    (4, ITEM.replace("9", "7").replace("120", "60").replace("km", "miles")), (5, "Nothing of this is in the benchmark at all, I think."),
    (6, None), (7, ""), (None, ITEM), (8, f"{ITEM}\n{ITEM.replace('2 hours', '3 hours')}"), (9, "word " * 30_000), (3, ITEM),
    (10, ITEM), (10, ITEM), (11, "She has 3 of 3 and 3 more than 3 who came, that is all we know of it now."),
    (12, "She has 3 of 4 and 5 more than 3 who came, that is all we know of it now."), (13, "Far too short an item here."),
]
ITEMS = [
    (1, ITEM), (2, "He has 5 of 5 and 5 more than 5 who came, that is all we know of it now."), (3, None), (4, ""),
    (None, ITEM), (5, "too short an item"), (6, "1 2 3"), (1, ITEM),
]


def test_against_brute_force(spark):
    got = rows(decontaminate.contaminated(documents(spark, DOCS), bench(spark, ITEMS)).distinct())
    assert got == by_hand(DOCS, ITEMS)
    assert {(1, 1), (3, 1), (4, 1), (11, 2), (13, 5)} <= {r[:2] for r in got}
    assert not any(r[0] in (5, 9) for r in got)


def test_slots_must_agree(spark):
    """3 of 3 and 3 may stand for 5 of 5 and 5, but 3 of 4 and 5 may not."""
    got = {r[:2]: r for r in rows(decontaminate.contaminated(documents(spark, DOCS), bench(spark, ITEMS)))}
    assert got[11, 2][3] == 4
    assert got.get((12, 2), (0, 0, 99, 0))[2] != got[11, 2][2]


def found_in(spark, text, item):
    got = decontaminate.contaminated(documents(spark, [(1, text)]), bench(spark, [(1, item)]))
    return [r.n_covered for r in got.collect()]


def test_pieces_far_apart_are_no_passage(spark):
    """Two pieces of eight words count together in their order, with a few words between them."""
    words = "the old man went down to the sea with his boat and his son came after him".split()
    first, second, filler = " ".join(words[:8]), " ".join(words[9:]), "and then it was " * 200
    item = " ".join(words)
    assert found_in(spark, f"{first} then and only then {second}", item) == [16]
    assert found_in(spark, f"{second} {filler} {first}", item) == []
    assert found_in(spark, f"{first} {filler} {second}", item) == []


def test_items_of_several_lengths(spark):
    words = "It was 3 men of Rome who saw 7 ships go down with all hands near Malta in 20 days".split()
    items = [(n, " ".join(words[n : 2 * n])) for n in range(1, 10)] + [(20, " ".join(words)), (21, "a 1 b 2 c 3 d 4 e 5")]
    docs = [(i, " ".join(words[i:] + ["and", "so"] + words[:i])) for i in range(12)] + [
        (30, "a 9 b 8 c 7 d 6 e 5"), (31, "x a 1 b 2 c 3 d 4 e 5 y"), (32, " ".join(words).replace("7", "8"))]
    got = rows(decontaminate.contaminated(documents(spark, docs), bench(spark, items)))
    assert got == by_hand(docs, items) and {r[1] for r in got} == {*range(1, 10), 20, 21}


def test_copies_with_few_literal_tokens(spark):
    sums = "What is 17 * 23 + 41 * 19 - 8 * 12 + 5?"
    assert found_in(spark, f"Now this. {sums} Next.", sums) == [9]
    assert found_in(spark, "It counts: 1 2 3.", "1 2 3") == [3]
    assert found_in(spark, sums.replace("41", "43"), sums) == []


def test_one_value_changed_in_one_place(spark):
    """One of two equal values differs; the rest stands word for word."""
    item = ("With 3 of the boats gone out to sea the old man and his son went home to eat and sleep, "
            "then in the morning another 3 came back to the shore with all the fish they had")
    text = item.replace("another 3", "another 4")
    assert found_in(spark, text, item)


@pytest.mark.parametrize("text, item, n", [
    ("Now question 3 What is the largest planet that orbits around the sun?", "What is the largest planet that orbits around the sun?", 10),
    ("He lives in the old city of\nParis in northern France now.", "He lives in the old city of Paris in northern France", 11),
])
def test_copies_in_other_surroundings(spark, text, item, n):
    assert found_in(spark, text, item) == [n]


def test_documents_without_leaks(spark):
    table = clashing(spark, DOCS)
    left = decontaminate.without_leaks(table, bench(spark, ITEMS))
    leaks = {(r[0]) for r in by_hand(DOCS, ITEMS)}
    assert left.columns == table.columns
    assert {r.doc_id for r in left.collect()} == {i for i, _ in DOCS} - leaks


def test_empty_tables(spark):
    assert decontaminate.contaminated(documents(spark, []), bench(spark, ITEMS)).collect() == []
    assert decontaminate.contaminated(documents(spark, DOCS), bench(spark, [])).collect() == []
    assert decontaminate.without_leaks(documents(spark, DOCS), bench(spark, [])).count() == len(DOCS)


@pytest.mark.skipif(not HAVE_TABLES, reason="no test tables")
def test_registered_query(spark):
    out = QUERIES["op9_decontamination"](spark, SF)
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    assert rows(out) == by_hand(docs, items)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
