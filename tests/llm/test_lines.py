import hashlib
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from support import clashing, documents, rows

from marquee.llm import lines

SPACE = " \t\n\x0b\x0c\r"
LOWER = {c: c + 32 for c in range(65, 91)}


def by_hand(docs, min_chars=20, min_documents=3):
    """(kept text, lines, dropped) of each row."""
    holders = defaultdict(set)
    def key(line):
        return line.strip(SPACE).translate(LOWER)
    for i, text in docs:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(i)
    last = {}
    for k, ids in holders.items():
        if len(ids) >= min_documents:
            last[k] = max(i for i in ids if i is not None)
    out = []
    for i, text in docs:
        split = (text or "").split("\n")
        kept = [x for x in split if last.get(key(x), i) == i]
        out.append((i, len(split), len(split) - len(kept), "\n".join(kept)))
    return out


def digests(docs, **limits):
    return sorted(((i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in by_hand(docs, **limits)), key=str)


A, B = "A line that many documents share.", "Ünother line, of more than twenty."
DOCS = [
    (1, f"one\n{A}\ntwo\n{A}\n"), (2, f"  {A.upper()}\t\n{B}"), (3, f"{A}\r\n{A}"), (4, B), (5, f"x\n{B}\n\ny"),
    (6, None), (7, ""), (8, "short\nshort"), (9, "short"), (10, "short"), (None, f"{A}\n{B}"), (None, A),
    (3, f"{A}\nthe same id again"), (4, B), (11, "\n\n\n"), (12, "word " * 40_000),
]


def test_against_brute_force(spark):
    assert rows(lines.digest(documents(spark, DOCS))) == digests(DOCS)


def test_texts_and_columns(spark):
    table = clashing(spark, DOCS)
    cut = lines.without_repeats(table)
    assert cut.columns == table.columns
    assert sorted(((r.doc_id, r.text) for r in cut.collect()), key=str) == sorted(
        ((i, t) for i, _, _, t in by_hand(DOCS)), key=str)
    assert {r.id for r in cut.collect()} == {f"id-{i}" for i, _ in DOCS}


def test_bitmaps_are_runs(spark):
    docs = documents(spark, [(i, f"{A}\n{B}\n\n{A}") for i in range(4)])
    found = {r.id: [tuple(x) for x in r.dropped] for r in lines.keep_bitmaps(docs).collect()}
    assert found == {i: [(0, 1), (3, 3)] for i in range(3)}


def test_empty_table(spark):
    assert lines.digest(documents(spark, [])).collect() == []


def test_a_line_in_every_document(spark):
    docs = [(i, f"own line of document {i}\n{A}") for i in range(500)]
    assert rows(lines.digest(documents(spark, docs))) == digests(docs)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(["aa", "AA", " aa ", "ab", "", "b\t", "B", "é"]), max_size=5), max_size=7))
def test_small_alphabet(spark, texts):
    docs = [(i, "\n".join(t)) for i, t in enumerate(texts)]
    assert rows(lines.digest(documents(spark, docs), min_chars=1, min_documents=2)) == digests(
        docs, min_chars=1, min_documents=2)


@pytest.mark.parametrize("name", ["op8_line_dedup"])
def test_only_native_plans(spark, name):
    plan = lines.digest(documents(spark, DOCS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_the_sort_feeds_the_first_occurrences(spark):
    """Ranges are sorted by document and position and not dealt out anew before the window."""
    hashes = lines.line_hashes(documents(spark, DOCS), doc_id="doc_id", text="text", min_chars=20)
    plan = lines.last_holders(hashes, 3)._jdf.queryExecution().executedPlan().toString().splitlines()
    at = {name: next(i for i, line in enumerate(plan) if name in line)
          for name in ("Window [", "Sort [h1", "rangepartitioning")}
    assert at["Window ["] < at["Sort [h1"] < at["rangepartitioning"]
    assert all(x in plan[at["Sort [h1"]] for x in ("h2", "id", "pos"))
    assert not any("hashpartitioning" in line for line in plan[at["Window ["]:])
