import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from support import HAVE_TABLES, SF_LARGER, clashing, documents, rows

from marquee.llm import rules
from marquee.llm.queries import QUERIES

LABELS = "doc_id bigint, quality int, toxic int"


def base(text):
    """The first five counts and whether the plain rules reject."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            covered |= {i, i + 1, i + 2}
    n, r = len(words), len(covered)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), r,
            n < 50 or 100 * r > 50 * n)


def counted(texts):
    numbers = rules.counts(pa.array(texts, pa.string()))
    return [(*(int(x) for x in row[:5]), bool(failed)) for row, failed in zip(numbers, rules.base_failed(numbers))]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from(
    ["a", "A", "b", " ", "  ", "\n", "\t", "\x0b", "é", "漢", "#", "<|", "\x1c", " ", "a b c ", "\n\n"]), max_size=60).map("".join),
    min_size=1, max_size=5))
def test_counts(texts):
    assert counted(texts) == [base(t) for t in texts]


def test_odd_texts():
    texts = [None, "", " ", "\n", "word " * 200_000, "x" * 3_000_000, "same line\n" * 3, "a b c a b c", "end"]
    assert counted(texts) == [base(t) for t in texts]


def test_forest_sets_odd_rows_apart():
    random = np.random.default_rng(1)
    usual, odd = random.normal(0, 1, (2_000, 4)), random.normal(7, 1, (40, 4))
    forest = rules.grow_forest(np.concatenate([usual, odd]))
    assert np.quantile(forest.score(usual), 0.99) < np.quantile(forest.score(odd), 0.1)
    forest = rules.calibrate(forest, usual[:1_000], odd[:20])
    assert (forest.score(usual) > forest.threshold).mean() < 0.01 and (forest.score(odd) > forest.threshold).mean() > 0.9


def test_forest_of_little():
    assert rules.grow_forest(np.zeros((0, 3))).score(np.zeros((2, 3))).tolist() == [0, 0]
    alike = rules.grow_forest(np.ones((50, 3)))
    assert len(set(alike.score(np.ones((4, 3))).tolist())) == 1
    assert rules.calibrate(alike, np.ones((3, 3)), np.zeros((0, 3))).threshold == np.inf


DOCS = [(None, None), (1, ""), (2, "short"), (3, "a b c " * 40), (3, "a b c " * 40), (4, " ".join(f"word{i}" for i in range(80)))]


def test_rows(spark):
    labels = spark.createDataFrame([(4, 1, 0), (3, 0, 0), (None, 0, 0), (2, None, 0), (4, 1, 0)], LABELS)
    want = sorted(((i, *base(t)) for i, t in DOCS), key=str)
    for docs in (documents(spark, DOCS), clashing(spark, DOCS)):
        result = rules.digest(docs, labels).collect()
        assert sorted((tuple(r[:7]) for r in result), key=str) == want
        assert all(r.kept == (not r.base_failed) for r in result)


def test_empty_tables(spark):
    none = spark.createDataFrame([], LABELS)
    assert rules.digest(documents(spark, []), none).collect() == []
    assert rules.digest(documents(spark, DOCS), none).count() == len(DOCS)


def test_one_odd_good_row_does_not_decide():
    """The threshold is the one of least cost among all, tried one by one."""
    random = np.random.default_rng(3)
    usual, odd = random.normal(0, 1, (900, 3)), random.normal(8, 1, (60, 3))
    forest = rules.grow_forest(np.concatenate([usual, odd]))
    good = np.concatenate([usual[:400], [[30.0, 30.0, 30.0]]])
    found = rules.calibrate(forest, good, odd).threshold
    of_good, of_bad = forest.score(good), forest.score(odd)
    def cost(t):
        return rules.COST * sum(x > t for x in of_good) + sum(x <= t for x in of_bad)
    assert cost(found) == min(map(cost, [*of_good, *of_bad, np.inf]))
    assert (of_bad > found).mean() > 0.5 and 1 <= sum(of_good > found) <= 3


def by_hand(text, forest):
    """Anomaly and verdict of a text, one tree and one step at a time."""
    n, chars, symbols, _, _, failed = base(text)
    upper, marks = len(re.findall("[A-Z]", text)), len(re.findall(r"[!-/:-@\[-`{-~]", text))
    single = sum(len(w.encode()) == 1 for w in re.findall(r"[^\x20\x09-\x0D]+", text))
    values = [chars / max(n, 1), symbols / max(chars, 1), upper / max(chars, 1), marks / max(chars, 1), single / max(n, 1)]
    total = 0.0
    for feature, split, left, right, path in forest.trees:
        at = 0
        while feature[at] >= 0:
            at = left[at] if values[feature[at]] < split[at] else right[at]
        total += path[at]
    anomaly = 2 ** (-total / len(forest.trees) / forest.usual)
    return anomaly, not failed and anomaly <= forest.threshold


@pytest.mark.skipif(not HAVE_TABLES, reason="no test tables")
def test_verdicts_of_a_table_against_brute_force(spark):
    docs, labels = (spark.read.parquet(f"{SF_LARGER}/{t}.parquet") for t in ("documents", "labels"))
    forest = rules.fit(docs, labels)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in rules.digest(docs, labels).collect():
        anomaly, kept = by_hand(texts[r.doc_id] or "", forest)
        assert r.kept == kept and abs(r.anomaly - anomaly) < 1e-9


@pytest.mark.skipif(not HAVE_TABLES, reason="no test tables")
def test_registered_query(spark):
    result = QUERIES["op3_quality_rules"](spark, SF_LARGER)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_LARGER}/documents.parquet").collect()}
    found = result.collect()
    assert sorted(tuple(r[:7]) for r in found) == sorted((i, *base(t)) for i, t in texts.items())
    judged = result.join(spark.read.parquet(f"{SF_LARGER}/labels.parquet"), "doc_id").where("NOT base_failed").collect()
    assert np.mean([r.kept for r in judged if r.quality == 1]) > 0.98
    assert np.mean([r.kept for r in judged if r.quality == 0]) < 0.2


def test_threshold_of_all_labelled_rows_on_spark(spark, monkeypatch):
    """Calibrated on every labelled row, in several ranges of scores, as `calibrate` does at once."""
    monkeypatch.setattr(rules, "BUCKET_ROWS", 100)
    random = np.random.default_rng(5)
    usual, odd = random.normal(0, 1, (3_000, 3)), random.normal(4, 1, (400, 3))
    forest = rules.grow_forest(np.concatenate([usual[:500], odd[:50]]))
    good, bad = np.concatenate([usual, odd[:30]]), np.concatenate([odd[30:], usual[:100]])
    rows = [(True, float(s)) for s in forest.score(good)] + [(False, float(s)) for s in forest.score(bad)]
    scored = spark.createDataFrame(rows, "good boolean, score double").repartition(7)
    assert rules.calibrate_scored(forest, scored).threshold == rules.calibrate(forest, good, bad).threshold
    assert rules.calibrate_scored(forest, scored.where("good")).threshold == np.inf
