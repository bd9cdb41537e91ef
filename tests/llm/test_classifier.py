import zlib

import numpy as np
import pyarrow as pa
import pytest
from support import HAVE_TABLES, SF_LARGER, clashing, documents, rows

from marquee.llm import classifier
from marquee.llm.queries import QUERIES

LABELS = "doc_id bigint, quality int, toxic int"


@pytest.mark.skipif(not HAVE_TABLES, reason="no test tables")
def test_held_out_rows_are_told_apart(spark):
    result = QUERIES["op6_quality_classifier"](spark, SF_LARGER)
    labels = spark.read.parquet(f"{SF_LARGER}/labels.parquet")
    assert result.count() == spark.read.parquet(f"{SF_LARGER}/documents.parquet").count()
    judged = result.join(labels, "doc_id").where("held_out").collect()
    assert {zlib.crc32(str(r.doc_id).encode()) % 5 for r in judged} == {0}
    good = [r.predicted for r in judged if r.quality == 1]
    bad = [r.predicted for r in judged if r.quality == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.2
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in judged)


def _labelled(spark):
    good = [(i, f"The plain words of text {i} go on quietly, and so they say what they mean.") for i in range(60)]
    bad = [(100 + i, "$$$ ### win ### $$$ " * 5 + str(i)) for i in range(20)]
    docs = good + bad
    labels = [(i, int(i < 100), 0) for i, _ in docs]
    return docs, spark.createDataFrame(labels, LABELS)


def test_odd_rows_have_scores(spark):
    docs, labels = _labelled(spark)
    docs += [(None, None), (500, ""), (500, ""), (501, "$$$ ### " * 50_000), (502, "x")]
    result = classifier.classify(documents(spark, docs), labels).collect()
    assert len(result) == len(docs)
    assert all(r.score is not None and 0 <= r.score <= 1 for r in result)
    assert not any(r.held_out for r in result if r.doc_id is None)
    assert len({r.score for r in result if r.doc_id in (500, None)}) == 1
    by_id = {r.doc_id: r.predicted for r in result}
    assert by_id[501] == 0 and by_id[0] == 1


def test_labels_with_nulls_and_conflicts(spark):
    docs, _ = _labelled(spark)
    odd = spark.createDataFrame([(1, None, None), (None, 1, 0), (2, 1, 0), (2, 0, 0), (3, 1, 0)], LABELS)
    assert classifier.classify(documents(spark, docs), odd).count() == len(docs)


def test_empty_tables(spark):
    docs, labels = _labelled(spark)
    none = spark.createDataFrame([], LABELS)
    assert classifier.classify(documents(spark, []), labels).collect() == []
    scores = {r.score for r in classifier.classify(documents(spark, docs), none).collect()}
    assert len(scores) == 1


def test_accepted_keeps_all_columns(spark):
    docs, labels = _labelled(spark)
    table = clashing(spark, docs)
    kept = classifier.accepted(table, labels)
    assert kept.columns == table.columns
    assert set(rows(kept)) <= set(rows(table))
    assert {r.doc_id for r in kept.collect()} == set(range(60))


def test_risk_is_not_negative(spark):
    """With all texts alike nothing can be learned, and no score runs away."""
    same = pa.array(["the same text"] * 50)
    values = classifier.statistics(same)
    model = classifier.fit(values, values, 0.9)
    assert 0.3 < model.score(*values)[0] < 1


def _mixture(seed, n, share):
    """Statistics of good texts and of a mixture that has `share` of them."""
    draw = np.random.default_rng(seed)
    good = [" ".join(draw.choice(["the", "old", "man", "and", "sea", "went", "down"], 40)) for _ in range(n)]
    mixed = [" ".join(draw.choice(["the", "old", "man", "and", "sea", "went", "down"] if draw.random() < share
                                  else ["$$$", "WIN", "0000", "click", "the", "###"], 40)) for _ in range(2 * n)]
    return tuple(classifier.statistics(pa.array(x)) for x in (good, mixed))


@pytest.mark.parametrize("share", [0.3, 0.6, 0.9])
def test_prior_is_estimated_from_positives_and_unlabelled(share):
    positive, unlabelled = _mixture(4, 600, share)
    assert abs(classifier.class_prior(positive, unlabelled) - share) < 0.08


def test_tail_ratio_against_all_thresholds():
    draw = np.random.default_rng(2)
    p, u = draw.normal(1, 1, 400), draw.normal(0, 1, 700)
    every = [np.mean(u >= c) / np.mean(p >= c) for c in p if np.mean(p >= c) >= classifier.LEAST_TAIL]
    assert min(every) <= classifier.tail_ratio(p, u) <= min(every) * 1.1


def test_fit_against_plain_descent():
    """The risk that Adam reaches is no worse than that of many small steps along a numeric gradient."""
    positive, unlabelled = _mixture(6, 150, 0.7)
    prior = 0.65
    model = classifier.fit(positive, unlabelled, prior)

    def risk(m):
        p, u = (m.scaled(*x) @ m.weights + m.bias for x in (positive, unlabelled))
        rest = np.logaddexp(0, u).mean() - prior * np.logaddexp(0, p).mean()
        return prior * np.logaddexp(0, -p).mean() + max(0, rest)

    p, u = (model.scaled(*x).astype(float) for x in (positive, unlabelled))
    w, b = np.zeros(classifier.WIDTH), 0.0
    for _ in range(4_000):
        sp, su = (1 / (1 + np.exp(-(x @ w + b))) for x in (p, u))
        rest = np.logaddexp(0, u @ w + b).mean() - prior * np.logaddexp(0, p @ w + b).mean()
        step = np.append(u.T @ su, su.sum()) / len(u) - prior * np.append(p.T @ sp, sp.sum()) / len(p)
        step = step + prior * np.append(p.T @ (sp - 1), (sp - 1).sum()) / len(p) if rest >= 0 else -step
        w, b = w - 0.05 * (step[:-1] + 1e-3 * w), b - 0.05 * step[-1]
    reference = classifier.Model(model.mean, model.scale, w, b)
    assert risk(model) <= risk(reference) + 0.01
    agree = (model.score(*unlabelled) >= 0.5) == (reference.score(*unlabelled) >= 0.5)
    assert agree.mean() > 0.98


def test_spread_covers_all_documents(spark):
    docs, _ = _labelled(spark)
    docs += [(None, None), (7, ""), (7, "x" * 300_000)]
    mean, deviation = classifier._spread(documents(spark, docs), "text")
    values = classifier.statistics(pa.array([t for _, t in docs], pa.string()))[0].astype(float)
    assert np.allclose(mean, values.mean(0), atol=1e-6) and np.allclose(deviation, values.std(0), atol=1e-4)
    assert classifier._spread(documents(spark, []), "text") is None


def test_labels_without_a_document_use_up_no_bound(spark):
    docs, labels = _labelled(spark)
    strangers = spark.range(10_000, 18_000).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic")
    both = labels.unionByName(strangers)
    model = classifier.train(documents(spark, docs), both, positives=40)
    assert np.abs(model.weights).sum() > 0
