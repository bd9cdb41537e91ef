"""Quality classifier by positive-unlabelled learning.

A linear model of text statistics is fitted by the non-negative unbiased risk: trusted positives
weigh with the class prior, texts drawn without regard to labels stand for the whole web, and the part of the risk
that positives explain is taken off the unlabelled one, but never below zero. Labels that say 0
are used for nothing.

The prior, the share of good texts among all, is estimated from the same two samples: a model that
tells trusted from unlabelled texts scores the half that it has not seen, and above any score the
share of unlabelled texts over the share of trusted ones is an upper bound of the prior, since all
unlabelled good texts are there too. The least of these bounds is taken, as the mean of both halves.

Fitting takes bounded samples (`POSITIVES`, `UNLABELLED` rows, those with the least hash of the
id among documents that exist); mean and spread of the statistics are sums over all documents, and
scoring reads every whole text.

Cases: null and empty texts get the score of a text about which nothing is known. A null id is not
held out and in no sample. Rows with equal ids are scored each by itself, equal texts alike; one of
them is in a sample. Ties of the sampling hash go to the lower id. An empty table gives an empty
result; without positives all texts get one score. Columns of other names are kept.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from .common import fold_of, packed, small_batches, unpacked
from .words import byte_tables, chunks, release, word_hashes

FOLDS = 5
POSITIVES = 3_000
UNLABELLED = 6_000
BIGRAMS = 512
DENSE = 9
WIDTH = 256 + BIGRAMS + DENSE
#: A text counts as if so many average bytes were added, so that short texts stay near the mean.
SMOOTHING = 100.0
THRESHOLD = 0.3
#: Byte and pair shares are many and weak: each group weighs about as much as the word shares.
GROUPS = np.concatenate([np.full(256, 1 / 16), np.full(BIGRAMS, BIGRAMS**-0.5), np.full(DENSE, 1.0)])
FARTHEST = 6.0
#: Scores that at least this share of the trusted texts reach are looked at for the prior.
LEAST_TAIL = 0.7


def statistics(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Byte, byte-pair and word shares of each text, and its bytes. An empty text has zeros."""
    space, numbers = byte_tables()
    out, sizes = np.zeros((len(column), WIDTH), np.float32), np.zeros(len(column))
    for first, last, data, offsets in chunks(column):
        n, lengths = last - first, np.diff(offsets)
        sizes[first:last] = lengths
        if not len(data):
            continue
        row = np.repeat(np.arange(n), lengths)
        part = out[first:last]
        part[:, :256] = np.bincount(row * 256 + data, minlength=n * 256).reshape(n, 256)
        pair = (data[:-1].astype(np.int64) * 31 + data[1:]) % BIGRAMS
        same = row[:-1] == row[1:]
        part[:, 256 : 256 + BIGRAMS] = np.bincount(
            (row[:-1] * BIGRAMS + pair)[same], minlength=n * BIGRAMS
        ).reshape(n, BIGRAMS)
        hashes, of, starts, ends = word_hashes(data, offsets, space, numbers)
        words = np.bincount(of, minlength=n)
        per_word = np.maximum(words, 1)
        dense = part[:, 256 + BIGRAMS :]
        if len(hashes):
            one = of[1:] == of[:-1]
            two = of[2:] == of[:-2]
            again = one & (hashes[1:] == hashes[:-1])
            second = two & (hashes[2:] == hashes[:-2])
            order = np.lexsort((hashes, of))
            fresh = np.ones(len(order), bool)
            fresh[1:] = (hashes[order][1:] != hashes[order][:-1]) | (of[order][1:] != of[order][:-1])
            short = ends - starts == 1
            dense[:, 0] = np.bincount(of[1:][again], minlength=n) / per_word
            dense[:, 1] = np.bincount(of[2:][second], minlength=n) / per_word
            dense[:, 2] = np.bincount(of[order][fresh], minlength=n) / per_word
            dense[:, 3] = np.bincount(of[short], minlength=n) / per_word
            dense[:, 4] = np.bincount(of, weights=ends - starts, minlength=n) / per_word / 20
        total = np.maximum(lengths, 1)
        counts = part[:, :256]
        dense[:, 5] = counts[:, 65:91].sum(1) / total
        dense[:, 6] = counts[:, 48:58].sum(1) / total
        marks = [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]
        dense[:, 7] = counts[:, marks].sum(1) / total
        dense[:, 8] = counts[:, 128:].sum(1) / total
        part[:, : 256 + BIGRAMS] /= total[:, None]
    return out, sizes


@dataclass(frozen=True)
class Model:
    """score = sigmoid((x - mean) / scale * size / (size + SMOOTHING) . weights + bias)"""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float

    def scaled(self, values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        share = (sizes / (sizes + SMOOTHING))[:, None].astype(self.mean.dtype)
        out = (values - self.mean) / self.scale
        np.clip(out, -FARTHEST, FARTHEST, out=out)
        out *= GROUPS.astype(out.dtype)
        out *= share
        return out

    def score(self, values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        line = self.scaled(values, sizes) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(line, -40, 40)))


def fit(
    positive: tuple[np.ndarray, np.ndarray], unlabelled: tuple[np.ndarray, np.ndarray], prior: float,
    spread: tuple[np.ndarray, np.ndarray] | None = None, corrected: bool = True,
    steps: int = 400, rate: float = 0.02, decay: float = 1e-3,
) -> Model:
    """Minimise prior * loss(P, 1) + max(0, loss(U, 0) - prior * loss(P, 0)) by Adam, with the
    logistic loss; where the second part is negative, a step goes against its gradient. Not
    `corrected`, it tells P from U. `spread` has mean and deviation of the statistics."""
    if not len(positive[0]) or not len(unlabelled[0]):
        return Model(np.zeros(WIDTH), np.ones(WIDTH), np.zeros(WIDTH), float(np.log(prior / (1 - prior))))
    both = np.concatenate((positive[0], unlabelled[0]))
    mean, deviation = spread or (both.mean(0, dtype=np.float64), both.std(0, dtype=np.float64))
    model = Model(mean.astype(np.float32), (deviation + 1e-4).astype(np.float32), np.zeros(WIDTH), 0.0)
    p, u = (model.scaled(*x).astype(np.float32) for x in (positive, unlabelled))
    w, b = np.zeros(WIDTH), 0.0
    moment, square = np.zeros(WIDTH + 1), np.zeros(WIDTH + 1)

    def sigmoid(x):
        return 1 / (1 + np.exp(-np.clip(x, -40, 40)))

    def mean_gradient(x, slope):
        return np.append(x.T @ slope.astype(np.float32), slope.sum()) / len(x)

    for step in range(1, steps + 1):
        at_p, at_u = p @ w.astype(np.float32) + b, u @ w.astype(np.float32) + b
        if corrected:
            negative = np.logaddexp(0, at_u).mean() - prior * np.logaddexp(0, at_p).mean()
            rest = mean_gradient(u, sigmoid(at_u)) - prior * mean_gradient(p, sigmoid(at_p))
            gradient = prior * mean_gradient(p, sigmoid(at_p) - 1) + rest if negative >= 0 else -rest
        else:
            gradient = mean_gradient(p, sigmoid(at_p) - 1) + mean_gradient(u, sigmoid(at_u))
        gradient[:-1] += decay * w
        moment = 0.9 * moment + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        move = rate * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return Model(model.mean, model.scale, w, float(b))


def tail_ratio(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The least share of unlabelled scores over the share of positive ones above a score."""
    bounds = np.unique(np.quantile(positive, np.linspace(0, 1 - LEAST_TAIL, 181), method="lower"))
    return min(float((unlabelled >= c).mean() / (positive >= c).mean()) for c in bounds)


def class_prior(
    positive: tuple[np.ndarray, np.ndarray], unlabelled: tuple[np.ndarray, np.ndarray],
    spread: tuple[np.ndarray, np.ndarray] | None = None,
) -> float:
    """The share of positives among the unlabelled, from the scores of the halves not fitted on."""
    if min(len(positive[0]), len(unlabelled[0])) < 2:
        return 0.5
    found = []
    for half in (0, 1):
        (p, unseen_p), (u, unseen_u) = (
            [tuple(x[i::2] for x in sample) for i in (half, 1 - half)] for sample in (positive, unlabelled))
        model = fit(p, u, 0.5, spread, corrected=False, steps=300, decay=1e-2)
        found.append(tail_ratio(model.score(*unseen_p), model.score(*unseen_u)))
    return min(max(sum(found) / 2, 0.05), 0.95)


def _numbers(batches):
    """(which, bytes of the statistics) of each text."""
    for batch in batches:
        values, sizes = statistics(batch.column("text"))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("which"),
                pa.array(sizes, pa.float64()),
                pa.array([v.tobytes() for v in values], pa.binary()),
            ],
            names=["which", "size", "numbers"],
        )


def _collected(texts: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """The statistics of a bounded sample."""
    rows = texts.mapInArrow(_numbers, "which string, size double, numbers binary").collect()
    out = {}
    for which in ("p", "u"):
        mine = [r for r in rows if r["which"] == which]
        values = np.array([np.frombuffer(r["numbers"], np.float32) for r in mine])
        out[which] = values.reshape(len(mine), WIDTH), np.array([r["size"] for r in mine])
    return out


def train(
    docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
    label: str = "quality", positives: int = POSITIVES, unlabelled: int = UNLABELLED,
) -> Model:
    """Fit on the training folds. Labels and ids that are null are left out; a document is a
    positive if every label it has is 1. Without positives or texts the model returns the prior."""
    votes = (
        labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull() & (fold_of(F.col(doc_id)) != 0))
        .groupBy(doc_id).agg((F.min(label) >= 1).alias("good"))
    )
    ids = docs.select(F.col(doc_id).alias("id")).where("id IS NOT NULL").distinct()
    order = F.xxhash64(F.lit("pu"), "id")
    trusted = votes.where("good").select(F.col(doc_id).alias("id")).join(ids, "id", "left_semi")
    marked = (
        trusted.orderBy(order, "id").limit(positives).select("id", F.lit("p").alias("which"))
        .unionAll(ids.orderBy(order, "id").limit(unlabelled).select("id", F.lit("u").alias("which")))
    )
    chosen = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(
        F.broadcast(marked), "id"  # at most positives + unlabelled rows
    )
    chosen = chosen.dropDuplicates(["id", "which"])
    sample = _collected(chosen)
    spread = _spread(docs, text)
    return fit(sample["p"], sample["u"], class_prior(sample["p"], sample["u"], spread), spread)


def _moments(batches):
    total = np.zeros((3, WIDTH))
    for batch in batches:
        values = statistics(batch.column("text"))[0].astype(np.float64)
        total += [np.full(WIDTH, len(values)), values.sum(0), np.square(values).sum(0)]
    release()
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.arange(WIDTH), pa.int32()), *(pa.array(x) for x in total)], names=["place", "n", "sum", "squares"])


def _spread(docs: DataFrame, text: str) -> tuple[np.ndarray, np.ndarray] | None:
    """Mean and deviation of each statistic over all documents."""
    small_batches(docs.sparkSession)
    sums = docs.select(F.col(text).alias("text")).mapInArrow(_moments, "place int, n double, sum double, squares double")
    rows = sums.groupBy("place").agg(*(F.sum(c).alias(c) for c in ("n", "sum", "squares"))).orderBy("place").collect()
    n, total, squares = (np.array([r[c] for r in rows]) for c in ("n", "sum", "squares"))  # WIDTH rows
    if not len(n) or not n[0]:
        return None
    return total / n, np.sqrt(np.maximum(squares / n - (total / n) ** 2, 0))


def score(docs: DataFrame, model: Model, *, text: str = "text", into: str = "score") -> DataFrame:
    """`docs` with a score from 0 to 1; higher: good quality is likelier. Null and empty texts
    get the score of a text about which nothing is known. Other columns pass through."""
    small_batches(docs.sparkSession)
    model = Model(*(np.asarray(x, np.float64) for x in (model.mean, model.scale, model.weights)), model.bias)

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        values, sizes = statistics(texts)
        out = pa.array(model.score(values, sizes), pa.float64())
        del values
        release()
        return out

    return docs.withColumn(into, scored(F.col(text)))


def classify(
    docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
    label: str = "quality", threshold: float = THRESHOLD,
) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of `docs`. A null id is not held out,
    and its text is scored like any other."""
    small_batches(docs.sparkSession)
    model = train(docs, labels, doc_id=doc_id, text=text, label=label)
    held_out = F.coalesce(fold_of(F.col(doc_id)) == 0, F.lit(False))
    scored = score(docs.select(doc_id, text), model, text=text)
    return scored.select(
        doc_id, held_out.alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def accepted(
    docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
    label: str = "quality", threshold: float = THRESHOLD,
) -> DataFrame:
    """The rows of `docs` that the classifier takes, with their columns."""
    model = train(docs, labels, doc_id=doc_id, text=text, label=label)
    rows = score(packed(docs, text=text), model)
    return unpacked(rows.where(F.col("score") >= threshold), docs)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
