"""Quality rules: statistics of a text, and an isolation forest over them.

Plain rules reject texts that are short or mostly repeated. For the rest, an isolation forest looks
at shares of symbols, marks, capitals, digits, repeats and word lengths: random splits separate an
odd text from the others after few steps. The forest is grown on a bounded sample (`SAMPLE` texts
with the least hash of the id, whatever their labels); the threshold on its score is calibrated on
all labelled rows at the least cost, on Spark, where a good row that is lost costs as much as
`COST` bad ones that stay; so no single odd row decides. Statistics are taken of every whole text.

Cases: a null or empty text has no words and fails the plain rules. Labels that are null, or of no
document, are left out; without good or bad labelled rows the forest rejects nothing. An empty table
gives an empty result. Rows with equal ids are judged each by itself, and one of them is in a sample;
ties of the sampling hash go to the lower id. Columns of other names are kept.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F

from .common import drop_stored, fold_of, small_batches, stored
from .words import SEED, byte_tables, chunks, mix, release, word_hashes

MIN_WORDS, MAX_REPEATED = 50, 50
SAMPLE = 6_000
#: Distinct scores a range holds at least, and ranges at most, in calibrating.
BUCKET_ROWS, MOST_BUCKETS = 10_000, 1_000
TREES, TREE_ROWS = 128, 256
COST = 20
SYMBOLS = b"#*$%&|<>"
COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_upper", "n_marks", "n_single",
)


def counts(column: pa.Array) -> np.ndarray:
    """The numbers of COUNTS for each text, a row for each."""
    space, numbers = byte_tables()
    exact = numbers.copy()
    exact[65:91] = np.random.default_rng(SEED + 3).integers(1, 2**63, 26, dtype=np.uint64) * np.uint64(2)
    kinds = np.zeros((4, 256), bool)
    kinds[0] = ~space
    kinds[0, 0x80:0xC0] = False
    kinds[1, list(SYMBOLS)] = True
    kinds[2, 65:91] = True
    kinds[3, [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
    out = np.zeros((len(column), len(COUNTS)), np.int64)
    for first, last, data, offsets in chunks(column):
        n, part = last - first, out[first:last]
        row = np.repeat(np.arange(n), np.diff(offsets))
        for kind, at in zip(kinds, (1, 2, 5, 6)):
            part[:, at] = np.bincount(row[kind[data]], minlength=n)
        hashes, of, starts, ends = word_hashes(data, offsets, space, exact)
        part[:, 0] = np.bincount(of, minlength=n)
        part[:, 7] = np.bincount(of[ends - starts == 1], minlength=n)
        if len(hashes) > 2:
            at = np.flatnonzero(of[2:] == of[:-2])
            three = mix(hashes[at] + mix(hashes[at + 1] + mix(hashes[at + 2])))
            order = np.lexsort((three, of[at]))
            same = (three[order][1:] == three[order][:-1]) & (of[at][order][1:] == of[at][order][:-1])
            twice = np.zeros(len(order), bool)
            twice[1:] |= same
            twice[:-1] |= same
            found = at[order[twice]]
            covered = np.zeros(len(hashes), bool)
            for j in range(3):
                covered[found + j] = True
            part[:, 4] = np.bincount(of[covered], minlength=n)
        raw = data.tobytes()
        for i in range(n):
            lines = [x for x in raw[offsets[i] : offsets[i + 1]].split(b"\n") if x.strip()]
            part[i, 3] = len(lines) - len(set(lines))
    return out


def shares(numbers: np.ndarray) -> np.ndarray:
    """What the forest looks at; none grows with the length of a text. Repeats are left to the
    plain rules, and digits out: they are rare in good texts, and so set them apart. (With shares of
    repeated lines and words, 85 to 100 % of the held-out bad rows stayed, against 0 to 3 %.)"""
    n = dict(zip(COUNTS, numbers.T.astype(np.float64)))
    words, chars = np.maximum(n["n_words"], 1), np.maximum(n["word_chars"], 1)
    return np.stack([
        n["word_chars"] / words, n["n_symbols"] / chars, n["n_upper"] / chars, n["n_marks"] / chars, n["n_single"] / words,
    ], 1)


def base_failed(numbers: np.ndarray) -> np.ndarray:
    words, repeated = numbers[:, 0], numbers[:, 4]
    return (words < MIN_WORDS) | (100 * repeated > MAX_REPEATED * words)


def usual_path(n: int) -> float:
    """The mean path length of a search that ends in a leaf of n rows."""
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (np.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n


@dataclass(frozen=True)
class Forest:
    """trees: (feature, split, left, right, path) arrays; a leaf has feature -1 and its path."""

    trees: tuple
    usual: float
    threshold: float

    def score(self, values: np.ndarray) -> np.ndarray:
        """From 0 to 1; higher: fewer splits set the row apart."""
        if not self.trees:
            return np.zeros(len(values))
        total = np.zeros(len(values))
        for feature, split, left, right, path in self.trees:
            at = np.zeros(len(values), np.int64)
            while True:
                inner = np.flatnonzero(feature[at] >= 0)
                if not len(inner):
                    break
                node = at[inner]
                at[inner] = np.where(values[inner, feature[node]] < split[node], left[node], right[node])
            total += path[at]
        return 2.0 ** (-total / len(self.trees) / self.usual)


def _tree(values: np.ndarray, random, limit: int):
    feature, split, left, right, path = [], [], [], [], []

    def grow(rows: np.ndarray, depth: int) -> int:
        me = len(feature)
        for part, blank in ((feature, -1), (split, 0.0), (left, 0), (right, 0), (path, 0.0)):
            part.append(blank)
        open_ = np.flatnonzero(np.ptp(values[rows], 0) > 0)
        if depth >= limit or not len(open_):
            path[me] = depth + usual_path(len(rows))
            return me
        f = int(random.choice(open_))
        low, high = values[rows, f].min(), values[rows, f].max()
        # never the least value itself, so that both sides have rows
        at = max(float(random.uniform(low, high)), float(np.nextafter(low, high)))
        below = values[rows, f] < at
        feature[me], split[me] = f, at
        left[me] = grow(rows[below], depth + 1)
        right[me] = grow(rows[~below], depth + 1)
        return me

    grow(np.arange(len(values)), 0)
    return tuple(np.array(x) for x in (feature, split, left, right, path))


def grow_forest(values: np.ndarray, trees: int = TREES, rows: int = TREE_ROWS) -> Forest:
    """A forest without a threshold, so that it rejects nothing yet."""
    if len(values) < 2:
        return Forest((), 1.0, np.inf)
    random, size = np.random.default_rng(SEED + 4), min(rows, len(values))
    limit = int(np.ceil(np.log2(size)))
    grown = tuple(
        _tree(values[random.choice(len(values), size, replace=False)], random, limit) for _ in range(trees)
    )
    return Forest(grown, usual_path(size), np.inf)


def calibrate(forest: Forest, good: np.ndarray, bad: np.ndarray, cost: float = COST) -> Forest:
    """Set the threshold of the least cost over all labelled scores, the lowest if several are."""
    if not len(good) or not len(bad) or not forest.trees:
        return forest
    of_good, of_bad = np.sort(forest.score(good)), np.sort(forest.score(bad))
    every = np.unique(np.concatenate((of_good, of_bad)))
    between = np.append((every[1:] + every[:-1]) / 2, np.inf)
    lost = len(of_good) - np.searchsorted(of_good, between, side="right")
    stay = np.searchsorted(of_bad, between, side="right")
    return Forest(forest.trees, forest.usual, float(between[np.argmin(cost * lost + stay)]))


def _sampled(batches):
    for batch in batches:
        numbers = counts(batch.column("text"))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(numbers.tolist(), pa.list_(pa.int64()))], names=["id", "numbers"])


def calibrate_scored(forest: Forest, scored: DataFrame, cost: float = COST) -> Forest:
    """`calibrate` over all rows of `scored` (good boolean, score double) on Spark: the costs of
    distinct scores come from running sums within ranges of scores plus the sums of the ranges before."""
    if not forest.trees:
        return forest
    per = stored(scored.groupBy("score").agg(  # scored once, not by each of the jobs below
        F.sum(F.col("good").cast("long")).alias("g"), F.sum((~F.col("good")).cast("long")).alias("b")), "scores")
    totals = per.agg(F.sum("g"), F.sum("b"), F.count(F.lit(1))).first()
    goods, bads, distinct = (int(v or 0) for v in totals)
    if not goods or not bads:
        drop_stored(per)
        return forest
    buckets = max(1, min(MOST_BUCKETS, distinct // BUCKET_ROWS))
    bounds = sorted(set(per.approxQuantile("score", [i / buckets for i in range(1, buckets)], 1e-3))) if buckets > 1 else []
    bucket = sum((F.when(F.col("score") > b, 1).otherwise(0) for b in bounds), F.lit(0))
    ranged = per.withColumn("bucket", bucket)
    sums = ranged.groupBy("bucket").agg(F.sum("g").alias("bg"), F.sum("b").alias("bb")).collect()
    before, g_seen, b_seen = [], 0, 0
    for row in sorted(sums, key=lambda r: r["bucket"]):
        before.append((row["bucket"], g_seen, b_seen))
        g_seen, b_seen = g_seen + row["bg"], b_seen + row["bb"]
    offsets = scored.sparkSession.createDataFrame(before, "bucket int, og long, ob long")
    upto = Window.partitionBy("bucket").orderBy("score").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    costs = ranged.join(F.broadcast(offsets), "bucket").select(
        "score", (cost * (goods - F.col("og") - F.sum("g").over(upto)) + F.col("ob") + F.sum("b").over(upto)).alias("cost"))
    best = costs.orderBy("cost", "score").first()["score"]
    above = per.where(F.col("score") > best).agg(F.min("score")).first()[0]
    drop_stored(per)
    return Forest(forest.trees, forest.usual, float("inf") if above is None else (above + best) / 2)


def fit(
    docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
    sample: int = SAMPLE,
) -> Forest:
    """Grow on a sample of all texts that pass the plain rules, and calibrate on all labelled ones."""
    ids = docs.select(F.col(doc_id).alias("id")).where("id IS NOT NULL").distinct()
    order = F.xxhash64(F.lit("forest"), "id")
    votes = (
        labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull() & (fold_of(F.col(doc_id)) != 0))
        .groupBy(F.col(doc_id).alias("id")).agg(F.min(label).alias("vote"))
    )
    chosen = ids.orderBy(order, "id").limit(sample)
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    rows = (
        texts.join(F.broadcast(chosen), "id").dropDuplicates(["id"])  # at most sample rows, grown in order of id
        .select("id", "text").mapInArrow(_sampled, "id long, numbers array<bigint>").collect()
    )
    numbers = np.array([r["numbers"] for r in sorted(rows, key=lambda r: r["id"])], np.int64).reshape(-1, len(COUNTS))
    forest = grow_forest(shares(numbers[~base_failed(numbers)]))
    # every text is scored where it lies; only ids and scores meet the labels
    judged = judge(texts, forest).select("id", "rules.base_failed", "rules.anomaly").where("id IS NOT NULL")
    scored = judged.join(votes, "id").dropDuplicates(["id"]).where(~F.col("base_failed")).select(
        (F.col("vote") >= 1).alias("good"), F.col("anomaly").alias("score"))
    return calibrate_scored(forest, scored)


def judge(
    docs: DataFrame, forest: Forest, *, text: str = "text", into: str = "rules",
) -> DataFrame:
    """`docs` with a struct of the counts, `base_failed`, `anomaly` (0 to 1) and `kept`."""
    small_batches(docs.sparkSession)
    fields = [*((c, pa.int64()) for c in COUNTS), ("base_failed", pa.bool_()), ("anomaly", pa.float64()), ("kept", pa.bool_())]
    kind = ", ".join(f"{c}: bigint" for c in COUNTS) + ", base_failed: boolean, anomaly: double, kept: boolean"

    @F.arrow_udf(f"struct<{kind}>")
    def rules(texts: pa.Array) -> pa.Array:
        numbers = counts(texts)
        failed, anomaly = base_failed(numbers), forest.score(shares(numbers))
        columns = [*(pa.array(c) for c in numbers.T), pa.array(failed), pa.array(anomaly, pa.float64()),
                   pa.array(~failed & (anomaly <= forest.threshold))]
        release()
        return pa.StructArray.from_arrays(columns, fields=[pa.field(*f) for f in fields])

    return docs.withColumn(into, rules(F.col(text)))


def digest(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, the first five COUNTS, base_failed, kept, anomaly) for each row."""
    small_batches(docs.sparkSession)
    judged = judge(docs.select(doc_id, text), fit(docs, labels, doc_id=doc_id, text=text), text=text)
    return judged.select(doc_id, *(f"rules.{c}" for c in (*COUNTS[:5], "base_failed", "kept", "anomaly")))


cloudpickle.register_pickle_by_value(sys.modules[__name__])
