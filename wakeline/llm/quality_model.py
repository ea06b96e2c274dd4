"""Operator 4: ordinal cumulative-link regression on graded ratings.

Grades: 0 toxic, 1 low quality, 2 good. One weight vector over hashed text features
is shared by all grades; ordered thresholds cut its score into grades:
``P(grade <= k) = sigmoid(threshold_k - score)``. A document gets its expected grade
and the tail probability of the top grade, by which it is selected.

The model is fitted on a bounded sample of labelled documents (``max_labelled``), a third of it
for each grade, so that a rare grade is learned as well as a common one; the thresholds are
then fitted anew with every grade weighted by its share of all labels. Features are chosen in
Spark, so only those that get a weight come to the driver. All
documents are scored by a map over Arrow batches with the fitted weights.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

from wakeline.llm.tables import stored
from wakeline.llm.tokens import NOT_LETTER, U64, give_back, mix, slices, text_bytes, words_of

N_GRADES = 3


@dataclass(frozen=True)
class FitParams:
    max_labelled: int = 6_000   # bound of the labelled sample, a third of it for each grade
    min_share: float = 0.005    # a feature must occur in as many documents as this share of the rarest grade's sample
    min_z: float = 4.0          # standard errors between the grades with and without it
    l2: float = 0.5
    rounds: int = 3_000         # of the descent, at most
    slope: float = 1e-4         # at which it ends: the largest derivative per document
    min_tail: float = 0.5       # keep from this probability of the top grade on


@dataclass(frozen=True)
class OrdinalModel:
    """Sorted feature hashes with their weights, and ascending thresholds."""

    features: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def grade_probabilities(self, score: np.ndarray) -> np.ndarray:
        below = 1 / (1 + np.exp(-np.clip(self.thresholds[None, :] - score[:, None], -60, 60)))
        below = np.concatenate([np.zeros((len(score), 1)), below, np.ones((len(score), 1))], axis=1)
        return np.diff(below, axis=1)

    def scores(self, row: np.ndarray, feature: np.ndarray, n_rows: int) -> np.ndarray:
        if not len(self.features):
            return np.zeros(n_rows)
        at = np.minimum(np.searchsorted(self.features, feature), len(self.features) - 1)
        known = self.features[at] == feature
        return np.bincount(row[known], weights=self.weights[at[known]], minlength=n_rows)


def document_features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, feature hash) pairs: the letter words of a text, and bins of its shape.

    Shape: shares of upper case, of symbols and of repeated words, and the length of the
    longest share of one word, in eighths of a doubling scale.
    """
    n = len(column)
    data, offsets = text_bytes(column)
    words = words_of(column, NOT_LETTER)
    order = np.lexsort((words.hash, words.row))
    row, h = words.row[order], words.hash[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
    n_words = np.bincount(row, minlength=n)
    first = np.flatnonzero(new)
    top = np.zeros(n, np.int64)
    np.maximum.at(top, row[first], np.diff(np.append(first, len(row))))
    row, h = row[new], h[new]

    def count(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mask)])
        return sums[offsets[1:]] - sums[offsets[:-1]]

    size = np.maximum(1, np.diff(offsets))
    shape = [
        count((data >= 65) & (data <= 90)) / size,
        count(np.isin(data, np.frombuffer(b"#*$%&|<>!", np.uint8))) / size,
        1 - np.bincount(row, minlength=n) / np.maximum(1, n_words),
        top / np.maximum(1, n_words),
    ]
    extra = []
    for k, share in enumerate(shape):
        bin_ = np.floor(np.log2(np.maximum(share, 2.0 ** -9)) * 2).astype(np.int64)
        extra.append(mix((bin_ + 1000 * (k + 1)).astype(U64), 11))
    rows = np.concatenate([row, *[np.arange(n)] * len(extra)])
    return rows, np.concatenate([h, *extra])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def feature_floor(grade_counts: Iterable[int], params: FitParams) -> int:
    """Documents that a feature must occur in: relative to the rarest grade of the sample, three at least."""
    return max(3, math.ceil(params.min_share * min(n for n in grade_counts if n)))


def loss_and_gradient(p: np.ndarray, rows: np.ndarray, cols: np.ndarray, grade: np.ndarray, weight: np.ndarray,
                      l2: float) -> tuple[float, np.ndarray]:
    """Negative log likelihood of the grades with its penalty, and its gradient.

    ``p``: the feature weights, the first threshold, the logarithms of the gaps between thresholds
    (so they stay ordered). ``rows, cols``: which document holds which feature. ``weight``: of each document.
    """
    n, m = len(grade), len(p) - (N_GRADES - 1)
    w, cuts = p[:m], np.cumsum(np.concatenate([p[m:m + 1], np.exp(p[m + 1:])]))
    score = np.bincount(rows, weights=w[cols], minlength=n)
    edge = np.concatenate([[-np.inf], cuts, [np.inf]])
    hi, lo = _sigmoid(edge[grade + 1] - score), _sigmoid(edge[grade] - score)
    lo[grade == 0], hi[grade == N_GRADES - 1] = 0, 1
    mass = np.maximum(hi - lo, 1e-12)
    d_hi, d_lo = weight * hi * (1 - hi) / mass, weight * lo * (1 - lo) / mass
    g = np.zeros_like(p)
    g[:m] = np.bincount(cols, weights=(d_hi - d_lo)[rows], minlength=m) + l2 * w
    by_edge = np.bincount(grade, weights=d_lo, minlength=N_GRADES + 1)[:N_GRADES + 1] - np.bincount(grade + 1, weights=d_hi, minlength=N_GRADES + 1)
    tails = np.cumsum(by_edge[1:-1][::-1])[::-1]
    g[m] = tails[0]
    g[m + 1:] = tails[1:] * np.exp(p[m + 1:])
    return float(-(weight * np.log(mass)).sum() + l2 / 2 * (w * w).sum()), g


def _descend(p: np.ndarray, free: slice, rounds: int, flat: float, gradient) -> np.ndarray:
    """Full-batch Adam over the parameters ``free``, until all their derivatives are below ``flat``."""
    p, first, second = p.copy(), np.zeros_like(p), np.zeros_like(p)
    for t in range(1, rounds + 1):
        g = gradient(p)
        if np.abs(g[free]).max() < flat:
            break
        first = 0.9 * first + 0.1 * g
        second = 0.999 * second + 0.001 * g * g
        rate = 0.05 / (1 + t / 300)
        p[free] -= (rate * (first / (1 - 0.9 ** t)) / (np.sqrt(second / (1 - 0.999 ** t)) + 1e-8))[free]
    return p


def _log_odds_cuts(share: np.ndarray) -> np.ndarray:
    """First threshold and logarithms of gaps that give grades these shares at a score of 0."""
    below = np.clip(np.cumsum(share)[:-1], 1e-6, 1 - 1e-6)
    theta = np.log(below / (1 - below))
    for k in range(1, len(theta)):
        theta[k] = max(theta[k], theta[k - 1] + 0.1)
    return np.concatenate([theta[:1], np.log(np.diff(theta))])


def fit_ordinal(row: np.ndarray, feature: np.ndarray, grade: np.ndarray, params: FitParams = FitParams(),
                share: np.ndarray | None = None) -> OrdinalModel:
    """Maximum likelihood with an L2 penalty on the bounded sample; ``share``: of the grades among all labels.

    Features whose documents' mean grade is not clearly off the overall mean get no weight:
    most words of a corpus are rare, and labels are noisy. The weights are those of the sample as it is;
    the thresholds are fitted again, from the given shares on, with the documents of a grade weighted to them.
    """
    n = len(grade)
    counts = np.bincount(grade, minlength=N_GRADES)
    names, inverse, seen = np.unique(feature, return_inverse=True, return_counts=True)
    z = (np.bincount(inverse, weights=grade[row]) / seen - grade.mean()) / (grade.std() / np.sqrt(seen))
    use = (seen >= feature_floor(counts, params)) & (np.abs(z) >= params.min_z)
    column = np.cumsum(use) - 1
    on = use[inverse]
    rows, cols, names = row[on], column[inverse[on]], names[use]
    m = len(names)
    ones = np.ones(n)
    p = np.concatenate([np.zeros(m), _log_odds_cuts(counts / n)])
    p = _descend(p, slice(None), params.rounds, params.slope * n, lambda p: loss_and_gradient(p, rows, cols, grade, ones, params.l2)[1])
    if share is not None:
        weight = (np.asarray(share) / np.maximum(counts / n, 1e-300))[grade]
        p = _descend(p, slice(m, None), params.rounds, params.slope * n, lambda p: loss_and_gradient(p, rows, cols, grade, weight, params.l2)[1])
    return OrdinalModel(names, p[:m].copy(), np.cumsum(np.concatenate([p[m:m + 1], np.exp(p[m + 1:])])))


def graded_labels(labels: DataFrame) -> DataFrame:
    """One grade per doc_id: 0 toxic, 1 low quality, 2 good (the worst of repeated labels).

    Rows without a doc_id, or where both ratings are null, carry no grade.
    """
    grade: Column = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)
    return (labels.select("doc_id", grade.alias("grade")).where(F.col("doc_id").isNotNull() & F.col("grade").isNotNull())
            .groupBy("doc_id").agg(F.min("grade").alias("grade")))


@give_back
def _list_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        row, feature = document_features(batch.column("text"))
        order = np.argsort(row, kind="stable")
        cut = np.searchsorted(row[order], np.arange(batch.num_rows + 1)).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(cut), pa.array(feature[order].astype(np.int64)))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("grade"), lists], ["doc_id", "grade", "features"])


def fit(docs: DataFrame, labels: DataFrame, params: FitParams = FitParams()) -> OrdinalModel:
    """Fit on at most ``max_labelled`` labelled documents, a third of them per grade, chosen by a hash of the doc_id.

    With no labelled document, or one grade only, the model has no features and its
    thresholds put all documents in that grade (the top grade when there is none).
    """
    graded = graded_labels(labels)
    total = {r["grade"]: r["count"] for r in graded.groupBy("grade").count().collect()}  # a row per grade
    by_hash = [graded.where(F.col("grade") == g).orderBy(F.xxhash64("doc_id"), "doc_id").limit(params.max_labelled // N_GRADES)
               for g in range(N_GRADES)]
    chosen = reduce(DataFrame.unionByName, by_hash)
    # bounded by max_labelled rows of two numbers
    sample = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    one_each = sample.groupBy("doc_id").agg(F.min("grade").alias("grade"), F.min("text").alias("text"))
    listed = stored(one_each.mapInArrow(_list_features, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, grade int, features array<long>"),
                    "quality-sample")
    counts = {r["grade"]: r["count"] for r in listed.groupBy("grade").count().collect()}
    if len(counts) < 2:
        only = next(iter(counts), N_GRADES - 1)
        return OrdinalModel(np.zeros(0, U64), np.zeros(0), np.where(np.arange(N_GRADES - 1) < only, -60.0, 60.0))
    n = sum(counts.values())
    mean = sum(g * c for g, c in counts.items()) / n
    deviation = math.sqrt(sum((g - mean) ** 2 * c for g, c in counts.items()) / n)
    pairs = listed.select("doc_id", "grade", F.explode("features").alias("feature"))
    z = (F.avg("grade") - mean) / deviation * F.sqrt(F.count("*"))
    clear = pairs.groupBy("feature").agg(F.count("*").alias("seen"), z.alias("z")).where(
        (F.col("seen") >= feature_floor(counts.values(), params)) & (F.abs("z") >= params.min_z * (1 - 1e-9)))
    weighed = pairs.join(clear.select("feature"), "feature", "left_semi").groupBy("doc_id").agg(F.collect_list("feature").alias("features"))
    # at most max_labelled rows; of their features those that get a weight
    got = listed.select("doc_id", "grade").join(weighed, "doc_id", "left").collect()
    grade = np.array([r["grade"] for r in got], np.int64)
    features = [np.array(r["features"] or [], np.int64).astype(U64) for r in got]
    row = np.repeat(np.arange(len(features)), [len(f) for f in features])
    share = np.array([total.get(g, 0) if g in counts else 0 for g in range(N_GRADES)], float)
    return fit_ordinal(row, np.concatenate(features), grade, params, share / share.sum())


def score_documents(docs: DataFrame, model: OrdinalModel, min_tail: float = FitParams.min_tail) -> DataFrame:
    """``docs`` with ``expected_grade``, ``tail_probability`` and ``kept`` added.

    Every row is scored on its whole text. Defined cases: a null or empty text is
    scored on its shape alone; repeated rows get equal scores; an empty table gives an
    empty result; other columns pass through, except that columns of ``docs`` with the
    three names are replaced.
    """
    added = ["expected_grade", "tail_probability", "kept"]
    docs = docs.drop(*added)

    @give_back
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            row, feature = document_features(batch.column("text"))
            probability = model.grade_probabilities(model.scores(row, feature, batch.num_rows))
            tail = probability[:, -1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(probability @ np.arange(N_GRADES, dtype=float)), pa.array(tail), pa.array(tail >= min_tail)],
                [*batch.schema.names, *added])

    schema = StructType([*docs.schema, StructField("expected_grade", DoubleType()),
                         StructField("tail_probability", DoubleType()), StructField("kept", BooleanType())])
    return docs.mapInArrow(score, schema)


def op4_ordinal_quality(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_documents(docs.select("doc_id", "text"), model).drop("text")
