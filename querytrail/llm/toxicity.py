"""Expected severity of toxic language from a cumulative-link ordinal regression.

Grades come from the labels: 0 for rows not marked toxic; marked rows are split at the terciles of
the number of features typical of marked texts that they have, into grades 1 to 3. The model
has one weight per feature (a word, or the first letters of a word), shared by all thresholds, and ordered thresholds t1 < t2 < t3:
P(grade >= k) = sigmoid(x.w - t_k). Expected severity is the sum of the three probabilities.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from querytrail.session import ship, store

_LETTERS = re.compile(r"[^\W\d_]+")
STEMS = (4, 5)
#: Labels up to this number are broadcast (16 bytes each); more are joined by shuffle.
BROADCAST_LABELS = 2_000_000


def features_of(text: str) -> set[str]:
    """Distinct lower-case runs of letters, and the first letters of the longer ones, marked `^`."""
    words = set(_LETTERS.findall(text.lower()))
    return words.union(*({"^" + w[:n] for w in words if len(w) > n} for n in STEMS))


def _features(labelled: DataFrame) -> DataFrame:
    """(marked, feature): the distinct features of each row, and the empty one once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [["", *features_of(t.as_py() or "")] for t in batch.column(0)]
            lists = pa.array(found, pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(1).take(lists.value_parent_indices()), lists.flatten()],
                names=["marked", "feature"])

    return labelled.select("text", "marked").mapInArrow(run, "marked int, feature string")


def _held(labelled: DataFrame, keep: frozenset[str]) -> DataFrame:
    """(marked, held): the features of `keep` that a row has."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features_of(t.as_py() or "") for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array([sorted(keep & f) for f in found], pa.list_(pa.string()))],
                names=["marked", "held"])

    return labelled.select("text", "marked").mapInArrow(
        run, "marked int, held array<string>")


@dataclass
class Model:
    """Words, their weights, and the ordered thresholds."""

    words: list[str] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    thresholds: np.ndarray = field(default_factory=lambda: np.full(3, np.inf))

    def probabilities(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, 3; one row per score."""
        with np.errstate(over="ignore"):
            return 1 / (1 + np.exp(self.thresholds[None, :] - score[:, None]))


def typical_words(
    labelled: DataFrame, min_rows: int, max_words: int, min_z: float
) -> tuple[int, dict[str, float]]:
    """Number of labelled rows, and the features whose rows are marked far more, or far less, often
    than the rest, with their z value.

    Counts cover every labelled row. One row per feature is shuffled from each task; at most
    `max_words` rows reach the driver.
    """
    counts = store(
        _features(labelled).groupBy("feature").agg(F.count("*").alias("n"), F.sum("marked").alias("k"))
        .filter(F.col("n") >= min_rows), "feature-counts")
    total = counts.filter("feature = ''").first()
    if total is None or total.k in (0, total.n):
        return 0, {}
    rate = total.k / total.n
    z = (F.col("k") - rate * F.col("n")) / F.sqrt(rate * (1 - rate) * F.col("n"))
    best = counts.filter("feature <> ''").select("feature", z.alias("z")).filter(
        F.abs("z") >= min_z).orderBy(F.abs("z").desc(), "feature").limit(max_words)
    return total.n, {feature: value for feature, value in best.collect()}


def grades(counts: np.ndarray, marked: np.ndarray) -> np.ndarray:
    """0 for unmarked rows, 1 to 3 by tercile of the count for marked ones."""
    grade = np.zeros(len(counts), np.int64)
    if marked.any():
        cuts = np.quantile(counts[marked], [1 / 3, 2 / 3])
        grade[marked] = 1 + (counts[marked][:, None] > cuts[None, :]).sum(axis=1)
    return grade


def fit_ordinal(
    rows: list[np.ndarray], grade: np.ndarray, n_words: int, ridge: float = 0.05, steps: int = 600
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds that maximise the penalised cumulative-logit likelihood.

    `rows` holds the word numbers of each row. Thresholds are the first one plus positive gaps, so
    they stay ordered. Full-gradient steps with adaptive step sizes; nothing is random.
    """
    n, levels = len(rows), 3
    at = np.repeat(np.arange(n), [len(r) for r in rows])
    column = np.concatenate(rows).astype(np.int64) if n else np.zeros(0, np.int64)
    weights = np.zeros(n_words)
    free = np.array([2.0, 0.0, 0.0])  # first threshold, logarithms of the gaps
    params = np.concatenate([weights, free])
    first, second = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, steps + 1):
        weights, free = params[:n_words], params[n_words:]
        thresholds = free[0] + np.concatenate([[0], np.cumsum(np.exp(free[1:]))])
        score = np.bincount(at, weights[column], minlength=n)
        cdf = 1 / (1 + np.exp(np.clip(thresholds[None, :] - score[:, None], -40, 40)))
        bound = np.concatenate([np.ones((n, 1)), cdf, np.zeros((n, 1))], axis=1)
        here = np.maximum(
            bound[np.arange(n), grade] - bound[np.arange(n), grade + 1], 1e-12)
        slope = np.concatenate([np.zeros((n, 1)), cdf * (1 - cdf), np.zeros((n, 1))], axis=1)
        upper, lower = slope[np.arange(n), grade], slope[np.arange(n), grade + 1]
        d_score = (upper - lower) / here
        d_threshold = np.zeros(levels)
        np.add.at(d_threshold, np.maximum(grade - 1, 0), np.where(grade > 0, -upper / here, 0))
        np.add.at(d_threshold, np.minimum(grade, levels - 1), np.where(grade < levels, lower / here, 0))
        d_free = np.array([
            d_threshold.sum(), *(d_threshold[i:].sum() * np.exp(free[i]) for i in (1, 2))])
        gradient = np.concatenate([
            np.bincount(column, d_score[at], minlength=n_words) - ridge * weights, d_free]) / max(n, 1)
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient ** 2
        params = params + 0.1 * (first / (1 - 0.9 ** step)) / (
            np.sqrt(second / (1 - 0.99 ** step)) + 1e-9)
    free = params[n_words:]
    return params[:n_words], free[0] + np.concatenate([[0], np.cumsum(np.exp(free[1:]))])


def train(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    label_column: str = "toxic", max_rows: int = 20000, max_words: int = 4096, min_rows: int = 5,
    min_z: float = 5.0,
) -> Model:
    """Model from the labelled rows.

    Word statistics cover all labelled rows. The regression is fitted on at most `max_rows` of them,
    picked by a hash of the id; only their selected features reach the driver, at most `max_words` a
    row. Rows without a label, and labels without a row, are ignored; where no feature or no marked
    row is found the model gives severity 0 to every text.
    """
    ship(docs.sparkSession)
    marks = store(
        labels.select(F.col(id_column).alias("_id"), F.col(label_column).cast("int").alias("marked"))
        .filter("_id is not null and marked is not null").groupBy("_id").agg(
            F.max("marked").alias("marked")), "labels")
    marks = F.broadcast(marks) if marks.count() <= BROADCAST_LABELS else marks
    labelled = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).join(
        marks, F.col("id") == F.col("_id"))
    total, typical = typical_words(labelled, min_rows, max_words, min_z)
    if not typical:
        return Model()
    names = sorted(typical)
    number = {w: i for i, w in enumerate(names)}
    share = min(1.0, 0.9 * max_rows / total)
    sample = labelled.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 32)) < int(share * (1 << 32)))
    picked = _held(sample, frozenset(names)).limit(max_rows).collect()
    marked = np.array([r.marked == 1 for r in picked])
    indexes = [np.array([number[w] for w in r.held], np.int64) for r in picked]
    typical_of_marked = {number[w] for w, z in typical.items() if z > 0}
    counts = np.array([sum(i in typical_of_marked for i in ix.tolist()) for ix in indexes])
    weights, thresholds = fit_ordinal(indexes, grades(counts, marked), len(names))
    return Model(names, weights, thresholds)


def score(
    docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text",
    threshold: float = 0.5,
) -> DataFrame:
    """(id, severity, p_toxic, grade, toxic) of every row.

    `severity` is the expected grade, `p_toxic` the probability of grade 1 or more, `toxic` whether
    that reaches `threshold`, `grade` the number of thresholds passed with it. A null or empty text has
    no words and the model's base severity. Whole texts count; repeated rows and null ids keep
    their rows; other columns are left behind.
    """
    ship(docs.sparkSession)
    number = {w: i for i, w in enumerate(model.words)}
    known = frozenset(model.words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [features_of(t.as_py() or "") & known for t in batch.column(1)]
            total = np.array([sum(model.weights[number[w]] for w in sorted(h)) for h in held], np.float64)
            p = model.probabilities(total)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(p.sum(axis=1)), pa.array(p[:, 0]),
                 pa.array((p >= threshold).sum(axis=1), pa.int64()), pa.array(p[:, 0] >= threshold)],
                names=["id", "severity", "p_toxic", "grade", "toxic"])

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).mapInArrow(
        run, f"id {kind}, severity double, p_toxic double, grade long, toxic boolean"
    ).withColumnRenamed("id", id_column)
