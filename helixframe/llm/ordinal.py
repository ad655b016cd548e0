"""Quality by ordinal cumulative-link regression on graded ratings.

``P(grade <= k) = sigmoid(t_k - w.x)`` with weights ``w`` over hashed words and word shapes that
all grades share and ordered thresholds ``t_1 < t_2 < ...`` (the first free, the others by
positive steps). A document's expected grade is the sum of its tail probabilities
``P(grade > k)``; selection is by the tail probability of ``KEEP_GRADE``.

Grades of the query: 0 for quality 0, 1 for quality 1 with toxic 1, 2 for quality 1 otherwise (toxic 0
or unknown).
Training: a bounded sample (``RATED``) of labelled rows outside the held-out fold. Application:
one scan without a shuffle; x is the mean over all words of the whole text.

Edge cases: null and empty texts have x = 0 and are not kept; without ratings the expected grade
and the tail probability are 0; grades may be any whole numbers, ties in rating share a grade;
repeated rows give repeated results; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold, slices, table
from .features import Adam, Rows, features_of, least_hash_ids, shape_features, sigmoid
from .words import Words, as_bytes, chunks, sums

BITS = 16
RATED = 6000
STEPS = 300
KEEP_GRADE = 1
KEEP = 0.5


class Ordinal:
    def __init__(self, grades: list[int], weight: np.ndarray, thresholds: np.ndarray):
        self.grades, self.weight, self.thresholds = grades, weight, thresholds

    def tails(self, texts: list[bytes]) -> np.ndarray:
        """P(grade > k) per text and threshold."""
        z = np.zeros(len(texts))
        for lo, hi in chunks(texts):
            w = Words(texts[lo:hi])
            f = shape_features(w, BITS)
            z[lo:hi] = sums(self.weight[f].sum(0), w.doc, hi - lo) / np.maximum(w.count, 1)
        return sigmoid(z[:, None] - self.thresholds[None])


def fit(x: Rows, y: np.ndarray, grades: list[int], steps: int = STEPS, rate: float = 0.5, decay: float = 1e-6) -> Ordinal:
    size, k = 1 << BITS, len(grades) - 1
    w = np.zeros(size)
    first, steps_up = np.array([0.0]), np.zeros(max(0, k - 1))
    adam = Adam(rate)
    for t in range(1, steps + 1):
        adam.t = t
        cut = np.concatenate([first, first + np.cumsum(np.exp(steps_up))])[:k]
        z = x.dot(w)
        # P(y = j) = tail_{j-1} - tail_j with tail_{-1} = 1 and tail_k = 0
        tail = np.concatenate([np.ones((x.n, 1)), sigmoid(z[:, None] - cut[None]), np.zeros((x.n, 1))], 1)
        slope = tail * (1 - tail)
        r = np.arange(x.n)
        p = np.maximum(tail[r, y] - tail[r, y + 1], 1e-9)
        dz = -(slope[r, y] - slope[r, y + 1]) / p / x.n
        dcut = np.zeros((x.n, k + 2))
        dcut[r, y] += slope[r, y] / p / x.n
        dcut[r, y + 1] -= slope[r, y + 1] / p / x.n
        dcut = dcut[:, 1 : k + 1].sum(0)
        adam.step("w", w, x.back(dz, size) + decay * w)
        adam.step("first", first, np.array([dcut.sum()]))
        if k > 1:
            adam.step("up", steps_up, np.exp(steps_up) * np.cumsum(dcut[::-1])[::-1][1:])
    cut = np.concatenate([first, first + np.cumsum(np.exp(steps_up))])[:k]
    return Ordinal(grades, w.astype(np.float32), cut)


def train(spark: SparkSession, docs: DataFrame, ratings: DataFrame) -> Ordinal | None:
    """ratings: doc_id, grade; only rows outside the held-out fold are used."""
    known = ratings.where((fold(F.col("doc_id"), 3) != 1) & F.col("grade").isNotNull() & F.col("doc_id").isNotNull())
    ids = least_hash_ids(known, RATED)
    wanted = spark.createDataFrame([(i,) for i in ids], "doc_id bigint")
    grade = dict(sorted((r[0], r[1]) for r in known.join(F.broadcast(wanted), "doc_id").groupBy("doc_id").agg(F.min("grade")).collect()))
    f = features_of(spark, docs, ids, BITS, shape_features)
    use = [i for i in ids if i in f and f[i].shape[1]]
    grades = sorted({grade[i] for i in use})
    if len(grades) < 2:
        return None
    x = Rows([f[i][0] for i in use], [3 * f[i][1] / f[i][1].sum() for i in use])
    return fit(x, np.array([grades.index(grade[i]) for i in use]), grades)


def rate(docs: DataFrame, model: Ordinal | None, keep_grade: int = KEEP_GRADE, keep: float = KEEP) -> DataFrame:
    """doc_id, expected_grade, tail_probability, kept of every document."""

    def run(batches):
        for b in slices(batches):
            texts = as_bytes(b.column(1))
            expected, tail = np.zeros(len(texts)), np.zeros(len(texts))
            if model:
                t = model.tails(texts)
                g = np.array(model.grades, float)
                expected = g[0] + t @ np.diff(g)
                above = int(np.searchsorted(g, keep_grade))
                tail = np.ones(len(texts)) if above == 0 else t[:, above - 1] if above < len(g) else tail
            words = np.array([bool(x.strip(b" \t\n\x0b\x0c\r")) for x in texts], bool)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(expected), pa.array(tail), pa.array((tail >= keep) & words)], ["doc_id", "expected_grade", "tail_probability", "kept"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "doc_id bigint, expected_grade double, tail_probability double, kept boolean")


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    ratings = labels.select("doc_id", (F.col("quality") * (2 - F.coalesce("toxic", F.lit(0)))).cast("int").alias("grade"))
    return rate(docs, train(spark, docs, ratings)).select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "expected_grade", "tail_probability", "kept")
