"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents (positives) and unlabelled text train a linear classifier over hashed
words and word beginnings. The risk is the class-prior-corrected estimator
``prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))``: where the corrected negative part falls
below zero, its gradient is reversed, so that the classifier cannot profit from overfitting the
positives. Labels other than confirmed toxic ones serve for the prior alone.

Training: bounded samples (``POSITIVES``, ``UNLABELLED``) of rows outside the held-out fold.
Application: one scan without a shuffle; every distinct feature of the whole text counts once.

Edge cases: null and empty texts get the score of no feature; without positives every score is
0; repeated rows give repeated results; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold, slices, table
from .features import Adam, Rows, features_of, least_hash_ids, sigmoid, word_features
from .words import Words, as_bytes, chunks

BITS = 18
POSITIVES = 3000
UNLABELLED = 6000
STEPS = 150
THRESHOLD = 0.7
SEEN = 4
LIFT = 3.0
CHANCE = 4.0


class PUModel:
    def __init__(self, weight: np.ndarray, bias: float):
        self.weight, self.bias = weight, bias

    def score(self, texts: list[bytes]) -> np.ndarray:
        out = np.empty(len(texts))
        for lo, hi in chunks(texts):
            w = Words(texts[lo:hi])
            f = word_features(w, BITS)
            known = self.weight[f] != 0
            doc = np.broadcast_to(w.doc, f.shape)[known]
            key = np.unique(doc.astype(np.int64) << BITS | f[known])
            z = np.bincount(key >> BITS, self.weight[key & ((1 << BITS) - 1)], minlength=hi - lo)
            out[lo:hi] = sigmoid(z + self.bias)
        return out


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, steps: int = STEPS, rate: float = 0.1, decay: float = 2e-4) -> PUModel:
    """positive, unlabelled: distinct feature numbers per document."""
    size = 1 << BITS
    seen = np.bincount(np.concatenate([*positive, np.empty(0, np.int64)]).astype(np.int64), minlength=size)
    usual = (np.bincount(np.concatenate([*unlabelled, np.empty(0, np.int64)]).astype(np.int64), minlength=size) + 0.5) / (len(unlabelled) + 1)
    n = len(positive)
    # unlabelled rows hold a share ``prior`` of toxic ones: without it, the rate in clean text is left
    clean = np.maximum(usual - prior * seen / n, 0) / (1 - prior)
    # features of hardly any positive, or no more frequent there than chance allows, say nothing of them
    useful = (seen >= min(SEEN, n)) & (seen / n >= LIFT * clean) & (seen / n - usual >= CHANCE * np.sqrt(usual * (1 - np.minimum(usual, 0.999)) / n))
    rows = [Rows([r[useful[r]] for r in x], [np.ones(int(useful[r].sum())) for r in x]) for x in (positive, unlabelled)]
    p, u = rows
    w, b = np.zeros(size), np.array([np.log(prior / (1 - prior))])
    adam = Adam(rate)
    for t in range(1, steps + 1):
        adam.t = t
        fp, fu = sigmoid(p.dot(w) + b), sigmoid(u.dot(w) + b)
        gp, gu = np.zeros(p.n), np.zeros(u.n)
        gp += prior * (fp - 1) / p.n  # logistic loss of positives as positive
        negative = np.mean(-np.log(1 - fu + 1e-12)) - prior * np.mean(-np.log(1 - fp + 1e-12))
        sign = 1.0 if negative >= 0 else -1.0
        if sign < 0:
            gp[:] = 0
        gu += sign * fu / u.n
        gp -= sign * prior * fp / p.n
        g = p.back(gp, size) + u.back(gu, size) + decay * w
        adam.step("w", w, g)
        adam.step("b", b, np.array([gp.sum() + gu.sum()]))
        w[~useful] = 0
    w[np.abs(w) < 1e-3] = 0
    return PUModel(w.astype(np.float32), float(b[0]))


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> PUModel | None:
    learn = fold(F.col("doc_id"), 3) != 1
    known = labels.where(learn & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    n, toxic = known.agg(F.count(F.lit(1)), F.sum(F.col("toxic").cast("bigint"))).first()
    if not toxic:
        return None
    prior = min(0.9, toxic / n)
    rows = docs.where(learn & F.col("doc_id").isNotNull())
    pos = least_hash_ids(known.where("toxic = 1"), POSITIVES)
    unl = least_hash_ids(rows, UNLABELLED)
    f = features_of(spark, docs, sorted({*pos, *unl}), BITS, word_features)
    # documents of equal features count once: copies of one text are no further evidence
    positive, unlabelled = ([np.frombuffer(b, np.int32) for b in sorted({f[i][0].tobytes() for i in x if i in f})] for x in (pos, unl))
    return fit(positive, unlabelled, prior) if positive else None


def score(docs: DataFrame, model: PUModel | None) -> DataFrame:
    """doc_id, score of every document."""

    def run(batches):
        for b in slices(batches):
            texts = as_bytes(b.column(1))
            s = model.score(texts) if model else np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s.astype(np.float64))], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "doc_id bigint, score double")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, train(spark, docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
