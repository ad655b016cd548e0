"""Hashed text features shared by the classifiers, and bounded training samples."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices
from .words import SHAPES, Words, mix

PREFIX = 5


def word_features(w: Words, bits: int) -> np.ndarray:
    """Two rows of feature numbers per word: the word, and its first five bytes."""
    mask = np.uint64((1 << bits) - 1)
    whole = w.hashes()
    begin = w.hashes(w.start, np.minimum(w.start + PREFIX, w.end)) ^ np.uint64(0x5555)
    return np.stack([whole & mask, begin & mask]).astype(np.int64)


def shape_features(w: Words, bits: int) -> np.ndarray:
    """Three rows of feature numbers per word: the word, the shape of its last three bytes, and
    whether it repeats one of the two words before it."""
    mask = np.uint64((1 << bits) - 1)
    tail = w.hashes(np.maximum(w.start, w.end - 3), w.end, SHAPES) ^ np.uint64(0x3333)
    h = w.hashes()
    again = np.zeros(len(h), np.uint64)
    for back in (1, 2):
        again[back:] |= ((h[back:] == h[:-back]) & (w.doc[back:] == w.doc[:-back])).astype(np.uint64)
    return np.stack([h & mask, tail & mask, mix(again + np.uint64(0x7777)) & mask]).astype(np.int64)


def least_hash_ids(ids: DataFrame, n: int) -> list[int]:
    """Up to n ids of least hash: a bounded sample that does not depend on order or layout. Ids that
    cannot be among the least are left out before the shuffle."""
    ids = ids.select("doc_id", F.xxhash64("doc_id").alias("h"))
    many = ids.agg(F.approx_count_distinct("h")).first()[0]
    limit = min(2**63 - 1, -(2**63) + 2**64 * (2 * n + 64) // max(1, many))
    return [r[0] for r in ids.where(F.col("h") <= limit).distinct().orderBy("h", "doc_id").limit(n).collect()]


def features_of(spark: SparkSession, docs: DataFrame, ids: list[int], bits: int, kind) -> dict[int, np.ndarray]:
    """Feature numbers with counts of the sampled documents, made on the executors: all of
    a text, 2**bits at most. Of rows that share an id the least list of features counts."""

    def run(batches):
        for b in slices(batches):
            rows = []
            for t in b.column(1).to_pylist():
                f, n = np.unique(kind(Words([(t or "").encode()]), bits), return_counts=True)
                rows.append(np.stack([f, n]).astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, pa.binary())], ["doc_id", "f"])

    wanted = spark.createDataFrame([(i,) for i in ids], "doc_id bigint")
    got = docs.select(F.col("doc_id").cast("bigint"), "text").join(F.broadcast(wanted), "doc_id").mapInArrow(run, "doc_id bigint, f binary")
    got = got.groupBy("doc_id").agg(F.min("f").alias("f")).collect()
    return {r[0]: np.frombuffer(r[1], np.int32).reshape(2, -1) for r in sorted(got)}


class Rows:
    """Sparse rows: feature numbers, values and row of each entry."""

    def __init__(self, rows: list[np.ndarray], values: list[np.ndarray]):
        self.n = len(rows)
        self.col = np.concatenate([*rows, np.empty(0, np.int64)]).astype(np.int64)
        self.val = np.concatenate([*values, np.empty(0)])
        self.row = np.repeat(np.arange(self.n), [len(r) for r in rows])

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.val * w[self.col], minlength=self.n)

    def back(self, d: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.col, self.val * d[self.row], minlength=size)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


class Adam:
    def __init__(self, rate: float):
        self.rate, self.t, self.m, self.v = rate, 0, {}, {}

    def step(self, name: str, p: np.ndarray, g: np.ndarray) -> None:
        m = self.m.setdefault(name, np.zeros_like(p))
        v = self.v.setdefault(name, np.zeros_like(p))
        m += 0.1 * (g - m)
        v += 0.01 * (g * g - v)
        p -= self.rate * (m / (1 - 0.9**self.t)) / (np.sqrt(v / (1 - 0.99**self.t)) + 1e-8)
