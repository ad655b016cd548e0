"""Language identification by a byte convolutional network trained in numpy.

Filters of widths 2, 3 and 4 bytes slide over one-hot bytes, are max-pooled over a window of
``WINDOW`` bytes, rectified, and a softmax layer gives language probabilities. Training uses a
bounded sample of labelled rows outside the held-out fold: of each language the ``PER_LANG`` distinct
texts of least hash (fewer of each where ``SAMPLE`` texts would not suffice for all languages),
``WINDOWS`` windows each. Every language that occurs is learned. A whole text is cut into adjoining
windows, where the last filters of a window read on into the next; its probabilities are the mean
over all its windows.

Application is one scan without a shuffle: filter sums of two bytes are looked up in tables, so
that a byte costs two look-ups for all filters.

Edge cases: null text or text without a letter is ``und`` with score 0; so is everything when no
row can be learned from; repeated rows give repeated results and count once in training, whatever their
ids; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import fold, slices, table

WIDTHS = (2, 3, 4)
FILTERS = 8
WINDOW = 512
PER_LANG = 300
SAMPLE = 30_000
WINDOWS = 4
STEPS = 400
STEPS_PER_LANG = 20
MARGIN = 4


def sample(spark: SparkSession, docs: DataFrame, per_lang: int = PER_LANG, total: int = SAMPLE) -> tuple[np.ndarray, list[str]]:
    """Windows (n x WINDOW bytes, zero-padded) and their languages, from a bounded sample. Texts are
    ranked by a hash of their own; equal texts of a language count once."""
    rows = docs.where((fold(F.col("doc_id"), 4) != 2) & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text", F.xxhash64("text").alias("h"))
    langs = rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).orderBy("lang").collect()  # a row per language
    if not langs:
        return np.empty((0, WINDOW), np.uint8), []
    per_lang = max(1, min(per_lang, total // len(langs)))
    # hashes above these are not among the least, by a wide margin against the error of the count
    limits = [(r[0], min(2**63 - 1, -(2**63) + 2**64 * (MARGIN * per_lang + 64) // max(1, r[1]))) for r in langs]
    limits = spark.createDataFrame(limits, "_lang string, _limit bigint")

    def windows(batches):
        for b in batches:
            out = []
            for t, h in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                raw = t.encode()
                at = np.random.default_rng(h % 2**63).integers(0, max(1, len(raw) - WINDOW // 2), WINDOWS)
                out.append(b"".join(raw[a : a + WINDOW].ljust(WINDOW, b"\0") for a in at))
            yield pa.RecordBatch.from_arrays([b.column(2), b.column(1), pa.array(out, pa.binary())], ["lang", "h", "windows"])

    few = rows.join(F.broadcast(limits), (F.col("lang") == F.col("_lang")) & (F.col("h") <= F.col("_limit")))
    few = few.select("text", "h", "lang").mapInArrow(windows, "lang string, h bigint, windows binary")
    few = few.groupBy("lang", "h").agg(F.min("windows").alias("windows"))
    few = few.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).where(F.col("n") <= per_lang)
    got = sorted((r[0], bytes(r[1])) for r in few.select("lang", "windows").collect())
    x = np.frombuffer(b"".join(w for _, w in got), np.uint8).reshape(-1, WINDOW)
    return x, [name for name, _ in got for _ in range(WINDOWS)]


class ByteCNN:
    def __init__(self, langs: list[str], seed: int = 0):
        rng = np.random.default_rng(seed)
        self.langs = langs
        self.conv = [rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
        for c in self.conv:
            c[:, 0] = 0
        self.bias = np.zeros(len(WIDTHS) * FILTERS, np.float32)
        self.out = rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(langs))).astype(np.float32)
        self.out_bias = np.zeros(len(langs), np.float32)

    def params(self) -> list[np.ndarray]:
        return [*self.conv, self.bias, self.out, self.out_bias]

    def gradients(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        n, top, where = len(x), [], []
        for c in self.conv:
            w = len(c)
            s = sum(c[k][x[:, k : x.shape[1] - w + 1 + k]] for k in range(w))
            p = s.argmax(1)
            where.append(p)
            top.append(np.take_along_axis(s, p[:, None], 1)[:, 0])
        z = np.concatenate(top, 1) + self.bias
        h = np.maximum(z, 0)
        p = softmax(h @ self.out + self.out_bias)
        p[np.arange(n), y] -= 1
        p /= n
        dz = (p @ self.out.T) * (z > 0)
        grads = []
        rows, f = np.arange(n)[:, None], np.arange(FILTERS)[None]
        for i, c in enumerate(self.conv):
            g = np.zeros_like(c)
            d = dz[:, i * FILTERS : (i + 1) * FILTERS]
            for k in range(len(c)):
                np.add.at(g[k], (x[rows, where[i] + k], np.broadcast_to(f, where[i].shape)), d)
            grads.append(g)
        return [*grads, dz.sum(0), h.T @ p, p.sum(0)]

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = STEPS, batch: int = 64, rate: float = 0.02, seed: int = 1):
        rng = np.random.default_rng(seed)
        first = [np.zeros_like(p) for p in self.params()]
        second = [np.zeros_like(p) for p in self.params()]
        classes = [np.flatnonzero(y == c) for c in range(len(self.langs))]
        for t in range(1, steps + 1):
            pick = np.array([rng.choice(classes[c]) for c in rng.integers(0, len(classes), batch)])
            cut = rng.integers(0, WINDOW // 2)  # half windows suffice to learn from
            for p, g, m, v in zip(self.params(), self.gradients(x[pick, cut : cut + WINDOW // 2], y[pick]), first, second):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-6)
        return self

    def tables(self):
        """Sums of filters over two bytes: all of width 2, the first two of 3 and 4; the rest."""
        a = [(c[0][:, None] + c[1][None]).reshape(65536, FILTERS) for c in self.conv]
        third = np.repeat(self.conv[1][2][:, None], 256, 1).reshape(65536, FILTERS)
        fourth = (self.conv[2][2][:, None] + self.conv[2][3][None]).reshape(65536, FILTERS)
        return np.ascontiguousarray(np.concatenate(a, 1)), np.ascontiguousarray(np.concatenate([third, fourth], 1))

    def predict(self, texts: list[bytes], tabs, step: int = 1 << 18) -> np.ndarray:
        """Probabilities per text: mean over its windows. Rows of empty texts are zero."""
        one, two = tabs
        out = np.zeros((len(texts), len(self.langs)))
        at = 0
        while at < len(texts):
            lo, size = at, 0
            while at < len(texts) and (at == lo or size + len(texts[at]) <= step):
                size += len(texts[at]) + 4
                at += 1
            out[lo:at] = self._few(texts[lo:at], one, two, step)
        return out

    def _few(self, texts, one, two, step):
        raw = np.frombuffer(b"\0\0\0\0".join(texts) + b"\0\0\0\0\0", np.uint8)
        pair = raw[:-1].astype(np.int32) * 256 + raw[1:]
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        begin = np.cumsum(sizes + 4) - (sizes + 4)
        n = -(-sizes // WINDOW)
        doc = np.repeat(np.arange(len(texts)), n)
        start = begin[doc] + (np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)) * WINDOW
        end = np.minimum(start + WINDOW, begin[doc] + sizes[doc])
        pooled = np.empty((len(doc), one.shape[1]), np.float32)
        i = 0
        while i < len(doc):  # some windows at a time
            j = max(i + 1, int(np.searchsorted(start, start[i] + step)))
            lo, hi = start[i], end[j - 1]
            s = one[pair[lo:hi]]
            s[:, FILTERS:] += two[pair[lo + 2 : hi + 2]]
            cuts = np.stack([start[i:j] - lo, end[i:j] - lo], 1).ravel()
            if cuts[-1] == len(s):
                cuts = cuts[:-1]
            pooled[i:j] = np.maximum.reduceat(s, cuts)[::2]
            i = j
        p = softmax(np.maximum(pooled + self.bias, 0) @ self.out + self.out_bias)
        out = np.zeros((len(texts), len(self.langs)))
        np.add.at(out, doc, p)
        return out / np.maximum(n, 1)[:, None]


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def train(spark: SparkSession, docs: DataFrame) -> ByteCNN | None:
    x, names = sample(spark, docs)
    if not len(x):
        return None
    langs = sorted(set(names))
    place = {n: i for i, n in enumerate(langs)}
    return ByteCNN(langs).fit(x, np.array([place[n] for n in names]), max(STEPS, STEPS_PER_LANG * len(langs)))


def identify(docs: DataFrame, model: ByteCNN | None) -> DataFrame:
    """doc_id, lang_pred, score of every document."""

    def run(batches):
        tabs = model.tables() if model else None
        for b in slices(batches):
            texts = [t or "" for t in b.column(1).to_pylist()]
            known = [model is not None and any(map(str.isalpha, t)) for t in texts]
            names, score = ["und"] * len(texts), np.zeros(len(texts))
            use = np.flatnonzero(known)
            if len(use):
                p = model.predict([texts[i].encode() for i in use], tabs)
                best = p.argmax(1)
                score[use] = np.clip(p[np.arange(len(use)), best], 0, 1)
                for i, k in zip(use, best):
                    names[i] = model.langs[k]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(names, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "doc_id bigint, lang_pred string, score double")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, train(spark, docs)).select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")
