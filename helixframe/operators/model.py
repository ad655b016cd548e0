"""The model stage: length buckets, a pluggable scorer, pooled embeddings, likelihoods, quarantine.

A scorer takes padded token ids and masks (rows x width) and gives log-probabilities (rows x width) and hidden
states (rows x width x ``dim``). Rows are sorted by length within a partition, so that a call's rows share a bucket;
a call that runs out of memory is halved down to one row, which then is quarantined, as is a row beyond the context.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import KEY, PAD_MASK
from .tokenize import PAD

#: Widths that rows are padded to.
BUCKETS = (512, 1024, 2048, 4096, 8192, 16384, 32768)
CALL_TOKENS = 1 << 16
RESULT = (
    "status string, embedding array<double>, embedding_norm double, mean_log_prob double, sum_log_prob double, perplexity double, "
    "supervised_position_count bigint, min_token_logprob double, argmin_position int, per_token_logprob_std double"
)


class Scorer(Protocol):
    dim: int

    def __call__(self, ids: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]: ...


class StandIn:
    """A deterministic scorer in place of a model: both outputs are functions of the token id."""

    dim = 4

    def __call__(self, ids: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hidden = (ids[..., None] * (np.arange(self.dim) + 3) % 97) / 97.0 - 0.5
        return -(ids % 13 + 1) / 4.0, hidden


_REVISION = re.compile("[0-9a-f]{7,64}")
_made: dict[str, Scorer] = {}


class Lazy:
    """A scorer that ``make(revision)`` gives, made once in each worker process when a row first needs it, so that no
    model travels with tasks. The revision is a commit's hash: a name that may move is refused. Each width of ``warm``
    is scored once before the first rows, for scorers that compile by shape."""

    def __init__(self, make: Callable[[str], Scorer], revision: str, dim: int, warm: tuple[int, ...] = ()):
        if not _REVISION.fullmatch(revision):
            raise ValueError(f"not a pinned revision: {revision!r}")
        self.make, self.revision, self.dim, self.warm, self.key = make, revision, dim, warm, uuid.uuid4().hex

    def __call__(self, ids: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if self.key not in _made:
            scorer = self.make(self.revision)
            for width in self.warm:
                scorer(np.full((1, width), PAD, np.int64), np.full((1, width), PAD_MASK, np.int64))
            _made[self.key] = scorer
        return _made[self.key](ids, mask)


def _reduce(log_probs: np.ndarray, hidden: np.ndarray, mask: np.ndarray) -> list[tuple]:
    """Per row: mean of the states of all tokens but padding, and statistics of supervised positions (shifted by one)."""
    real = mask != PAD_MASK
    pooled = (hidden * real[..., None]).sum(1) / np.maximum(real.sum(1), 1)[:, None]
    out = []
    for v, x, m in zip(pooled, log_probs[:, 1:], mask[:, 1:]):
        at = np.flatnonzero(m > 0)
        p, n = x[at], max(1, len(at))
        total = float(p.sum())
        low = int(p.argmin()) if len(p) else None
        out.append(("ok", v.tolist(), float(np.sqrt((v * v).sum())), total / n, total, float(np.exp(-total / n)), n, float(p[low]) if len(p) else 0.0, int(at[low]) if len(p) else -1, float(p.std()) if len(p) else 0.0))
    return out


def _score(scorer: Scorer, ids: np.ndarray, mask: np.ndarray) -> list[tuple]:
    try:
        return _reduce(*scorer(ids, mask), mask)
    except MemoryError:
        if len(ids) == 1:
            return [("memory", *[None] * 9)]
        half = len(ids) // 2
        return _score(scorer, ids[:half], mask[:half]) + _score(scorer, ids[half:], mask[half:])


def infer(df: DataFrame, scorer: Scorer, key: tuple[str, ...] = KEY, buckets: tuple[int, ...] = BUCKETS) -> DataFrame:
    """key, token_length and RESULT of every tokenized row; status is ok, context or memory."""
    names = [f.split()[0] for f in RESULT.split(", ")]

    def run(batches):
        for pdf in batches:
            lengths = pdf["token_length"].to_numpy(np.int64)
            flat = [np.concatenate([np.empty(0, np.int64), *pdf[c]]) for c in ("token_ids", "token_mask")]  # of the batch, end to end
            sizes = pdf["token_ids"].map(len).to_numpy(np.int64)
            begin = np.cumsum(sizes) - sizes
            place = np.searchsorted(buckets, lengths)
            rows: list[tuple] = [("context", *[None] * 9)] * len(pdf)
            for b, width in enumerate(buckets):
                at = np.flatnonzero(place == b)
                step = max(1, CALL_TOKENS // width)
                for part in (at[i : i + step] for i in range(0, len(at), step)):
                    ids, mask = np.full((len(part), width), PAD, np.int64), np.full((len(part), width), PAD_MASK, np.int64)
                    inside = np.arange(width) < lengths[part][:, None]
                    at_flat = (begin[part][:, None] + np.arange(width))[inside]
                    ids[inside], mask[inside] = flat[0][at_flat], flat[1][at_flat]
                    for i, got in zip(part, _score(scorer, ids, mask)):
                        rows[i] = got
            out = pd.DataFrame({c: pd.Series([r[k] for r in rows], dtype=object) for k, c in enumerate(names)})
            yield pd.concat([pdf[[*key, "token_length"]].reset_index(drop=True), out], axis=1)

    fields = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in (*key, "token_length"))
    ordered = df.select(*key, "token_length", "token_ids", F.col("token_mask").cast("array<int>").alias("token_mask")).sortWithinPartitions("token_length")
    return ordered.mapInPandas(run, f"{fields}, {RESULT}")
