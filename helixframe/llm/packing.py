"""Best-fit packing of tokenized documents by a grouping genetic algorithm on islands.

Documents become token ids plus an end id; longer ones than a sequence are cut into full pieces
with the remainder first. Full pieces are sequences of their own. The others are dealt to
shards of about ``SHARD`` pieces, each a bin-packing problem of bounded size. A shard is solved
by several islands. An island keeps a few solutions; an offspring takes whole well-filled bins
of one parent into the other, drops the bins there that hold duplicates, and best-fits the
documents displaced by that; now and then the emptiest bins are dissolved the same way. After each epoch
the best solution of an island migrates to the next island of its shard; the best of all wins.

Ids are those of the tokenizer file ``byte_bpe_50k.json``; they are made with the same vocabulary as
ranks, several times faster, and tests hold the two equal on text of every script.

Scale: one scan tokenizes and writes 40 bytes a piece; everything after that moves those rows
only. Shards are dealt by row, so that no document, source or group of copies gathers in one; a
shard's packing loses less than one sequence against a perfect split of its tokens.

Edge cases: null or empty text is one piece holding the end id; a null id stays null and is ordered as 0;
repeated rows are packed each for itself; ties are broken by id and piece; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import base64
import math
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, table

CAPACITY = 1024
END_ID = 2
SHARD = 2048
ROWS = 1024
ISLANDS = 2
EPOCHS = 2
POPULATION = 4
GENERATIONS = 12
WELL_FILLED = 0.98
SPECIAL = {"<|endoftext|>": 50256}
PIECE = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def ranks_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


#: Runs of blanks that long are beyond the backtracking of the fast encoder's pattern (it gives up
#: between 500,000 and 1,000,000); texts that have one go to the tokenizer file itself.
LONG_BLANK = 100_000
_LONG_BLANK = re.compile(rf"(?<!\s)\s{{{LONG_BLANK}}}")

_encoders: dict = {}


def encoder(path: str):
    """ids of a text, as the tokenizer file gives them without adding special tokens. ``path``: the
    ranks; the tokenizer file of the same name lies beside it."""
    if path not in _encoders:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        fast = tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)
        slow = []

        def encode(t: str) -> list[int]:
            if len(t) >= LONG_BLANK and _LONG_BLANK.search(t):
                if not slow:
                    import tokenizers  # few workers need it

                    slow.append(tokenizers.Tokenizer.from_file(path.removesuffix(".tiktoken") + ".json"))
                return slow[0].encode(t, add_special_tokens=False).ids
            return fast.encode(t, allowed_special="all") if any(s in t for s in SPECIAL) else fast.encode_ordinary(t)

        _encoders[path] = encode
    return _encoders[path]


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece of every document, with the CRC-32 of its ids."""
    path = path or ranks_path()

    types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())

    def few(encode, ids_: pa.Array, texts: pa.Array) -> pa.RecordBatch:
        out: list[list] = [[], [], [], [], []]
        for doc, text in zip(ids_.to_pylist(), texts):
            text = text.as_py()
            ids = np.array(encode(text) if text else [], "<u4")
            ids = np.append(ids, np.array([END_ID], "<u4"))
            n = -(-len(ids) // capacity)
            first = len(ids) - (n - 1) * capacity
            edges = [0, *range(first, len(ids) + 1, capacity)]
            raw = memoryview(ids.tobytes())
            for k in range(n):
                lo, hi = edges[k], edges[k + 1]
                for column, v in zip(out, (doc, k, lo, hi - lo, zlib.crc32(raw[4 * lo : 4 * hi]))):
                    column.append(v)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    def run(batches):
        pa.default_memory_pool().release_unused()  # what an operator before left in this worker
        encode = encoder(path)
        for b in batches:
            for at in range(0, b.num_rows, ROWS):  # texts as Python strings one by one
                yield few(encode, b.column(0).slice(at, ROWS), b.column(1).slice(at, ROWS))

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, PIECE)


# --- one shard ------------------------------------------------------------------------------


def best_fit(lengths: np.ndarray, order: np.ndarray, assigned: np.ndarray, room: list[int], capacity: int) -> None:
    """Put items, in order, into the fullest bin that has room, or a new one. ``assigned`` and
    ``room`` (left per bin) are changed in place."""
    by_room: dict[int, list[int]] = {}
    mask = 0
    for b, r in enumerate(room):
        if r > 0:
            by_room.setdefault(r, []).append(b)
            mask |= 1 << r
    for i in order.tolist():
        n = int(lengths[i])
        fits = mask >> n
        if fits:
            r = n + (fits & -fits).bit_length() - 1
            b = by_room[r].pop()
            if not by_room[r]:
                mask &= ~(1 << r)
        else:
            r, b = capacity, len(room)
            room.append(capacity)
        assigned[i] = b
        left = room[b] = r - n
        if left:
            by_room.setdefault(left, []).append(b)
            mask |= 1 << left


def compact(assigned: np.ndarray) -> np.ndarray:
    return np.unique(assigned, return_inverse=True)[1].astype(np.int32)


def fitness(lengths: np.ndarray, assigned: np.ndarray) -> tuple[int, int]:
    """Smaller is better: number of bins, then minus the sum of squared fills."""
    fill = np.bincount(assigned, lengths)
    return len(fill), -int((fill * fill).sum())


def refit(lengths, assigned, displaced: np.ndarray, capacity: int, rng) -> np.ndarray:
    """Best-fit the displaced items into the bins of the others, largest first."""
    out = assigned.copy()
    out[displaced] = -1
    stay = np.flatnonzero(out >= 0)
    out[stay] = compact(out[stay])
    room = (capacity - np.bincount(out[stay], lengths[stay])).astype(int).tolist() if len(stay) else []
    items = np.flatnonzero(out < 0)
    order = items[np.argsort(-(lengths[items] + rng.random(len(items))), kind="stable")]
    best_fit(lengths, order, out, room, capacity)
    return out


def crossover(lengths, into: np.ndarray, giver: np.ndarray, capacity: int, rng) -> np.ndarray:
    """Whole well-filled bins of ``giver`` go into ``into``."""
    fill = np.bincount(giver, lengths)
    good = (fill >= WELL_FILLED * capacity) & (rng.random(len(fill)) < 0.5)
    taken = good[giver]
    hit = np.zeros(into.max() + 1, bool)
    hit[into[taken]] = True  # bins that would hold an item twice
    displaced = hit[into] & ~taken
    out = np.where(taken, giver + into.max() + 1, into).astype(np.int32)
    return refit(lengths, out, displaced, capacity, rng)


def dissolve(lengths, assigned: np.ndarray, capacity: int, rng) -> np.ndarray:
    """The emptiest bins, and as many at random, are dissolved."""
    fill = np.bincount(assigned, lengths)
    n = max(1, len(fill) // 20)
    gone = np.zeros(len(fill), bool)
    gone[np.argsort(fill)[:n]] = True
    gone[rng.integers(0, len(fill), n)] = True
    return refit(lengths, assigned, gone[assigned], capacity, rng)


def evolve(lengths: np.ndarray, seeds: list[np.ndarray], seed: int, capacity: int = CAPACITY) -> list[np.ndarray]:
    """The island's solutions after an epoch, best first. ``seeds``: its own and migrants."""
    if not len(lengths):
        return [np.empty(0, np.int32)]
    rng = np.random.default_rng(seed)
    least = -(-int(lengths.sum()) // capacity)
    people = [s for s in seeds if len(s) == len(lengths)]
    while len(people) < POPULATION and not (people and fitness(lengths, people[0])[0] == least):
        noise = 0 if not people else 0.2 * rng.random(len(lengths)) * lengths
        a = np.full(len(lengths), -1, np.int32)
        best_fit(lengths, np.argsort(-(lengths + noise), kind="stable"), a, [], capacity)
        people.append(a)
    for _ in range(GENERATIONS):
        people = sorted(people, key=lambda a: fitness(lengths, a))[:POPULATION]
        if len(people) < 2 or fitness(lengths, people[0])[0] == least:
            break
        children = []
        for _ in range(POPULATION):
            a, b = rng.choice(len(people), 2, replace=False)
            child = crossover(lengths, people[a], people[b], capacity, rng)
            children.append(dissolve(lengths, child, capacity, rng))
        people += children
    return sorted(people, key=lambda a: fitness(lengths, a))[:POPULATION]


def _ordered(items: pd.DataFrame) -> pd.DataFrame:
    by = ["length", "doc_id", "piece", "ids_crc32", "deal"]
    return items.sort_values(by, ascending=[False, *[True] * (len(by) - 1)], kind="stable").reset_index(drop=True)


ELITE = "shard int, island int, place int, bins int, square bigint, assigned binary"


def _epoch(epoch: int, capacity: int):
    def run(key, items: pd.DataFrame, elites: pd.DataFrame) -> pd.DataFrame:
        out: dict = {c.split()[0]: [] for c in ELITE.split(", ")}
        if len(items):
            shard, island = int(key[0]), int(key[1])
            lengths = _ordered(items)["length"].to_numpy(np.int64)
            seeds = [np.frombuffer(x, np.int32) for x in elites.sort_values(["e_from", "e_place"])["e_assigned"]] if len(elites) else []
            for place, a in enumerate(evolve(lengths, seeds, epoch * 1_000_003 + shard * 31 + island, capacity)):
                bins, square = fitness(lengths, a)
                for c, v in zip(out, (shard, island, place, bins, square, compact(a).tobytes())):
                    out[c].append(v)
        return pd.DataFrame(out)

    return run


def _finish(key, items: pd.DataFrame, elites: pd.DataFrame) -> pd.DataFrame:
    full = items[items["open"] == 0]
    items = _ordered(items[items["open"] == 1])
    bins = np.frombuffer(elites.sort_values(["e_bins", "e_square", "e_island", "e_place"])["e_assigned"].iloc[0], np.int32) if len(elites) else np.empty(0, np.int32)
    items = items.assign(bin=bins)
    items = items.sort_values("bin", kind="stable")
    items["offset"] = items.groupby("bin")["length"].cumsum() - items["length"]
    n = int(bins.max()) + 1 if len(bins) else 0
    out = pd.concat([items, full.assign(bin=np.arange(n, n + len(full)), offset=0)])
    out["sequence_id"] = (int(key[0]) << 32) + out["bin"].astype(np.int64)
    return out[["doc_id", "named", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]]


def pack_pieces(spark: SparkSession, rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """rows: the columns of ``pieces``. Returns them with sequence_id and offset."""
    deal = F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id())
    # no null ids in pandas, where they would make all ids of a shard floating-point numbers
    rows = rows.withColumns({"deal": deal, "named": F.col("doc_id").isNotNull(), "doc_id": F.coalesce("doc_id", F.lit(0).cast("bigint"))})
    rows = cut(spark, rows, "pack-pieces")
    shards = max(1, math.ceil(rows.count() / SHARD))
    rows = rows.withColumn("shard", F.pmod("deal", F.lit(shards)).cast("int")).withColumn("open", (F.col("length") < capacity).cast("int"))
    small = rows.where("open = 1").select("shard", F.explode(F.array(*[F.lit(i) for i in range(ISLANDS)])).alias("island"), "length", "doc_id", "piece", "ids_crc32", "deal")
    elites = spark.createDataFrame([], ELITE)
    for epoch in range(EPOCHS):
        own = elites.withColumn("to", F.col("island"))
        migrant = elites.where("place = 0").withColumn("to", (F.col("island") + 1) % ISLANDS)
        guests = own.unionByName(migrant).select(
            F.col("shard").alias("e_shard"), F.col("to").alias("e_to"), F.col("island").alias("e_from"), F.col("place").alias("e_place"), F.col("assigned").alias("e_assigned")
        )
        elites = cut(spark, small.groupBy("shard", "island").cogroup(guests.groupBy("e_shard", "e_to")).applyInPandas(_epoch(epoch, capacity), ELITE), f"pack-epoch{epoch}")
    best = elites.where("place = 0").select(*[F.col(c).alias(f"e_{c}") for c in elites.columns])
    placed = (
        rows.groupBy("shard").cogroup(best.groupBy("e_shard"))
        .applyInPandas(_finish, f"{PIECE}, named boolean, sequence_id bigint, offset bigint")
    )
    return placed.withColumn("doc_id", F.when(F.col("named"), F.col("doc_id"))).drop("named")


def pack(spark: SparkSession, docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    return pack_pieces(spark, pieces(docs, path, capacity), capacity)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark, table(spark, sf_dir, "documents"))
