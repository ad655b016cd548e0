"""N-gram Jaccard join by vertical partitioning.

A document's set is its distinct shingles of k words. All shingles stand in one global order:
by document frequency, then by hash, with the heaviest shingles last. The order is cut into
fragments. A pair's overlap is counted in every fragment separately and summed per pair; two
sets link when ``den * intersection >= num * union``.

How it runs:

1. One scan gives each document its set size and two independent 64-bit signatures of its set. Equal
   first signatures are one class from there on, whatever their number of copies; where the second
   signatures differ, they replace the first ones. Shingles that are heavy in a part of the
   scan are counted up, and the ``HEAVY`` most frequent are known to all tasks (a fixed bound).
2. A second scan deals the other shingles of each class to fragments by range of hash, packed. A
   fragment counts document frequencies and sends back only shingles of two classes or more:
   nothing else can overlap. Heavy shingles are not dealt, so that no fragment is hot.
3. A class whose shared shingles are too few for any partner is done. The others keep their
   shared shingles in global order, cut into segments, and a prefix: the first
   ``size - least overlap + 1`` places, of which shingles of one class take the first.
4. Classes that share a prefix shingle are candidates. They are not all paired: each shingle
   compares its members with one pivot, pairs are checked, links joined into components, and
   only members of different components meet again (another pivot, ``STARS`` times; at last in
   tiles of bounded size, where the sum over ``CELLS`` ranges of the lesser count bounds the
   overlap). So a group of near copies costs in proportion to its size, yet no link between
   different components is lost and nothing is capped.
5. A pair's segments meet fragment by fragment; partial overlaps are summed per pair.

Hot shingles and hot pivots: shingles of very many members are joined with their pivots apart from the
others, so that their members need not meet in a task; a pivot's segments are copied once per
``COPY_PAIRS`` pairs it is compared in.

Shingle hashes are 64-bit: two different shingles count as one with a chance of 2**-64. Sets are told
apart by 128 bits.

Edge cases: null, empty or blank text has size 0, links with nothing and is its own component;
fewer words than k are one shingle; repeated rows and equal texts are one class; an empty table
gives no rows; a null id counts for nothing but its row is returned; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WORD, cut, slices, table
from .components import components, join_spread
from .words import Words, as_bytes, chunks, mix

HEAVY = 1 << 16
HEAVY_SHARE = 0.01
FRAGMENT_ROWS = 1_000_000
SEGMENTS = 16
CELLS = 64
STARS = 3
TILE = 512
TILE_ROWS = 500
SIGNED_ROWS = 512
COPY_PAIRS = 1024
_U = np.uint64
_HEAVY_DF = np.int64(1 << 40)


def _signatures(n: int, doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Set sizes of n documents, their signatures and what replaces signatures that collide."""
    size = np.bincount(doc, minlength=n)
    at = np.cumsum(size) - size
    some = size > 0
    sig, other = np.zeros(n, _U), np.zeros(n, _U)
    if len(h):
        total = np.add.reduceat(mix(h + _U(0x51)), at[some])
        parity = np.bitwise_xor.reduceat(mix(h ^ _U(0xA7)), at[some])
        sig[some] = mix(total + mix(parity + size[some].astype(_U)))
        total = np.add.reduceat(mix(h * _U(0xC2B2AE3D27D4EB4F) + _U(0xB5)), at[some])
        other[some] = mix(total + mix(sig[some]))
    return size, sig.view(np.int64), other.view(np.int64)


def _settled(sig: np.ndarray, other: np.ndarray, collided: np.ndarray) -> np.ndarray:
    return np.where(np.isin(sig, collided), other, sig) if len(collided) else sig


SCAN = ["doc_id", "n", "sig", "other", "heavy"]


def _scan(k: int):
    """doc_id, n, sig, other per document; at the end of a task its heavy shingles with counts."""

    def run(batches):
        heavy: dict[int, int] = {}
        for b in slices(batches):
            texts = as_bytes(b.column(1))
            size, sig, other = (np.zeros(len(texts), np.int64) for _ in range(3))
            for lo, hi in chunks(texts):
                doc, h = Words(texts[lo:hi]).shingles(k)
                size[lo:hi], sig[lo:hi], other[lo:hi] = _signatures(hi - lo, doc, h)
                first = np.zeros(hi - lo, bool)
                first[np.unique(sig[lo:hi], return_index=True)[1]] = True
                values, counts = np.unique(h[first[doc]], return_counts=True)
                much = counts >= max(4, HEAVY_SHARE * first.sum())
                for v, c in zip(values[much].view(np.int64).tolist(), counts[much].tolist()):
                    heavy[v] = heavy.get(v, 0) + c
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(size.astype(np.int32)), pa.array(sig), pa.array(other), pa.nulls(len(texts), pa.int64())], SCAN)
        if heavy:
            n = len(heavy)
            none = pa.nulls(n, pa.int64())
            counts = pa.array(np.minimum(list(heavy.values()), 2**31 - 1).astype(np.int32))
            yield pa.RecordBatch.from_arrays([none, counts, none, none, pa.array(list(heavy), pa.int64())], SCAN)

    return run


BLOCK = pa.schema([("key", pa.int32()), ("kind", pa.int8()), ("sigs", pa.binary()), ("counts", pa.binary()), ("sizes", pa.binary()), ("tokens", pa.binary()), ("dfs", pa.binary())])
BLOCK_DDL = "key int, kind tinyint, sigs binary, counts binary, sizes binary, tokens binary, dfs binary"


def _runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of runs of equal values."""
    at = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.empty(0, np.int64)
    return at, np.diff(np.append(at, len(x)))


class _Blocks:
    def __init__(self):
        self.rows: list[tuple] = []

    def add(self, key, kind, sigs, counts, sizes, tokens, dfs=b""):
        raw = [x if isinstance(x, bytes) else x.tobytes() for x in (sigs, counts, sizes, tokens, dfs)]
        self.rows.append((int(key), kind, *raw))

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) if self.rows else [[]] * len(BLOCK)
        return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, BLOCK)], schema=BLOCK)


def _by(key: np.ndarray):
    """Slices of a stable order by key: key value, index array."""
    order = np.argsort(key, kind="stable")
    at, n = _runs(key[order])
    for a, m in zip(at, n):
        yield key[order[a]], order[a : a + m]


def _deal(k: int, heavy: np.ndarray, fragments: int, collided: np.ndarray):
    """kind 0: shingles of classes by fragment; kind 1: per class size and heavy shingles, by class."""

    def run(batches):
        seen: set[int] = set()
        for b in slices(batches):
            texts = as_bytes(b.column(1))
            for lo, hi in chunks(texts):
                out = _Blocks()
                doc, h = Words(texts[lo:hi]).shingles(k)
                size, sig, other = _signatures(hi - lo, doc, h)
                sig = _settled(sig, other, collided)
                new = np.zeros(hi - lo, bool)
                for i in np.flatnonzero(size):
                    s = int(sig[i])
                    if s not in seen:
                        seen.add(s)
                        new[i] = True
                use = new[doc]
                doc, h = doc[use], h[use]
                at = np.searchsorted(heavy, h)
                is_heavy = (heavy[np.minimum(at, len(heavy) - 1)] == h) if len(heavy) else np.zeros(len(h), bool)
                light, hl = doc[~is_heavy], h[~is_heavy]
                frag = ((hl >> _U(32)) * _U(fragments) >> _U(32)).astype(np.int32)
                for f, i in _by(frag):
                    a, m = _runs(light[i])
                    out.add(f, 0, sig[light[i][a]], m.astype(np.uint32), b"", hl[i])
                hd, hh = doc[is_heavy], h[is_heavy]
                n_heavy = np.bincount(hd, minlength=hi - lo)
                first = np.cumsum(n_heavy) - n_heavy
                docs = np.flatnonzero(new)
                part = (sig[docs].view(_U) % _U(fragments)).astype(np.int32)
                for p, i in _by(part):
                    d = docs[i]
                    take = np.concatenate([np.arange(first[x], first[x] + n_heavy[x]) for x in d]).astype(np.int64)
                    out.add(p, 1, sig[d], n_heavy[d].astype(np.uint32), size[d].astype(np.uint32), hh[take])
                if out.rows:
                    yield out.batch()

    return run


def _column(t: pa.Table, name: str, dtype) -> np.ndarray:
    return np.concatenate([np.empty(0, dtype), *(np.frombuffer(x, dtype) for x in t[name].to_pylist())])


def _fragment(fragments: int):
    """Document frequencies in a fragment: shingles of two classes or more go to their classes."""

    def run(t: pa.Table) -> pa.Table:
        kind = t["kind"].to_numpy()
        asked, passed = t.filter(pa.array(kind == 0)), t.filter(pa.array(kind == 1))
        sig = np.repeat(_column(asked, "sigs", np.int64), _column(asked, "counts", np.uint32))
        token = _column(asked, "tokens", _U)
        order = np.lexsort((sig, token))
        sig, token = sig[order], token[order]
        keep = np.ones(len(sig), bool)
        keep[1:] = (sig[1:] != sig[:-1]) | (token[1:] != token[:-1])  # a class met in several tasks
        sig, token = sig[keep], token[keep]
        _, n = _runs(token)
        df = np.repeat(n, n)
        sig, token, df = sig[df > 1], token[df > 1], df[df > 1]
        out = _Blocks()
        order = np.argsort(sig, kind="stable")
        sig, token, df = sig[order], token[order], df[order]
        for p, i in _by((sig.view(_U) % _U(fragments)).astype(np.int32)):
            a, m = _runs(sig[i])
            out.add(p, 0, sig[i][a], m.astype(np.uint32), b"", token[i], df[i].astype(np.uint32))
        return pa.concat_tables([passed.select(BLOCK.names).cast(BLOCK), pa.Table.from_batches([out.batch()])])

    return run


CLASS_DDL = "sig bigint, n int, single int, prefix array<bigint>, segments array<array<bigint>>, cells array<int>"


def _assemble(num: int, den: int):
    """Classes that may have a partner, with shared shingles in global order."""

    def run(t: pa.Table) -> pa.Table:
        kind = t["kind"].to_numpy()
        back, own = t.filter(pa.array(kind == 0)), t.filter(pa.array(kind == 1))
        own_sig, own_count = _column(own, "sigs", np.int64), _column(own, "counts", np.uint32)
        ids, first = np.unique(own_sig, return_index=True)
        size = _column(own, "sizes", np.uint32)[first].astype(np.int64)
        heavy_from = np.repeat(np.arange(len(own_sig)), own_count)
        real = np.zeros(len(own_sig), bool)
        real[first] = True
        heavy_token = _column(own, "tokens", _U)[real[heavy_from]]
        heavy_sig = own_sig[heavy_from[real[heavy_from]]]
        sig = np.concatenate([np.repeat(_column(back, "sigs", np.int64), _column(back, "counts", np.uint32)), heavy_sig])
        token = np.concatenate([_column(back, "tokens", _U), heavy_token])
        df = np.concatenate([_column(back, "dfs", np.uint32).astype(np.int64), np.full(len(heavy_token), _HEAVY_DF)])
        who = np.searchsorted(ids, sig)
        shared = np.bincount(who, minlength=len(ids))
        alive = shared * den >= num * size
        use = alive[who]
        who, token, df = who[use], token[use], df[use]
        order = np.lexsort((token, df, who))
        who, token, df = who[order], token[order], df[order]
        # fragments of the order: ranges of frequency, then ranges of hash for the heavy ones
        half = SEGMENTS // 2
        segment = np.where(df == _HEAVY_DF, half + (token >> _U(61)).astype(np.int64) * half // 8, np.minimum(np.log2(df).astype(np.int64), half - 1))
        live = np.flatnonzero(alive)
        n = len(live)
        row = np.searchsorted(live, who)
        count = np.bincount(row, minlength=n)
        starts = np.append(np.cumsum(count) - count, len(row))
        least = -(-num * size[live] // den)
        single = size[live] - count
        prefix = np.minimum(size[live] - least + 1 - single, count)
        at = np.concatenate([[0], np.cumsum(prefix)])
        pick = np.arange(at[-1]) - np.repeat(at[:-1], prefix) + np.repeat(starts[:-1], prefix)
        inner = np.concatenate([[0], np.cumsum(np.bincount(row * SEGMENTS + segment, minlength=n * SEGMENTS))])
        cells = np.bincount(row * CELLS + (token >> _U(58)).astype(np.int64), minlength=n * CELLS)
        signed = token.view(np.int64)
        lists = lambda off, v: pa.ListArray.from_arrays(pa.array(off, pa.int32()), v)
        return pa.table({
            "sig": pa.array(ids[live], pa.int64()), "n": pa.array(size[live], pa.int32()), "single": pa.array(single, pa.int32()),
            "prefix": lists(at, pa.array(signed[pick], pa.int64())),
            "segments": lists(np.arange(n + 1) * SEGMENTS, lists(inner, pa.array(signed, pa.int64()))),
            "cells": lists(np.arange(n + 1) * CELLS, pa.array(cells, pa.int32())),
        })

    return run


def _may_link(n1: Column, p1: Column, n2: Column, p2: Column, num: int, den: int) -> Column:
    """Length filter, and the bound on the overlap if the shared shingle at places p1, p2 (from 0) is
    the first that the two have in common."""
    length = num * F.greatest(n1, n2) <= den * F.least(n1, n2)
    return length & (F.least(n1 - p1, n2 - p2) * (num + den) >= num * (n1 + n2))


def verify(pairs: DataFrame, segments: DataFrame, num: int, den: int) -> DataFrame:
    """pairs (a, b, na, nb, copies) that link: partial overlaps per fragment, summed per pair. ``b`` may
    be a hot pivot: its segments are copied ``copies`` times, the same number for all its pairs."""
    pairs = pairs.withColumn("copy", F.pmod(F.xxhash64("a"), F.col("copies")))
    left = segments.select(F.col("sig").alias("a"), "segment", F.col("tokens").alias("ta"))
    hubs = pairs.groupBy("b").agg(F.max("copies").alias("copies"))
    right = segments.join(hubs, F.col("sig") == F.col("b")).withColumn("copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1)))
    right = right.select("b", "copy", "segment", F.col("tokens").alias("tb"))
    part = pairs.join(left, "a").join(right, ["b", "copy", "segment"]).select("a", "b", "na", "nb", F.size(F.array_intersect("ta", "tb")).alias("overlap"))
    total = part.groupBy("a", "b", "na", "nb").agg(F.sum("overlap").alias("overlap"))
    return total.where(F.col("overlap") * (num + den) >= num * (F.col("na") + F.col("nb"))).select(F.col("a").alias("u"), F.col("b").alias("v"))


def _star(spark: SparkSession, active: DataFrame, star: int) -> DataFrame:
    """Members of buckets that hold different components, each beside its bucket's pivot ``p`` and that
    pivot's number of copies."""
    first = F.struct((F.col("single") if star == 0 else F.xxhash64("sig", F.lit(star))).alias("by"), "sig", "n", "pos", "comp")
    pivots = active.groupBy(F.col("token").alias("_key")).agg(F.min(first).alias("p"), F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("m"))
    pivots = cut(spark, pivots.where("lo <> hi").select("_key", "p", "m"), f"jaccard-pivots{star}")
    hubs = pivots.groupBy(F.col("p.sig").alias("hub")).agg(F.ceil(F.sum("m") / COPY_PAIRS).alias("copies"))
    pivots = pivots.join(hubs, F.col("p.sig") == F.col("hub")).drop("hub")
    return join_spread(spark, active, "token", pivots, f"jaccard-spread{star}").where("sig <> p.sig")


def _tiles(num: int, den: int):
    """Pairs of different components that may link, in each tile (rows of left and right side)."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out: dict[str, list] = {"a": [], "b": [], "na": [], "nb": []}
        for _, t in pdf.groupby(["token", "i", "j"], sort=False):
            left, right = t[t["side"] == 0], t[t["side"] == 1]
            if t["i"].iloc[0] == t["j"].iloc[0]:
                right = left
            if not len(left) or not len(right):
                continue
            cols = lambda x: (x["sig"].to_numpy(np.int64), x["n"].to_numpy(np.int64), x["pos"].to_numpy(np.int64), x["comp"].to_numpy(np.int64))
            (s1, n1, p1, c1), (s2, n2, p2, c2) = cols(left), cols(right)
            need = num * (n1[:, None] + n2[None])
            ok = (c1[:, None] != c2[None]) & (num * np.maximum(n1[:, None], n2[None]) <= den * np.minimum(n1[:, None], n2[None]))
            ok &= np.minimum((n1 - p1)[:, None], (n2 - p2)[None]) * (num + den) >= need
            if right is left:
                ok &= s1[:, None] < s2[None]
            x, y = np.nonzero(ok)
            v1, v2 = np.stack(left["cells"].to_numpy()), np.stack(right["cells"].to_numpy())
            for k in range(0, len(x), 1 << 16):
                i, j = x[k : k + (1 << 16)], y[k : k + (1 << 16)]
                good = np.minimum(v1[i], v2[j]).sum(1) * (num + den) >= need[i, j]
                i, j = i[good], j[good]
                swap = s1[i] > s2[j]
                out["a"].append(np.where(swap, s2[j], s1[i]))
                out["b"].append(np.where(swap, s1[i], s2[j]))
                out["na"].append(np.where(swap, n2[j], n1[i]))
                out["nb"].append(np.where(swap, n1[i], n2[j]))
        got = pd.DataFrame({c: np.concatenate([np.empty(0, np.int64), *v]) for c, v in out.items()})
        return got.drop_duplicates()

    return run


class _Links:
    """Components of classes so far; classes without a link are not listed."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.labels: DataFrame | None = None

    def of(self, df: DataFrame, sig: str = "sig") -> DataFrame:
        """df with ``comp``, the component of its class."""
        if self.labels is None:
            return df.withColumn("comp", F.col(sig))
        known = self.labels.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
        return df.join(known, F.col(sig) == F.col("_node"), "left").withColumn("comp", F.coalesce("_root", sig)).drop("_node", "_root")

    def add(self, links: DataFrame) -> None:
        if self.labels is None:
            self.labels = cut(self.spark, components(self.spark, links), "labels")
            return
        u = self.of(links, "u").select(F.col("comp").alias("u"), "v")
        joined = components(self.spark, self.of(u, "v").select("u", F.col("comp").alias("v")))
        joined = cut(self.spark, joined.select(F.col("node").alias("old"), F.col("root").alias("new")), "labels")
        moved = self.labels.join(joined, F.col("root") == F.col("old"), "left").select("node", F.coalesce("new", "root").alias("root"))
        fresh = joined.join(self.labels, F.col("old") == F.col("node"), "left_anti").select(F.col("old").alias("node"), F.col("new").alias("root"))
        self.labels = cut(self.spark, moved.unionByName(fresh), "labels")


def _rows_with_components(spark: SparkSession, docs: DataFrame, k: int, num: int, den: int) -> tuple[DataFrame, np.ndarray]:
    """doc_id, n, sig, comp, component_id of every row; of rows without shingles sig and comp are null.
    Also the signatures that had to be replaced."""
    rows = docs.select(F.col("doc_id").cast("bigint"), "text")
    scan = cut(spark, rows.mapInArrow(_scan(k), "doc_id bigint, n int, sig bigint, other bigint, heavy bigint"), "jaccard-scan")
    sets = scan.where("sig is not null")
    # of n sets about n * n / 2**65 signatures collide: none, or a few of 10 billion
    collided = sets.where("n > 0").groupBy("sig").agg((F.min("other") != F.max("other")).alias("differ")).where("differ").select("sig").collect()
    collided = np.array([r[0] for r in collided], np.int64)
    if len(collided):
        sets = sets.withColumn("sig", F.when(F.col("sig").isin(collided.tolist()), F.col("other")).otherwise(F.col("sig")))
    top = scan.where("heavy is not null").groupBy("heavy").agg(F.sum("n").alias("c")).orderBy(F.desc("c"), "heavy").limit(HEAVY).select("heavy").collect()
    heavy = np.sort(np.array([r[0] for r in top], np.int64).view(_U))
    total = sets.agg(F.sum("n")).first()[0] or 0
    fragments = max(1, math.ceil(total / FRAGMENT_ROWS))
    classes = cut(
        spark,
        rows.mapInArrow(_deal(k, heavy, fragments, collided), BLOCK_DDL).groupBy("key").applyInArrow(_fragment(fragments), BLOCK_DDL)
        .groupBy("key").applyInArrow(_assemble(num, den), CLASS_DDL),
        "jaccard-classes",
    )
    segments = cut(spark, classes.select("sig", F.posexplode("segments").alias("segment", "tokens")).where(F.size("tokens") > 0), "jaccard-segments")
    links = _Links(spark)
    entries = classes.select("sig", "n", "single", "cells", F.posexplode("prefix").alias("place", "token")).withColumn("pos", F.col("place") + F.col("single")).drop("place")
    active = entries.drop("cells")
    for star in range(STARS):
        met = cut(spark, _star(spark, links.of(active.drop("comp")), star), f"jaccard-star{star}")
        pairs = met.where((F.col("comp") != F.col("p.comp")) & _may_link(F.col("n"), F.col("pos"), F.col("p.n"), F.col("p.pos"), num, den))
        pairs = pairs.groupBy(F.col("sig").alias("a"), F.col("p.sig").alias("b"), F.col("n").alias("na"), F.col("p.n").alias("nb")).agg(F.max("copies").alias("copies"))
        # written, so that few pairs are sent to the segments and these are not shuffled
        links.add(verify(cut(spark, pairs, f"jaccard-pairs{star}"), segments, num, den))
        active = met.select("token", "sig", "n", "single", "pos")
    # what is left: members of different components in one bucket, tile by tile
    active = cut(spark, links.of(active), "jaccard-left")
    sizes = active.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("m"))
    sizes = sizes.groupBy("token").agg(F.max(F.struct("m", "comp")).alias("main"), F.sum("m").alias("all"), F.count(F.lit(1)).alias("comps")).where("comps > 1")
    sizes = sizes.select(
        F.col("token").alias("_key"), F.col("main.comp").alias("main"), F.col("all").alias("m"),
        F.ceil((F.col("all") - F.col("main.m")) / TILE).cast("int").alias("others"), F.ceil(F.col("main.m") / TILE).cast("int").alias("mains"),
    )
    left = join_spread(spark, active, "token", sizes, "jaccard-buckets")
    deal = F.xxhash64("sig")
    is_main = F.col("comp") == F.col("main")
    number = F.when(is_main, F.col("others") + F.pmod(deal, F.col("mains"))).otherwise(F.pmod(deal, F.col("others"))).cast("int")
    left = left.withColumn("number", number)
    # the other components' chunks meet each other and the main component's; its own chunks don't meet
    as_left = left.where(~is_main).withColumn("j", F.explode(F.sequence(F.col("number"), F.col("others") + F.col("mains") - 1))).withColumn("i", F.col("number")).withColumn("side", F.lit(0))
    as_right = left.withColumn("i", F.explode(F.sequence(F.lit(0), F.least("number", F.col("others") - 1)))).withColumn("j", F.col("number")).withColumn("side", F.lit(1)).where("i <> j")
    cols = ("token", "i", "j", "side", "sig", "n", "pos", "comp")
    tiles = cut(spark, as_left.select(*cols).unionByName(as_right.select(*cols)), "jaccard-tiles")
    groups = max(1, math.ceil(tiles.count() / TILE_ROWS))
    tiles = tiles.join(classes.select("sig", "cells"), "sig").withColumn("g", F.pmod(F.xxhash64("token", "i", "j"), F.lit(groups)).cast("int"))
    pairs = tiles.groupBy("g").applyInPandas(_tiles(num, den), "a bigint, b bigint, na int, nb int").distinct().withColumn("copies", F.lit(1).cast("bigint"))
    links.add(verify(cut(spark, pairs, "jaccard-tile-pairs"), segments, num, den))
    # smallest id of each component; a component or a class may hold a third of all rows
    members = sets.where("n > 0").groupBy("sig").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("rows"))
    members = cut(spark, links.of(members), "jaccard-members")
    least = members.groupBy(F.col("comp").alias("_key")).agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("m"))
    named = join_spread(spark, members, "comp", least, "jaccard-least")
    named = named.select(F.col("sig").alias("_key"), "comp", "component_id", F.col("rows").alias("m"))
    found = join_spread(spark, sets.where("n > 0").select("doc_id", "n", "sig"), "sig", named, "jaccard-named")
    none = F.lit(None).cast("bigint")
    blank = sets.where("n = 0").select("doc_id", "n", none.alias("sig"), none.alias("comp"), F.col("doc_id").alias("component_id"))
    found = found.select("doc_id", "n", "sig", "comp", F.coalesce("component_id", "doc_id").alias("component_id"))
    return found.unionByName(blank), collided


def jaccard_components(spark: SparkSession, docs: DataFrame, k: int = 3, num: int = 90, den: int = 100) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    return _rows_with_components(spark, docs, k, num, den)[0].select("doc_id", F.col("n").cast("bigint").alias("n_shingles"), "component_id")


def _with_signature(docs: DataFrame, k: int, name: str, collided: np.ndarray) -> DataFrame:
    """docs with the signature of each row's shingle set, null where it is empty."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, SIGNED_ROWS):
                b = batch.slice(at, SIGNED_ROWS)
                texts = as_bytes(b.column(b.schema.get_field_index("text")))
                size, sig = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
                for lo, hi in chunks(texts):
                    size[lo:hi], first, other = _signatures(hi - lo, *Words(texts[lo:hi]).shingles(k))
                    sig[lo:hi] = _settled(first, other, collided)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(sig, mask=size == 0)], [*b.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())]))


def keep_one(spark: SparkSession, docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row of each component, and every row without words. The row of the smallest id stays (null
    ids last); of rows of one id the one of least signature, then of least columns. Ids that occur once
    decide by id; texts of the others are read once more to tell their rows apart."""
    name = "_gone"
    while any(c.startswith(name) for c in docs.columns):
        name += "_"
    at = f"{name}sig"
    rows, collided = _rows_with_components(spark, docs, k, num, den)
    rows = cut(spark, rows.select("doc_id", "sig", "comp", "component_id"), "jaccard-rows")
    odd = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("m")).where("m > 1 or doc_id is null").select(F.col("doc_id").alias(name))
    gone = rows.where("doc_id <> component_id").select(F.col("doc_id").alias(name))
    by_id = lambda ids, how: docs.join(ids, F.col("doc_id") == F.col(f"`{name}`"), how)
    if odd.isEmpty():
        return by_id(gone, "left_anti")
    odd = cut(spark, odd, "jaccard-odd")
    once = by_id(gone.unionByName(odd.where(f"`{name}` is not null")), "left_anti").where("doc_id is not null")
    many = _with_signature(docs.join(odd, F.col("doc_id").eqNullSafe(F.col(f"`{name}`")), "left_semi"), k, at, collided)
    # of rows of the component's id the least signature stands for it
    stays = rows.where("sig is not null and doc_id <=> component_id").groupBy("comp").agg(F.min("sig").alias(f"{name}s"), F.min("doc_id").alias(name)).drop("comp")
    first = many.join(stays, (F.col(f"`{at}`") == F.col(f"`{name}s`")) & F.col("doc_id").eqNullSafe(F.col(f"`{name}`")), "left_semi")
    order = F.struct(*[F.col(f"`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()])
    first = first.groupBy(at).agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in docs.columns]), order).alias(name)).select(f"{name}.*")
    return once.unionByName(many.where(F.col(f"`{at}`").isNull()).drop(at)).unionByName(first)


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(spark, table(spark, sf_dir, "documents"))


SHINGLE_SQL = rf"""
{{name}}_w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM {{docs}}),
{{name}}_s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + {{k}} - 1], ' ') AS s FROM {{name}}_w, unnest(range(1, greatest(len(w) - {{k}} + 2, 2))) AS u(i) WHERE len(w) > 0),
{{name}}_n AS (SELECT doc_id, count(*)::BIGINT AS n FROM {{name}}_s GROUP BY doc_id),
{{name}}_o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM {{name}}_s a JOIN {{name}}_s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
{{name}}_l AS (SELECT a, b FROM {{name}}_o JOIN {{name}}_n x ON x.doc_id = a JOIN {{name}}_n y ON y.doc_id = b WHERE {{den}} * o >= {{num}} * (x.n + y.n - o)),
{{name}}_r AS (SELECT doc_id AS a, doc_id AS b FROM {{name}}_w UNION SELECT r.a, l.b FROM {{name}}_r r JOIN {{name}}_l l ON r.b = l.a),
{{name}}_c AS (SELECT a AS doc_id, min(b) AS component_id FROM {{name}}_r GROUP BY a)
"""
OP8_SQL = "WITH RECURSIVE " + SHINGLE_SQL.format(name="j", docs="documents", k=3, num=90, den=100) + """
SELECT c.doc_id, coalesce(n, 0) AS n_shingles, component_id FROM j_c c LEFT JOIN j_n USING (doc_id)
"""
