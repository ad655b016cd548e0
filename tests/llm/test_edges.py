"""Odd tables: nulls in any column, empty and very long texts, ties, repeated rows, empty tables and
extra columns whose names the operators use inside."""

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from helixframe.llm import chat, features, jaccard, langid, mixing, ordinal, packing, pii, quality_rules, topk, toxicity
from helixframe.llm.words import Words

CLASHES = (
    "_gone", "_row", "_words", "_lines", "_win", "_at", "_lang", "_limit", "size", "u", "h", "n", "sig", "heavy", "host", "strict", "rate", "copies", "copy", "target",
    "plan_source", "base_failed", "soft_failed", "kept", "comp", "token", "node", "root", "spans", "score", "deal", "shard", "open", "piece", "start", "length", "count",
)
COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint, doc string"
BIG = 2**60 + 1
WORDS = " ".join(f"word{i % 83} of line{i}" for i in range(40))
ROWS = [
    (1, WORDS, "en", "a", 1), (2, WORDS, None, None, None), (2, WORDS, None, None, None), (None, WORDS + " more", "en", "a", 1), (None, None, None, None, None), (3, "", "en", "b", 0),
    (4, " \n\t ", "de", "b", 4), (BIG, WORDS.replace("word1", "other"), "en", "a", 9), (5, "lang " * 60_000, "en", "a", 1), (6, "x" * 300_000, "de", "c", 1), (7, "7 " * 100, "de", "c", 1),
    (8, " " * 200_000 + "é🙂 " * 70 + WORDS, "de", "c", 1), (9, "a\x00b ﻿ " * 60 + WORDS, "fr", "", 1), (BIG + 1, "one two", "fr", "", 1),
]


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame([(*r, None) for r in ROWS], COLUMNS)
    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHES)]).persist()


def ids(df):
    return sorted((r[0] is not None, r[0] or 0) for r in df.select("doc_id").collect())


def test_a_row_for_every_row(spark, odd):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, None), (None, 1, 1), (3, None, 1), (5, 0, 0), (1, 0, 0), (77, 1, 1)], "doc_id bigint, quality int, toxic int").withColumn("score", F.lit(1))
    ratings = labels.select("doc_id", (F.col("quality") * (2 - F.col("toxic"))).alias("grade"))
    want = ids(odd)
    assert ids(langid.identify(odd, langid.train(spark, odd))) == want
    assert ids(toxicity.score(odd, toxicity.train(spark, odd, labels))) == want
    assert ids(ordinal.rate(odd, ordinal.train(spark, odd, ratings))) == want
    assert ids(quality_rules.judge(spark, odd)) == ids(mixing.mix(spark, odd)) == ids(pii.find_pii(odd)) == want
    assert ids(jaccard.jaccard_components(spark, odd)) == want
    assert ids(packing.pack(spark, odd).where("piece = 0")) == want


def test_training_reads_whole_texts(spark):
    text = " ".join(f"word{i}" for i in range(9000))
    docs = spark.createDataFrame([(1, text), (2, "a b a"), (3, None)], "doc_id bigint, text string")
    for kind, bits in ((features.word_features, toxicity.BITS), (features.shape_features, ordinal.BITS)):
        got = features.features_of(spark, docs, [1, 2, 3], bits, kind)
        for i, t in ((1, text), (2, "a b a"), (3, "")):
            f, n = np.unique(kind(Words([t.encode()]), bits), return_counts=True)
            assert got[i].tolist() == [f.tolist(), n.tolist()]


def test_without_labels(spark, odd):
    none = odd.select("doc_id", F.lit(None).cast("int").alias("toxic"), F.lit(None).cast("int").alias("grade"))
    assert toxicity.train(spark, odd, none) is None and ordinal.train(spark, odd, none) is None
    assert langid.train(spark, odd.withColumn("lang", F.lit(None).cast("string"))) is None


def test_copies_and_null_ids_of_the_join(spark, odd):
    got = {r.doc_id: r for r in jaccard.jaccard_components(spark, odd).collect() if r.doc_id is not None}
    assert got[1].component_id == got[2].component_id == 1 and got[BIG + 1].component_id == BIG + 1
    assert [got[i].n_shingles for i in (3, 4, 6, BIG + 1)] == [0, 0, 1, 1]


def test_packing_keeps_large_ids_beside_null_ids(spark, odd):
    got = packing.pack(spark, odd).collect()
    assert {r.doc_id for r in got} == {r[0] for r in ROWS}
    assert len({(r.sequence_id, r.offset) for r in got}) == len(got)


def test_ids_of_very_long_runs():
    slow = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    fast = packing.encoder(packing.ranks_path())
    for run in (" ", "\n", "　", "\t "):
        t = "a" + run * (1_200_000 // len(run)) + "b <|endoftext|>"
        assert fast(t) == slow.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES[:4]], ids=[n for n, _ in corpus_pipeline.STAGES[:4]])
def test_stage_on_odd_rows(spark, odd, stage):
    got = stage(spark, odd, "")
    assert got.schema.names == odd.columns and len(got.collect()) <= 3 * len(ROWS)
    assert stage(spark, odd.where("false"), "").collect() == []


def test_last_stage_on_odd_rows(spark, odd):
    assert ids(corpus_pipeline.packed(spark, odd, "").where("piece = 0")) == ids(odd)
    assert corpus_pipeline.packed(spark, odd.where("false"), "").collect() == []


def test_near_duplicates_keep_one_of_each_group(spark, odd):
    kept = [r.doc_id for r in jaccard.keep_one(spark, odd).collect()]
    assert 1 in kept and 2 not in kept and {3, 4, 6, 7, BIG + 1} <= set(kept)


def test_near_duplicates_decide_by_row(spark):
    """Repeated and null ids: each text stays once, and no other text goes with its id."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(3, a), (5, a), (5, b), (5, b), (5, b.upper()), (None, c), (None, c), (None, c + " end"), (None, b), (7, c.replace("c0 ", "")), (8, "one"), (8, "two"), (9, "one"), (10, None), (10, None), (None, " "), (11, "solo")]
    docs = spark.createDataFrame([(*r, {"k": "v"}) for r in rows], "doc_id bigint, text string, m map<string,string>").repartition(3)
    got = jaccard.keep_one(spark, docs)
    assert got.schema == docs.schema
    want = [(3, a), (5, b.upper()), (7, c.replace("c0 ", "")), (8, "one"), (8, "two"), (10, None), (10, None), (None, " "), (11, "solo")]
    first = got.collect()
    # of the two texts of id 8 neither is a copy of the other
    assert sorted(map(repr, ((r.doc_id, r.text) for r in first))) == sorted(map(repr, want))
    nulls = spark.createDataFrame([(None, c)] * 4 + [(None, a)], "doc_id bigint, text string")
    assert sorted(r.text for r in jaccard.keep_one(spark, nulls).collect()) == [a, c]


def test_chat_odd_rows(spark):
    rows = [(1, 0, "user", None), (1, 0, "user", None), (1, None, "assistant", "a\\"), (None, 1, None, "x" * 200_000), (2, 1, "assistant", "")]
    e = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string")
    e = e.select("*", F.col("turn").alias("seq"), F.lit("message").alias("kind"), *[F.lit(0).alias(c) for c in ("msg", "log", "last", "head", "body", "parts", "starts", "n")])
    got = {r.conv_id: r for r in chat.format_chats(e).withColumn("turns", chat.parse(F.col("formatted"))).collect()}
    assert [tuple(t) for t in got[1].turns] == [("assistant", "a\\"), ("user", ""), ("user", "")]
    assert [tuple(t) for t in got[None].turns] == [("", "x" * 200_000)] and len(got[2].loss_spans) == 1
    assert chat.format_chats(e.where("false")).collect() == []


def test_topk_odd_rows(spark):
    rows = [(0, [1.0, 2.0]), (None, [1.0, 2.0]), (0, [1.0, 2.0]), (1, []), (20, []), (40, [3.0]), (3, [-1.0, 5.0]), (2, [-1.0, 5.0]), (5, [float("inf"), 0.0])]
    v = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").select("*", *[F.lit(0).alias(c) for c in ("v", "h", "side", "grp", "ids", "part")])
    got = {tuple(r) for r in topk.top_k(spark, v).collect()}
    # the two rows of id 0 are two vectors, each with its candidates
    assert {(0, 1, 2, 64 * 64 * 9), (0, 2, 2, 64 * 64 * 9), (0, 3, 3, 64 * 64 * 9), (20, 1, 1, 0)} <= got and not any(r[0] == 40 for r in got)
    assert topk.top_k(spark, v.where("false")).collect() == []
