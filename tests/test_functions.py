import math

import pytest
from pyspark.sql import functions as F

from helixframe import contracts as C
from helixframe.functions import lineage as L
from helixframe.functions import sequence as S
from helixframe.functions import stats as St
from helixframe.operators import inference, tokenize
from helixframe.sources.catalog import RunConfig, lineage_of


def one(spark, c, **cols):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in cols.items()]).select(c.alias("x")).first()[0]


def test_composition(spark):
    s = F.col("s")
    assert one(spark, S.gc_content(s), s="ACGT") == 0.5 and one(spark, S.gc_skew(s), s="ACGT") == 0.0
    assert one(spark, S.entropy(s), s="ACGT") == 2.0 and not one(spark, S.ambiguous(s), s="ACGT")
    assert one(spark, S.gc_content(s), s="") == 0 and one(spark, S.entropy(s), s="NNNN") == 0


def test_kmers_and_codons(spark):
    v = spark.createDataFrame([("ACGT",), (None,), ("TAAC",)], "s string").select(S.kmer_frequencies("s").alias("v"), S.codon_statistics("s").alias("c")).collect()
    assert v[0].v[6] == 0.5 and v[0].v[27] == 0.5 and sum(v[1].v) == 0 and v[2].c.stops0 == 1


def test_qc_flag(spark):
    flag = S.qc_flag(F.col("s"), F.col("b"), F.col("e"))
    got = lambda s, b="<s>", e="</s>": one(spark, flag, s=s, b=b, e=e)
    assert got("NNNN") == "ambiguous_bases" and got("AAAAAA") == "low_complexity" and got("ACGT") == "clean" and got("") == "missing_sequence_boundary_tokens"


def test_reverse_complement_and_cpg(spark):
    assert one(spark, S.reverse_complement(F.col("s"), F.lit("<->")), s="ACGTN") == "NACGT"
    assert one(spark, S.cpg_odds(F.col("s")), s="CGA") > 0 and one(spark, S.cpg_odds(F.col("s")), s="ACG") == 0


def test_lineage(spark):
    assert one(spark, L.normalize(F.col("t")), t="Eukaryota; ;Fungi ;") == "Eukaryota;;Fungi;"
    a, b = L.parts(F.lit("A;B;C")), L.parts(F.lit("A;X;C"))
    assert one(spark, L.shared_prefix(a, b)) == 1 and one(spark, L.shared_positions(a, b)) == 2
    assert one(spark, L.kingdom(F.col("t")), t="Eukaryota;Fungi;x") == "Fungi" and one(spark, F.array_join(L.compact(F.col("t")), ","), t="A; unknown ;A;B;B") == "A,B"
    assert [one(spark, L.distance_category(F.lit(i))) for i in (0, 1, 2, 3, 9, 30)] == [0, 1, 1, 2, 5, 5]


def test_buckets_and_hash(spark):
    assert [one(spark, S.length_bucket(F.lit(n))) for n in (512, 513, 32768, 32769)] == [512, 2048, 32768, -1]
    assert [one(spark, S.token_bucket(F.lit(n))) for n in (512, 513, 40000)] == [512, 1024, 32768]
    assert abs(one(spark, S.hash_fraction(42, F.lit("NC_1"))) - 0.57939818) < 1e-7
    assert [one(spark, St.bucket(F.lit(x), 0.0, 1.0, 4)) for x in (-0.1, 1.0, float("nan"))] == [0, 5, 0]


def test_tokenize_probe(spark):
    d = spark.createDataFrame([("ACGTACGTACGT", "clean"), ("ACGTA", "clean"), ("ACGTACGTACG", "clean")], "sequence string, qc_flag string")
    assert sorted(r.token_length for r in tokenize.tokenize(d).collect()) == [3, 4]


def test_likelihood_reduction(spark):
    d = spark.createDataFrame([([0.0, -1.0, -3.0], [0, 1, 1]), ([0.0], [0])], "lp array<double>, m array<int>")
    a, b = tokenize.reduce_likelihood(d, "lp", "m").collect()
    assert (a.sum_log_prob, a.mean_log_prob, a.per_token_logprob_std, a.argmin_position) == (-4.0, -2.0, 1.0, 1) and abs(a.perplexity - math.e**2) < 1e-9
    assert (b.sum_log_prob, b.perplexity, b.supervised_position_count, b.argmin_position) == (0.0, 1.0, 1, -1)


def test_global_ntile(spark):
    d = St.global_rank(spark, spark.range(23).withColumn("x", -F.col("id")), F.col("x"))
    got = d.select("rn", St.ntile(F.col("rn"), 23, 5).alias("t")).orderBy("rn").collect()
    assert [r.rn for r in got] == list(range(1, 24)) and [sum(r.t == k for r in got) for k in range(1, 6)] == [5, 5, 5, 4, 4]


def test_contracts(spark):
    with pytest.raises(ValueError):
        C.assert_schema(spark.range(1))
    with pytest.raises(ValueError):
        C.assert_unique(spark.createDataFrame([(1,), (1,)], "a int"), ("a",))
    with pytest.raises(ValueError):
        RunConfig(tier="dev_gpu_small")
    assert lineage_of("tokenized") == ["sampled_cpu", "cpu_enriched", "pretraining_corpus"]


def test_p_values():
    assert abs(inference.two_sided_p(2.0, 10) - 0.07339) < 1e-4 and inference.holm([0.01, 0.04]) == [0.02, 0.04]
