"""Layered analyses: likelihoods against length and composition, and anomaly scores over several layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.stats import finite, quantiles, robust_iqr, robust_mad, value_counts, zscore
from ..sources.shared import cut
from .inference import least_squares

#: Thresholds of the anomaly layers.
BURN_IN = 50
OUTLIER_Z = 3.0
MIN_GROUP = 20
EDGE = 50
ENTROPY_LEAST = 1.5
GC_RANGE = (0.25, 0.70)
PERPLEXITY_RANGE = (50.0, 4000.0)
EDGE_PENALTY, ENTROPY_PENALTY = 0.1, 0.2


def likelihood_base(df: DataFrame) -> DataFrame:
    """Columns made of a likelihood row: how far its least token lies below the mean, whether that is in the
    burn-in, the mean without that token, and its depth against the mean (null unless the mean is below 0)."""
    mean, least, n = F.col("mean_log_prob"), F.col("min_token_logprob"), F.col("supervised_position_count").cast("double")
    sd = F.col("per_token_logprob_std")
    return df.where(finite(mean) & finite(n)).withColumns({
        "local_anomaly_z": F.when(sd > 0, (mean - least) / sd).otherwise(0.0), "is_burn_in": (F.col("argmin_position") <= BURN_IN).cast("int"),
        "background_mean_log_prob": F.when(n > 1, (mean * n - least) / (n - 1)).otherwise(mean), "anomaly_depth_ratio": F.when(mean < 0, least / mean),
    })


def length_model(df: DataFrame) -> DataFrame:
    """df with ``length_adjusted``, the residual of the mean on log1p(length)."""
    b = least_squares(df.select(F.log1p("sequence_length").alias("x"), "mean_log_prob"), ("x",), "mean_log_prob")
    return df.withColumn("length_adjusted", F.col("mean_log_prob") - (b["intercept"] + b["x"] * F.log1p("sequence_length")))


def composition_model(df: DataFrame) -> DataFrame:
    """df with ``composition_adjusted``, the residual on length, GC content and entropy; the model is fitted
    where both are known, and the residual is null elsewhere."""
    known = df.where(F.col("gc_content").isNotNull() & F.col("entropy").isNotNull())
    b = least_squares(known.select(F.log1p("sequence_length").alias("x"), "gc_content", "entropy", "mean_log_prob"), ("x", "gc_content", "entropy"), "mean_log_prob")
    fit = b["intercept"] + b["x"] * F.log1p("sequence_length") + b["gc_content"] * F.col("gc_content") + b["entropy"] * F.col("entropy")
    return df.withColumn("composition_adjusted", F.col("mean_log_prob") - fit)


def record_metrics(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Both residuals with their z-scores (also by median and MAD), token surprise, heterogeneity, the
    place of the least token, and flags of the upper and lower 5 % (the limits included)."""
    s = composition_model(length_model(likelihood_base(df))).withColumns({
        "token_surprise": -F.col("min_token_logprob"), "relative_position": F.col("argmin_position") / F.greatest(F.col("supervised_position_count").cast("double"), F.lit(1.0)),
    })
    s = cut(spark, s, "record-metrics")
    names = {"la": "length_adjusted", "ca": "composition_adjusted", "ts": "token_surprise", "sd": "per_token_logprob_std"}
    rows = [s.agg(*[f(c).alias(f"_{k}_{n}") for k, c in names.items() for n, f in (("mean", F.avg), ("sd", F.stddev_samp))])]
    two = s.select(F.col("length_adjusted").alias("la"), F.col("composition_adjusted").alias("ca")).unpivot([], ["la", "ca"], "metric", "x")
    q = cut(spark, quantiles(spark, two, "x", {"low": 0.05, "med": 0.5, "high": 0.95}, ("metric",), interpolated=False), "record-quantiles")
    rows.append(q.agg(*[F.max(F.when(F.col("metric") == k, F.col(p))).alias(f"_{k}_{p}") for k in ("la", "ca") for p in ("low", "med", "high")]))
    center = rows[1].select("_la_med")
    away = s.crossJoin(F.broadcast(center)).select(F.abs(F.col("length_adjusted") - F.col("_la_med")).alias("away"))
    rows.append(quantiles(spark, away, "away", {"_la_mad": 0.5}, interpolated=False))
    one = rows[0]
    for r in rows[1:]:
        one = one.crossJoin(r)  # rows of one
    s = s.crossJoin(F.broadcast(cut(spark, one, "record-centers")))
    z = lambda k: zscore(F.col(names[k]), F.col(f"_{k}_mean"), F.col(f"_{k}_sd"))
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("int")
    return s.withColumns({
        "length_adjusted_z": z("la"), "length_adjusted_robust_z": robust_mad(F.col("length_adjusted"), F.col("_la_med"), F.col("_la_mad")),
        "composition_adjusted_z": F.when(F.col("composition_adjusted").isNotNull() & (F.col("_ca_sd") > 0), z("ca")), "token_surprise_z": z("ts"), "heterogeneity_z": z("sd"),
        "top_length": flag(F.col("length_adjusted") >= F.col("_la_high")), "bottom_length": flag(F.col("length_adjusted") <= F.col("_la_low")),
        "top_composition": flag(F.col("composition_adjusted") >= F.col("_ca_high")), "bottom_composition": flag(F.col("composition_adjusted") <= F.col("_ca_low")),
    }).drop(*[c for c in s.columns if c.startswith("_")])


def token_profile(values: Column) -> dict[str, Column]:
    """Length, least, greatest and mean of an array; the mean of an empty one is null."""
    n = F.size(values)
    return {"profile_length": n, "profile_min": F.array_min(values), "profile_max": F.array_max(values), "profile_mean": F.when(n > 0, F.aggregate(values, F.lit(0.0), lambda a, x: a + x) / n)}


LAYERS = {"gc": "gc_content", "length": "sequence_length", "perplexity": "perplexity", "norm": "embedding_norm", "entropy": "entropy", "min_token": "min_token_logprob", "token_std": "per_token_logprob_std"}
GROUPED = {"taxon_gc": "gc_content", "taxon_perplexity": "perplexity", "taxon_norm": "embedding_norm"}
RANKED = {"gc_percentile": "gc_content", "length_percentile": "sequence_length", "perplexity_percentile": "perplexity", "norm_percentile": "embedding_norm"}


def anomaly_layers(spark: SparkSession, df: DataFrame, recurrent: tuple[int, ...], group: str = "taxon") -> DataFrame:
    """Rows with z-scores against all rows and against their group (0 for groups under ``MIN_GROUP``), percentile
    ranks within the group (null there), composite scores, outlier flags and artifact penalties.

    Population statistics come from one aggregation and one exact quantile; ranks from counts per value, so that
    no group gathers in a task."""
    df = cut(spark, df, "anomaly-rows")
    stats = df.agg(*[f(c).alias(f"_{k}_{n}") for k, c in LAYERS.items() for n, f in (("mean", F.avg), ("sd", F.stddev_pop))])
    one = cut(spark, stats.crossJoin(quantiles(spark, df, "sequence_length", {"_q1": 0.25, "_q2": 0.5, "_q3": 0.75})), "anomaly-centers")
    per = df.groupBy(group).agg(F.count(F.lit(1)).alias("taxon_n"), *[f(c).alias(f"_{k}_{n}") for k, c in GROUPED.items() for n, f in (("mean", F.avg), ("sd", F.stddev_pop))])
    out = df.crossJoin(F.broadcast(one)).join(per, group)
    large = F.col("taxon_n") >= MIN_GROUP
    z = {f"{k}_z": zscore(F.col(c), F.col(f"_{k}_mean"), F.col(f"_{k}_sd")) for k, c in LAYERS.items()}
    z["length_z_robust"] = robust_iqr(F.col("sequence_length"), F.col("_q2"), F.col("_q1"), F.col("_q3"))
    z |= {f"{k}_z": F.when(large, zscore(F.col(c), F.col(f"_{k}_mean"), F.col(f"_{k}_sd"))).otherwise(0.0) for k, c in GROUPED.items()}
    out = out.withColumns(z)
    # one pass over all ranked columns in long form
    long = df.select(F.col(group).alias("_group"), *[F.col(c).cast("double").alias(name) for name, c in RANKED.items()]).unpivot("_group", list(RANKED), "_metric", "x")
    ranks = value_counts(spark, long, "x", ("_group", "_metric"))
    below = F.when(F.col("n") > 1, (F.col("upto_c") - F.col("c")) / (F.col("n") - 1)).otherwise(0.0)
    ranks = cut(spark, ranks.select("_group", "_metric", F.col("value").alias("_value"), below.alias("_below")), "anomaly-ranks")
    for name, c in RANKED.items():
        own = ranks.where(F.col("_metric") == name).drop("_metric")
        out = out.join(own, (F.col(group) == F.col("_group")) & (F.col(c).cast("double") == F.col("_value")), "left")
        out = out.withColumn(name, F.when(large, F.col("_below"))).drop("_group", "_value", "_below")
    size = {k: F.abs(F.col(k)) for k in z}
    mean = lambda *names: sum((size[f"{n}_z"] for n in names[1:]), size[f"{names[0]}_z"]) / len(names)
    edge = F.least(F.abs(F.col("argmin_position").cast("double")), F.abs(F.col("sequence_length") - F.col("argmin_position")))
    coding = F.abs(F.col("is_coding").cast("double") - 0.5) * 2
    out = out.withColumns({
        "multi_layer": mean("gc", "length", "perplexity", "norm"), "content": mean("gc", "perplexity", "norm"), "taxon_aware": mean("taxon_gc", "taxon_perplexity", "taxon_norm"),
        "multi_layer_robust": (size["gc_z"] + size["length_z_robust"] + size["perplexity_z"] + size["norm_z"]) / 4, "likelihood_signal": mean("perplexity", "min_token", "token_std"),
        "non_embedding": mean("gc", "length", "perplexity"), "cpu_signal": (size["gc_z"] + size["length_z"] + size["entropy_z"] + coding) / 4, "edge_distance": edge,
        "outlier_layers": sum(((size[f"{n}_z"] >= OUTLIER_Z).cast("int") for n in ("length", "perplexity", "norm")), (size["gc_z"] >= OUTLIER_Z).cast("int")),
        "relative_position": F.when(F.col("sequence_length") != 0, F.col("argmin_position") / F.col("sequence_length")),
    })
    gc, ppl = F.col("gc_content"), F.col("perplexity")
    out = out.withColumns({
        "edge_artifact": F.col("edge_distance") < EDGE, "low_entropy": F.col("entropy") < ENTROPY_LEAST, "extreme_gc": ~gc.between(*GC_RANGE), "perplexity_artifact": ~ppl.between(*PERPLEXITY_RANGE),
        "recurrent_dimension": F.arrays_overlap("top_dimensions", F.array(*[F.lit(i) for i in recurrent])),
    })
    penalty = F.when(F.col("edge_artifact"), EDGE_PENALTY).otherwise(1.0) * F.when(F.col("low_entropy"), ENTROPY_PENALTY).otherwise(1.0)
    return out.withColumn("bio_content", F.col("content") * penalty).drop(*[c for c in out.columns if c.startswith("_")])


def biological(scored: DataFrame) -> DataFrame:
    """Rows that no artifact explains: away from the ends, in large groups, within the usual ranges."""
    keep = ~F.col("edge_artifact") & ~F.col("low_entropy") & ~F.col("extreme_gc") & ~F.col("perplexity_artifact") & ~F.col("recurrent_dimension")
    return scored.where(keep & (F.col("taxon_n") >= MIN_GROUP))
