"""The sample-gated correlation mart and the questions asked of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelmart import schemas as S
from reelmart.functions import columns as C
from reelmart.functions.ranks import exact_median

FEATURE_DIMS = ["chunk_theme", "sentiment", "chunk_role"]


def mart_base(metric_chunk: DataFrame) -> DataFrame:
    """Unpivot the three feature dimensions; one row per (ad, metric, dim)."""
    dims = F.explode(F.array(*[F.struct(F.lit(d).alias("feature_dim"),
                                        F.col(d).alias("feature_value"))
                               for d in FEATURE_DIMS]))
    return (metric_chunk.where(F.col("metric_value").isNotNull())
            .select("platform_id", "metric_name", "ad_id", "metric_value", "standalone_score",
                    dims.alias("f"))
            .select("platform_id", "metric_name", F.col("f.feature_dim").alias("feature_dim"),
                    F.col("f.feature_value").alias("feature_value"), "ad_id", "metric_value",
                    "standalone_score"))


def evidence_regime(n: F.Column) -> F.Column:
    return (F.when(n < S.BLOCK_BELOW, "BLOCK").when(n < S.DIRECTIONAL_BELOW, "DIRECTIONAL")
            .otherwise("SUGGESTIVE"))


def chunk_perf_correlation(metric_chunk: DataFrame, approx_median: bool = False) -> DataFrame:
    """Per platform x metric x feature: n_ads, median/mean/min/max, rank within
    (platform, metric, dimension) by median, evidence regime, honesty note.

    The exact median comes from two-level order statistics
    (``exact_median``): no group is sorted on one task or held whole in one
    aggregation buffer, so a feature value holding most ads stays parallel.
    Each (ad, platform, metric) has exactly one row (guarded by the
    expectations report), so count(*) equals count(distinct ad_id) without
    the extra distinct shuffle. ``approx_median`` trades exactness for one
    fewer pass.
    """
    keys = ["platform_id", "metric_name", "feature_dim", "feature_value"]
    base = mart_base(metric_chunk)
    aggs = [F.count(F.lit(1)).alias("n_ads"), F.avg("metric_value").alias("mean_raw"),
            F.min("metric_value").alias("min_metric"), F.max("metric_value").alias("max_metric")]
    if approx_median:
        aggs.append(F.percentile_approx("metric_value", 0.5, 10000).alias("median_raw"))
    g = base.groupBy(*keys).agg(*aggs)
    if not approx_median:
        g = g.join(exact_median(base, keys, "metric_value")
                   .withColumnRenamed("median", "median_raw"), keys)
    w = Window.partitionBy("platform_id", "metric_name", "feature_dim") \
        .orderBy(F.col("median_raw").desc())
    return g.select(
        "platform_id", "metric_name", "feature_dim", "feature_value", "n_ads",
        C.r6(F.col("median_raw")).alias("median_metric"), C.r6(F.col("mean_raw")).alias("mean_metric"),
        C.r6(F.col("min_metric")).alias("min_metric"), C.r6(F.col("max_metric")).alias("max_metric"),
        F.rank().over(w).alias("rank_in_platform"),
        evidence_regime(F.col("n_ads")).alias("evidence_regime"),
        F.lit(S.HONESTY_NOTE).alias("honesty_note"))


def surfaced(mart: DataFrame) -> DataFrame:
    """Only non-BLOCK rows are ever surfaced."""
    return mart.where(F.col("evidence_regime") != "BLOCK")


def winning_hook_themes(mart: DataFrame) -> DataFrame:
    return (surfaced(mart)
            .where((F.col("metric_name") == "hook_rate") & (F.col("feature_dim") == "chunk_theme"))
            .select("platform_id", F.col("feature_value").alias("hook_theme"), "n_ads",
                    F.round("median_metric", 3).alias("median_hook_rate"), "rank_in_platform",
                    "evidence_regime", "honesty_note")
            .orderBy("platform_id", F.col("median_hook_rate").desc(), "hook_theme"))


def cta_sentiment(mart: DataFrame) -> DataFrame:
    return (surfaced(mart)
            .where((F.col("metric_name") == "ctr_link") & (F.col("feature_dim") == "sentiment"))
            .select("platform_id", F.col("feature_value").alias("cta_sentiment"), "n_ads",
                    F.round("median_metric", 4).alias("median_ctr_link"), "evidence_regime")
            .orderBy("platform_id", F.col("median_ctr_link").desc(), "cta_sentiment"))


def winning_themes(mart: DataFrame, top: int = 3) -> DataFrame:
    return (surfaced(mart)
            .where((F.col("metric_name") == "hook_rate") & (F.col("feature_dim") == "chunk_theme")
                   & (F.col("rank_in_platform") <= top))
            .select(F.col("feature_value").alias("chunk_theme")).distinct())


def mine_library(mart: DataFrame, chunks: DataFrame, assets: DataFrame,
                 bridge: DataFrame) -> DataFrame:
    """Unused RAW reusable clips whose theme ranks top-3 for hook rate.

    IN becomes a semi join and NOT IN an anti join (a NOT IN subquery would
    plan a null-aware, broadcast-only anti join and return nothing if the
    list held a NULL).
    """
    raw = assets.where(F.col("asset_type") == "RAW").select("asset_id")
    return (chunks.where(F.col("standalone_score") >= S.REUSABLE_SCORE)
            .join(raw, "asset_id", "left_semi")
            .join(winning_themes(mart), "chunk_theme", "left_semi")
            .join(bridge.select("chunk_id"), "chunk_id", "left_anti")
            .select("chunk_id", "asset_id", "chunk_theme", "standalone_score",
                    "transcript_segment")
            .orderBy(F.col("standalone_score").desc(), "chunk_id"))


def mine_lineage(bridge: DataFrame, assets: DataFrame, chunks: DataFrame) -> DataFrame:
    """ad -> chunk -> edited asset -> raw parent -> candidate pool. Carries no
    metric. Ads are counted per raw parent before the pool join, so the
    output is one row per candidate chunk, not ads x chunks."""
    edited = assets.where(F.col("asset_type") == "EDITED") \
        .select("asset_id", F.col("parent_asset_id").alias("raw_parent_id")) \
        .where(F.col("raw_parent_id").isNotNull())
    parents = (bridge.select("ad_id", "asset_id").distinct().join(edited, "asset_id")
               .groupBy("raw_parent_id").agg(F.countDistinct("ad_id").alias("n_ads_via_lineage")))
    pool = chunks.where(F.col("standalone_score") >= S.REUSABLE_SCORE) \
        .select(F.col("asset_id").alias("raw_parent_id"), "chunk_id", "chunk_theme",
                "standalone_score")
    return pool.join(parents, "raw_parent_id").select(
        "raw_parent_id", "chunk_id", "chunk_theme", "standalone_score", "n_ads_via_lineage")


def cross_platform_agreement(mart: DataFrame, top: int = 3) -> DataFrame:
    """Feature values in the top-3 of every platform (ranks only, no pooling)."""
    n_platforms = len(S.PLATFORMS)
    return (surfaced(mart).where((F.col("feature_dim") == "chunk_theme")
                                 & (F.col("rank_in_platform") <= top))
            .groupBy("metric_name", "feature_value")
            .agg(F.count(F.lit(1)).alias("n_platforms"),
                 F.max("rank_in_platform").alias("worst_rank"))
            .withColumn("agrees", F.col("n_platforms") == n_platforms))
