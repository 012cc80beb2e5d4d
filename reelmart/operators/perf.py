"""Ad performance: conform platform exports, keep the latest pull, the daily
fact, lifetime KPIs (ratio of sums) and target flags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmart import schemas as S
from reelmart.functions import columns as C

CANONICAL = ["ad_id", "perf_date", "impressions", "plays_3s", "plays_25", "plays_50",
             "plays_75", "plays_100", "sum_watch_time_sec", "play_count", "link_clicks",
             "results", "spend"]
COUNTS = CANONICAL[2:]


def conform_meta(raw: DataFrame) -> DataFrame:
    """Meta export -> canonical columns. Watch time is rebuilt as average x
    plays when only the average exists; results sum purchase/lead actions."""
    results = F.aggregate(
        F.filter("actions", lambda a: a["action_type"].isin(*S.RESULT_ACTIONS)),
        F.lit(0).cast("bigint"), lambda acc, a: acc + a["value"].cast("bigint"))
    watch = F.coalesce(F.col("video_total_time_watched").cast("double"),
                       F.col("video_avg_time_watched_actions") * F.col("video_play_actions"))
    return raw.select(
        "ad_id", F.col("date").alias("perf_date"), "impressions",
        F.col("video_3_sec_watched_actions").alias("plays_3s"),
        F.col("video_p25_watched_actions").alias("plays_25"),
        F.col("video_p50_watched_actions").alias("plays_50"),
        F.col("video_p75_watched_actions").alias("plays_75"),
        F.col("video_p100_watched_actions").alias("plays_100"),
        F.floor(watch).cast("bigint").alias("sum_watch_time_sec"),
        F.col("video_play_actions").alias("play_count"),
        F.col("inline_link_clicks").alias("link_clicks"),
        results.alias("results"), "spend", "load_ts",
        F.lit("meta").alias("platform_name"))


def conform_tiktok(raw: DataFrame) -> DataFrame:
    return raw.select(
        "ad_id", F.col("stat_time_day").alias("perf_date"), "impressions",
        F.col("video_views_p_3s").alias("plays_3s"),
        F.col("video_views_p25").alias("plays_25"),
        F.col("video_views_p50").alias("plays_50"),
        F.col("video_views_p75").alias("plays_75"),
        F.col("video_views_p100").alias("plays_100"),
        F.col("total_watch_time").alias("sum_watch_time_sec"),
        F.col("video_views").alias("play_count"),
        F.col("clicks_destination").alias("link_clicks"),
        F.col("conversions").alias("results"), "spend", "load_ts",
        F.lit("tiktok").alias("platform_name"))


def ad_perf_unioned(meta_raw: DataFrame, tiktok_raw: DataFrame) -> DataFrame:
    """Conform each platform, keep only rows tagged with that platform, union
    by name."""
    m = conform_meta(meta_raw.where(F.col("platform_native") == "meta"))
    t = conform_tiktok(tiktok_raw.where(F.col("platform_native") == "tiktok"))
    return m.unionByName(t)


def latest_pull(unioned: DataFrame) -> DataFrame:
    """Restated days: last write wins per (ad, platform, day) on load_ts.

    ``max`` of a struct is a partial aggregate: each map task keeps one row per
    key, so restatements never pile up on a reducer. Ties on load_ts (the same
    pull delivered twice) resolve on the row's own values, so the winner never
    depends on task order; the row travels once, as its own order.
    """
    keys = ["ad_id", "platform_name", "perf_date"]
    rest = [c for c in unioned.columns if c not in keys]
    order = ["load_ts", *[c for c in rest if c != "load_ts"]]
    w = unioned.groupBy(*keys).agg(F.max(F.struct(*order)).alias("w"))
    return w.select(*keys, *[F.col(f"w.{c}").alias(c) for c in rest])


def fact_ad_performance(latest: DataFrame, platforms: DataFrame, ad_map: DataFrame) -> DataFrame:
    """Ad x platform x day counts with the mapped EDITED asset.

    The platform table is a literal seed (two rows), so broadcasting it is
    safe by construction; the ad map grows with ads and is left to AQE.
    """
    return (latest.join(F.broadcast(platforms.select("platform_id", "platform_name")),
                        "platform_name")
            .join(ad_map, "ad_id")
            .select("ad_id", "platform_id", "perf_date", "asset_id", *COUNTS))


def ad_kpi(fact: DataFrame, digits: int | None = None) -> DataFrame:
    """Lifetime ratios per (ad, platform): sum the counts first, then divide.

    Ratios stay at full precision for downstream medians; ``digits`` rounds
    them for display only.
    """
    s = fact.groupBy("ad_id", "platform_id").agg(*[F.sum(c).alias(c) for c in COUNTS])

    def r(n, d):
        x = C.safe_ratio(n, d)
        return F.round(x, digits) if digits is not None else x
    return s.select(
        "ad_id", "platform_id",
        r("plays_3s", "impressions").alias("hook_rate"),
        r("plays_25", "plays_3s").alias("hold_rate_25"),
        r("plays_50", "plays_3s").alias("hold_rate_50"),
        r("plays_75", "plays_3s").alias("retention_75"),
        r("plays_100", "plays_3s").alias("retention_100"),
        r("sum_watch_time_sec", "play_count").alias("avg_play_time_sec"),
        r("link_clicks", "impressions").alias("ctr_link"),
        r("spend", "results").alias("cpa"),
        r("results", "link_clicks").alias("cvr"))


def kpi_targets(kpi: DataFrame) -> DataFrame:
    """Target flags; a NULL ratio gives a NULL flag (unknown, not failed)."""
    return kpi.select(
        "ad_id", "platform_id",
        (F.col("hook_rate") >= S.TARGET_HOOK_RATE).alias("hook_ok"),
        (F.col("avg_play_time_sec") >= S.TARGET_AVG_PLAY_SEC).alias("play_time_ok"),
        (F.col("ctr_link") >= S.TARGET_CTR_LINK).alias("ctr_ok"),
        F.col("cvr").between(S.TARGET_CVR_LOW, S.TARGET_CVR_HIGH).alias("cvr_ok"))


def bridge_ad_chunk(edl: DataFrame, chunks: DataFrame) -> DataFrame:
    """Editor's cut resolved to chunks; unmatched EDL rows drop (see reconcile)."""
    return edl.join(chunks.select("chunk_id", "asset_id"), "chunk_id").select(
        "ad_id", "chunk_id", "asset_id", "chunk_role", "position_in_ad", "start_sec", "end_sec")
