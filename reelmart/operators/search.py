"""Clip search: theme / sentiment / score / text filters, keyword tags,
provenance, and store profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmart import schemas as S
from reelmart.functions import columns as C


def search_clips(chunks: DataFrame, assets: DataFrame, theme: str | None = None,
                 sentiment: str | None = None, min_score: int | None = None,
                 contains: str | None = None, client_id: str | None = None) -> DataFrame:
    """Reusable clips by theme, sentiment, score and free text, safest first.

    Equality filters are applied on the chunk side before the join so they
    reach the scan; the text test is a literal, case-insensitive substring.
    Client scoping filters the asset side and, when the chunk frame carries
    the tenant (stored Silver does), prunes the chunk scan to that partition.
    """
    c = chunks
    if theme is not None:
        c = c.where(F.col("chunk_theme") == theme)
    if sentiment is not None:
        c = c.where(F.col("sentiment") == sentiment)
    if min_score is not None:
        c = c.where(F.col("standalone_score") >= min_score)
    if contains is not None:
        c = c.where(C.contains_ci(F.col("transcript_segment"), contains))
    a = assets.select("asset_id", "asset_name", "client_id")
    if client_id is not None:
        a = a.where(F.col("client_id") == client_id)
        if "client_id" in c.columns:
            # Silver is partitioned by client: scope the chunk side too, so the
            # scan reads one client's partition instead of all of them
            c = c.where(F.col("client_id") == client_id)
    if "client_id" in c.columns:
        c = c.drop("client_id")
    return (c.join(a, "asset_id")
            .select("chunk_id", "asset_id", "client_id", "asset_name", "start_sec", "end_sec",
                    "standalone_score", "chunk_theme", "sentiment", "transcript_segment")
            .orderBy(F.col("standalone_score").desc(), "start_sec", "chunk_id"))


def search_keyword(wide: DataFrame, keyword: str) -> DataFrame:
    """Clips tagged with ``keyword``: a filter on Silver's array column."""
    return wide.where(F.array_contains("keywords", keyword.lower())) \
        .select("chunk_id", "asset_id", "chunk_theme", "standalone_score")


def clip_provenance(chunks: DataFrame, assets: DataFrame) -> DataFrame:
    """Clip -> its asset -> the asset's lineage parent (if any). Parents are
    looked up by asset, and only by assets that have one: chunks are joined
    once, by their asset, and no key is missing in a join."""
    a = assets.select("asset_id", "client_id", "asset_name", "asset_type", "parent_asset_id")
    p = assets.select(F.col("asset_id").alias("parent_asset_id"),
                      F.col("asset_name").alias("parent_asset_name"),
                      F.col("asset_type").alias("parent_asset_type"))
    child = F.col("parent_asset_id").isNotNull()
    roots = a.where(~child).select("*", F.lit(None).cast("string").alias("parent_asset_name"),
                                   F.lit(None).cast("string").alias("parent_asset_type"))
    known = a.where(child).join(p, "parent_asset_id", "left").unionByName(roots)
    return (chunks.select("chunk_id", "asset_id", "chunk_sequence").join(known, "asset_id")
            .select("chunk_id", "asset_id", "chunk_sequence", "client_id", "asset_name",
                    "asset_type", "parent_asset_id", "parent_asset_name", "parent_asset_type"))


def asset_duration(chunks: DataFrame) -> DataFrame:
    return chunks.groupBy("asset_id").agg(F.max("end_sec").alias("duration_from_chunks"),
                                          F.count(F.lit(1)).alias("n_chunks"))


def reusable_inventory(chunks: DataFrame, assets: DataFrame) -> DataFrame:
    """Share of chunks safe to reuse (score >= 4), per client."""
    ok = (F.col("standalone_score") >= S.REUSABLE_SCORE).cast("int")
    return (chunks.join(assets.select("asset_id", "client_id"), "asset_id")
            .groupBy("client_id")
            .agg(F.count(F.lit(1)).alias("n_chunks"), F.sum(ok).alias("n_reusable"))
            .withColumn("reusable_share", C.r6(C.safe_ratio("n_reusable", "n_chunks"))))


def store_profile(chunks: DataFrame, assets: DataFrame) -> DataFrame:
    """Asset mix and chunk-per-asset spread, per client."""
    per_asset = chunks.groupBy("asset_id").agg(F.count(F.lit(1)).alias("k"))
    a = assets.select("asset_id", "client_id", "asset_type").join(per_asset, "asset_id", "left")
    return a.groupBy("client_id").agg(
        F.count(F.lit(1)).alias("n_assets"),
        F.count_if(F.col("asset_type") == "RAW").alias("n_raw"),
        F.count_if(F.col("asset_type") == "EDITED").alias("n_edited"),
        F.count("k").alias("n_assets_with_chunks"),
        F.coalesce(F.sum("k"), F.lit(0)).cast("bigint").alias("n_chunks"),
        F.min("k").alias("min_chunks_per_asset"),
        F.max("k").alias("max_chunks_per_asset"))
