"""Ingest: tenant-scoped identity, manifest, skip-existing, copies, near-dups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelmart import schemas as S
from reelmart.functions import columns as C

MANIFEST_COLS = ["asset_id", "client_id", "content_sha256", "asset_name", "asset_type",
                 "parent_asset_id", "duration_sec", "source_uri", "ingested_at"]


def asset_identity(deliveries: DataFrame) -> DataFrame:
    """Per landed file: content hash and the tenant-scoped asset id."""
    return deliveries.select("doc_id", "client_id", "content_sha256", "asset_id")


def asset_manifest(manifest: DataFrame) -> DataFrame:
    """Manifest rows with the derived landing key, extension and mime type."""
    return manifest.select(*MANIFEST_COLS, "folder", "ext",
                           C.mime_type(F.col("ext")).alias("mime_type"), "landing_key")


def dedupe_deliveries(deliveries: DataFrame) -> DataFrame:
    """Repeat deliveries in one run collapse to one asset; min(doc_id) wins.

    ``min(struct)`` aggregates map-side first, so a hot asset never lands
    whole on one reducer.
    """
    cols = ["doc_id", "client_id", "content_sha256", "asset_name", "modified_at"]
    w = deliveries.groupBy("asset_id").agg(F.min(F.struct(*cols)).alias("w"),
                                           F.count(F.lit(1)).alias("n_deliveries"))
    return w.select("asset_id", *[F.col(f"w.{c}").alias(c) for c in cols], "n_deliveries")


def ingest_new_assets(deliveries: DataFrame, known: DataFrame) -> DataFrame:
    """Assets of this run that the manifest does not know yet (left anti)."""
    run = dedupe_deliveries(deliveries)
    return run.join(known.select("asset_id"), "asset_id", "left_anti") \
        .select("asset_id", "client_id", "content_sha256", "asset_name",
                F.col("doc_id").alias("winner_doc_id"), "n_deliveries")


def list_new_assets(manifest: DataFrame, bronze: DataFrame) -> DataFrame:
    """Manifest assets without a Bronze response yet (work for the extractor)."""
    return manifest.join(bronze.select("asset_id"), "asset_id", "left_anti") \
        .select("asset_id", "client_id", "source_uri",
                C.bronze_key(F.col("client_id"), F.col("asset_id")).alias("bronze_key"))


def cross_client_copies(deliveries: DataFrame) -> DataFrame:
    """Same bytes at several clients stay separate assets; report the hashes.

    Two-level count: (hash, client) first, so the distinct count is an
    ordinary partial aggregate.
    """
    per_client = deliveries.groupBy("content_sha256", "client_id") \
        .agg(F.count(F.lit(1)).alias("n"))
    return (per_client.groupBy("content_sha256")
            .agg(F.count(F.lit(1)).alias("n_clients"), F.sum("n").alias("n_deliveries"))
            .where(F.col("n_clients") > 1))


def _stem(name):
    return F.substring_index(name, "-", 1)


def near_dup_flags(manifest: DataFrame, band: int = S.NEAR_DUP_BAND_SEC) -> DataFrame:
    """Flag assets with another asset of the same client, folder and name stem
    within ``band`` seconds of duration. Linear: per (group, duration) counts,
    then a range window over duration; no pairs are built."""
    keys = ["client_id", "folder", "stem"]
    m = manifest.withColumn("stem", _stem(F.col("asset_name"))) \
        .where(F.col("duration_sec").isNotNull())
    per_d = m.groupBy(*keys, "duration_sec").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*keys).orderBy("duration_sec").rangeBetween(-band, band)
    near = per_d.withColumn("n_near", F.sum("n").over(w)) \
        .where(F.col("n_near") > 1).select(*keys, "duration_sec")
    return m.join(near, keys + ["duration_sec"], "left_semi").select("asset_id")


def dim_asset(manifest: DataFrame, band: int = S.NEAR_DUP_BAND_SEC) -> DataFrame:
    flagged = near_dup_flags(manifest, band).withColumn("dq_flag", F.lit("likely_near_dup"))
    return manifest.select(*MANIFEST_COLS).join(flagged, "asset_id", "left")


def near_dup_pairs(manifest: DataFrame, band: int = S.NEAR_DUP_BAND_SEC) -> DataFrame:
    """Near-duplicate candidates: for each asset, how many assets of the same
    client, folder and name stem lie within ``band`` seconds of duration, and
    which one is nearest (smallest gap, then shorter duration, then asset id).

    Linear: the work runs over distinct durations per group (a range window
    over per-duration counts and lag/lead for the neighbouring durations),
    never over pairs, so a hot stem with thousands of equal durations costs
    one row per duration, not one per pair.
    """
    keys = ["client_id", "folder", "stem"]
    m = (manifest.where(F.col("duration_sec").isNotNull())
         .select("asset_id", "client_id", "folder", "duration_sec",
                 _stem(F.col("asset_name")).alias("stem")))
    kd = keys + ["duration_sec"]
    per_d = m.groupBy(*kd).agg(F.count(F.lit(1)).alias("n"), F.min("asset_id").alias("a1"))
    second = (m.join(per_d.select(*kd, "a1"), kd).where(F.col("asset_id") != F.col("a1"))
              .groupBy(*kd).agg(F.min("asset_id").alias("a2")))
    band_w = Window.partitionBy(*keys).orderBy("duration_sec").rangeBetween(-band, band)
    order_w = Window.partitionBy(*keys).orderBy("duration_sec")
    per_d = (per_d.join(second, kd, "left")
             .withColumn("n_band", F.sum("n").over(band_w))
             .withColumn("prev_d", F.lag("duration_sec").over(order_w))
             .withColumn("prev_a", F.lag("a1").over(order_w))
             .withColumn("next_d", F.lead("duration_sec").over(order_w))
             .withColumn("next_a", F.lead("a1").over(order_w)))
    r = m.join(per_d, kd)
    same = F.when(F.col("asset_id") == F.col("a1"), F.col("a2")).otherwise(F.col("a1"))
    gp = F.col("duration_sec") - F.col("prev_d")
    gn = F.col("next_d") - F.col("duration_sec")
    use_prev = gp.isNotNull() & (gn.isNull() | (gp <= gn))
    nearest_a = F.when(same.isNotNull(), same).when(use_prev, F.col("prev_a")) \
        .otherwise(F.col("next_a"))
    nearest_gap = F.when(same.isNotNull(), F.lit(0)).when(use_prev, gp).otherwise(gn)
    return (r.withColumn("n_near_dups", F.col("n_band") - 1)
            .where(F.col("n_near_dups") > 0)
            .select("asset_id", "client_id", "folder", "stem", "duration_sec", "n_near_dups",
                    nearest_a.alias("nearest_asset_id"),
                    nearest_gap.cast("int").alias("nearest_gap_sec")))
