"""Asset lineage: parent edges, and each asset's root by pointer doubling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmart.sources.scratch import cut_lineage


def lineage_edges(assets: DataFrame) -> DataFrame:
    """RAW/EDITED -> EDITED edges; navigation only, never carries metrics."""
    return assets.where(F.col("parent_asset_id").isNotNull()) \
        .select("parent_asset_id", F.col("asset_id").alias("child_asset_id"))


def lineage_roots(assets: DataFrame) -> DataFrame:
    """(asset_id, root_asset_id, depth): one row per asset, chains of any depth.

    Every asset points to its parent (a root to itself). A round replaces each
    pointer by its target's pointer and adds up the depths, so a chain of n
    assets is resolved in log2(n) rounds; the output stays one row per asset.
    A parent outside ``assets`` counts as the root. Cycles are an error.
    """
    up = F.coalesce("parent_asset_id", "asset_id")
    table = cut_lineage(assets.select(
        "asset_id", up.alias("root_asset_id"),
        F.when(F.col("parent_asset_id").isNull(), 0).otherwise(1).cast("bigint").alias("depth")))
    rounds = max(1, table.count()).bit_length() + 1
    reached = None
    for _ in range(rounds):
        to = table.select(F.col("asset_id").alias("at"), F.col("root_asset_id").alias("next"),
                          F.col("depth").alias("more"))
        table = cut_lineage(
            table.join(to, table["root_asset_id"] == to["at"], "left")
            .select("asset_id", F.coalesce("next", "root_asset_id").alias("root_asset_id"),
                    (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")))
        total = table.agg(F.sum("depth")).first()[0]
        if total == reached:
            return table
        reached = total
    raise ValueError("asset lineage has a cycle")
