"""Landing retention: TTL plan with the golden exemption and Bronze guard,
its summary, and the frozen-asset log records.

The plan is built from a listing (path, modificationTime) - the columns of a
``binaryFile`` scan with ``content`` pruned - so no bytes are ever read.
Physical deletion is an operator's step and not done here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmart import schemas as S

LANDING_RE = r"^landing/([^/]+)/video/[^/]+$"


def relative_key(path: F.Column) -> F.Column:
    """Strip a URI prefix back to the Files-relative key."""
    marker = ".Lakehouse/Files/"
    return F.when(F.instr(path, marker) > 0, F.substring_index(path, marker, -1)).otherwise(path)


def retention_plan(listing: DataFrame, clients: DataFrame, bronze: DataFrame,
                   now: str) -> DataFrame:
    """Per landing object under a client prefix: age, TTL, Bronze presence and
    action (skip_no_mtime / within_ttl / skip_no_bronze / delete_candidate).

    Objects under ``landing/_golden/`` never match a client prefix and are
    never listed. A missing mtime is not treated as epoch 0 (which would
    expire at once); it is sent to ``skip_no_mtime``.
    """
    key = relative_key(F.col("path"))
    objs = (listing.select(key.alias("landing_key"), F.col("modificationTime").alias("mtime"))
            .where(F.col("landing_key").rlike(LANDING_RE))
            .withColumn("client_id", F.regexp_extract("landing_key", LANDING_RE, 1))
            .withColumn("asset_id", F.regexp_extract("landing_key", r"([^/]+)\.[^./]+$", 1)))
    ttl = clients.select("client_id", "landing_ttl_days")
    have = bronze.select("asset_id", "client_id").withColumn("bronze_present", F.lit(True))
    age = F.floor((F.unix_seconds(F.lit(now).cast("timestamp")) - F.unix_seconds(F.col("mtime")))
                  / 86400).cast("bigint")
    p = (objs.join(ttl, "client_id")
         .join(have, ["asset_id", "client_id"], "left")
         .withColumn("bronze_present", F.coalesce("bronze_present", F.lit(False)))
         .withColumn("age_days", age))
    action = (F.when(F.col("mtime").isNull(), "skip_no_mtime")
              .when(F.col("age_days") < F.col("landing_ttl_days"), "within_ttl")
              .when(~F.col("bronze_present"), "skip_no_bronze")
              .otherwise("delete_candidate"))
    return p.select("landing_key", "client_id", "asset_id", "age_days", "landing_ttl_days",
                    "bronze_present", action.alias("action"))


def retention_summary(plan: DataFrame) -> DataFrame:
    return plan.groupBy("action").agg(F.count(F.lit(1)).alias("n_objects"))


def frozen_log(plan: DataFrame, now_iso: str) -> DataFrame:
    """One JSON record per expired asset with Bronze: the asset is now frozen
    at its last extraction."""
    d = plan.where(F.col("action") == "delete_candidate")
    rec = F.to_json(F.struct(
        F.lit("landing_ttl_delete").alias("event"), "asset_id", "client_id",
        F.col("landing_key").alias("deleted_key"), "age_days",
        F.lit(now_iso).alias("deleted_at"), F.lit(S.FROZEN_CONSEQUENCE).alias("consequence")))
    log_key = F.concat(F.lit("bronze/"), F.col("client_id"), F.lit("/ttl_delete_log/"),
                       F.col("asset_id"), F.lit("_" + now_iso + ".json"))
    return d.select("asset_id", "client_id", log_key.alias("log_key"), rec.alias("record"))
