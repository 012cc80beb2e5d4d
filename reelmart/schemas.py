"""Fixed schemas and fixed values of the clip store.

Everything below marked FIXED VALUES must stay equal to the source system's
contract for results to agree; it is stated once, here, in natural order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------- FIXED VALUES
# Sentiment enum of the extraction contract, in contract order.
SENTIMENTS = ["energetic", "frustrated", "aspirational", "neutral", "urgent", "calm"]
# Chunk roles of an editor's cut.
CHUNK_ROLES = ["hook", "body", "social_proof", "cta"]
# Asset types.
ASSET_TYPES = ["RAW", "EDITED"]
# Platforms.
PLATFORMS = ["meta", "tiktok"]
# Evidence regimes of the correlation mart.
EVIDENCE_REGIMES = ["BLOCK", "DIRECTIONAL", "SUGGESTIVE"]
# Client status values.
CLIENT_STATUS = ["active", "paused", "offboarded"]
# Fields every chunk of a response must carry.
REQUIRED_CHUNK_KEYS = ["start_sec", "end_sec", "transcript_segment", "chunk_theme",
                       "sentiment", "standalone_score"]
# Placeholder client ids that must never reach lineage.
PLACEHOLDER_CLIENTS = ["", "demo_client", "test", "tbd", "todo", "unknown", "client", "na", "none"]
# Folder words that mark an edited cut (case-insensitive substring).
EDITED_FOLDER_PATTERN = "edited|winning|winners"
# Default extension when a landed name has none.
DEFAULT_EXTENSION = ".mp4"
# Mime type by extension; anything else is video/mp4.
MIME_BY_EXT = {".mp4": "video/mp4", ".mov": "video/quicktime", ".webm": "video/webm",
               ".avi": "video/x-msvideo"}
# Landing URI grammar: scheme://<workspace>@<host>/<lakehouse>.Lakehouse/Files/<key>
URI_HOST = "onelake.dfs.fabric.microsoft.com"
URI_PATTERN = (r"^abfss://([^@]+)@onelake\.dfs\.fabric\.microsoft\.com/"
               r"([^/]+)\.Lakehouse/Files/landing/([^/]+)/video/([0-9a-f]{64})\.\w+$")
HEX64_PATTERN = r"^[0-9a-f]{64}$"
GOLDEN_PREFIX = "landing/_golden/"
# Honesty note carried on every mart row (plain hyphen form of the SQL view).
HONESTY_NOTE = "Among winning ads only - within-platform ranking, correlation not causation"
# Evidence thresholds: n < 5 BLOCK, n < 12 DIRECTIONAL, else SUGGESTIVE.
BLOCK_BELOW = 5
DIRECTIONAL_BELOW = 12
# Metric anchors: hook at the platform hook window; the rest at a share of duration.
DURATION_METRICS = [("hold_rate_25", 0.25), ("hold_rate_50", 0.50),
                    ("retention_75", 0.75), ("retention_100", 1.00)]
# KPI targets.
TARGET_HOOK_RATE = 0.25
TARGET_AVG_PLAY_SEC = 5.0
TARGET_CTR_LINK = 0.01
TARGET_CVR_LOW, TARGET_CVR_HIGH = 0.01, 0.03
# Reuse threshold for mix-and-match and mining.
REUSABLE_SCORE = 4
# Promotion threshold of the constraint pass rate.
PROMOTE_PASS_RATE = 0.95
# Golden gate: Jaccard agreement and score tolerance.
GOLDEN_MIN_JACCARD = 0.80
GOLDEN_SCORE_TOLERANCE = 1
# Near-duplicate duration band, seconds.
NEAR_DUP_BAND_SEC = 5
# Platform seed rows: platform_id, platform_name, hook_window_sec, hold_milestones.
PLATFORM_SEED = [("meta", "meta", 3, "25,50,75,100"),
                 ("tiktok", "tiktok", 6, "25,50,75,100")]
# Action types counted as results.
RESULT_ACTIONS = ["purchase", "lead"]
# Frozen-asset consequence text.
FROZEN_CONSEQUENCE = ("FROZEN - re-extraction permanently impossible; "
                      "re-parse from Bronze survives")
# ------------------------------------------------------------ end FIXED VALUES

# Chunk envelope as the extractor promises it. The score is read as a string
# so that 4, 4.0 and "4" all survive parsing (a strict INT field turns 4.0
# into NULL silently); it is typed later with try_cast.
CHUNK_LENIENT = T.StructType([
    T.StructField("start_sec", T.DoubleType()),
    T.StructField("end_sec", T.DoubleType()),
    T.StructField("transcript_segment", T.StringType()),
    T.StructField("chunk_theme", T.StringType()),
    T.StructField("sentiment", T.StringType()),
    T.StructField("standalone_score", T.StringType()),
    T.StructField("next_compatible_themes", T.ArrayType(T.StringType())),
    T.StructField("keywords", T.ArrayType(T.StringType())),
])
ENVELOPE_LENIENT = T.StructType([T.StructField("chunks", T.ArrayType(CHUNK_LENIENT))])

BRONZE_ASSET_RAW = T.StructType([
    T.StructField("asset_id", T.StringType()),
    T.StructField("client_id", T.StringType()),
    T.StructField("raw_response", T.StringType()),
    T.StructField("model_version", T.StringType()),
    T.StructField("prompt_version", T.StringType()),
    T.StructField("content_sha256", T.StringType()),
    T.StructField("chunk_count", T.IntegerType()),
    T.StructField("load_ts", T.TimestampType()),
])

RUN_LOG = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("asset_id", T.StringType()),
    T.StructField("model_version", T.StringType()),
    T.StructField("prompt_version", T.StringType()),
    T.StructField("tokens_in", T.LongType()),
    T.StructField("tokens_out", T.LongType()),
    T.StructField("processing_time_sec", T.DoubleType()),
    T.StructField("retry_count", T.IntegerType()),
    T.StructField("extraction_confidence", T.DoubleType()),
    T.StructField("load_ts", T.TimestampType()),
])

# Seed CSV schemas (explicit: header-only seeds would otherwise type every
# column as string).
SEED_SCHEMAS = {
    "dim_client": "client_id STRING, client_name STRING, account_support_owner STRING, "
                  "drive_folder_id STRING, landing_ttl_days INT, status STRING",
    "dim_platform": "platform_id STRING, platform_name STRING, hook_window_sec INT, "
                    "hold_milestones STRING",
    "asset_manifest": "asset_id STRING, client_id STRING, content_sha256 STRING, "
                      "asset_name STRING, asset_type STRING, parent_asset_id STRING, "
                      "duration_sec INT, source_uri STRING, ingested_at TIMESTAMP",
    "map_ad_asset": "ad_id STRING, asset_id STRING",
    "edit_decision_list": "ad_id STRING, chunk_id STRING, chunk_role STRING, "
                          "position_in_ad INT, start_sec DOUBLE, end_sec DOUBLE",
}
