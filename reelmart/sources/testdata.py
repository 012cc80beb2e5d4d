"""Binding of the driver's parquet tables to the clip store's input shapes.

The store's real inputs are landed videos, model responses and platform
exports. Here they are derived, deterministically and with Spark only, from
the given tables (documents, lineitem, part, events), so every job's work
grows with the data. Rules are the contract in FIXTURES.md section B.

Every frame is lazy; the ``Lake`` memoises frames per session so one query
plan reuses the same sub-plans (Spark dedupes identical scans per job).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelmart import schemas as S
from reelmart.functions import columns as C
from reelmart.functions.ranks import previous_in_group
from reelmart.sources.scratch import cut_lineage
from reelmart.sources.store import LayerStore

# ---------------------------------------------------------------- FIXED VALUES
# Binding parameters of the test-data contract (FIXTURES.md section B).
THEMES = ["Hook", "Problem", "Solution", "Social Proof", "CTA"]
FOLDERS = ["Edited_Video", "WINNING", "raw_video", "misc"]
WORKSPACE, LAKEHOUSE = "creative-ws", "creative_lh"
LANDING_EPOCH = "2024-01-01"
RETENTION_NOW = "2024-02-15 00:00:00"
PRIOR_RUN_CUTOFF = "2024-02-01 00:00:00"
MODEL_V1, PROMPT_V1 = "model-a1", "p1"
MODEL_V2, PROMPT_V2 = "model-a2", "p2"
# micro-dollars per 1,000 tokens, by model version: (input, output)
PRICE_TABLE = [("m0", 75, 300), ("m1", 150, 600), ("m2", 1250, 5000)]
# ------------------------------------------------------------ end FIXED VALUES
#: ids that may be broadcast; beyond that the join is a shuffle
BROADCAST_IDS = 1_000_000


def stored_layer(partition_by: list[str] | None = None, cluster_by: list[str] | None = None,
                 rebalance: bool = False):
    """Make a Lake method a stored layer: built once, written, read back."""
    def deco(fn):
        def get(self):
            return self.store.table(fn.__name__, lambda: fn(self), partition_by, cluster_by, rebalance)
        get.__doc__ = fn.__doc__
        return property(get)
    return deco


def _pick(values: list[str], idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


class Lake:
    """Reference-shaped frames derived from ``sf_dir``'s parquet tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    @cached_property
    def store(self) -> LayerStore:
        return LayerStore(self.spark, "layers")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # ------------------------------------------------------------ text leg
    @cached_property
    def deliveries(self) -> DataFrame:
        """One landed file per document: the raw input of ingest."""
        d = self.table("documents").select("doc_id", "text", "lang", "source", "n_chars")
        doc = F.col("doc_id")
        name = F.concat(F.col("lang"), F.lit("-"), doc.cast("string"),
                        F.when(doc % 5 == 0, F.lit("")).otherwise(F.lit(".mov")))
        folder = _pick(FOLDERS, doc % 4)
        modified = F.date_add(F.lit(LANDING_EPOCH).cast("date"), (doc % 60).cast("int")) \
            .cast("timestamp")
        return (d
                .withColumn("client_id", F.col("source"))
                .withColumn("content_sha256", F.sha2(F.col("text"), 256))
                .withColumn("asset_id", C.asset_identity(F.col("client_id"),
                                                         F.col("content_sha256")))
                .withColumn("asset_name", name)
                .withColumn("folder", folder)
                .withColumn("duration_ms",
                            F.when(doc % 50 == 0, F.lit(None).cast("bigint"))
                            .otherwise(F.col("n_chars") * 67))
                .withColumn("modified_at", modified))

    @stored_layer()
    def dim_client(self) -> DataFrame:
        """Tenants: one per document source. TTL 10/20/30 days by source number."""
        num = F.regexp_extract(F.col("client_id"), r"(\d+)$", 1).try_cast("int")
        return (self.table("documents").select(F.col("source").alias("client_id")).distinct()
                .select("client_id",
                        F.col("client_id").alias("client_name"),
                        F.lit(None).cast("string").alias("account_support_owner"),
                        F.lit(None).cast("string").alias("drive_folder_id"),
                        (F.lit(10) + F.lit(10) * (num % 3)).cast("int").alias("landing_ttl_days"),
                        F.lit("active").alias("status")))

    @stored_layer(cluster_by=["asset_id"], rebalance=True)
    def landed_assets(self) -> DataFrame:
        """Deliveries collapsed to assets; the earliest delivery (min doc_id) wins.

        Only (asset_id, doc_id) is aggregated; the few losing deliveries are
        then taken out of the scan, so the text is neither sorted nor grouped.
        """
        keep = ["doc_id", "text", "lang", "client_id", "content_sha256", "asset_name", "folder",
                "duration_ms", "modified_at", "n_chars"]
        ids = self.deliveries.select("asset_id", "doc_id")
        first = ids.groupBy("asset_id").agg(F.min("doc_id").alias("first"),
                                            F.count(F.lit(1)).alias("n")).where("n > 1")
        losers = cut_lineage(ids.join(first.select("asset_id", "first"), "asset_id")
                             .where(F.col("doc_id") > F.col("first")).select("doc_id"))
        if losers.count() <= BROADCAST_IDS:
            losers = F.broadcast(losers)
        return (self.deliveries.join(losers, "doc_id", "left_anti")
                .select("asset_id", *keep))

    @stored_layer()
    def manifest(self) -> DataFrame:
        """Asset manifest (one row per asset), with lineage parents for EDITED."""
        a = self.landed_assets.drop("text")   # bytes stay in the landing layer
        ext = C.extension(F.col("asset_name"))
        key = C.landing_key(F.col("client_id"), F.col("asset_id"), ext)
        m = (a.withColumn("asset_type", C.asset_type_from_folder(F.col("folder")))
             .withColumn("duration_sec", C.whole_seconds_from_ms(F.col("duration_ms")))
             .withColumn("ext", ext)
             .withColumn("landing_key", key)
             .withColumn("source_uri", C.source_uri(WORKSPACE, LAKEHOUSE, key))
             .withColumn("ingested_at", F.col("modified_at")))
        # previous asset of the same client and language (skew-safe lag)
        m = previous_in_group(m, ["client_id", "lang"], "doc_id", "asset_id")
        return m.withColumn("parent_asset_id",
                            F.when(F.col("asset_type") == "EDITED", F.col("_prev"))).drop("_prev")

    @staticmethod
    def _chunk_struct(doc: Column, seq: Column, line: Column, score_shift: Column | None = None
                      ) -> Column:
        idx = (doc + seq) % 5
        ln = F.length(line)
        score = (ln % 5 + 1).cast("int")
        if score_shift is not None:
            score = score + score_shift
        compat = F.when(ln % 11 == 0, F.array().cast("array<string>")) \
            .otherwise(F.array(_pick(THEMES, (idx + 1) % 5), _pick(THEMES, (idx + 2) % 5)))
        words = F.filter(F.split(F.lower(line), " "), lambda w: F.length(w) >= 8)
        return F.struct(
            ((seq - 1) * 5).cast("double").alias("start_sec"),
            (seq * 5).cast("double").alias("end_sec"),
            line.alias("transcript_segment"),
            _pick(THEMES, idx).alias("chunk_theme"),
            _pick(S.SENTIMENTS, ln % 6).alias("sentiment"),
            score.alias("standalone_score"),
            compat.alias("next_compatible_themes"),
            F.array_distinct(words).alias("keywords"),
        )

    def _responses(self, run: int) -> DataFrame:
        """Model responses as verbatim JSON, one row per asset.

        run 1 is the clean extraction; run 2 re-extracts the same assets
        (score + 1 on every 7th chunk, every 11th chunk missing).
        """
        kept = F.filter(F.transform(F.split(F.col("text"), "\n"), lambda x: F.trim(x)),
                        lambda x: x != "")
        if run == 1:
            chunks = F.transform(kept, lambda x, i: self._chunk_struct(
                F.col("doc_id"), i + 1, x))
        else:
            tagged = F.transform(kept, lambda x, i: self._chunk_struct(
                F.col("doc_id"), i + 1, x,
                F.when((i + 1) % 7 == 0, F.lit(1)).otherwise(F.lit(0))))
            chunks = F.filter(tagged, lambda c, i: (i + 1) % 11 != 0)
        model, prompt = (MODEL_V1, PROMPT_V1) if run == 1 else (MODEL_V2, PROMPT_V2)
        return (self.landed_assets
                .select("asset_id", "client_id", "content_sha256", "doc_id",
                        F.to_json(F.struct(chunks.alias("chunks"))).alias("raw_response"),
                        F.lit(model).alias("model_version"),
                        F.lit(prompt).alias("prompt_version"),
                        F.size(chunks).cast("int").alias("chunk_count"),
                        (F.col("modified_at") + F.expr(f"INTERVAL {run} DAYS"))
                        .alias("load_ts")))

    @stored_layer(partition_by=["client_id"], cluster_by=["asset_id"])
    def bronze(self) -> DataFrame:
        """Clean Bronze (run 1): the input of Silver."""
        return self._responses(1).drop("doc_id")

    @cached_property
    def extracted_so_far(self) -> DataFrame:
        """(asset_id, client_id) with a response at the time of an unfinished
        run: the state that listing new assets and the TTL plan are about."""
        return self.manifest.where(F.col("doc_id") % 13 != 0).select("asset_id", "client_id")

    @cached_property
    def bronze_run2(self) -> DataFrame:
        return self._responses(2).drop("doc_id")

    @stored_layer(partition_by=["client_id"], cluster_by=["asset_id"])
    def bronze_damaged(self) -> DataFrame:
        """Bronze as it arrives in the wild: truncated, empty and out-of-range rows."""
        r = self._responses(1)
        doc = F.col("doc_id")
        score9 = F.regexp_replace(F.col("raw_response"), r'"standalone_score":\d+',
                                  '"standalone_score":9')
        raw = (F.when(doc % 37 == 0, F.substring(F.col("raw_response"), 1, 40))
               .when(doc % 41 == 0, F.lit('{"chunks":[]}'))
               .when(doc % 43 == 0, score9)
               .otherwise(F.col("raw_response")))
        return r.withColumn("raw_response", raw).drop("doc_id")

    @cached_property
    def landing_objects(self) -> DataFrame:
        """Landing listing: (path, modificationTime, length) like a binaryFile scan."""
        a = self.manifest
        golden = F.concat(F.lit(S.GOLDEN_PREFIX), F.col("client_id"), F.lit("/video/"),
                          F.col("asset_id"), F.col("ext"))
        key = F.when(F.col("doc_id") % 17 == 0, golden).otherwise(F.col("landing_key"))
        return a.select(C.source_uri(WORKSPACE, LAKEHOUSE, key).alias("path"),
                        F.col("modified_at").alias("modificationTime"),
                        F.col("n_chars").alias("length"))

    # ------------------------------------------------------ performance leg
    @cached_property
    def perf_daily(self) -> DataFrame:
        """Daily funnel counts per (ad, platform, day), all BIGINT."""
        li = self.table("lineitem").select("l_suppkey", "l_partkey", "l_linestatus",
                                           "l_shipdate", "l_extendedprice", "l_discount",
                                           "l_tax", "l_quantity", "l_returnflag")
        ep = F.col("l_extendedprice")
        plays = ep * (F.lit(0.2) + F.col("l_discount"))
        fl = lambda c: F.floor(c).cast("bigint")
        return (li.groupBy("l_suppkey", "l_linestatus",
                           F.to_date("l_shipdate").alias("perf_date"))
                .agg(F.sum(fl(ep)).alias("impressions"),
                     F.sum(fl(plays)).alias("plays_3s"),
                     F.sum(fl(plays * 0.5)).alias("plays_25"),
                     F.sum(fl(plays * 0.35)).alias("plays_50"),
                     F.sum(fl(plays * 0.2)).alias("plays_75"),
                     F.sum(fl(plays * 0.1)).alias("plays_100"),
                     F.sum(fl(F.col("l_quantity")) * 60).alias("sum_watch_time_sec"),
                     F.sum(fl(ep * 0.02)).alias("link_clicks"),
                     F.count_if(F.col("l_returnflag") == "R").alias("results"),
                     F.sum(fl(ep * F.col("l_tax"))).alias("spend"))
                .withColumn("ad_id", F.col("l_suppkey").cast("string"))
                .withColumn("platform_native",
                            F.when(F.col("l_linestatus") == "O", "meta").otherwise("tiktok"))
                .drop("l_suppkey", "l_linestatus"))

    @cached_property
    def perf_pulls(self) -> DataFrame:
        """Two pulls per day: a partial one (90 %, day + 1) and the final (day + 3).

        One pass: each daily row is exploded into its two pulls (no union,
        so the daily aggregate runs once).
        """
        counts = ["impressions", "plays_3s", "plays_25", "plays_50", "plays_75", "plays_100",
                  "sum_watch_time_sec", "link_clicks", "results", "spend"]
        pulls = F.explode(F.array(
            F.struct(F.lit(0.9).alias("f"), F.lit(1).alias("lag")),
            F.struct(F.lit(None).cast("double").alias("f"), F.lit(3).alias("lag"))))
        d = self.perf_daily.select("*", pulls.alias("pull"))
        scaled = lambda c: F.when(F.col("pull.f").isNull(), F.col(c)).otherwise(
            F.floor(F.col(c) * F.col("pull.f")).cast("bigint"))
        return d.select("ad_id", "platform_native", "perf_date",
                        *[scaled(c).alias(c) for c in counts],
                        F.date_add("perf_date", F.col("pull.lag")).cast("timestamp")
                        .alias("load_ts"))

    @cached_property
    def perf_pulls_mistagged(self) -> DataFrame:
        """Pulls with a wrong platform tag here and there: input of the tag check only."""
        wrong = F.col("ad_id").cast("bigint") % 7 == 0
        return self.perf_pulls.withColumn(
            "platform_native", F.when(wrong, "other").otherwise(F.col("platform_native")))

    def perf_native(self, platform: str) -> DataFrame:
        """A platform's export under its own column names."""
        p = self.perf_pulls.where(F.col("platform_native") == platform)
        if platform == "meta":
            actions = F.array(
                F.struct(F.lit("purchase").alias("action_type"), F.col("results").alias("value")),
                F.struct(F.lit("link_click").alias("action_type"),
                         F.col("link_clicks").alias("value")))
            return p.select(
                "ad_id", F.col("perf_date").alias("date"), "impressions",
                F.col("plays_3s").alias("video_3_sec_watched_actions"),
                F.col("plays_25").alias("video_p25_watched_actions"),
                F.col("plays_50").alias("video_p50_watched_actions"),
                F.col("plays_75").alias("video_p75_watched_actions"),
                F.col("plays_100").alias("video_p100_watched_actions"),
                F.col("sum_watch_time_sec").alias("video_total_time_watched"),
                F.lit(None).cast("double").alias("video_avg_time_watched_actions"),
                F.col("plays_3s").alias("video_play_actions"),
                F.col("link_clicks").alias("inline_link_clicks"),
                actions.alias("actions"), "spend", "load_ts",
                F.lit("meta").alias("platform_native"))
        return p.select(
            "ad_id", F.col("perf_date").alias("stat_time_day"), "impressions",
            F.col("plays_3s").alias("video_views_p_3s"),
            F.col("plays_25").alias("video_views_p25"),
            F.col("plays_50").alias("video_views_p50"),
            F.col("plays_75").alias("video_views_p75"),
            F.col("plays_100").alias("video_views_p100"),
            F.col("sum_watch_time_sec").alias("total_watch_time"),
            F.col("plays_3s").alias("video_views"),
            F.col("link_clicks").alias("clicks_destination"),
            F.col("results").alias("conversions"), "spend", "load_ts",
            F.lit("tiktok").alias("platform_native"))

    @stored_layer()
    def cut(self) -> DataFrame:
        """Editor's cut per ad: all its distinct parts, laid end to end."""
        # dealt out by ad once, for the distinct parts and for the order
        li = self.table("lineitem").select("l_suppkey", "l_partkey", "l_quantity").repartition("l_suppkey")
        pairs = li.groupBy("l_suppkey", "l_partkey").agg(F.min("l_quantity").alias("len"))
        order = (F.col("l_partkey") * 31 + F.col("l_suppkey") * 17) % 997
        w = Window.partitionBy("l_suppkey").orderBy(order, "l_partkey")
        ranked = pairs.withColumn("position_in_ad", F.row_number().over(w))
        run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)  # the same sort
        return (ranked.withColumn("end_sec", F.sum("len").over(run))
                .withColumn("start_sec", F.col("end_sec") - F.col("len"))
                .select(F.col("l_suppkey").cast("string").alias("ad_id"),
                        F.col("l_suppkey").alias("ad_num"), "l_partkey",
                        F.col("position_in_ad").cast("int").alias("position_in_ad"),
                        "start_sec", "end_sec"))

    @staticmethod
    def _part_features(size: Column) -> list[Column]:
        theme = (F.when(size <= 25, "Hook").when(size <= 40, "Problem")
                 .when(size <= 46, "Solution").when(size <= 49, "Social Proof")
                 .otherwise("CTA"))
        return [theme.alias("chunk_theme"), _pick(S.SENTIMENTS, size % 6).alias("sentiment"),
                (size % 5 + 1).cast("int").alias("standalone_score")]

    @stored_layer()
    def edit_decision_list(self) -> DataFrame:
        c = self.cut
        ad, pos = F.col("ad_num"), F.col("position_in_ad")
        role = (F.when(pos == 1, "hook").when(pos == 4, "social_proof")
                .when((pos == 5) & (ad % 5 != 0), "cta").otherwise("body"))
        cid = F.when((ad % 3 == 0) & (pos == 3),
                     F.concat(F.lit("p"), F.col("l_partkey").cast("string"))) \
            .otherwise(F.concat(F.col("ad_id"), F.lit("_"), C.padded_sequence(pos)))
        return (c.where(~((ad % 4 == 0) & (pos == 1)))
                .select("ad_id", cid.alias("chunk_id"), role.alias("chunk_role"),
                        "position_in_ad", "start_sec", "end_sec"))

    @stored_layer()
    def perf_chunks(self) -> DataFrame:
        """fact_chunk of the performance leg: edited cuts plus the raw library."""
        part = self.table("part").select("p_partkey", "p_size", "p_name")
        c = self.cut.join(part, F.col("l_partkey") == F.col("p_partkey"))
        edited = c.select(
            F.concat(F.col("ad_id"), F.lit("_"), C.padded_sequence(F.col("position_in_ad")))
            .alias("chunk_id"),
            F.concat(F.lit("ed"), F.col("ad_id")).alias("asset_id"),
            F.col("position_in_ad").alias("chunk_sequence"), "start_sec", "end_sec",
            F.col("p_name").alias("transcript_segment"), *self._part_features(F.col("p_size")))
        raw = part.select(
            F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("chunk_id"),
            F.concat(F.lit("raw"), (F.col("p_partkey") % 50).cast("string")).alias("asset_id"),
            (F.floor(F.col("p_partkey") / 50) + 1).cast("int").alias("chunk_sequence"),
            F.lit(0.0).alias("start_sec"), F.col("p_size").cast("double").alias("end_sec"),
            F.col("p_name").alias("transcript_segment"), *self._part_features(F.col("p_size")))
        return edited.unionByName(raw)

    @stored_layer()
    def perf_assets(self) -> DataFrame:
        """dim_asset of the performance leg."""
        ed = (self.cut.groupBy("ad_id", "ad_num").agg(F.max("end_sec").alias("mx"))
              .select(F.concat(F.lit("ed"), F.col("ad_id")).alias("asset_id"),
                      F.lit("EDITED").alias("asset_type"),
                      F.concat(F.lit("raw"), (F.col("ad_num") % 50).cast("string"))
                      .alias("parent_asset_id"),
                      F.when(F.col("ad_num") % 29 != 0, F.col("mx").cast("int"))
                      .alias("duration_sec")))
        raw = (self.table("part").select((F.col("p_partkey") % 50).alias("k")).distinct()
               .select(F.concat(F.lit("raw"), F.col("k").cast("string")).alias("asset_id"),
                       F.lit("RAW").alias("asset_type"),
                       F.lit(None).cast("string").alias("parent_asset_id"),
                       F.lit(None).cast("int").alias("duration_sec")))
        return ed.unionByName(raw).withColumn("client_id", F.lit("perf"))

    @stored_layer()
    def map_ad_asset(self) -> DataFrame:
        return (self.table("lineitem").select("l_suppkey").distinct()
                .select(F.col("l_suppkey").cast("string").alias("ad_id"),
                        F.concat(F.lit("ed"), F.col("l_suppkey").cast("string"))
                        .alias("asset_id")))

    @cached_property
    def map_ad_asset_gaps(self) -> DataFrame:
        """A map that lacks some ads: input of the unmapped-ad check only."""
        return self.map_ad_asset.where(F.col("ad_id").cast("bigint") % 31 != 0)

    def dim_platform(self) -> DataFrame:
        """Platform seed: two literal rows (size bound is the literal)."""
        return C.literal_table(self.spark, S.PLATFORM_SEED, S.SEED_SCHEMAS["dim_platform"])

    # -------------------------------------------------------------- other
    @cached_property
    def run_log_json(self) -> DataFrame:
        """Extraction run records as the extractor writes them: one JSON text each."""
        e = self.table("events").select("event_id", "ts", "user_id", "event_type", "value",
                                        "props")
        k = F.get_json_object(F.col("props"), "$.k").cast("bigint")
        rec = F.struct(
            F.col("event_id").cast("string").alias("run_id"),
            F.col("user_id").cast("string").alias("asset_id"),
            F.concat(F.lit("m"), (k % 3).cast("string")).alias("model_version"),
            F.concat(F.lit("v"), (k % 2).cast("string")).alias("prompt_version"),
            F.floor(F.col("value") * 100).cast("bigint").alias("tokens_in"),
            F.floor(F.col("value") * 10).cast("bigint").alias("tokens_out"),
            F.col("value").alias("processing_time_sec"),
            F.when(F.col("event_type") == "error", 1).otherwise(0).alias("retry_count"),
            F.col("ts").cast("timestamp").alias("load_ts"))
        return e.select(F.to_json(rec, {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})
                        .alias("value"))

    def price_table(self) -> DataFrame:
        return C.literal_table(
            self.spark, PRICE_TABLE,
            "model_version STRING, price_in_micro BIGINT, price_out_micro BIGINT")

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events").select("event_id", F.col("ts").cast("timestamp").alias("ts"),
                                           "user_id", "event_type", "value")
