"""Query keys: each wires operators to the bound test data.

``QUERIES[key](spark, sf_dir) -> DataFrame`` and ``ORACLE[key] -> SQL``. The
wiring is all that lives here; semantics live in ``reelmart.operators``.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelmart import schemas as S
from reelmart.operators import assemble as A
from reelmart.operators import ingest as I
from reelmart.operators import search as SR
from reelmart.operators import silver as SV
from reelmart.plans import oracle as O
from reelmart.session import apply_core_conf
from reelmart.sources.testdata import Lake

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

_LAKES: dict[tuple[str, str], Lake] = {}


def lake(spark: SparkSession, sf_dir: str) -> Lake:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LAKES:
        apply_core_conf(spark)   # UTC, ANSI, AQE on a session built elsewhere
        _LAKES[key] = Lake(spark, sf_dir)
    return _LAKES[key]


def query(name: str, sql: str | None = None, deps: list[str] | None = None):
    def deco(fn: Callable[[Lake], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(lake(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = O.with_ctes(sql, deps or [])
        return fn
    return deco


# Shared derived frames --------------------------------------------------------
def shared(fn: Callable[[Lake], DataFrame]) -> Callable[[Lake], DataFrame]:
    """Build a derived (view) frame once per Lake: the DataFrame object, and
    its analysed plan, are reused by every query that needs it."""
    def get(lk: Lake) -> DataFrame:
        memo = lk.__dict__.setdefault("_views", {})
        if fn.__name__ not in memo:
            memo[fn.__name__] = fn(lk)
        return memo[fn.__name__]
    get.__name__ = fn.__name__
    get.__doc__ = fn.__doc__
    return get


def silver_wide(lk: Lake) -> DataFrame:
    """The Silver chunk table (stored, partitioned by client)."""
    return lk.store.table("silver_wide", lambda: SV.silver_chunk_wide(lk.bronze),
                          partition_by=["client_id"], cluster_by=["asset_id", "chunk_sequence"])


@shared
def fact_chunk(lk: Lake) -> DataFrame:
    return SV.fact_chunk(silver_wide(lk))


@shared
def compat(lk: Lake) -> DataFrame:
    return SV.compatibility_bridge(silver_wide(lk))


# Search parameters of the registered queries.
SEARCH = dict(theme="Hook", sentiment="energetic", min_score=4, contains="the")
KEYWORD = "thanedble"  # a tag present at every scale of the test data
TOPK = 3


# Wave 0/1: ingest and Silver ---------------------------------------------------
@query("search_clips", """
SELECT clip.chunk_id, asset_id, client_id, asset_name, clip.start_sec, clip.end_sec,
       clip.standalone_score, clip.chunk_theme, clip.sentiment, clip.transcript_segment
FROM (FROM fact_chunk WHERE standalone_score > 3 AND chunk_theme || '/' || sentiment = 'Hook/energetic'
                        AND contains(lower(transcript_segment), 'the')) AS clip
JOIN (SELECT asset_id, client_id, asset_name FROM manifest) USING (asset_id)
ORDER BY -clip.standalone_score, clip.start_sec, clip.chunk_id""", ["fact_chunk", "manifest"])
def _search_clips(lk: Lake) -> DataFrame:
    return SR.search_clips(fact_chunk(lk), lk.manifest, **SEARCH)


@query("asset_identity", """
SELECT doc_id, client_id, content_sha256, asset_id FROM deliv""", ["deliv"])
def _asset_identity(lk: Lake) -> DataFrame:
    return I.asset_identity(lk.deliveries)


@query("asset_manifest", """
SELECT asset_id, client_id, content_sha256, asset_name, asset_type, parent_asset_id,
       duration_sec, source_uri, ingested_at, folder, ext,
       CASE lower(ext) WHEN '.mp4' THEN 'video/mp4' WHEN '.mov' THEN 'video/quicktime'
                       WHEN '.webm' THEN 'video/webm' WHEN '.avi' THEN 'video/x-msvideo'
                       ELSE 'video/mp4' END AS mime_type,
       landing_key
FROM manifest""", ["manifest"])
def _asset_manifest(lk: Lake) -> DataFrame:
    return I.asset_manifest(lk.manifest)


def _prior_manifest(lk: Lake) -> DataFrame:
    """What an earlier ingest run already knew: deliveries landed before the cutoff."""
    from reelmart.sources.testdata import PRIOR_RUN_CUTOFF
    return I.dedupe_deliveries(lk.deliveries.where(F.col("modified_at") < PRIOR_RUN_CUTOFF))


@query("ingest_new_assets", """
SELECT asset_id, client_id, content_sha256, asset_name, doc_id AS winner_doc_id, n_deliveries
FROM (SELECT *, row_number() OVER (PARTITION BY asset_id ORDER BY doc_id) AS rn,
             count(*) OVER (PARTITION BY asset_id) AS n_deliveries FROM deliv)
WHERE rn = 1
  AND asset_id NOT IN (SELECT asset_id FROM deliv WHERE modified_at < TIMESTAMP '2024-02-01')
""", ["deliv"])
def _ingest_new_assets(lk: Lake) -> DataFrame:
    return I.ingest_new_assets(lk.deliveries, _prior_manifest(lk))


@query("list_new_assets", """
SELECT asset_id, client_id, source_uri,
       'bronze/' || client_id || '/asset_raw/' || asset_id || '.parquet' AS bronze_key
FROM manifest WHERE doc_id % 13 = 0""", ["manifest"])
def _list_new_assets(lk: Lake) -> DataFrame:
    return I.list_new_assets(lk.manifest, lk.extracted_so_far)


@query("cross_client_copies", """
SELECT content_sha256, count(*) AS n_clients, CAST(sum(n) AS BIGINT) AS n_deliveries
FROM (SELECT content_sha256, client_id, count(*) AS n FROM deliv GROUP BY 1, 2)
GROUP BY 1 HAVING count(*) > 1""", ["deliv"])
def _cross_client_copies(lk: Lake) -> DataFrame:
    return I.cross_client_copies(lk.deliveries)


@query("silver_chunk", "SELECT * FROM fact_chunk", ["fact_chunk"])
def _silver_chunk(lk: Lake) -> DataFrame:
    return fact_chunk(lk)


FILLERS = ["um", "uh", "er", "like", "so", "euh", "ben", "eh", "pues", "also", "le", "the"]


@query("clean_transcript", f"""
SELECT chunk_id, array_to_string(kept, ' ') AS clean_transcript,
       CAST(len(toks) - len(kept) AS INTEGER) AS n_removed, start_label,
       CAST(split_part(start_label, ':', 1) AS DOUBLE) * 60
         + CAST(split_part(start_label, ':', 2) AS DOUBLE) AS start_sec_norm
FROM (SELECT chunk_id, toks,
             list_filter(toks, lambda w: w <> '' AND lower(w) NOT IN
               ({', '.join(repr(f) for f in FILLERS)})) AS kept,
             CAST(CAST(floor(start_sec / 60) AS INTEGER) AS VARCHAR) || ':' ||
               lpad(CAST(CAST(floor(start_sec % 60) AS INTEGER) AS VARCHAR), 2, '0') AS start_label
      FROM (SELECT chunk_id, start_sec, string_split(transcript_segment, ' ') AS toks
            FROM fact_chunk))""", ["fact_chunk"])
def _clean_transcript(lk: Lake) -> DataFrame:
    return SV.clean_transcript(fact_chunk(lk), FILLERS)


@query("keyword_bridge", "SELECT chunk_id, keyword FROM kw_bridge", ["kw_bridge"])
def _keyword_bridge(lk: Lake) -> DataFrame:
    return SV.keyword_bridge(silver_wide(lk))


@query("theme_bridge", "SELECT chunk_id, chunk_theme AS theme FROM silver", ["silver"])
def _theme_bridge(lk: Lake) -> DataFrame:
    return SV.theme_bridge(silver_wide(lk))


@query("bridge_chunk_compatibility", """
SELECT chunk_id, compatible_theme, CAST(NULL AS DECIMAL(5,4)) AS theme_match_score
FROM compat_bridge""", ["compat_bridge"])
def _bridge_chunk_compatibility(lk: Lake) -> DataFrame:
    return compat(lk)


@query("dim_asset", """
SELECT m.asset_id, m.client_id, m.content_sha256, m.asset_name, m.asset_type, m.parent_asset_id,
       m.duration_sec, m.source_uri, m.ingested_at,
       CASE WHEN EXISTS (SELECT 1 FROM manifest o
                         WHERE o.client_id = m.client_id AND o.folder = m.folder
                           AND split_part(o.asset_name, '-', 1) = split_part(m.asset_name, '-', 1)
                           AND o.asset_id <> m.asset_id AND o.duration_sec IS NOT NULL
                           AND abs(o.duration_sec - m.duration_sec) <= 5)
            THEN 'likely_near_dup' END AS dq_flag
FROM manifest m""", ["manifest"])
def _dim_asset(lk: Lake) -> DataFrame:
    return I.dim_asset(lk.manifest)


@query("near_dup_pairs", """
SELECT asset_id, client_id, folder, stem, duration_sec, count(*) AS n_near_dups,
       first(b_id ORDER BY gap, b_d, b_id) AS nearest_asset_id,
       CAST(min(gap) AS INTEGER) AS nearest_gap_sec
FROM (SELECT a.asset_id, a.client_id, a.folder, split_part(a.asset_name, '-', 1) AS stem,
             a.duration_sec, b.asset_id AS b_id, b.duration_sec AS b_d,
             abs(a.duration_sec - b.duration_sec) AS gap
      FROM manifest a JOIN manifest b
        ON a.client_id = b.client_id AND a.folder = b.folder
       AND split_part(a.asset_name, '-', 1) = split_part(b.asset_name, '-', 1)
       AND a.asset_id <> b.asset_id AND abs(a.duration_sec - b.duration_sec) <= 5)
GROUP BY 1, 2, 3, 4, 5""", ["manifest"])
def _near_dup_pairs(lk: Lake) -> DataFrame:
    return I.near_dup_pairs(lk.manifest)


O.cte("bgate", """
SELECT b.asset_id, b.client_id, 'model-a1' AS model_version,
       CAST(CASE WHEN b.asset_reason = 'unparsable' THEN NULL
                 WHEN b.asset_reason = 'empty' THEN 0
                 ELSE (SELECT count(*) FROM chunkall c WHERE c.asset_id = b.asset_id) END
            AS INTEGER) AS chunk_count,
       CASE WHEN b.asset_reason IS NULL THEN 'PASS' ELSE 'QUARANTINE' END AS gate_status,
       b.asset_reason AS reason
FROM bronze_dmg b""", ["bronze_dmg", "chunkall"])


@query("bronze_gate", "SELECT * FROM bgate", ["bgate"])
def _bronze_gate(lk: Lake) -> DataFrame:
    return SV.bronze_gate(lk.bronze_damaged)


@query("quarantine_rows", """
SELECT asset_id, client_id, CAST(NULL AS VARCHAR) AS chunk_id,
       CAST(NULL AS INTEGER) AS chunk_sequence, asset_reason AS reason
FROM bronze_dmg WHERE asset_reason IS NOT NULL
UNION ALL
SELECT asset_id, client_id, chunk_id, chunk_sequence, 'score_out_of_range'
FROM dmg_chunks WHERE standalone_score NOT BETWEEN 1 AND 5""", ["bronze_dmg", "dmg_chunks"])
def _quarantine_rows(lk: Lake) -> DataFrame:
    return SV.quarantine_rows(lk.bronze_damaged)


@query("silver_pass_rate", """
SELECT client_id, count(*) AS n_chunks,
       CAST(count(*) FILTER (WHERE standalone_score BETWEEN 1 AND 5) AS BIGINT) AS n_pass,
       round(count(*) FILTER (WHERE standalone_score BETWEEN 1 AND 5)::DOUBLE / count(*), 6)
         AS pass_rate,
       round(count(*) FILTER (WHERE standalone_score BETWEEN 1 AND 5)::DOUBLE / count(*), 6)
         >= 0.95 AS promote
FROM dmg_chunks GROUP BY 1""", ["dmg_chunks"])
def _silver_pass_rate(lk: Lake) -> DataFrame:
    return SV.pass_rate(lk.bronze_damaged)


# Wave 2: search and assembly ----------------------------------------------------
@query("search_keyword", """
SELECT c.chunk_id, c.asset_id, c.chunk_theme, c.standalone_score FROM fact_chunk c
WHERE c.chunk_id IN (SELECT chunk_id FROM kw_bridge WHERE keyword = 'thanedble')""",
       ["fact_chunk", "kw_bridge"])
def _search_keyword(lk: Lake) -> DataFrame:
    return SR.search_keyword(silver_wide(lk), KEYWORD)


@query("clip_provenance", """
SELECT c.chunk_id, c.asset_id, c.chunk_sequence, a.client_id, a.asset_name, a.asset_type,
       a.parent_asset_id, p.asset_name AS parent_asset_name, p.asset_type AS parent_asset_type
FROM fact_chunk c JOIN manifest a ON a.asset_id = c.asset_id
LEFT JOIN manifest p ON p.asset_id = a.parent_asset_id""", ["fact_chunk", "manifest"])
def _clip_provenance(lk: Lake) -> DataFrame:
    return SR.clip_provenance(fact_chunk(lk), lk.manifest)


@query("asset_duration", """
SELECT asset_id, max(end_sec) AS duration_from_chunks, count(*) AS n_chunks
FROM fact_chunk GROUP BY 1""", ["fact_chunk"])
def _asset_duration(lk: Lake) -> DataFrame:
    return SR.asset_duration(fact_chunk(lk))


@query("reusable_inventory", """
SELECT m.client_id, count(*) AS n_chunks,
       CAST(count(*) FILTER (WHERE c.standalone_score >= 4) AS BIGINT) AS n_reusable,
       round(count(*) FILTER (WHERE c.standalone_score >= 4)::DOUBLE / count(*), 6)
         AS reusable_share
FROM fact_chunk c JOIN manifest m ON m.asset_id = c.asset_id GROUP BY 1""",
       ["fact_chunk", "manifest"])
def _reusable_inventory(lk: Lake) -> DataFrame:
    return SR.reusable_inventory(fact_chunk(lk), lk.manifest)


@query("store_profile", """
SELECT m.client_id, count(*) AS n_assets,
       count(*) FILTER (WHERE m.asset_type = 'RAW') AS n_raw,
       count(*) FILTER (WHERE m.asset_type = 'EDITED') AS n_edited,
       count(k.k) AS n_assets_with_chunks, CAST(coalesce(sum(k.k), 0) AS BIGINT) AS n_chunks,
       min(k.k) AS min_chunks_per_asset, max(k.k) AS max_chunks_per_asset
FROM manifest m LEFT JOIN (SELECT asset_id, count(*) AS k FROM fact_chunk GROUP BY 1) k
  ON k.asset_id = m.asset_id
GROUP BY 1""", ["manifest", "fact_chunk"])
def _store_profile(lk: Lake) -> DataFrame:
    return SR.store_profile(fact_chunk(lk), lk.manifest)


@query("compatible_pairs", """
SELECT h.client_id, h.hook_chunk, h.hook_asset, h.next_theme,
       CAST(t.n - CASE WHEN h.hook_theme = h.next_theme THEN 1 ELSE 0 END AS BIGINT)
         AS n_next_candidates
FROM hook_edges h
JOIN (SELECT client_id, chunk_theme, count(*) AS n FROM elig GROUP BY 1, 2) t
  ON t.client_id = h.client_id AND t.chunk_theme = h.next_theme
WHERE t.n - CASE WHEN h.hook_theme = h.next_theme THEN 1 ELSE 0 END > 0""",
       ["hook_edges", "elig"])
def _compatible_pairs(lk: Lake) -> DataFrame:
    return A.compatible_pairs(silver_wide(lk), lk.manifest, compat(lk))


@query("compatible_pairs_topk", f"""
SELECT * FROM (
  SELECT h.client_id, h.hook_chunk, h.hook_asset, h.next_theme, n.chunk_id AS next_chunk,
         n.asset_id AS next_asset, n.standalone_score AS next_score,
         CAST(row_number() OVER (PARTITION BY h.hook_chunk, h.next_theme
                                 ORDER BY n.standalone_score DESC, n.chunk_id) AS INTEGER)
           AS next_rank
  FROM hook_edges h JOIN elig n
    ON n.client_id = h.client_id AND n.chunk_theme = h.next_theme AND n.chunk_id <> h.hook_chunk)
WHERE next_rank <= {TOPK}""", ["hook_edges", "elig"])
def _compatible_pairs_topk(lk: Lake) -> DataFrame:
    return A.compatible_pairs_topk(silver_wide(lk), lk.manifest, compat(lk), TOPK)


ASSEMBLE_K = 2


_ASM_OUT = """
SELECT client_id, path[1] AS hook_chunk, array_to_string(path, '>') AS sequence,
       array_to_string(themes, '>') AS themes, score AS sequence_score FROM best{d}"""


@query("assemble_3step", _ASM_OUT.format(d="3_cta"), ["best3_cta"])
def _assemble_3step(lk: Lake) -> DataFrame:
    """Hook, body, call to action: the best sequences of each hook."""
    return A.assemble(silver_wide(lk), lk.manifest, compat(lk), depth=3, k=ASSEMBLE_K,
                      last_theme="CTA")


@query("assemble_nstep", _ASM_OUT.format(d=5), ["best5"])
def _assemble_nstep(lk: Lake) -> DataFrame:
    return A.assemble(silver_wide(lk), lk.manifest, compat(lk), depth=5, k=ASSEMBLE_K,
                      checkpoint_every=2)




# Wave 3: performance ------------------------------------------------------------
from reelmart.operators import align as AL  # noqa: E402
from reelmart.operators import correlate as CO  # noqa: E402
from reelmart.operators import perf as P  # noqa: E402
from reelmart.operators import significance as SG  # noqa: E402

ALIGN_TOLERANCE = O.ALIGN_TOLERANCE


@shared
def perf_unioned(lk: Lake) -> DataFrame:
    """int_ad_perf_unioned: each platform's stored raw pulls conformed and
    unioned (a view; the deduplicated form below is the stored Silver)."""
    return P.ad_perf_unioned(lk.perf_native("meta"), lk.perf_native("tiktok"))


def _perf_latest(lk: Lake) -> DataFrame:
    """Silver dedup: latest pull per (ad, platform, day) (stored)."""
    return lk.store.table("perf_latest", lambda: P.latest_pull(perf_unioned(lk)),
                          cluster_by=["ad_id", "platform_name", "perf_date"])  # as the dedup sorts


@shared
def perf_fact(lk: Lake) -> DataFrame:
    return P.fact_ad_performance(_perf_latest(lk), lk.dim_platform(), lk.map_ad_asset)


@shared
def perf_kpi(lk: Lake) -> DataFrame:
    return P.ad_kpi(perf_fact(lk))


@shared
def perf_bridge(lk: Lake) -> DataFrame:
    return P.bridge_ad_chunk(lk.edit_decision_list, lk.perf_chunks)


@shared
def perf_anchors(lk: Lake) -> DataFrame:
    return AL.anchors(perf_kpi(lk), lk.dim_platform(), lk.map_ad_asset, lk.perf_assets)


@shared
def perf_alignment(lk: Lake) -> DataFrame:
    return AL.metric_chunk_alignment(perf_anchors(lk), perf_bridge(lk), perf_kpi(lk),
                                     tolerance_sec=ALIGN_TOLERANCE)


def perf_metric_chunk(lk: Lake) -> DataFrame:
    """fct_ad_metric_chunk, one row per (ad, platform, metric). Stored: the
    mart, its median and the significance tests each read it several times,
    and re-running the alignment lineage for every read costs more than
    writing one row per ad and metric."""
    return lk.store.table("perf_metric_chunk", lambda: AL.ad_metric_chunk(
        perf_alignment(lk), perf_kpi(lk), lk.perf_chunks), cluster_by=["platform_id", "metric_name"])


@shared
def perf_mart(lk: Lake) -> DataFrame:
    return CO.chunk_perf_correlation(perf_metric_chunk(lk))


_UNIONED_COLS = ("ad_id, perf_date, impressions, plays_3s, plays_25, plays_50, plays_75, "
                 "plays_100, sum_watch_time_sec, plays_3s AS play_count, link_clicks, results, "
                 "spend, load_ts, platform_name")


@query("ad_perf_unioned", f"SELECT {_UNIONED_COLS} FROM perf_pulls", ["perf_pulls"])
def _ad_perf_unioned(lk: Lake) -> DataFrame:
    return perf_unioned(lk)


@query("perf_latest_pull", f"SELECT {_UNIONED_COLS} FROM perf_latest", ["perf_latest"])
def _perf_latest_pull(lk: Lake) -> DataFrame:
    return P.latest_pull(perf_unioned(lk))


@query("fact_ad_performance", "SELECT * FROM fact_perf", ["fact_perf"])
def _fact_ad_performance(lk: Lake) -> DataFrame:
    return perf_fact(lk)


@query("ad_kpi", """
SELECT ad_id, platform_id, round(hook_rate, 6) AS hook_rate, round(hold_rate_25, 6) AS hold_rate_25,
       round(hold_rate_50, 6) AS hold_rate_50, round(retention_75, 6) AS retention_75,
       round(retention_100, 6) AS retention_100, round(avg_play_time_sec, 6) AS avg_play_time_sec,
       round(ctr_link, 6) AS ctr_link, round(cpa, 6) AS cpa, round(cvr, 6) AS cvr FROM kpi""",
       ["kpi"])
def _ad_kpi(lk: Lake) -> DataFrame:
    return P.ad_kpi(perf_fact(lk), digits=6)


@query("kpi_targets", """
SELECT ad_id, platform_id, hook_rate >= 0.25 AS hook_ok, avg_play_time_sec >= 5.0 AS play_time_ok,
       ctr_link >= 0.01 AS ctr_ok, cvr BETWEEN 0.01 AND 0.03 AS cvr_ok FROM kpi""", ["kpi"])
def _kpi_targets(lk: Lake) -> DataFrame:
    return P.kpi_targets(perf_kpi(lk))


@query("bridge_ad_chunk", "SELECT * FROM bridge_ad_chunk", ["bridge_ad_chunk"])
def _bridge_ad_chunk(lk: Lake) -> DataFrame:
    return perf_bridge(lk)


@query("anchors", "SELECT * FROM anchors", ["anchors"])
def _anchors(lk: Lake) -> DataFrame:
    return perf_anchors(lk)


@query("metric_chunk_alignment", "SELECT * FROM alignment", ["alignment"])
def _metric_chunk_alignment(lk: Lake) -> DataFrame:
    return perf_alignment(lk)


@query("ad_metric_chunk", "SELECT * FROM metric_chunk", ["metric_chunk"])
def _ad_metric_chunk(lk: Lake) -> DataFrame:
    return perf_metric_chunk(lk)


# Wave 4: insight ------------------------------------------------------------------
@query("chunk_perf_correlation", "SELECT * FROM mart", ["mart"])
def _chunk_perf_correlation(lk: Lake) -> DataFrame:
    return perf_mart(lk)


@query("winning_hook_themes", """
SELECT platform_id, feature_value AS hook_theme, n_ads, round(median_metric, 3) AS median_hook_rate,
       rank_in_platform, evidence_regime, honesty_note
FROM (FROM mart WHERE n_ads >= 5) WHERE (metric_name, feature_dim) = ('hook_rate', 'chunk_theme')
ORDER BY ALL""", ["mart"])
def _winning_hook_themes(lk: Lake) -> DataFrame:
    return CO.winning_hook_themes(perf_mart(lk))


@query("cta_sentiment", """
SELECT platform_id, feature_value AS cta_sentiment, n_ads, round(median_metric, 4) AS median_ctr_link,
       evidence_regime
FROM (FROM mart WHERE n_ads >= 5) WHERE (metric_name, feature_dim) = ('ctr_link', 'sentiment')
ORDER BY ALL""", ["mart"])
def _cta_sentiment(lk: Lake) -> DataFrame:
    return CO.cta_sentiment(perf_mart(lk))


@query("mine_library", """
FROM (FROM pchunk WHERE standalone_score > 3) AS lib
SEMI JOIN (FROM passet WHERE asset_type = 'RAW') AS raw USING (asset_id)
SEMI JOIN (SELECT feature_value AS chunk_theme FROM mart
           WHERE n_ads >= 5 AND rank_in_platform < 4
             AND (metric_name, feature_dim) = ('hook_rate', 'chunk_theme')) AS top USING (chunk_theme)
ANTI JOIN bridge_ad_chunk AS used USING (chunk_id)
SELECT chunk_id, asset_id, chunk_theme, standalone_score, transcript_segment
ORDER BY -standalone_score, chunk_id""", ["pchunk", "passet", "mart", "bridge_ad_chunk"])
def _mine_library(lk: Lake) -> DataFrame:
    return CO.mine_library(perf_mart(lk), lk.perf_chunks, lk.perf_assets, perf_bridge(lk))


@query("mine_lineage", """
SELECT p.asset_id AS raw_parent_id, p.chunk_id, p.chunk_theme, p.standalone_score,
       x.n_ads_via_lineage
FROM pchunk p
JOIN (SELECT a.parent_asset_id AS raw_parent_id, count(DISTINCT b.ad_id) AS n_ads_via_lineage
      FROM bridge_ad_chunk b JOIN passet a ON a.asset_id = b.asset_id
      WHERE a.asset_type = 'EDITED' AND a.parent_asset_id IS NOT NULL GROUP BY 1) x
  ON x.raw_parent_id = p.asset_id
WHERE p.standalone_score >= 4""", ["pchunk", "passet", "bridge_ad_chunk"])
def _mine_lineage(lk: Lake) -> DataFrame:
    return CO.mine_lineage(perf_bridge(lk), lk.perf_assets, lk.perf_chunks)


@query("cross_platform_agreement", """
SELECT metric_name, feature_value, count(*) AS n_platforms, max(rank_in_platform) AS worst_rank,
       count(*) = 2 AS agrees
FROM mart WHERE evidence_regime <> 'BLOCK' AND feature_dim = 'chunk_theme' AND rank_in_platform <= 3
GROUP BY 1, 2""", ["mart"])
def _cross_platform_agreement(lk: Lake) -> DataFrame:
    return CO.cross_platform_agreement(perf_mart(lk))


_FAM = "platform_id, metric_name, feature_dim"


@query("mann_whitney", f"""
, mw_base AS (
  SELECT *, rank() OVER (PARTITION BY {_FAM} ORDER BY metric_value)
            + (count(*) OVER (PARTITION BY {_FAM}, metric_value) - 1) / 2.0 AS r
  FROM mart_base),
mw_fam AS (SELECT {_FAM}, count(*) AS n_total FROM mw_base GROUP BY 1, 2, 3),
mw_ties AS (SELECT {_FAM}, sum(t * t * t - t) AS tie_sum
            FROM (SELECT {_FAM}, metric_value, CAST(count(*) AS DOUBLE) AS t FROM mw_base GROUP BY 1, 2, 3, 4)
            GROUP BY 1, 2, 3),
mw_grp AS (SELECT {_FAM}, feature_value, count(*) AS n1, sum(r) AS r1 FROM mw_base
           GROUP BY 1, 2, 3, 4),
mw_calc AS (
  SELECT g.platform_id, g.metric_name, g.feature_dim, g.feature_value, g.n1,
         f.n_total - g.n1 AS n_rest, m.evidence_regime,
         g.r1 - g.n1::DOUBLE * (g.n1::DOUBLE + 1) / 2.0 AS u1,
         g.n1::DOUBLE * (f.n_total - g.n1)::DOUBLE / 12.0
           * ((f.n_total::DOUBLE + 1) - t.tie_sum::DOUBLE
              / (f.n_total::DOUBLE * (f.n_total::DOUBLE - 1))) AS var,
         g.n1::DOUBLE * (f.n_total - g.n1)::DOUBLE AS n1n2
  FROM mw_grp g JOIN mw_fam f USING ({_FAM}) JOIN mw_ties t USING ({_FAM})
  JOIN mart m USING ({_FAM}, feature_value)),
mw_z AS (
  SELECT *, CASE WHEN var > 0 THEN greatest(abs(u1 - n1n2 / 2.0) - 0.5, 0.0) / sqrt(var) END AS z,
         (evidence_regime = 'SUGGESTIVE' AND n_rest >= 5 AND var > 0) AS tested
  FROM mw_calc),
mw_p AS (
  SELECT *, CASE WHEN tested THEN least(1.0, 2.0 * (exp(-0.5 * abs(z) * abs(z)) * 0.3989422804014327)
              * (tt * (0.319381530 + tt * (-0.356563782 + tt * (1.781477937
                 + tt * (-1.821255978 + tt * 1.330274429)))))) END AS p_raw,
         sum(CAST(tested AS INTEGER)) OVER (PARTITION BY {_FAM}) AS n_tests
  FROM (SELECT *, 1.0 / (1.0 + 0.2316419 * abs(z)) AS tt FROM mw_z))
SELECT platform_id, metric_name, feature_dim, feature_value, n1 AS n_value, n_rest,
       round(u1, 6) AS u_stat, round(CASE WHEN tested THEN z END, 6) AS z_score,
       round(p_raw, 6) AS p_value, round(least(1.0, p_raw * n_tests), 6) AS p_bonferroni,
       coalesce(least(1.0, p_raw * n_tests) < 0.05, false) AS is_significant
FROM mw_p""", ["mart_base", "mart"])
def _mann_whitney(lk: Lake) -> DataFrame:
    return SG.mann_whitney(perf_metric_chunk(lk), perf_mart(lk))


@query("spearman_directional", f"""
SELECT platform_id, metric_name, feature_dim, feature_value, count(*) AS n_ads,
       CASE WHEN var_pop(rs) > 0 AND var_pop(rm) > 0 THEN round(corr(rs, rm), 6) END
         AS spearman_rho
FROM (SELECT b.*,
        rank() OVER (PARTITION BY {_FAM}, feature_value ORDER BY standalone_score)
          + (count(*) OVER (PARTITION BY {_FAM}, feature_value, standalone_score) - 1) / 2.0 AS rs,
        rank() OVER (PARTITION BY {_FAM}, feature_value ORDER BY metric_value)
          + (count(*) OVER (PARTITION BY {_FAM}, feature_value, metric_value) - 1) / 2.0 AS rm
      FROM mart_base b JOIN mart m USING ({_FAM}, feature_value)
      WHERE m.evidence_regime = 'DIRECTIONAL')
GROUP BY 1, 2, 3, 4""", ["mart_base", "mart"])
def _spearman_directional(lk: Lake) -> DataFrame:
    return SG.spearman_directional(perf_metric_chunk(lk), perf_mart(lk))


def _fix_mann_whitney() -> None:
    # the statement above continues the WITH list built from its deps
    sql = ORACLE["mann_whitney"]
    head, _, body = sql.partition("\n\n, mw_base AS (")
    ORACLE["mann_whitney"] = head + ",\nmw_base AS (" + body


_fix_mann_whitney()


# Wave 5: quality, lineage, retention, telemetry ---------------------------------------
from reelmart.functions import columns as C  # noqa: E402
from reelmart.operators import lineage as LN  # noqa: E402
from reelmart.operators import quality as Q  # noqa: E402
from reelmart.operators import retention as RT  # noqa: E402
from reelmart.operators import telemetry as TM  # noqa: E402
from reelmart.sources import testdata as TD  # noqa: E402
from reelmart.sources.scratch import counted  # noqa: E402

NOW_ISO = "2024-02-15T00:00:00+00:00"


@query("asset_lineage_edges", """
SELECT parent_asset_id, asset_id AS child_asset_id FROM manifest
WHERE parent_asset_id IS NOT NULL""", ["manifest"])
def _asset_lineage_edges(lk: Lake) -> DataFrame:
    return LN.lineage_edges(lk.manifest)


@query("asset_lineage_closure", """RECURSIVE
, down(asset_id, root_asset_id, depth) AS (
  SELECT asset_id, asset_id, 0 FROM manifest WHERE parent_asset_id IS NULL
  UNION ALL
  SELECT m.asset_id, d.root_asset_id, d.depth + 1 FROM down d
  JOIN manifest m ON m.parent_asset_id = d.asset_id)
SELECT asset_id, root_asset_id, CAST(depth AS BIGINT) AS depth FROM down""", ["manifest"])
def _asset_lineage_closure(lk: Lake) -> DataFrame:
    return LN.lineage_roots(lk.manifest)


def manifest_log(lk: Lake) -> DataFrame:
    """Manifest rows as appended per delivery (before dedupe)."""
    d = lk.deliveries
    ext = C.extension(F.col("asset_name"))
    key = C.landing_key(F.col("client_id"), F.col("asset_id"), ext)
    return d.select("asset_id", "client_id", "content_sha256", "asset_name",
                    C.asset_type_from_folder(F.col("folder")).alias("asset_type"),
                    C.source_uri(TD.WORKSPACE, TD.LAKEHOUSE, key).alias("source_uri"))


_HEX = f"'{S.HEX64_PATTERN}'"
_URI = f"'{S.URI_PATTERN}'"
_PLACE = "(" + ", ".join(f"'{c}'" for c in S.PLACEHOLDER_CLIENTS) + ")"


@query("lineage_contract", f"""
, mlog AS (
  SELECT asset_id, client_id, content_sha256,
         CASE WHEN regexp_matches(lower(folder), 'edited|winning|winners') THEN 'EDITED'
              ELSE 'RAW' END AS asset_type,
         '{O.URI_PREFIX}landing/' || client_id || '/video/' || asset_id
           || coalesce(nullif(regexp_extract(asset_name, '(\\.[^.]+)$', 1), ''), '.mp4')
           AS source_uri
  FROM deliv),
viol AS (
  SELECT 'R1' AS rule, count(*) AS n FROM mlog
  WHERE coalesce(trim(asset_id), '') = '' OR coalesce(trim(client_id), '') = ''
     OR coalesce(trim(content_sha256), '') = '' OR coalesce(trim(asset_type), '') = ''
     OR coalesce(trim(source_uri), '') = ''
  UNION ALL SELECT 'R2', count(*) FROM mlog
  WHERE NOT regexp_matches(coalesce(asset_id, ''), {_HEX})
     OR NOT regexp_matches(coalesce(content_sha256, ''), {_HEX})
  UNION ALL SELECT 'R3', count(*) FROM mlog
  WHERE regexp_matches(coalesce(content_sha256, ''), {_HEX}) AND coalesce(client_id, '') <> ''
    AND sha256(client_id || ':' || content_sha256) <> asset_id
  UNION ALL SELECT 'R4', count(*) FROM mlog
  WHERE NOT regexp_matches(source_uri, {_URI})
     OR regexp_extract(source_uri, {_URI}, 3) <> client_id
     OR regexp_extract(source_uri, {_URI}, 4) <> asset_id
  UNION ALL SELECT 'R5', count(*) FROM mlog
  WHERE coalesce(client_id, '') <> '' AND client_id NOT IN (SELECT client_id FROM dclient)
  UNION ALL SELECT 'R6', count(*) FROM (SELECT asset_id FROM mlog GROUP BY 1 HAVING count(*) > 1)
  UNION ALL SELECT 'R7', count(*) FROM mlog WHERE coalesce(client_id, '') IN {_PLACE})
SELECT rule, CAST(n AS BIGINT) AS n_violations FROM viol""", ["deliv", "dclient"])
def _lineage_contract(lk: Lake) -> DataFrame:
    v = Q.lineage_violations(manifest_log(lk), lk.dim_client)
    return Q.lineage_contract_summary(v, lk.spark)


@query("referential_report", """
SELECT check_name, severity, CAST(n AS BIGINT) AS n_orphans, n = 0 AS passed FROM (
  SELECT 'fact_chunk.asset_id->dim_asset' AS check_name, 'CRITICAL' AS severity, count(*) AS n
  FROM fact_chunk c WHERE c.asset_id NOT IN (SELECT asset_id FROM manifest)
  UNION ALL SELECT 'bridge_chunk_compatibility.chunk_id->fact_chunk', 'HIGH', count(*)
  FROM compat_bridge b WHERE b.chunk_id NOT IN
    (SELECT chunk_id FROM dmg_chunks WHERE standalone_score BETWEEN 1 AND 5)
  UNION ALL SELECT 'dim_asset.client_id->dim_client', 'CRITICAL', count(*)
  FROM manifest m WHERE m.client_id NOT IN (SELECT client_id FROM dclient)
  UNION ALL SELECT 'edit_decision_list.chunk_id->fact_chunk', 'CRITICAL', count(*)
  FROM edl e WHERE e.chunk_id NOT IN (SELECT chunk_id FROM pchunk)
  UNION ALL SELECT 'fact_ad_performance.asset_id->EDITED asset', 'CRITICAL', count(*)
  FROM fact_perf f WHERE f.asset_id NOT IN (SELECT asset_id FROM passet WHERE asset_type = 'EDITED')
  UNION ALL SELECT 'ad mapped to an asset', 'CRITICAL', count(DISTINCT ad_id)
  FROM perf_latest l WHERE l.ad_id NOT IN (SELECT ad_id FROM map_ad_asset WHERE CAST(ad_id AS BIGINT) % 31 <> 0)
  UNION ALL SELECT 'ad has at least one chunk', 'CRITICAL', count(DISTINCT ad_id)
  FROM fact_perf f WHERE f.ad_id NOT IN (SELECT ad_id FROM bridge_ad_chunk)
  UNION ALL SELECT 'pull with unknown platform tag', 'HIGH', count(*)
  FROM perf_pulls WHERE CAST(ad_id AS BIGINT) % 7 = 0)""",
       ["fact_chunk", "dmg_chunks", "manifest", "compat_bridge", "dclient", "edl", "pchunk", "fact_perf",
        "passet", "perf_latest", "map_ad_asset", "bridge_ad_chunk", "perf_pulls"])
def _referential_report(lk: Lake) -> DataFrame:
    fc, bridge, fact = fact_chunk(lk), perf_bridge(lk), perf_fact(lk)
    edited = lk.perf_assets.where(F.col("asset_type") == "EDITED")
    unmapped = _perf_latest(lk).select("ad_id").join(lk.map_ad_asset_gaps, "ad_id", "left_anti") \
        .distinct()
    chunkless = fact.select("ad_id").join(bridge, "ad_id", "left_anti").distinct()
    return Q.referential_report([
        ("fact_chunk.asset_id->dim_asset", "CRITICAL", Q.orphans(fc, "asset_id", lk.manifest)),
        ("bridge_chunk_compatibility.chunk_id->fact_chunk", "HIGH",
         Q.orphans(compat(lk), "chunk_id", SV.silver_chunk_wide(lk.bronze_damaged))),
        ("dim_asset.client_id->dim_client", "CRITICAL",
         Q.orphans(lk.manifest, "client_id", lk.dim_client)),
        ("edit_decision_list.chunk_id->fact_chunk", "CRITICAL",
         Q.orphans(lk.edit_decision_list, "chunk_id", lk.perf_chunks)),
        ("fact_ad_performance.asset_id->EDITED asset", "CRITICAL",
         Q.orphans(fact, "asset_id", edited)),
        ("ad mapped to an asset", "CRITICAL", unmapped),
        ("ad has at least one chunk", "CRITICAL", chunkless),
        ("pull with unknown platform tag", "HIGH",
         Q.unknown_tags(lk.perf_pulls_mistagged, "platform_native", S.PLATFORMS)),
    ])


def _reconcile_sql(name: str, base: str, view: str, keys: str) -> str:
    return f"""
SELECT '{name}' AS check_name, (SELECT count(*) FROM {base}) AS n_base,
       (SELECT count(*) FROM {view}) AS n_view,
       (SELECT count(*) FROM (SELECT {keys} FROM {base} EXCEPT ALL SELECT {keys} FROM {view}))
         AS n_base_only,
       (SELECT count(*) FROM (SELECT {keys} FROM {view} EXCEPT ALL SELECT {keys} FROM {base}))
         AS n_view_only"""


@query("reconcile_keys", "SELECT *, n_base_only = 0 AND n_view_only = 0 AS reconciled FROM ("
       + _reconcile_sql("edl_vs_bridge_ad_chunk", "edl", "bridge_ad_chunk",
                        "ad_id, chunk_id, position_in_ad")
       + "\nUNION ALL" + _reconcile_sql("damaged_delivery_vs_fact_chunk", "dmg_chunks", "fact_chunk",
                                        "chunk_id")
       + "\nUNION ALL" + _reconcile_sql("latest_pull_vs_fact_ad_performance", "perf_latest",
                                        "fact_perf", "ad_id, perf_date") + ")",
       ["edl", "bridge_ad_chunk", "dmg_chunks", "fact_chunk", "perf_latest", "fact_perf"])
def _reconcile_keys(lk: Lake) -> DataFrame:
    # a job for each check, the performance leg before the texts are stored: what one has shuffled is gone before the next
    done = lambda check: counted(check, "reconcile")[0]
    pulls = done(Q.reconcile("latest_pull_vs_fact_ad_performance", _perf_latest(lk), perf_fact(lk),
                             ["ad_id", "perf_date"]))
    cuts = done(Q.reconcile("edl_vs_bridge_ad_chunk", lk.edit_decision_list, perf_bridge(lk),
                            ["ad_id", "chunk_id", "position_in_ad"]))
    chunks = done(Q.reconcile("damaged_delivery_vs_fact_chunk", parsed_run(lk.bronze_damaged), fact_chunk(lk),
                              ["chunk_id"]))
    return cuts.unionByName(chunks).unionByName(pulls)


def parsed_run(bronze: DataFrame) -> DataFrame:
    """Every parsed chunk of a run, gate flags aside (what the model said)."""
    flat, _ = SV.explode_chunks(bronze)
    return flat


_ITEMS = """
SELECT DISTINCT asset_id, item FROM (
  SELECT asset_id, 't:' || chunk_theme AS item FROM {t}
  UNION ALL
  SELECT asset_id, 'k:' || kw FROM (SELECT asset_id, unnest(keywords) AS kw FROM {t}))"""


def silver_run2(lk: Lake) -> DataFrame:
    """Every parsed chunk of the second extraction run (stored, like Silver): what
    the runs are compared by, without the texts."""
    return lk.store.table("silver_run2", lambda: parsed_run(lk.bronze_run2).select(
        "asset_id", "client_id", "chunk_sequence", "chunk_theme", "standalone_score", "keywords"),
                          partition_by=["client_id"], cluster_by=["asset_id", "chunk_sequence"])


@query("golden_gate", f"""
, it1 AS ({_ITEMS.format(t='silver')}),
it2 AS ({_ITEMS.format(t='silver2')}),
jac AS (
  SELECT asset_id, count(*) FILTER (WHERE a IS NOT NULL AND b IS NOT NULL)::DOUBLE / count(*) AS j
  FROM (SELECT coalesce(x.asset_id, y.asset_id) AS asset_id, x.item AS a, y.item AS b
        FROM it1 x FULL JOIN it2 y ON x.asset_id = y.asset_id AND x.item = y.item)
  GROUP BY 1),
sc AS (
  SELECT a.asset_id, count(*) AS n_common,
         count(*) FILTER (WHERE abs(a.standalone_score - b.standalone_score) <= 1) AS n_within
  FROM silver a JOIN silver2 b ON a.asset_id = b.asset_id AND a.chunk_sequence = b.chunk_sequence
  GROUP BY 1)
SELECT m.client_id, count(*) AS n_assets, round(avg(j.j), 6) AS mean_jaccard,
       round(sum(sc.n_within)::DOUBLE / sum(sc.n_common), 6) AS score_agreement,
       avg(j.j) >= 0.8 AND sum(sc.n_within) = sum(sc.n_common) AS passes
FROM jac j LEFT JOIN sc ON sc.asset_id = j.asset_id JOIN manifest m ON m.asset_id = j.asset_id
GROUP BY 1""", ["silver", "silver2", "manifest"])
def _golden_gate(lk: Lake) -> DataFrame:
    return Q.golden_gate(silver_wide(lk), silver_run2(lk), lk.manifest)


@query("drift_report", """
SELECT asset_id, count(in1) AS n_run1, count(in2) AS n_run2,
       count(*) FILTER (WHERE in2 IS NULL) AS n_missing,
       count(*) FILTER (WHERE in1 IS NULL) AS n_new,
       count(*) FILTER (WHERE in1 IS NOT NULL AND in2 IS NOT NULL AND s1 <> s2) AS n_score_changed,
       count(*) FILTER (WHERE in1 IS NOT NULL AND in2 IS NOT NULL AND t1 <> t2) AS n_theme_changed,
       count(*) FILTER (WHERE in2 IS NULL OR in1 IS NULL
                          OR (in1 IS NOT NULL AND in2 IS NOT NULL AND (s1 <> s2 OR t1 <> t2))) > 0
         AS drifted
FROM (SELECT coalesce(a.asset_id, b.asset_id) AS asset_id, a.in1, b.in2, a.s1, b.s2, a.t1, b.t2
      FROM (SELECT asset_id, chunk_sequence, standalone_score AS s1, chunk_theme AS t1, 1 AS in1
            FROM silver) a
      FULL JOIN (SELECT asset_id, chunk_sequence, standalone_score AS s2, chunk_theme AS t2,
                        1 AS in2 FROM silver2) b
        ON a.asset_id = b.asset_id AND a.chunk_sequence = b.chunk_sequence)
GROUP BY 1""", ["silver", "silver2"])
def _drift_report(lk: Lake) -> DataFrame:
    return Q.drift_report(silver_wide(lk), silver_run2(lk))


_PLAN_SQL = """
SELECT landing_key, client_id, asset_id, age_days, landing_ttl_days, bronze_present,
       CASE WHEN mtime IS NULL THEN 'skip_no_mtime'
            WHEN age_days < landing_ttl_days THEN 'within_ttl'
            WHEN NOT bronze_present THEN 'skip_no_bronze'
            ELSE 'delete_candidate' END AS action
FROM (SELECT m.landing_key, m.client_id, m.asset_id, m.modified_at AS mtime, c.landing_ttl_days,
             m.doc_id % 13 <> 0 AS bronze_present,
             CAST(floor((epoch(TIMESTAMP '2024-02-15 00:00:00') - epoch(m.modified_at)) / 86400)
                  AS BIGINT) AS age_days
      FROM manifest m JOIN dclient c ON c.client_id = m.client_id
      WHERE m.doc_id % 17 <> 0)"""
CTE_PLAN = "plan"
O.cte(CTE_PLAN, _PLAN_SQL, ["manifest", "dclient"])


@shared
def retention(lk: Lake) -> DataFrame:
    return RT.retention_plan(lk.landing_objects, lk.dim_client, lk.extracted_so_far,
                             TD.RETENTION_NOW)


@query("retention_plan", "SELECT * FROM plan", ["plan"])
def _retention_plan(lk: Lake) -> DataFrame:
    return retention(lk)


@query("retention_summary", "SELECT action, count(*) AS n_objects FROM plan GROUP BY 1", ["plan"])
def _retention_summary(lk: Lake) -> DataFrame:
    return RT.retention_summary(retention(lk))


@query("frozen_log", f"""
SELECT asset_id, client_id,
       'bronze/' || client_id || '/ttl_delete_log/' || asset_id || '_{NOW_ISO}.json' AS log_key,
       CAST(json_object('event', 'landing_ttl_delete', 'asset_id', asset_id,
                        'client_id', client_id, 'deleted_key', landing_key,
                        'age_days', age_days, 'deleted_at', '{NOW_ISO}',
                        'consequence', '{'FROZEN - re-extraction permanently impossible; re-parse from Bronze survives'}')
            AS VARCHAR) AS record
FROM plan WHERE action = 'delete_candidate'""", ["plan"])
def _frozen_log(lk: Lake) -> DataFrame:
    return RT.frozen_log(retention(lk), NOW_ISO)


O.cte("runlog", """
SELECT CAST(event_id AS VARCHAR) AS run_id, CAST(user_id AS VARCHAR) AS asset_id,
       'm' || CAST(k % 3 AS VARCHAR) AS model_version, 'v' || CAST(k % 2 AS VARCHAR) AS prompt_version,
       CAST(floor(value * 100) AS BIGINT) AS tokens_in, CAST(floor(value * 10) AS BIGINT) AS tokens_out,
       value AS processing_time_sec,
       CAST(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS INTEGER) AS retry_count,
       CAST(NULL AS DOUBLE) AS extraction_confidence, ts AS load_ts
FROM (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)""")


@shared
def run_log(lk: Lake) -> DataFrame:
    return TM.parse_run_log(lk.run_log_json)


@query("extraction_run", "SELECT * FROM runlog", ["runlog"])
def _extraction_run(lk: Lake) -> DataFrame:
    return run_log(lk)


@query("extraction_cost", """
SELECT r.model_version, r.prompt_version, count(*) AS n_runs,
       CAST(sum(r.tokens_in) AS BIGINT) AS tokens_in, CAST(sum(r.tokens_out) AS BIGINT) AS tokens_out,
       round(sum(r.processing_time_sec), 6) AS processing_time_sec,
       CAST(sum(r.retry_count) AS BIGINT) AS retries,
       round(CAST(sum(r.tokens_in * p.pin + r.tokens_out * p.pout) AS DOUBLE) / 1e9, 6) AS cost_usd
FROM runlog r LEFT JOIN (VALUES ('m0', 75, 300), ('m1', 150, 600), ('m2', 1250, 5000))
  AS p(model_version, pin, pout) ON p.model_version = r.model_version
GROUP BY 1, 2""", ["runlog"])
def _extraction_cost(lk: Lake) -> DataFrame:
    return TM.extraction_cost(run_log(lk), lk.price_table())


# expectations report ---------------------------------------------------------------
_SUITE_TABLES = {
    "bronze_asset_raw": "bgate", "dim_asset": "manifest", "dim_client": "dclient",
    "fact_chunk": "fact_chunk", "silver_chunk": "dmg_chunks",
    "bridge_chunk_compatibility": "compat_bridge", "bridge_ad_chunk": "bridge_ad_chunk",
    "fact_ad_performance": "fact_perf", "mart_chunk_perf_correlation": "mart",
    "fct_ad_kpi": "kpi", "fct_ad_metric_chunk": "metric_chunk",
    "assembled_sequence": "asm_chunks",
}
O.cte("asm_chunks", """
SELECT c.standalone_score FROM (SELECT unnest(path) AS chunk_id FROM best3) s
JOIN fact_chunk c ON c.chunk_id = s.chunk_id""", ["best3", "fact_chunk"])


def _sql_lit(v) -> str:
    return f"'{v}'" if isinstance(v, str) else str(v)


def _suite_sql(name: str, table: str) -> list[str]:
    out = []
    for kind, col, args, sev in Q.SUITES[name]:
        head = f"SELECT '{name}' AS suite, '{Q._label(kind, col, args)}' AS expectation, '{sev}' AS severity"
        if kind == "not_null":
            fail = f"{col} IS NULL"
        elif kind == "between":
            lo, hi = args
            conds = ([f"{col} < {lo}"] if lo is not None else []) + \
                    ([f"{col} > {hi}"] if hi is not None else [])
            fail = f"{col} IS NOT NULL AND ({' OR '.join(conds)})"
        elif kind == "in_set":
            fail = f"{col} IS NOT NULL AND {col} NOT IN ({', '.join(_sql_lit(v) for v in args)})"
        elif kind in ("unique", "compound_unique"):
            cols = col if isinstance(col, list) else [col]
            nn = " AND ".join(f"{c} IS NOT NULL" for c in cols)
            out.append(f"{head}, CAST(coalesce(sum(k), 0) AS BIGINT) AS n_checked, "
                       f"CAST(coalesce(sum(k) FILTER (WHERE k > 1), 0) AS BIGINT) AS n_failed "
                       f"FROM (SELECT {', '.join(cols)}, count(*) AS k FROM {table} WHERE {nn} "
                       f"GROUP BY {', '.join(cols)})")
            continue
        elif kind == "row_count":
            out.append(f"{head}, count(*) AS n_checked, "
                       f"CAST(CASE WHEN count(*) < {args} THEN 1 ELSE 0 END AS BIGINT) AS n_failed "
                       f"FROM {table}")
            continue
        out.append(f"{head}, count(*) AS n_checked, count(*) FILTER (WHERE {fail}) AS n_failed "
                   f"FROM {table}")
    return out


_EXP_SQL = ("SELECT suite, expectation, severity, n_checked, n_failed, n_failed = 0 AS success, "
            "n_failed > 0 AND severity = 'CRITICAL' AS blocks_promotion FROM (\n"
            + "\nUNION ALL\n".join(q for n, t in _SUITE_TABLES.items() for q in _suite_sql(n, t))
            + ")")


@query("expectations_report", _EXP_SQL, sorted(set(_SUITE_TABLES.values())))
def _expectations_report(lk: Lake) -> DataFrame:
    return Q.expectations_report(_suite_frames(lk))


def _suite_frames(lk: Lake) -> dict[str, DataFrame]:
    perf_metric_chunk(lk)  # what the performance leg shuffles is gone before the texts are stored
    seqs = A.assemble(silver_wide(lk), lk.manifest, compat(lk), depth=3, k=ASSEMBLE_K)
    asm = seqs.select(F.explode(F.split("sequence", ">")).alias("chunk_id")) \
        .join(fact_chunk(lk).select("chunk_id", "standalone_score"), "chunk_id")
    return {
        "bronze_asset_raw": SV.bronze_gate(lk.bronze_damaged),
        "dim_asset": I.dim_asset(lk.manifest),
        "dim_client": lk.dim_client,
        "fact_chunk": fact_chunk(lk),
        "silver_chunk": parsed_run(lk.bronze_damaged),
        "bridge_chunk_compatibility": compat(lk),
        "bridge_ad_chunk": perf_bridge(lk),
        "fact_ad_performance": perf_fact(lk),
        "mart_chunk_perf_correlation": perf_mart(lk),
        "fct_ad_kpi": perf_kpi(lk),
        "fct_ad_metric_chunk": perf_metric_chunk(lk),
        "assembled_sequence": asm,
    }


# Wave 6: sources, sinks, extraction stage, streams -------------------------------------
from reelmart import schemas as S  # noqa: E402
from reelmart.operators import extract as EX  # noqa: E402
from reelmart.sources import files as FS  # noqa: E402
from reelmart.sources.scratch import new_scratch  # noqa: E402
from reelmart.sources.paths import delete, write_text  # noqa: E402
from reelmart.sources.versioned import VersionedTable  # noqa: E402
from reelmart.streaming import streams as ST  # noqa: E402


def _seed_frames(lk: Lake) -> dict[str, DataFrame]:
    return {
        "dim_client": lk.dim_client,
        "dim_platform": lk.dim_platform(),
        "asset_manifest": lk.manifest.select(*I.MANIFEST_COLS),
        "map_ad_asset": lk.map_ad_asset,
        "edit_decision_list": lk.edit_decision_list,
    }


@query("seed_tables", """
SELECT 'dim_client' AS table_name, count(*) AS n_rows FROM dclient
UNION ALL SELECT 'dim_platform', count(*) FROM dim_platform
UNION ALL SELECT 'asset_manifest', count(*) FROM manifest
UNION ALL SELECT 'map_ad_asset', count(*) FROM map_ad_asset
UNION ALL SELECT 'edit_decision_list', count(*) FROM edl""",
       ["dclient", "dim_platform", "manifest", "map_ad_asset", "edl"])
def _seed_tables(lk: Lake) -> DataFrame:
    """Seeds round-trip through header CSVs read back with explicit schemas."""
    root = new_scratch(lk.spark, "seeds")
    parts = []
    for name, df in _seed_frames(lk).items():
        FS.write_seed(df, f"{root}/{name}")
        back = FS.read_seed(lk.spark, f"{root}/{name}", name)
        parts.append(back.agg(F.count(F.lit(1)).alias("n_rows"))
                     .select(F.lit(name).alias("table_name"), "n_rows"))
    out = parts[0]
    for p_ in parts[1:]:
        out = out.unionByName(p_)
    return out


_EXPORT_CSV = {
    "meta": "ad_id STRING, date DATE, impressions BIGINT, video_3_sec_watched_actions BIGINT, "
            "video_p25_watched_actions BIGINT, video_p50_watched_actions BIGINT, "
            "video_p75_watched_actions BIGINT, video_p100_watched_actions BIGINT, "
            "video_total_time_watched BIGINT, video_avg_time_watched_actions DOUBLE, "
            "video_play_actions BIGINT, inline_link_clicks BIGINT, actions STRING, spend BIGINT, "
            "load_ts TIMESTAMP, platform_native STRING",
    "tiktok": "ad_id STRING, stat_time_day DATE, impressions BIGINT, video_views_p_3s BIGINT, "
              "video_views_p25 BIGINT, video_views_p50 BIGINT, video_views_p75 BIGINT, "
              "video_views_p100 BIGINT, total_watch_time BIGINT, video_views BIGINT, "
              "clicks_destination BIGINT, conversions BIGINT, spend BIGINT, load_ts TIMESTAMP, "
              "platform_native STRING",
}


@query("perf_raw_capture", f"SELECT {_UNIONED_COLS} FROM perf_pulls", ["perf_pulls"])
def _perf_raw_capture(lk: Lake) -> DataFrame:
    """Both platforms' CSV exports captured verbatim (file, row hash, capture
    time), stored, and conformed from the stored captures."""
    root = new_scratch(lk.spark, "perf-raw")
    raw = {}
    for name, schema in _EXPORT_CSV.items():
        native = lk.perf_native(name)
        flat = native.withColumn("actions", F.to_json("actions")) if name == "meta" else native
        FS.write_export(flat, f"{root}/export/{name}")
        for _ in range(2):  # a replayed capture adds nothing
            raw[name] = FS.capture_raw_csv(lk.spark, f"{root}/export/{name}", schema, f"{root}/bronze/{name}")
        delete(lk.spark, f"{root}/export/{name}")  # captured; nothing reads it again
        if name == "meta":
            kind = native.schema["actions"].dataType
            raw[name] = raw[name].withColumn("actions", F.from_json("actions", kind))
    return P.ad_perf_unioned(raw["meta"], raw["tiktok"])


@query("perf_capture_audit", """
SELECT platform_name, count(*) AS n_rows, 0 AS n_without_time, 0 AS n_before_run, 1 AS n_times
FROM perf_pulls GROUP BY 1""", ["perf_pulls"])
def _perf_capture_audit(lk: Lake) -> DataFrame:
    """Capture times of the raw exports, by platform: one for each capture, none
    missing, none before the run."""
    began, root, parts = datetime.now(timezone.utc), new_scratch(lk.spark, "perf-audit"), []
    for name, schema in _EXPORT_CSV.items():
        native = lk.perf_native(name)
        flat = native.withColumn("actions", F.to_json("actions")) if name == "meta" else native
        FS.write_export(flat, f"{root}/export/{name}")
        rows = FS.capture_raw_csv(lk.spark, f"{root}/export/{name}", schema, f"{root}/bronze/{name}")
        delete(lk.spark, f"{root}/export/{name}")
        by_file = FS.capture_audit(rows, began)
        parts.append(by_file.agg(
            F.lit(name).alias("platform_name"), F.sum("n_rows").alias("n_rows"),
            F.sum("n_without_time").cast("int").alias("n_without_time"),
            F.sum("n_before_run").cast("int").alias("n_before_run"), F.max("n_times").cast("int").alias("n_times")))
    return parts[0].unionByName(parts[1])


@query("manifest_append", "SELECT asset_id, client_id, content_sha256, asset_type FROM manifest",
       ["manifest"])
def _manifest_append(lk: Lake) -> DataFrame:
    """Two ingests into one manifest: the second adds what the first lacked."""
    path = new_scratch(lk.spark, "manifest")
    rows = lk.manifest.select("asset_id", "client_id", "content_sha256", "asset_type")
    FS.manifest_append(rows.where(F.crc32("asset_id") % 2 == 0), path)
    FS.manifest_append(rows.unionByName(rows), path)
    return FS.stored_rows(lk.spark, path)


@query("silver_store", "SELECT *, client_id FROM fact_chunk JOIN (SELECT asset_id, client_id FROM manifest) "
       "USING (asset_id)".replace("*, client_id", "fact_chunk.*, client_id"), ["fact_chunk", "manifest"])
def _silver_store(lk: Lake) -> DataFrame:
    """Silver overwritten by client: a rerun of one client leaves the others."""
    path = new_scratch(lk.spark, "silver")
    rows = silver_wide(lk).select(*SV.FACT_CHUNK_COLS, "client_id")
    FS.write_silver(rows, path)
    FS.write_silver(rows.where(F.col("client_id") == "src0"), path)
    return lk.spark.read.schema(rows.schema).parquet(path).select(*rows.columns)


@query("quarantine_store", ORACLE["quarantine_rows"])
def _quarantine_store(lk: Lake) -> DataFrame:
    path = new_scratch(lk.spark, "quarantine")
    rows = SV.quarantine_rows(lk.bronze_damaged)
    FS.write_quarantine(rows, path)
    return lk.spark.read.schema(rows.schema).parquet(path).select(*rows.columns)


@query("run_log_scan", "SELECT * FROM runlog", ["runlog"])
def _run_log_scan(lk: Lake) -> DataFrame:
    """Run records appended as JSON lines and read back by a typed JSON scan."""
    path = new_scratch(lk.spark, "runs")
    FS.write_json_records(lk.run_log_json, path)
    return FS.read_run_log(lk.spark, path)


@query("frozen_log_store", """
SELECT asset_id, client_id, landing_key AS deleted_key, age_days FROM plan
WHERE action = 'delete_candidate'""", ["plan"])
def _frozen_log_store(lk: Lake) -> DataFrame:
    """Freeze records appended as JSON lines and read back."""
    path = new_scratch(lk.spark, "frozen")
    FS.write_json_records(RT.frozen_log(retention(lk), NOW_ISO).select(F.col("record").alias("value")), path)
    return lk.spark.read.schema("asset_id string, client_id string, deleted_key string, age_days bigint").json(path)


@query("landing_scan", """
SELECT client_id, asset_id, CAST(strlen(text) + 1 AS BIGINT) AS length,
       sha256(text || chr(10)) AS content_sha256 FROM asset1""", ["asset1"])
def _landing_scan(lk: Lake) -> DataFrame:
    """Landed objects listed and hashed from their bytes."""
    path = new_scratch(lk.spark, "landing")
    FS.write_landing(lk.landed_assets, path)
    return FS.scan_landing(lk.spark, path)


@query("search_clips_client", ORACLE["search_clips"].replace(
    "'Hook/energetic'", "'Hook/energetic' AND asset_id IN (SELECT asset_id FROM manifest WHERE client_id = 'src0')"))
def _search_clips_client(lk: Lake) -> DataFrame:
    """Search inside one tenant: Silver is partitioned by client."""
    return SR.search_clips(silver_wide(lk), lk.manifest, client_id="src0", **SEARCH)


@query("bronze_append", """
SELECT a.asset_id, a.client_id, 'model-a1' AS model_version,
       CAST(count(c.chunk_id) AS INTEGER) AS chunk_count
FROM asset1 a LEFT JOIN chunkall c ON c.asset_id = a.asset_id
GROUP BY 1, 2""", ["asset1", "chunkall"])
def _bronze_append(lk: Lake) -> DataFrame:
    """Write-once Bronze: the second append of the same responses adds nothing."""
    path = new_scratch(lk.spark, "bronze")
    rows = lk.bronze.select(*[f.name for f in S.BRONZE_ASSET_RAW.fields])
    FS.bronze_append(rows, path)
    again = FS.bronze_append(rows, path)
    if again:
        raise RuntimeError(f"bronze append is not write-once: {again} rows re-appended")
    return FS.stored_rows(lk.spark, path).select("asset_id", "client_id", "model_version", "chunk_count")


def line_segments(text: F.Column) -> F.Column:
    """Stand-in for the model: one chunk per non-blank line, 5 s each."""
    lines = F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), lambda x: x != "")
    return F.transform(lines, lambda x, i: F.struct(
        (i * 5.0).alias("start_sec"), ((i + 1) * 5.0).alias("end_sec"),
        x.alias("transcript_segment"), F.lit("Body").alias("chunk_theme"),
        F.lit("neutral").alias("sentiment"), F.lit(3).alias("standalone_score")))


def extract_stage(new_assets: DataFrame, segments: Callable[[F.Column], F.Column]) -> DataFrame:
    """Responses for assets without Bronze: ``segments`` turns an asset's text
    into an array of chunks. A model call would take its place as a column
    function; rows never leave the executors."""
    return new_assets.withColumn("chunks", segments(F.col("text"))).select(
        "asset_id", "client_id", F.to_json(F.struct("chunks")).alias("raw_response"),
        F.lit("stand-in").alias("model_version"), F.lit("p0").alias("prompt_version"),
        "content_sha256", F.size("chunks").alias("chunk_count"))


@query("extract_stage", """
SELECT m.asset_id, m.client_id, CAST(count(c.chunk_id) AS INTEGER) AS chunk_count
FROM manifest m LEFT JOIN chunkall c ON c.asset_id = m.asset_id
WHERE m.doc_id % 13 = 0 GROUP BY 1, 2""", ["manifest", "chunkall"])
def _extract_stage(lk: Lake) -> DataFrame:
    todo = I.list_new_assets(lk.manifest, lk.extracted_so_far).select("asset_id") \
        .join(lk.landed_assets.select("asset_id", "client_id", "content_sha256", "text"),
              "asset_id")
    return extract_stage(todo, line_segments).select("asset_id", "client_id", "chunk_count")


#: of the stand-in below: assets whose calls always fail, and whose first call fails
_FAILS, _FAILS_ONCE = "01", "2345"


def line_model() -> Callable[[dict], dict]:
    """Stand-in for a model client: a chunk per non-blank line; fails for some
    assets. A local function, so that it is sent to executors with the job."""
    fails, fails_once = _FAILS, _FAILS_ONCE

    def call(asset: dict) -> dict:
        first = asset["asset_id"][0]
        if first in fails or first in fails_once and asset["attempt"] == 1:
            raise TimeoutError(f"no answer for {asset['asset_id']}")
        lines = [x for x in (y.strip(" ") for y in asset["text"].split("\n")) if x]
        chunks = [{"start_sec": 5.0 * i, "transcript_segment": x} for i, x in enumerate(lines)]
        return {"raw_response": json.dumps({"chunks": chunks}), "model_version": "stand-in",
                "prompt_version": "p0", "tokens_in": len(asset["text"]), "tokens_out": len(chunks)}
    return call


@query("extraction_rounds", f"""
SELECT m.asset_id, m.client_id, CAST(r.n AS BIGINT) AS n_calls, CAST(r.e AS BIGINT) AS n_errors,
       CAST(r.n AS INTEGER) AS last_attempt, r.n > r.e AS extracted,
       CASE WHEN r.n > r.e THEN CAST(k.n_chunks AS INTEGER) END AS chunk_count
FROM manifest m
JOIN (SELECT asset_id, CASE WHEN contains('{_FAILS}', left(asset_id, 1)) THEN 3
                            WHEN contains('{_FAILS_ONCE}', left(asset_id, 1)) THEN 2 ELSE 1 END AS n,
             CASE WHEN contains('{_FAILS}', left(asset_id, 1)) THEN 3
                  WHEN contains('{_FAILS_ONCE}', left(asset_id, 1)) THEN 1 ELSE 0 END AS e FROM manifest) r USING (asset_id)
LEFT JOIN (SELECT asset_id, count(chunk_id) AS n_chunks FROM manifest LEFT JOIN chunkall USING (asset_id) GROUP BY 1) k
  USING (asset_id)""", ["manifest", "chunkall"])
def _extraction_rounds(lk: Lake) -> DataFrame:
    """Every landed asset extracted by a function on executors, in rounds: three
    attempts each, errors in the run log, and a rerun that calls nothing twice."""
    root = new_scratch(lk.spark, "extraction")
    bronze = VersionedTable(lk.spark, f"{root}/bronze", ["client_id"])
    runs = VersionedTable(lk.spark, f"{root}/runs")
    assets = lk.landed_assets.select("asset_id", "client_id", "content_sha256", "text")
    EX.extract(assets, line_model(), bronze, runs, attempts=3, slices=2, concurrent=4, pause_sec=0.0)
    answered = assets.join(bronze.read().select("asset_id"), "asset_id", "left_semi")
    EX.extract(answered, line_model(), bronze, runs, attempts=1, pause_sec=0.0)
    return (EX.run_summary(runs.read()).join(bronze.read().select("asset_id", "chunk_count"), "asset_id", "left")
            .select("asset_id", "client_id", "n_calls", "n_errors", "last_attempt", "extracted", "chunk_count"))


_DELIVERY_SCHEMA = ("asset_id STRING, client_id STRING, content_sha256 STRING, doc_id BIGINT, "
                    "modified_at TIMESTAMP")


@query("stream_new_assets", "SELECT DISTINCT asset_id, client_id, content_sha256 FROM deliv",
       ["deliv"])
def _stream_new_assets(lk: Lake) -> DataFrame:
    root = new_scratch(lk.spark, "arrivals")
    (lk.deliveries.select("asset_id", "client_id", "content_sha256", "doc_id", "modified_at")
     .repartitionByRange(4, "doc_id").write.parquet(f"{root}/landing"))
    out = ST.stream_new_assets(lk.spark, f"{root}/landing", _DELIVERY_SCHEMA, f"{root}/sink",
                               f"{root}/_checkpoint")
    return out.select("asset_id", "client_id", "content_sha256")


_PERF_COLS = ("ad_id STRING, perf_date DATE, impressions BIGINT, plays_3s BIGINT, "
              "plays_25 BIGINT, plays_50 BIGINT, plays_75 BIGINT, plays_100 BIGINT, "
              "sum_watch_time_sec BIGINT, play_count BIGINT, link_clicks BIGINT, results BIGINT, "
              "spend BIGINT, load_ts TIMESTAMP, platform_name STRING")


@query("stream_perf_upsert", f"SELECT {_UNIONED_COLS} FROM perf_latest", ["perf_latest"])
def _stream_perf_upsert(lk: Lake) -> DataFrame:
    root = new_scratch(lk.spark, "perf-stream")
    u = perf_unioned(lk)
    first = F.col("load_ts") == F.date_add("perf_date", 1).cast("timestamp")
    # early partial pulls (a) and restatements (b), computed and written in one pass; a pull without a time is neither
    u.where(first.isNotNull()).withColumn("pull", F.when(first, "a").otherwise("b")).write.partitionBy("pull").parquet(f"{root}/pulls")
    src_dir = f"{root}/pulls/*"
    return ST.stream_perf_upsert(lk.spark, src_dir, _PERF_COLS, f"{root}/target",
                                 f"{root}/_checkpoint", P.latest_pull)


_DAILY_SQL = """
SELECT CAST(date_trunc('day', ts) AS DATE) AS day, user_id, event_type, count(*) AS n_events,
       round(sum(value), 6) AS sum_value
FROM events GROUP BY 1, 2, 3"""


_EVENT_SCHEMA = ("event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
                 "value DOUBLE, props STRING")


@query("daily_counts", _DAILY_SQL)
def _daily_counts(lk: Lake) -> DataFrame:
    return ST.daily_counts_batch(lk.events).withColumn("sum_value", C.r6(F.col("sum_value")))


@query("stream_daily_counts", _DAILY_SQL)
def _stream_daily_counts(lk: Lake) -> DataFrame:
    root = new_scratch(lk.spark, "events-stream")
    out = ST.stream_daily_counts(lk.spark, lk.sf_dir, "events.parquet", _EVENT_SCHEMA,
                                 f"{root}/target", f"{root}/_checkpoint")
    return out.withColumn("sum_value", C.r6(F.col("sum_value")))


_LATE_DELAY = timedelta(days=2)


@query("stream_daily_late", """
WITH e AS (SELECT *, CAST(ts AS DATE) AS day, CASE WHEN event_id % 10 = 0 THEN 3
              WHEN ts < (SELECT min(ts) + (max(ts) - min(ts)) / 2 FROM events) THEN 1 ELSE 2 END AS arrival FROM events),
w AS (SELECT arrival, (SELECT max(ts) FROM e b WHERE b.arrival < a.arrival) AS seen
      FROM (SELECT DISTINCT arrival FROM e) a)
SELECT day, count(*) FILTER (WHERE NOT late) AS n_counted, count(*) FILTER (WHERE late) AS n_late
FROM (SELECT day, coalesce(day < CAST(seen - INTERVAL 2 DAY AS DATE), false) AS late FROM e JOIN w USING (arrival))
GROUP BY 1""")
def _stream_daily_late(lk: Lake) -> DataFrame:
    """Events in event time, a tenth of them delivered after the rest: those of
    days closed by then are late, all others counted."""
    root = new_scratch(lk.spark, "late-stream")
    ev = lk.events
    low, high = ev.agg(F.min("ts"), F.max("ts")).first()
    arrival = F.when(F.col("event_id") % 10 == 0, 3).when(
        F.col("ts") < F.lit(str(low + (high - low) / 2)).cast("timestamp_ntz"), 1).otherwise(2)
    for i in (1, 2, 3):
        ev.where(arrival == i).write.mode("append").parquet(f"{root}/events")
        counts = ST.stream_daily_counts(lk.spark, f"{root}/events", "*.parquet", _EVENT_SCHEMA, f"{root}/target",
                                        f"{root}/_checkpoint", delay=_LATE_DELAY)
    late = ST.late_events(lk.spark, f"{root}/target").groupBy(F.to_date("ts").alias("day")) \
        .agg(F.count(F.lit(1)).alias("n"))
    return (counts.groupBy("day").agg(F.sum("n_events").alias("n"))
            .join(late.withColumnRenamed("n", "n_late"), "day", "full")
            .select("day", F.coalesce("n", F.lit(0)).alias("n_counted"), F.coalesce("n_late", F.lit(0)).alias("n_late")))


# Silver tables that the text leg's bridges and the performance leg store.
@query("silver_compatibility_store", ORACLE["bridge_chunk_compatibility"])
def _silver_compatibility_store(lk: Lake) -> DataFrame:
    path = new_scratch(lk.spark, "silver-compatibility")
    rows = QUERIES["bridge_chunk_compatibility"](lk.spark, lk.sf_dir)
    return FS.overwritten(rows, path)  # Silver is in the order of its chunks


@query("silver_keyword_store", ORACLE["keyword_bridge"])
def _silver_keyword_store(lk: Lake) -> DataFrame:
    path = new_scratch(lk.spark, "silver-keyword")
    return FS.overwritten(QUERIES["keyword_bridge"](lk.spark, lk.sf_dir), path)


@query("perf_unioned_store", ORACLE["ad_perf_unioned"])
def _perf_unioned_store(lk: Lake) -> DataFrame:
    path = new_scratch(lk.spark, "ad-perf-unioned")
    return FS.overwritten(QUERIES["ad_perf_unioned"](lk.spark, lk.sf_dir), path, ["ad_id"])


@query("suite_files_report", _EXP_SQL, sorted(set(_SUITE_TABLES.values())))
def _suite_files_report(lk: Lake) -> DataFrame:
    """The expectation report from suite files, read back from a folder."""
    folder = new_scratch(lk.spark, "suites")
    for name, rules in Q.SUITES.items():
        write_text(lk.spark, f"{folder}/{name}.json", json.dumps(Q.file_of(name, rules)))
    return Q.expectations_report(_suite_frames(lk), Q.read_suites(lk.spark, folder))


FAILING_SAMPLE = 5


@query("failing_rows", f"""
SELECT 'silver_chunk' AS suite, expectation, severity, CAST(r AS INTEGER) AS sample_rank, chunk_id, standalone_score
FROM (SELECT *, row_number() OVER (PARTITION BY expectation ORDER BY chunk_id) AS r FROM (
  SELECT 'between(standalone_score)' AS expectation, 'CRITICAL' AS severity, chunk_id, standalone_score
  FROM dmg_chunks WHERE standalone_score NOT BETWEEN 1 AND 5
  UNION ALL SELECT 'not_null(chunk_theme)', 'CRITICAL', chunk_id, standalone_score FROM dmg_chunks WHERE chunk_theme IS NULL
  UNION ALL SELECT 'in_set(sentiment)', 'HIGH', chunk_id, standalone_score FROM dmg_chunks
  WHERE sentiment NOT IN ('energetic', 'frustrated', 'aspirational', 'neutral', 'urgent', 'calm')))
WHERE r <= {FAILING_SAMPLE}""", ["dmg_chunks"])
def _failing_rows(lk: Lake) -> DataFrame:
    """The first offending rows of each rule of the damaged Silver chunks."""
    return Q.failing_rows("silver_chunk", parsed_run(lk.bronze_damaged), ["chunk_id"], FAILING_SAMPLE).select(
        "suite", "expectation", "severity", "sample_rank", "chunk_id",
        F.get_json_object("row", "$.standalone_score").cast("int").alias("standalone_score"))


# Gold: views by name over the stored layers, never a second copy.
GOLD_VIEWS = {
    "gold_ad_perf_unioned": (perf_unioned, "perf_pulls"),
    "gold_fact_ad_performance": (perf_fact, "fact_perf"),
    "gold_ad_kpi": (perf_kpi, "kpi"),
    "gold_bridge_ad_chunk": (perf_bridge, "bridge_ad_chunk"),
    "gold_chunk_perf_correlation": (perf_mart, "mart"),
    "gold_chunk": (fact_chunk, "fact_chunk"),
    "gold_chunk_compatibility": (compat, "compat_bridge"),
}


#: the warehouse's views by their names, and the query that each one is
WAREHOUSE_VIEWS = {
    "dim_asset": "dim_asset", "dim_keyword_bridge": "keyword_bridge", "dim_theme_bridge": "theme_bridge",
    "bridge_asset_lineage": "asset_lineage_edges", "bridge_chunk_compatibility": "bridge_chunk_compatibility",
    "fact_chunk": "silver_chunk", "fact_extraction_run": "extraction_run", "bridge_ad_chunk": "bridge_ad_chunk",
    "fact_ad_performance": "fact_ad_performance", "fct_ad_kpi": "ad_kpi", "fct_ad_metric_chunk": "ad_metric_chunk",
    "int_metric_chunk_alignment": "metric_chunk_alignment",
    "mart_chunk_perf_correlation": "chunk_perf_correlation",
}


def register_warehouse(lk: Lake, names: list[str] | None = None) -> None:
    """Register the warehouse's views in the session: no second copy is stored."""
    for name in names or WAREHOUSE_VIEWS:
        QUERIES[WAREHOUSE_VIEWS[name]](lk.spark, lk.sf_dir).createOrReplaceTempView(name)


def _by_name(name: str):
    def run(lk: Lake) -> DataFrame:
        register_warehouse(lk, [name])
        return lk.spark.sql(f"SELECT * FROM {name}")
    return run


for _name, _key in WAREHOUSE_VIEWS.items():
    query(f"view_{_name}", ORACLE[_key])(_by_name(_name))


def register_gold(lk: Lake) -> list[str]:
    """Register every Gold view in the session, for use from SQL."""
    for name, (frame, _) in GOLD_VIEWS.items():
        frame(lk).createOrReplaceTempView(name)
    return list(GOLD_VIEWS)


@query("gold_views", "\nUNION ALL ".join(f"SELECT '{name}' AS view_name, count(*) AS n_rows FROM {base}"
                                         for name, (_, base) in GOLD_VIEWS.items()),
       [base for _, base in GOLD_VIEWS.values()])
def _gold_views(lk: Lake) -> DataFrame:
    return lk.spark.sql("\nUNION ALL ".join(
        f"SELECT '{name}' AS view_name, count(*) AS n_rows FROM {name}" for name in register_gold(lk)))


def build_layers(lk: Lake) -> None:
    """Build every stored Bronze/Silver layer once (the transform step).

    The text leg and the performance leg share no layer, so they are built
    as two concurrent chains of Spark jobs (one driver thread each); the
    scheduler interleaves their tasks on the same executors.
    """
    from concurrent.futures import ThreadPoolExecutor
    text = (lambda: lk.manifest, lambda: lk.dim_client, lambda: silver_wide(lk),
            lambda: silver_run2(lk), lambda: lk.bronze_damaged)
    perf = (lambda: _perf_latest(lk), lambda: lk.edit_decision_list, lambda: lk.perf_chunks,
            lambda: lk.perf_assets, lambda: lk.map_ad_asset)

    def run(chain):
        for layer in chain:
            layer()

    lk.store  # create the store (and its folder) before the threads share it
    with ThreadPoolExecutor(max_workers=2) as pool:
        for f in [pool.submit(run, text), pool.submit(run, perf)]:
            f.result()
