"""Hand-computed edge cases (FIXTURES.md section C), one per test."""

import json

from pyspark.sql import functions as F

from reelmart import schemas as S
from reelmart.functions import columns as C
from reelmart.operators import align as AL
from reelmart.operators import correlate as CO
from reelmart.operators import ingest as I
from reelmart.operators import perf as P
from reelmart.operators import quality as Q
from reelmart.operators import retention as RT
from reelmart.operators import search as SR
from reelmart.operators import significance as SG
from reelmart.operators import silver as SV


def _bronze(spark, rows):
    return spark.createDataFrame(
        [(a, "c1", raw, "m", "p", "h", None, None) for a, raw in rows], S.BRONZE_ASSET_RAW)


def _chunk(score, theme="Hook", sentiment="calm"):
    return {"start_sec": 0.0, "end_sec": 5.0, "transcript_segment": "x", "chunk_theme": theme,
            "sentiment": sentiment, "standalone_score": score}


def test_01_damaged_json_is_quarantined(spark):
    good = json.dumps({"chunks": [_chunk(4)]})
    b = _bronze(spark, [("a", '{"chunks":[{"start_sec":0'), ("b", "{}"), ("c", '{"chunks":[]}'),
                        ("d", good)])
    gate = {r.asset_id: (r.gate_status, r.reason) for r in SV.bronze_gate(b).collect()}
    assert gate == {"a": ("QUARANTINE", "unparsable"), "b": ("QUARANTINE", "unparsable"),
                    "c": ("QUARANTINE", "empty"), "d": ("PASS", None)}
    q = {r.asset_id: r.reason for r in SV.quarantine_rows(b).collect()}
    assert q == {"a": "unparsable", "b": "unparsable", "c": "empty"}
    assert [r.asset_id for r in SV.silver_chunk_wide(b).collect()] == ["d"]


def test_02_lenient_score_typing(spark):
    raw = '{"chunks":[%s]}' % ",".join(
        json.dumps(_chunk(0))[:-2] + s + "}" for s in ["4", "4.0", '"4"', "4.5", "9"])
    flat, _ = SV.explode_chunks(_bronze(spark, [("a", raw)]))
    got = [(r.chunk_sequence, r.standalone_score, list(r.reasons))
           for r in flat.orderBy("chunk_sequence").collect()]
    assert got == [(1, 4, []), (2, 4, []), (3, 4, []), (4, None, ["score_not_integer"]),
                   (5, 9, ["score_out_of_range"])]


def test_03_thousand_and_one_chunks_keep_distinct_ids(spark):
    raw = json.dumps({"chunks": [_chunk(3)] * 1001})
    ids = SV.silver_chunk_wide(_bronze(spark, [("a", raw)])).select("chunk_id")
    assert ids.distinct().count() == 1001
    got = {r.chunk_id for r in ids.where(F.col("chunk_id").isin("a_001", "a_100", "a_1000"))
           .collect()}
    assert got == {"a_001", "a_100", "a_1000"}


def test_04_identity_is_tenant_scoped(spark):
    d = spark.createDataFrame(
        [(1, "c1", "h1", "n1", None), (2, "c1", "h1", "n2", None), (3, "c2", "h1", "n3", None)],
        "doc_id long, client_id string, content_sha256 string, asset_name string, "
        "modified_at timestamp")
    d = d.withColumn("asset_id", C.asset_identity(F.col("client_id"), F.col("content_sha256")))
    assets = I.dedupe_deliveries(d).collect()
    assert len(assets) == 2
    assert {(a.client_id, a.doc_id, a.n_deliveries) for a in assets} == {("c1", 1, 2), ("c2", 3, 1)}
    nul = spark.range(1).select(C.asset_identity(F.lit(None).cast("string"), F.lit("h")).alias("x"))
    assert nul.first().x is None


def _align(spark, chunks, anchor, tol=None):
    b = spark.createDataFrame(
        [("ad", f"k{i}", role, i, s, e) for i, (s, e, role) in enumerate(chunks, 1)],
        "ad_id string, chunk_id string, chunk_role string, position_in_ad int, "
        "start_sec double, end_sec double")
    anc = spark.createDataFrame([("ad", "meta", "hook_rate", anchor)],
                                "ad_id string, platform_id string, metric_name string, "
                                "anchor_sec double")
    fact = spark.createDataFrame([("ad", "meta")], "ad_id string, platform_id string")
    return AL.metric_chunk_alignment(anc, b, fact, tol)


def test_05_anchor_on_boundary_goes_to_next_chunk(spark):
    r = _align(spark, [(0.0, 3.0, "hook"), (3.0, 8.0, "body")], 3.0) \
        .where("metric_name = 'hook_rate'").first()
    assert (r.chunk_id, r.coverage_confidence) == ("k2", "HIGH")


def test_06_gap_tie_picks_lower_position(spark):
    r = _align(spark, [(0.0, 2.0, "hook"), (4.0, 8.0, "body")], 3.0) \
        .where("metric_name = 'hook_rate'").first()
    assert (r.chunk_id, r.coverage_confidence) == ("k1", "MEDIUM")
    low = _align(spark, [(0.0, 2.0, "hook"), (10.0, 18.0, "body")], 6.0, tol=1.0) \
        .where("metric_name = 'hook_rate'").first()
    assert low.coverage_confidence == "LOW"


def test_07_null_anchor_is_low_and_excluded(spark):
    al = _align(spark, [(0.0, 2.0, "hook")], None)
    assert al.where("metric_name = 'hook_rate'").first().coverage_confidence == "LOW"
    kpi = spark.createDataFrame([("ad", "meta") + (0.5,) * 6],
                                "ad_id string, platform_id string, hook_rate double, "
                                "hold_rate_25 double, hold_rate_50 double, retention_75 double, "
                                "retention_100 double, ctr_link double")
    ch = spark.createDataFrame([("k1", "Hook", "calm", 4)],
                               "chunk_id string, chunk_theme string, sentiment string, "
                               "standalone_score int")
    assert AL.ad_metric_chunk(al, kpi, ch).count() == 0


def test_08_no_cta_no_ctr_row(spark):
    al = _align(spark, [(0.0, 2.0, "hook"), (2.0, 4.0, "body")], 1.0)
    assert al.where("metric_name = 'ctr_link'").count() == 0
    al2 = _align(spark, [(0.0, 2.0, "hook"), (2.0, 4.0, "cta")], 1.0)
    assert al2.where("metric_name = 'ctr_link'").first().chunk_id == "k2"


def _fact(spark, rows):
    cols = P.COUNTS
    data = []
    for imp, p3 in rows:
        rec = dict.fromkeys(cols, 1)
        rec.update(impressions=imp, plays_3s=p3)
        data.append(("ad", "meta") + tuple(rec[c] for c in cols))
    return spark.createDataFrame(
        data, "ad_id string, platform_id string, " + ", ".join(f"{c} long" for c in cols))


def test_09_ratio_of_sums(spark):
    k = P.ad_kpi(_fact(spark, [(10, 1), (90, 81)])).first()
    assert abs(k.hook_rate - 0.82) < 1e-12


def test_10_zero_denominator_is_null_under_ansi(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    assert P.ad_kpi(_fact(spark, [(0, 0)])).first().hook_rate is None


def _metric_rows(spark, groups):
    rows = []
    for theme, vals in groups.items():
        for i, v in enumerate(vals):
            rows.append((f"{theme}{i}", "meta", "hook_rate", v, "c", "hook", "HIGH", theme,
                         "calm", 4))
    return spark.createDataFrame(
        rows, "ad_id string, platform_id string, metric_name string, metric_value double, "
              "chunk_id string, chunk_role string, coverage_confidence string, "
              "chunk_theme string, sentiment string, standalone_score int")


def test_11_evidence_regimes(spark):
    mc = _metric_rows(spark, {"A": [0.1] * 4, "B": [0.1] * 5, "C": [0.1] * 11, "D": [0.1] * 12})
    m = {r.feature_value: r.evidence_regime for r in CO.chunk_perf_correlation(mc)
         .where("feature_dim = 'chunk_theme'").collect()}
    assert m == {"A": "BLOCK", "B": "DIRECTIONAL", "C": "DIRECTIONAL", "D": "SUGGESTIVE"}


def test_12_rank_with_gaps(spark):
    mc = _metric_rows(spark, {"A": [0.3], "B": [0.3], "C": [0.2]})
    m = {r.feature_value: r.rank_in_platform for r in CO.chunk_perf_correlation(mc)
         .where("feature_dim = 'chunk_theme'").collect()}
    assert m == {"A": 1, "B": 1, "C": 3}


def test_13_mann_whitney_separated_groups(spark):
    mc = _metric_rows(spark, {"A": [1.0, 2.0, 3.0] * 4, "B": [4.0, 5.0, 6.0] * 4})
    mart = CO.chunk_perf_correlation(mc)
    mw = {r.feature_value: r for r in SG.mann_whitney(mc, mart)
          .where("feature_dim = 'chunk_theme'").collect()}
    assert mw["A"].u_stat == 0.0
    assert mw["A"].p_value < 0.001 and mw["A"].is_significant
    small = _metric_rows(spark, {"A": [1.0, 2.0, 3.0], "B": [4.0, 5.0, 6.0]})
    r = SG.mann_whitney(small, CO.chunk_perf_correlation(small)) \
        .where("feature_dim = 'chunk_theme' and feature_value = 'A'").first()
    assert r.u_stat == 0.0 and r.p_value is None and not r.is_significant


def test_14_lineage_contract_one_violation_per_rule(spark):
    import hashlib
    ok_sha = "a" * 64

    def aid(c, s):
        return hashlib.sha256(f"{c}:{s}".encode()).hexdigest()

    def uri(c, a):
        return (f"abfss://ws@{S.URI_HOST}/lh.Lakehouse/Files/landing/{c}/video/{a}.mp4")

    good = aid("acme", ok_sha)
    rows = [
        ("R1", good, "acme", ok_sha, "", uri("acme", good)),
        ("R2", "XYZ", "acme", "b" * 64, "RAW", uri("acme", "XYZ")),
        ("R3", "c" * 64, "acme", ok_sha, "RAW", uri("acme", "c" * 64)),
        ("R4", aid("acme", "d" * 64), "acme", "d" * 64, "RAW", "s3://elsewhere/x.mp4"),
        ("R5", aid("ghost", ok_sha), "ghost", ok_sha, "RAW", uri("ghost", aid("ghost", ok_sha))),
        ("R6", aid("acme", "e" * 64), "acme", "e" * 64, "RAW", uri("acme", aid("acme", "e" * 64))),
        ("R6", aid("acme", "e" * 64), "acme", "e" * 64, "RAW", uri("acme", aid("acme", "e" * 64))),
        ("R7", aid("test", ok_sha), "test", ok_sha, "RAW", uri("test", aid("test", ok_sha))),
    ]
    m = spark.createDataFrame([r[1:] for r in rows],
                              "asset_id string, client_id string, content_sha256 string, "
                              "asset_type string, source_uri string")
    clients = spark.createDataFrame([("acme",), ("test",)], "client_id string")
    v = Q.lineage_violations(m, clients)
    got = sorted(r.rule for r in v.collect())
    # R2's bad id also breaks R3 and R4 (they co-fire on a bad id)
    assert {"R1", "R2", "R3", "R4", "R5", "R6", "R7"} <= set(got)
    assert got.count("R1") == 1 and got.count("R5") == 1 and got.count("R6") == 1
    assert got.count("R7") == 1
    summary = {r.rule: r.n_violations for r in Q.lineage_contract_summary(v, spark).collect()}
    assert set(summary) == {f"R{i}" for i in range(1, 8)}


def test_15_duplicate_edl_row_fails_compound_unique(spark):
    b = spark.createDataFrame([("ad", "k1", "a", "hook", 1), ("ad", "k1", "a", "hook", 1)],
                              "ad_id string, chunk_id string, asset_id string, "
                              "chunk_role string, position_in_ad int")
    rep = Q.run_suite("bridge_ad_chunk", b)
    r = rep.where("expectation like 'compound_unique%'").first()
    assert r.n_failed == 2


def test_16_retention_rules(spark):
    from datetime import datetime
    now = "2024-02-15 00:00:00"
    pre = f"abfss://ws@{S.URI_HOST}/lh.Lakehouse/Files/"
    listing = spark.createDataFrame([
        (pre + "landing/c1/video/a1.mp4", datetime(2024, 1, 16)),   # age 30 = TTL
        (pre + "landing/c1/video/a2.mp4", datetime(2024, 1, 17)),   # age 29
        (pre + "landing/_golden/c1/video/a3.mp4", datetime(2020, 1, 1)),
        (pre + "landing/c1/video/a4.mp4", datetime(2023, 1, 1)),    # no bronze
        (pre + "landing/c1/video/a5.mp4", None),
    ], "path string, modificationTime timestamp")
    clients = spark.createDataFrame([("c1", 30)], "client_id string, landing_ttl_days int")
    bronze = spark.createDataFrame([("a1", "c1"), ("a2", "c1"), ("a3", "c1"), ("a5", "c1")],
                                   "asset_id string, client_id string")
    plan = {r.asset_id: r.action for r in RT.retention_plan(listing, clients, bronze, now)
            .collect()}
    assert plan == {"a1": "delete_candidate", "a2": "within_ttl", "a4": "skip_no_bronze",
                    "a5": "skip_no_mtime"}


def test_17_search_wildcards_are_literal(spark):
    ch = spark.createDataFrame(
        [("k1", "a", "100% fresh", "Hook", "calm", 5, 0.0, 5.0),
         ("k2", "a", "1000 fresh", "Hook", "calm", 5, 5.0, 10.0),
         ("k3", "a", "snake_case", "Hook", "calm", 5, 10.0, 15.0),
         ("k4", "a", "snakeXcase", "Hook", "calm", 5, 15.0, 20.0)],
        "chunk_id string, asset_id string, transcript_segment string, chunk_theme string, "
        "sentiment string, standalone_score int, start_sec double, end_sec double")
    assets = spark.createDataFrame([("a", "n", "c1")], "asset_id string, asset_name string, "
                                   "client_id string")
    assert [r.chunk_id for r in SR.search_clips(ch, assets, contains="0% F").collect()] == ["k1"]
    assert [r.chunk_id for r in SR.search_clips(ch, assets, contains="E_C").collect()] == ["k3"]


def test_watch_time_from_average_and_plays(spark):
    """Only the average exists: total = average x plays."""
    row = {"ad_id": "a", "date": None, "impressions": 10, "video_3_sec_watched_actions": 5,
           "video_p25_watched_actions": 4, "video_p50_watched_actions": 3, "video_p75_watched_actions": 2,
           "video_p100_watched_actions": 1, "video_total_time_watched": None,
           "video_avg_time_watched_actions": 2.5, "video_play_actions": 7, "inline_link_clicks": 1,
           "actions": [("purchase", 2), ("lead", 1), ("link_click", 9)], "spend": 3, "load_ts": None,
           "platform_native": "meta"}
    kinds = {"ad_id": "string", "date": "date", "video_avg_time_watched_actions": "double",
             "actions": "array<struct<action_type:string,value:long>>", "load_ts": "timestamp",
             "platform_native": "string"}
    raw = spark.createDataFrame([tuple(row.values())], ", ".join(f"{c} {kinds.get(c, 'long')}" for c in row))
    got = P.conform_meta(raw).first()
    assert (got.sum_watch_time_sec, got.results) == (17, 3)
