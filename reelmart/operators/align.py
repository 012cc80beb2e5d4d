"""Metric -> chunk alignment: each (ad, platform, metric) owns exactly one
chunk of the edited cut.

Time-anchored metrics sweep the ad's timeline. An ad has a handful of anchors
(platforms x metrics of the seeds) and any number of chunks, so the anchors of
an ad travel as one sorted array to its chunks, each of which says in a few
rows which anchors it bears on: those inside it, the first after its end and
the last before its start. ``min_by`` reduces these rows map-side to a few per
ad, which then meet the anchors. The bridge is read once, work is linear in
the chunks, no pair of anchor and chunk is built, and a hot ad's chunks are
spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmart import schemas as S

PERF_METRICS = ["hook_rate", "hold_rate_25", "hold_rate_50", "retention_75", "retention_100",
                "ctr_link"]
# FIXED VALUES: metric owned by each hold milestone (percent of duration).
MILESTONE_METRICS = {25: "hold_rate_25", 50: "hold_rate_50", 75: "retention_75",
                     100: "retention_100"}


def ad_platforms(fact: DataFrame) -> DataFrame:
    """(ad, platform) pairs. Pass the KPI frame (one row per pair) to share
    its aggregate with the KPI join instead of a second distinct."""
    if "hook_rate" in fact.columns:
        return fact.select("ad_id", "platform_id")
    return fact.select("ad_id", "platform_id").distinct()


def milestones(platforms: DataFrame) -> DataFrame:
    """Platform seed's packed milestone list ("25,50,75,100") -> one row per
    (platform, metric, share of duration)."""
    names = F.create_map(*[x for pct, name in MILESTONE_METRICS.items()
                           for x in (F.lit(pct), F.lit(name))])
    ms = F.transform(F.split("hold_milestones", ","), lambda x: F.trim(x).cast("int"))
    return (platforms.select("platform_id", F.explode(ms).alias("pct"))
            .select("platform_id", F.try_element_at(names, F.col("pct")).alias("metric_name"),
                    (F.col("pct") / 100.0).alias("share"))
            .where(F.col("metric_name").isNotNull()))


def anchors(fact: DataFrame, platforms: DataFrame, ad_map: DataFrame,
            assets: DataFrame) -> DataFrame:
    """Anchor second per (ad, platform, metric): the platform's hook window,
    or a milestone share of the edited asset's duration. Both platform-side
    inputs come from the literal platform seed (a bounded broadcast)."""
    ap = ad_platforms(fact)
    hook = ap.join(F.broadcast(platforms.select("platform_id", "hook_window_sec")),
                   "platform_id").select(
        "ad_id", "platform_id", F.lit("hook_rate").alias("metric_name"),
        F.col("hook_window_sec").cast("double").alias("anchor_sec"))
    dur = (ap.join(ad_map, "ad_id").join(assets.select("asset_id", "duration_sec"), "asset_id")
           .join(F.broadcast(milestones(platforms)), "platform_id")
           .select("ad_id", "platform_id", "metric_name",
                   (F.col("share") * F.col("duration_sec")).alias("anchor_sec")))
    return hook.unionByName(dur)


#: distance of a chunk that holds the anchor; those outside have 0 or more
INSIDE = -1.0
#: the owner among chunks of one distance: by position, then by id
OWNER = ["position_in_ad", "chunk_id", "chunk_role"]
#: what a chunk is to an anchor; one integer names it with its run of anchors
FIRST, CTA, BEFORE, AFTER, ODD, WITHIN = range(6)
RUN = 1 << 20


def slot_of(kind: int, at: Column, level: Column | None = None) -> Column:
    """The slot of ``kind`` (runs of 2 ** level anchors: kinds from WITHIN on)."""
    return ((F.lit(kind) + (F.lit(0) if level is None else level)) * RUN + at).cast("long")


def bearings(anc: DataFrame, bridge: DataFrame) -> DataFrame:
    """(ad_id, marks, found): an ad's distinct anchors in order, and by slot the
    chunk that may own one: found = {slot: (key, position, id, role)}.

    A chunk bears on anchors ``i`` to ``j - 1`` (inside it), on those from ``j``
    (the first at or after its end) and on those to ``i - 1`` (the last before
    its start); of the latter two only the nearest chunk matters, which has the
    least ``key``. A range of anchors is said by two rows: the two runs of
    ``2 ** level`` anchors that cover it, however many it has. Chunks whose
    bounds are missing or turned round say their distance from each anchor.
    The first call to action is kept as well, and the first chunk of an ad with
    an anchor out of time.
    """
    b = bridge.select("ad_id", "start_sec", "end_sec", *OWNER)
    marks = anc.groupBy("ad_id").agg(F.sort_array(F.collect_set("anchor_sec")).alias("marks"),
                                     F.max(F.col("anchor_sec").isNull()).alias("untimed"))
    before = lambda c: F.size(F.filter("marks", lambda m: m < F.col(c)))
    sound = F.coalesce(F.col("start_sec") <= F.col("end_sec"), F.lit(False)) & F.col("marks").isNotNull()
    d = (b.join(marks, "ad_id", "left").withColumn("sound", sound).withColumn("n", F.size("marks"))
         .withColumn("i", before("start_sec")).withColumn("j", before("end_sec")))
    i, j, ok = F.col("i"), F.col("j"), F.col("sound")
    level = F.length(F.bin(F.greatest(j - i, F.lit(1)).cast("long"))) - 1
    run = F.call_function("shiftleft", F.lit(1), level)

    def hit(slot: Column, key: Column) -> Column:
        return F.struct(slot.alias("slot"), key.cast("double").alias("key"))

    def apart(m, at) -> Column:
        return hit(slot_of(ODD, at), F.coalesce(
            F.greatest("start_sec", m) - F.least("end_sec", m), F.lit(float("inf"))))

    zero = F.lit(0)
    hits = F.array_compact(F.array(
        F.when(F.col("untimed"), hit(slot_of(FIRST, zero), zero)),
        F.when(F.col("chunk_role") == "cta", hit(slot_of(CTA, zero), zero)),
        F.when(ok & (j < F.col("n")), hit(slot_of(BEFORE, j), -F.col("end_sec"))),
        F.when(ok & (i > 0), hit(slot_of(AFTER, i - 1), F.col("start_sec"))),
        F.when(ok & (j > i), hit(slot_of(WITHIN, i, level), F.lit(INSIDE))),
        F.when(ok & (j - run > i), hit(slot_of(WITHIN, j - run, level), F.lit(INSIDE)))))
    odd = F.when(~ok & F.col("marks").isNotNull(), F.transform("marks", apart)).otherwise(
        F.array().cast("array<struct<slot:long,key:double>>"))
    best = (d.select("ad_id", *OWNER, F.inline(F.concat(hits, odd)))
            .groupBy("ad_id", "slot")
            .agg(F.min_by(F.struct("key", *OWNER), F.struct("key", *OWNER)).alias("c")))
    # a few rows an ad, by the number of its anchors
    return best.groupBy("ad_id").agg(F.map_from_entries(F.collect_list(F.struct("slot", "c"))).alias("found")) \
        .join(marks.drop("untimed"), "ad_id", "left")


def metric_chunk_alignment(anc: DataFrame, bridge: DataFrame, fact: DataFrame,
                           tolerance_sec: float | None = None) -> DataFrame:
    """Pick the owning chunk: containing first, then larger overlap (i.e. the
    nearer chunk), then earlier position, then chunk_id. The role metric is
    owned by the ad's first call to action, if it has one.

    Coverage: HIGH inside, MEDIUM outside, LOW when the anchor is NULL or
    farther than ``tolerance_sec`` (None = unlimited).
    """
    keys = ["ad_id", "platform_id", "metric_name"]
    role = ad_platforms(fact).select("ad_id", "platform_id", F.lit("ctr_link").alias("metric_name"),
                                     F.lit(None).cast("double").alias("anchor_sec"), F.lit(True).alias("by_role"))
    asks = anc.select(*keys, "anchor_sec", F.lit(False).alias("by_role")).unionByName(role)
    a, by_role = F.col("anchor_sec"), F.col("by_role")
    here = (asks.join(bearings(anc, bridge), "ad_id")
            .withColumn("q", F.size(F.filter("marks", lambda m: m < a)))
            .withColumn("n", F.coalesce(F.size("marks"), F.lit(0))))
    # the slots that bear on an anchor: itself, all runs that reach it, the ends before and the starts after
    q, n = F.col("q"), F.col("n")
    upto = F.sequence(F.lit(0), q)
    behind = F.sequence(q, F.greatest(n - 1, q))
    timed = F.concat(
        F.transform(upto, lambda x: slot_of(BEFORE, x)), F.transform(behind, lambda x: slot_of(AFTER, x)),
        F.array(slot_of(ODD, q)),
        F.flatten(F.transform(upto, lambda x: F.transform(
            # runs from x reach q if they are longer than q - x
            F.sequence(F.length(F.bin((q - x).cast("long"))) - F.when(q == x, 1).otherwise(0),
                       F.length(F.bin(n.cast("long")))), lambda lv: slot_of(WITHIN, x, lv)))))
    slots = F.when(by_role, F.array(slot_of(CTA, F.lit(0)))).when(
        a.isNull(), F.array(slot_of(FIRST, F.lit(0)))).otherwise(timed)
    picked = here.select(*keys, "anchor_sec", "by_role", F.filter(F.transform(
        slots, lambda s: F.struct(F.floor(s / RUN).alias("kind"), F.try_element_at("found", s).alias("c"))),
        lambda x: x["c"].isNotNull()).alias("bear"))
    away = lambda kind, key: (F.when(kind == BEFORE, a + key).when(kind == AFTER, key - a)
                              .otherwise(key).cast("double"))
    p = F.array_min(F.transform("bear", lambda x: F.struct(
        away(x["kind"], x["c"]["key"]).alias("away"), *[x["c"][o].alias(o) for o in OWNER])))
    cov = F.when(by_role, "HIGH").when(a.isNull(), "LOW").when(F.col("p.away") == INSIDE, "HIGH")
    if tolerance_sec is not None:
        cov = cov.when(F.col("p.away") > F.lit(float(tolerance_sec)), "LOW")
    return (picked.where(F.size("bear") > 0).select(*keys, "anchor_sec", "by_role", p.alias("p"))
            .select(*keys, F.col("p.chunk_id").alias("chunk_id"), F.col("p.chunk_role").alias("chunk_role"),
                    cov.otherwise("MEDIUM").alias("coverage_confidence")))


def kpi_long(kpi: DataFrame) -> DataFrame:
    """KPI columns -> (metric_name, metric_value) rows (unpivot)."""
    return kpi.unpivot(["ad_id", "platform_id"], PERF_METRICS, "metric_name", "metric_value")


def ad_metric_chunk(alignment: DataFrame, kpi: DataFrame, chunks: DataFrame) -> DataFrame:
    """Metric value joined to its one owning chunk's features; LOW excluded."""
    al = alignment.where(F.col("coverage_confidence").isin("HIGH", "MEDIUM"))
    return (al.join(kpi_long(kpi), ["ad_id", "platform_id", "metric_name"])
            .join(chunks.select("chunk_id", "chunk_theme", "sentiment", "standalone_score"),
                  "chunk_id")
            .select("ad_id", "platform_id", "metric_name", "metric_value", "chunk_id",
                    "chunk_role", "coverage_confidence", "chunk_theme", "sentiment",
                    "standalone_score"))
