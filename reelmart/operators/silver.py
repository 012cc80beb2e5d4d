"""Bronze -> Silver: parse verbatim responses, gate them, fan out to chunks.

One pass: the JSON is parsed once, asset-level and chunk-level rule flags are
computed in the same projection, rejects go to quarantine with a reason list,
and the good rows become the chunk store. No Python on the hot path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmart import schemas as S
from reelmart.functions import columns as C


def parse_bronze(bronze: DataFrame) -> DataFrame:
    """Add ``chunks`` (lenient envelope) to each Bronze row.

    Truncated JSON, ``{}`` and a wrong root all yield NULL chunks; the score is
    kept as text so 4, 4.0 and "4" survive and are typed afterwards.
    """
    env = F.from_json(F.col("raw_response"), S.ENVELOPE_LENIENT)
    return bronze.withColumn("chunks", env.getField("chunks"))


def _missing_required(c: Column) -> Column:
    return F.exists(c, lambda x: F.greatest(*[x[k].isNull().cast("int")
                                             for k in S.REQUIRED_CHUNK_KEYS]) == 1)


def bronze_gate(bronze: DataFrame) -> DataFrame:
    """Asset-level gate: parseable, non-empty, required keys present."""
    p = parse_bronze(bronze)
    chunks = F.col("chunks")
    reason = (F.when(chunks.isNull(), F.lit("unparsable"))
              .when(F.size(chunks) == 0, F.lit("empty"))
              .when(_missing_required(chunks), F.lit("missing_required_key")))
    return p.select(
        "asset_id", "client_id", "model_version",
        F.when(chunks.isNotNull(), F.size(chunks)).cast("int").alias("chunk_count"),
        F.when(reason.isNull(), F.lit("PASS")).otherwise(F.lit("QUARANTINE")).alias("gate_status"),
        reason.alias("reason"))


def typed_score(s: Column) -> Column:
    """Score text -> INT when it is a whole number, else NULL."""
    d = s.try_cast("double")
    return F.when(d == F.floor(d), d.try_cast("int"))


def explode_chunks(bronze: DataFrame) -> DataFrame:
    """One row per chunk with its rule flags; assets that fail the gate give
    one row with ``chunk_sequence`` NULL."""
    p = parse_bronze(bronze)
    chunks = F.col("chunks")
    asset_reason = (F.when(chunks.isNull(), F.lit("unparsable"))
                    .when(F.size(chunks) == 0, F.lit("empty")))
    good = p.where(asset_reason.isNull())
    rows = good.select("asset_id", "client_id",
                       F.posexplode("chunks").alias("pos", "chunk"))
    ch = F.col("chunk")
    score_txt = ch["standalone_score"]
    score = typed_score(score_txt)
    reasons = F.array_compact(F.array(
        F.when(F.greatest(*[ch[k].isNull().cast("int") for k in S.REQUIRED_CHUNK_KEYS]) == 1,
               F.lit("missing_required_key")),
        F.when(score_txt.isNotNull() & score.isNull(), F.lit("score_not_integer")),
        F.when(score.isNotNull() & ~score.between(1, 5), F.lit("score_out_of_range")),
        F.when(ch["sentiment"].isNotNull() & ~ch["sentiment"].isin(*S.SENTIMENTS),
               F.lit("sentiment_not_in_enum")),
        F.when(F.coalesce(F.trim(ch["chunk_theme"]), F.lit("")) == "", F.lit("theme_empty")),
    ))
    seq = (F.col("pos") + 1).cast("int")
    flat = rows.select(
        C.chunk_id(F.col("asset_id"), seq).alias("chunk_id"),
        "asset_id", "client_id", seq.alias("chunk_sequence"),
        ch["start_sec"].alias("start_sec"), ch["end_sec"].alias("end_sec"),
        ch["transcript_segment"].alias("transcript_segment"),
        ch["chunk_theme"].alias("chunk_theme"), ch["sentiment"].alias("sentiment"),
        score.alias("standalone_score"),
        ch["next_compatible_themes"].alias("next_compatible_themes"),
        ch["keywords"].alias("keywords"),
        reasons.alias("reasons"))
    rejected_assets = p.where(asset_reason.isNotNull()).select(
        F.lit(None).cast("string").alias("chunk_id"), "asset_id", "client_id",
        F.lit(None).cast("int").alias("chunk_sequence"),
        F.array(asset_reason).alias("reasons"))
    return flat, rejected_assets


def silver_chunk_wide(bronze: DataFrame) -> DataFrame:
    """Good chunk rows, arrays kept (input of the bridges)."""
    flat, _ = explode_chunks(bronze)
    return flat.where(F.size("reasons") == 0).drop("reasons")


FACT_CHUNK_COLS = ["chunk_id", "asset_id", "chunk_sequence", "start_sec", "end_sec",
                   "transcript_segment", "chunk_theme", "sentiment", "standalone_score"]


def fact_chunk(wide: DataFrame) -> DataFrame:
    """Scalar-only chunk table (the grain of the store)."""
    return wide.select(*FACT_CHUNK_COLS)


def quarantine_rows(bronze: DataFrame) -> DataFrame:
    """Rejected assets and chunks, with a comma-joined reason list."""
    flat, rejected_assets = explode_chunks(bronze)
    bad = flat.where(F.size("reasons") > 0).select("chunk_id", "asset_id", "client_id",
                                                   "chunk_sequence", "reasons")
    return (bad.unionByName(rejected_assets)
            .select("asset_id", "client_id", "chunk_id", "chunk_sequence",
                    F.array_join("reasons", ",").alias("reason")))


def pass_rate(bronze: DataFrame) -> DataFrame:
    """Constraint pass rate per client over parsed chunk rows; promote at >= 95 %."""
    flat, _ = explode_chunks(bronze)
    ok = (F.size("reasons") == 0).cast("int")
    return (flat.groupBy("client_id")
            .agg(F.count(F.lit(1)).alias("n_chunks"), F.sum(ok).alias("n_pass"))
            .withColumn("pass_rate", C.r6(C.safe_ratio("n_pass", "n_chunks")))
            .withColumn("promote", F.col("pass_rate") >= S.PROMOTE_PASS_RATE))


def compatibility_bridge(wide: DataFrame) -> DataFrame:
    """chunk -> compatible theme edges (distinct per chunk, else pairs double)."""
    return wide.select("chunk_id", F.explode(F.array_distinct("next_compatible_themes"))
                       .alias("compatible_theme")) \
        .withColumn("theme_match_score", F.lit(None).cast("decimal(5,4)"))


def keyword_bridge(wide: DataFrame) -> DataFrame:
    return wide.select("chunk_id", F.explode("keywords").alias("keyword"))


def theme_bridge(wide: DataFrame) -> DataFrame:
    return wide.select("chunk_id", F.col("chunk_theme").alias("theme"))


def clean_transcript(chunks: DataFrame, fillers: list[str]) -> DataFrame:
    """Drop filler tokens (caller's list, case-insensitive, whole tokens),
    squeeze whitespace, and normalise an 'm:ss' label back to seconds."""
    low = [f.lower() for f in fillers]
    toks = F.split(F.col("transcript_segment"), " ")
    kept = F.filter(toks, lambda w: (w != "") & ~F.lower(w).isin(*low))
    start = F.col("start_sec")
    label = F.format_string("%d:%02d", F.floor(start / 60).cast("int"),
                            F.floor(start % 60).cast("int"))
    return chunks.select("chunk_id",
                         F.array_join(kept, " ").alias("clean_transcript"),
                         (F.size(toks) - F.size(kept)).alias("n_removed"),
                         label.alias("start_label"),
                         C.to_seconds(label).alias("start_sec_norm"))
