"""Extraction-run telemetry: parse run logs, roll up tokens, time, retries
and the price applied downstream (never stored by the extractor)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmart import schemas as S
from reelmart.functions import columns as C

JSON_TS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def parse_run_log(json_lines: DataFrame) -> DataFrame:
    """JSON run records (column ``value``) -> typed run rows (fixed schema)."""
    r = F.from_json(F.col("value"), S.RUN_LOG, JSON_TS)
    return json_lines.select(r.alias("r")).select("r.*")


def extraction_cost(runs: DataFrame, prices: DataFrame) -> DataFrame:
    """Per (model, prompt): runs, tokens, time, retries and USD cost.

    Prices are micro-dollars per 1,000 tokens; the sum is exact BIGINT and is
    divided once. The price table is a literal parameter (a handful of rows),
    so its broadcast is bounded by construction.
    """
    j = runs.join(F.broadcast(prices), "model_version", "left")
    cost = (F.col("tokens_in") * F.col("price_in_micro")
            + F.col("tokens_out") * F.col("price_out_micro"))
    return (j.groupBy("model_version", "prompt_version")
            .agg(F.count(F.lit(1)).alias("n_runs"), F.sum("tokens_in").alias("tokens_in"),
                 F.sum("tokens_out").alias("tokens_out"),
                 F.sum("processing_time_sec").alias("t"),
                 F.sum("retry_count").cast("bigint").alias("retries"),
                 F.sum(cost).alias("cost_nano"))
            .select("model_version", "prompt_version", "n_runs", "tokens_in", "tokens_out",
                    C.r6(F.col("t")).alias("processing_time_sec"), "retries",
                    C.r6(F.col("cost_nano") / 1e9).alias("cost_usd")))
