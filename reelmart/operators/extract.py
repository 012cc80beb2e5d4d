"""Extraction: landed assets -> verbatim responses, by a function of the caller.

The function runs inside tasks, over a few assets at a time. What it returns
becomes one Bronze row an asset, untouched; what it raises becomes an error of
that asset alone. Work is dealt into slices, each one Spark job: its outcomes
are written down first and then committed, responses to Bronze and every
attempt to the run log, so a stage that dies has lost at most one slice of
calls; written outcomes are committed by the next run. Each round asks only for assets that Bronze lacks, so a rerun calls
nothing twice and failures are tried again, up to a number of rounds.
"""

from __future__ import annotations

import json
import sys
import time
import uuid
from collections.abc import Callable, Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmart.sources.versioned import VersionedTable

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# FIXED VALUES: attempts of an asset, seconds between two rounds, concurrent calls
ATTEMPTS = 5
PAUSE_SEC = 60.0
CONCURRENT = 2
#: assets whose bytes one task holds at a time
BATCH_ASSETS = 16

#: outcome of one call
OUTCOME = ("run_id string, asset_id string, client_id string, attempt int, raw_response string, "
           "model_version string, prompt_version string, content_sha256 string, chunk_count int, "
           "tokens_in long, tokens_out long, processing_time_sec double, error string, load_ts timestamp")
BRONZE = ["asset_id", "client_id", "raw_response", "model_version", "prompt_version", "content_sha256",
          "chunk_count", "load_ts"]
RUN_LOG = ["run_id", "asset_id", "client_id", "attempt", "model_version", "prompt_version", "tokens_in",
           "tokens_out", "processing_time_sec", "error", "load_ts"]

#: outcomes of slices, beside the run log that they are committed to
OUTCOMES = "_outcomes"
_KINDS = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "double": pa.float64(),
          "timestamp": pa.timestamp("us", tz="UTC")}


def outcome(call: Callable[[dict], dict], asset: dict, attempt: int) -> dict:
    """One call: its response with the number of chunks, or its error. The
    envelope must be JSON with an array of chunks; an empty one is a response
    (the Bronze gate quarantines it)."""
    started, done = time.monotonic(), {"run_id": str(uuid.uuid4()), "attempt": attempt}
    done |= {c: asset.get(c) for c in ("asset_id", "client_id", "content_sha256")}
    try:
        answer = call(asset | {"attempt": attempt})
        done |= {c: answer.get(c) for c in ("model_version", "prompt_version", "tokens_in", "tokens_out")}
        done |= {"chunk_count": len(json.loads(answer["raw_response"])["chunks"]),
                 "raw_response": answer["raw_response"]}
    except Exception as e:  # whatever a caller's function raises is this asset's error
        done["error"] = f"{type(e).__name__}: {e}"[:2000]
    done["processing_time_sec"] = round(time.monotonic() - started, 3)
    done["load_ts"] = datetime.now(timezone.utc)
    return done


def _called(call: Callable[[dict], dict], attempt: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([(n, _KINDS[k]) for n, k in (f.split() for f in OUTCOME.split(", "))])
        for batch in batches:
            for a in range(0, batch.num_rows, BATCH_ASSETS):
                rows = [outcome(call, r, attempt) for r in batch.slice(a, BATCH_ASSETS).to_pylist()]
                yield pa.RecordBatch.from_pylist(rows, kinds)
    return run


def _lacking(rows: DataFrame, have: DataFrame | None) -> DataFrame:
    """Rows of assets that ``have`` lacks."""
    return rows if have is None else rows.join(have.select("asset_id"), "asset_id", "left_anti") \
        .select(*rows.columns)


def commit_outcomes(name: str, bronze: VersionedTable, runs: VersionedTable) -> None:
    """Bring one slice's written outcomes into Bronze and the run log, once
    each, however often this is repeated."""
    done = runs.spark.read.schema(OUTCOME).parquet(f"{runs.root}/{OUTCOMES}/{name}")
    good = done.where("error IS NULL").select(*BRONZE)
    bronze.append(lambda have: _lacking(good, have))
    runs.append(lambda have: done.select(*RUN_LOG), (name, 1))


def recover(bronze: VersionedTable, runs: VersionedTable) -> int:
    """Commit the outcomes that a stage wrote before it died; returns how many slices."""
    known = runs.state()["streams"]
    left = [n for n in runs.names(OUTCOMES) if n not in known and "_SUCCESS" in runs.names(f"{OUTCOMES}/{n}")]
    for name in left:
        commit_outcomes(name, bronze, runs)
    return len(left)


def extract(assets: DataFrame, call: Callable[[dict], dict], bronze: VersionedTable, runs: VersionedTable,
            attempts: int = ATTEMPTS, slices: int = 1, concurrent: int = CONCURRENT,
            pause_sec: float = PAUSE_SEC) -> int:
    """Call ``call`` (a dict of the asset's columns and ``attempt`` -> a dict
    with ``raw_response``) for every asset (asset_id, client_id, content_sha256
    and whatever it needs) that Bronze lacks; returns how many assets still lack
    a response. At most ``concurrent`` calls run at a time. A task that Spark
    repeats calls again for its assets; Bronze keeps one response each."""
    ids = assets.select("asset_id").distinct()
    recover(bronze, runs)
    for attempt in range(1, attempts + 1):
        if attempt > 1:
            if _lacking(ids, bronze.read()).isEmpty():
                break
            time.sleep(pause_sec)
        for i in range(slices):
            # only what is left to call for is dealt out with its bytes
            todo = _lacking(assets.where(F.pmod(F.xxhash64("asset_id"), F.lit(slices)) == i), bronze.read()) \
                .dropDuplicates(["asset_id"])
            name = uuid.uuid4().hex
            # as many tasks as calls may run at a time
            (todo.repartition(concurrent, "asset_id").mapInArrow(_called(call, attempt), OUTCOME)
             .write.parquet(f"{runs.root}/{OUTCOMES}/{name}"))
            commit_outcomes(name, bronze, runs)
    return _lacking(ids, bronze.read()).count()


def run_summary(runs: DataFrame) -> DataFrame:
    """Calls, failures and outcome of each asset over all rounds."""
    failed = F.col("error").isNotNull()
    return runs.groupBy("asset_id", "client_id").agg(
        F.count(F.lit(1)).alias("n_calls"), F.count_if(failed).alias("n_errors"),
        F.max("attempt").alias("last_attempt"), (F.count_if(~failed) > 0).alias("extracted"),
        F.max_by("error", "attempt").alias("last_error"))
