"""Structured Streaming twins of the incremental rules.

All three run with ``trigger(availableNow=True)``: process what has arrived,
then stop - the same code runs continuously with a processing-time trigger.
Each micro-batch changes a ``VersionedTable`` in one commit, so a batch is
wholly in a table or not at all, and a replayed batch changes nothing. Tables
and checkpoints live in the shared scratch folder named by the session.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelmart.sources.files import append_new, stored_rows
from reelmart.sources.paths import read_text
from reelmart.sources.versioned import VersionedTable


#: files of one micro-batch; a batch is a Spark job, so it should be large
FILES_PER_TRIGGER = 1000


def query_name(kind: str, root: str) -> str:
    """The same name for the same target in every run."""
    return f"{kind}_{zlib.crc32(root.encode()):08x}"


def _run(writer, name: str) -> None:
    q = writer.queryName(name).trigger(availableNow=True).start()
    q.awaitTermination()


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a stream keeps as long as its checkpoint: epochs count within it."""
    return json.loads(read_text(spark, f"{checkpoint}/metadata"))["id"]


def stream_new_assets(spark: SparkSession, source_dir: str, schema: str, sink_dir: str,
                      checkpoint: str, files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """Append-only arrival with skip-existing: a landed asset is emitted once.

    Each batch is joined against the stored manifest, whatever its age: there is
    no horizon after which an asset counts as new again, no late row, and no
    state beside the manifest itself.
    """
    s = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
         .parquet(source_dir).select("asset_id", "client_id", "content_sha256", "modified_at"))
    _run(s.writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(lambda batch, epoch: append_new(batch, sink_dir, [])),
         query_name("new_assets", sink_dir))
    return stored_rows(spark, sink_dir)


def upsert_stream(spark: SparkSession, source: DataFrame, root: str, checkpoint: str,
                  combine: Callable[[DataFrame | None, DataFrame], DataFrame], date_col: str,
                  name: str = "upsert") -> DataFrame:
    """Drive ``source`` into a versioned table in parts by the month of
    ``date_col``: a batch reads and replaces the months that it touches, and no
    other; readers see the months before it or after it, never between."""
    table = VersionedTable(spark, f"{root}/table")
    month = F.date_format(date_col, "yyyy-MM")

    def put(batch: DataFrame, epoch: int) -> None:
        table.merge(batch, month, combine, (query_id(spark, checkpoint), epoch))
        table.vacuum()

    _run(source.writeStream.option("checkpointLocation", checkpoint).foreachBatch(put),
         query_name(name, root))
    return table.read()


def stream_perf_upsert(spark: SparkSession, source_dir: str, schema: str, root: str,
                       checkpoint: str, latest: Callable[[DataFrame], DataFrame],
                       files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """Restated daily pulls: each batch is merged with last-write-wins on
    load_ts (``latest`` = the batch rule), so late restatements replace the
    day they restate."""
    src = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
           .parquet(source_dir))

    def combine(prev: DataFrame | None, batch: DataFrame) -> DataFrame:
        return latest(batch if prev is None else prev.unionByName(batch))

    return upsert_stream(spark, src, root, checkpoint, combine, "perf_date", name="perf_upsert")


def stream_daily_counts(spark: SparkSession, events_dir: str, file_glob: str, schema: str,
                        root: str, checkpoint: str, files_per_trigger: int = FILES_PER_TRIGGER,
                        delay: timedelta | None = None) -> DataFrame:
    """Daily event counts per user and type, in event time, from a growing
    event folder.

    A day is closed once a committed batch has seen an event ``delay`` or more
    after its end. Events of closed days are late: they go to a side table
    (``late_events``) and are counted nowhere else, so events read = events
    counted + events late. Open days are updated in place, a month at a time;
    a closed month is one folder that is never written again. Without
    ``delay`` no day closes. The watermark is committed with the counts it
    belongs to, so a replayed batch finds the same days closed.
    """
    ev = (spark.readStream.schema(schema).option("pathGlobFilter", file_glob)
          .option("maxFilesPerTrigger", files_per_trigger).parquet(events_dir)
          .withColumn("ts", F.col("ts").cast("timestamp_ntz")))
    counts, late = VersionedTable(spark, f"{root}/counts"), VersionedTable(spark, f"{root}/late")

    def add(prev: DataFrame | None, batch: DataFrame) -> DataFrame:
        rows = batch if prev is None else prev.unionByName(batch)
        return rows.groupBy("day", "user_id", "event_type").agg(
            F.sum("n_events").alias("n_events"), F.sum("sum_value").alias("sum_value"))

    def put(batch: DataFrame, epoch: int) -> None:
        batch.persist()
        seen = counts.state()["notes"].get("max_ts")
        top = batch.agg(F.max("ts")).first()[0]
        top = max([t for t in (seen and datetime.fromisoformat(seen), top) if t], default=None)
        closed = F.lit(False)
        if delay is not None and seen:  # the first day still open
            open_day = (datetime.fromisoformat(seen) - delay).date()
            closed = F.coalesce(F.to_date("ts") < F.lit(open_day), F.lit(False))
        stream = (query_id(spark, checkpoint), epoch)
        if delay is not None:
            late.append(lambda have: batch.where(closed), stream)
        counts.merge(daily_counts_batch(batch.where(~closed)), F.date_format("day", "yyyy-MM"), add, stream,
                     {"max_ts": top.isoformat()} if top else None)
        counts.vacuum()
        batch.unpersist()

    _run(ev.writeStream.option("checkpointLocation", checkpoint).foreachBatch(put),
         query_name("daily_counts", root))
    return counts.read()


def late_events(spark: SparkSession, root: str) -> DataFrame | None:
    """Events that ``stream_daily_counts`` met after their day had closed."""
    return VersionedTable(spark, f"{root}/late").read()


def daily_counts_batch(events: DataFrame) -> DataFrame:
    """Batch twin of ``stream_daily_counts``."""
    return (events.groupBy(F.to_date("ts").alias("day"), "user_id", "event_type")
            .agg(F.count(F.lit(1)).alias("n_events"), F.sum("value").alias("sum_value")))
