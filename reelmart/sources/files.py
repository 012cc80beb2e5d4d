"""File sources and sinks: seed CSVs, raw platform captures, Bronze, landing
listings and run logs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelmart import schemas as S
from reelmart.sources.landing import folders, hash_objects, list_prefixes, put_objects
from reelmart.sources.scratch import counted
from reelmart.sources.versioned import VersionedTable


def read_seed(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Header CSV with an explicit schema (inference would type every column
    of a header-only seed as string)."""
    return spark.read.schema(S.SEED_SCHEMAS[table]).option("header", True).csv(path)


def write_seed(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_export(rows: DataFrame, path: str) -> None:
    """A platform's export: header CSV files, zipped; each as large as the task that writes it."""
    rows.write.option("header", True).option("escape", '"').option("compression", "gzip").csv(path)


def capture_raw_csv(spark: SparkSession, path: str, schema: str, target: str) -> DataFrame:
    """Verbatim capture of platform CSV exports into the versioned table
    ``target``: every row keeps its source file, a hash of the row, a hash of
    its file's rows and the capture time.

    A file whose rows have been captured before, under any name, is not
    captured again, so a replay or a second delivery adds nothing; new files
    beside it are. All files of one capture become visible in one commit.
    """
    raw = spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)
    row = F.sha2(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in raw.columns]), 256)
    rows = raw.select("*", F.col("_metadata.file_path").alias("source_file"), row.alias("content_hash"))
    # equal multisets of rows have equal sums, in whatever order they stand
    part = lambda k: F.sum(F.xxhash64(F.lit(k), "content_hash").cast("decimal(20,0)"))
    files = (rows.groupBy("source_file")
             .agg(F.sha2(F.concat_ws(":", F.count(F.lit(1)), part(1), part(2), part(3)), 256).alias("file_hash"))
             .groupBy("file_hash").agg(F.min("source_file").alias("source_file")))
    # one row a file, stored: its size is known, so the rows are not dealt out by the few files
    files, _ = counted(files, "captured-files")

    def fresh(have: DataFrame | None) -> DataFrame:
        new = files if have is None else files.join(have.select("file_hash").distinct(), "file_hash", "left_anti")
        return rows.join(new, "source_file").select(
            *raw.columns, "source_file", "content_hash", "file_hash", F.current_timestamp().alias("captured_at"))

    table = VersionedTable(spark, target)
    table.append(fresh)
    return table.read()


def capture_audit(captured: DataFrame, began: datetime) -> DataFrame:
    """Rows and capture times of each file: none may lack the time of its
    capture or bear one before the run ``began``."""
    return captured.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("captured_at").isNull()).alias("n_without_time"),
        F.count_if(F.col("captured_at") < F.lit(began)).alias("n_before_run"),
        F.countDistinct("captured_at").alias("n_times"))


def landing_listing(spark: SparkSession, root: str) -> DataFrame:
    """Landing objects with modification time; ``content`` is never selected,
    so the binaryFile scan reads no bytes."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
            .select("path", "modificationTime", "length"))


def content_hashes(spark: SparkSession, root: str) -> DataFrame:
    """sha256 of each landed object, computed on executors."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
            .select("path", F.sha2(F.col("content"), 256).alias("content_sha256")))


def append_new(rows: DataFrame, path: str, cluster_by: list[str]) -> int:
    """Append the rows whose asset_id is not stored yet, once each, in one
    commit; returns how many. A writer that finds another's commit in its place
    looks again at what is stored, so two writers never double an asset."""
    once = rows.dropDuplicates(["asset_id"]).select(*rows.columns)

    def fresh(have: DataFrame | None) -> DataFrame:
        return once if have is None else once.join(have.select("asset_id"), "asset_id", "left_anti").select(*rows.columns)

    return VersionedTable(rows.sparkSession, path, cluster_by).append(fresh)


def stored_rows(spark: SparkSession, path: str) -> DataFrame | None:
    """The committed rows of a table that ``append_new`` writes."""
    return VersionedTable(spark, path).read()


def bronze_append(new_rows: DataFrame, bronze_path: str) -> int:
    """Write-once Bronze: one response per asset, clustered by client."""
    return append_new(new_rows.select(*[f.name for f in S.BRONZE_ASSET_RAW.fields]), bronze_path,
                      ["client_id"])


def manifest_append(new_assets: DataFrame, manifest_path: str) -> int:
    """Append only assets the manifest does not know, so that re-running an
    ingest adds nothing."""
    return append_new(new_assets, manifest_path, [])


def write_silver(df: DataFrame, path: str) -> None:
    """Silver write: partitioned by client, dynamic partition overwrite (a run
    for one client never erases another), rows clustered by asset and
    sequence inside each task instead of a global sort. ``REBALANCE`` lets
    AQE size the write tasks and split a hot client over several of them."""
    (df.hint("rebalance", "client_id").sortWithinPartitions("client_id", "asset_id", "chunk_sequence")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("client_id").parquet(path))


def overwritten(rows: DataFrame, path: str, cluster_by: list[str] | None = None) -> DataFrame:
    """Silver bridge or union as a stored table: replaced in one commit, so a
    reader sees the table before a rebuild or after it, never half of one. The
    tasks that compute the rows write them; ``cluster_by`` sorts inside each, if
    the rows don't come in that order already."""
    table = VersionedTable(rows.sparkSession, path)
    table.replace(rows.sortWithinPartitions(*cluster_by) if cluster_by else rows)
    return table.read()


def write_json_records(records: DataFrame, path: str) -> None:
    """Append JSON records (column ``value``), a line each."""
    records.select("value").write.mode("append").text(path)


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.RUN_LOG).json(path, timestampFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")


def write_quarantine(rows: DataFrame, path: str) -> None:
    """Append rejected rows, by client."""
    rows.write.mode("append").partitionBy("client_id").parquet(path)


def write_landing(objects: DataFrame, path: str) -> None:
    """Landed objects (client_id, asset_id, text), a file each."""
    put_objects(objects, ["client_id", "asset_id"], "text", path)


def scan_landing(spark: SparkSession, path: str) -> DataFrame:
    """(client_id, asset_id, length, content_sha256) of landed objects, listed
    and hashed from their bytes inside tasks: clients first, then the assets of
    each, then the objects of each asset."""
    assets = folders(folders(spark.createDataFrame([(path,)], "prefix string")))
    listed = list_prefixes(assets).where(F.element_at(F.split("path", "/"), -1).startswith("part-"))
    part = lambda name: F.regexp_extract("path", f"/{name}=([^/]+)/", 1).alias(name)
    return hash_objects(listed).select(part("client_id"), part("asset_id"), "length", "content_sha256")
