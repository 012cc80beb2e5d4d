"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelmart.sources.paths import delete

#: a word: a run of characters other than space, tab, LF, VT, FF, CR
WORD = "[^\\x20\\x09-\\x0D]+"
#: the characters that part words
BLANKS = " \t\n\x0b\x0c\r"


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``.

    Only a session without that setting (a test, a laptop) falls back to the
    checkpoint folder someone set on the context; with neither, it is an error.
    """
    folder = (spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
              or spark.sparkContext.getCheckpointDir())
    if not folder:
        raise ValueError("spark.checkpoint.dir is not set: the operators cut lineage there")
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and go on from there."""
    sc = df.sparkSession.sparkContext
    folder = shared_folder(df.sparkSession)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once as Parquet to the shared folder and go on from there."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"
    df.write.option("compression", "zstd").partitionBy(partition_by or []).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Workspace:
    """Intermediate tables of one job, in the shared folder until it is done."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.name = spark, f"{label}_{uuid.uuid4().hex[:12]}"
        self.folder = f"{shared_folder(spark).rstrip('/')}/{self.name}"
        self.tables: list[str] = []

    def put(self, df: DataFrame, name: str) -> DataFrame:
        """Write a table once and go on from there."""
        df.write.option("compression", "zstd").parquet(f"{self.folder}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")

    def put_bucketed(self, df: DataFrame, name: str, by: str, buckets: int) -> DataFrame:
        """Write a table dealt by the hash of a column, so that grouping by it moves no row."""
        table = f"{self.name}_{name}"
        (df.write.bucketBy(buckets, by).option("path", f"{self.folder}/{name}")
         .option("compression", "zstd").saveAsTable(table))
        self.tables.append(table)
        return self.spark.table(table)

    def drop(self, *names: str) -> None:
        """Delete tables that nothing reads any more."""
        for name in names:
            delete(self.spark, f"{self.folder}/{name}")

    def close(self) -> None:
        for table in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        delete(self.spark, self.folder)


def maybe_broadcast(df: DataFrame, rows: int, most: int = 100_000) -> DataFrame:
    """Broadcast hint for a side of ``rows`` narrow rows if that is at most
    ``most``; beyond it the plain side, which Spark joins by shuffle."""
    return F.broadcast(df) if rows <= most else df


def text_key(text: str = "text") -> Column:
    """64-bit hash of a text; null counts as its own value."""
    return F.xxhash64(F.col(text), F.col(text).isNull())


def uniform(*cols: Column) -> Column:
    """(0, 1) from 52 bits of the MD5 of the columns' text, the same each run."""
    text = F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])
    bits = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")
    return (bits + 0.5) / F.lit(float(1 << 52))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Arrow batches in parts of a few rows: only so many texts are Python
    objects at a time, however many rows a batch has."""
    for batch in batches:
        for a in range(0, batch.num_rows, rows):
            yield batch.slice(a, rows)


def runs(frames: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Whole groups of a stream that is sorted by ``keys``, several at a time.

    Each frame given back ends at a group's end; the last, maybe unfinished
    group of an Arrow batch waits for the next batch.
    """
    held: list[pd.DataFrame] = []
    for frame in frames:
        if not len(frame):
            continue
        cols = [frame[k].to_numpy() for k in keys]
        change = np.zeros(len(frame), bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        if held and any(held[-1][k].iloc[-1] != c[0] for k, c in zip(keys, cols)):
            yield pd.concat(held) if len(held) > 1 else held[0]
            held = []
        last = int(np.flatnonzero(change)[-1]) if change.any() else 0
        if last:
            yield pd.concat([*held, frame.iloc[:last]]) if held else frame.iloc[:last]
            held = []
        held.append(frame.iloc[last:])
    if held:
        yield pd.concat(held) if len(held) > 1 else held[0]


def bounds_of(frame: pd.DataFrame, keys: list[str]) -> np.ndarray:
    """Start positions of the groups of a sorted frame, and its length."""
    change = np.ones(len(frame), bool)
    change[1:] = False
    for k in keys:
        c = frame[k].to_numpy()
        change[1:] |= c[1:] != c[:-1]
    return np.append(np.flatnonzero(change), len(frame))


def forest(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest member of each of ``n`` nodes' component, given links."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new
