"""Shared folder for jobs that write or cut lineage (layers, sinks, streams).

The folder is ``spark.checkpoint.dir``, which every executor of a cluster can
reach. Without that setting a job fails, unless the session is a single local
JVM, whose own disk is shared by definition (tests, a laptop).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir is not set: jobs write there")
        if sc.applicationId not in _LOCAL:
            _LOCAL[sc.applicationId] = tempfile.mkdtemp(prefix="reelmart-")
        base = _LOCAL[sc.applicationId]
    return base.rstrip("/")


def new_scratch(spark: SparkSession, label: str) -> str:
    """A fresh sub-folder per run; never reused, never cleared in place."""
    return f"{scratch_root(spark)}/reelmart-{label}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder once and go on from there."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(scratch_root(df.sparkSession))
    return df.checkpoint(eager=True)


def counted(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """Write ``df`` to the shared folder once and go on from there, knowing its
    number of rows (from the files' footers)."""
    path = new_scratch(df.sparkSession, label)
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    return back, back.count()
