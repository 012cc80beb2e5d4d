"""Stored layers: Bronze and Silver are tables, Gold is views.

A layer is built once per session by a Spark job and written as Parquet
under the session's shared scratch root (the cluster's checkpoint folder, or
the SQL warehouse); every later query reads it back with pushdown and column
pruning instead of re-running the lineage. A written table also survives the
loss of the executors that computed it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from reelmart.sources.scratch import new_scratch


class LayerStore:
    def __init__(self, spark: SparkSession, label: str = "layers"):
        self.spark = spark
        self.root = new_scratch(spark, label)
        self.tables: dict[str, DataFrame] = {}

    def table(self, name: str, build: Callable[[], DataFrame],
              partition_by: list[str] | None = None,
              cluster_by: list[str] | None = None, rebalance: bool = False) -> DataFrame:
        """Write ``build()`` once and return the stored table.

        A table in parts goes through a ``REBALANCE`` on the partition columns:
        AQE sizes the output tasks from the data (small tasks merge, a hot
        client's partition is split across several tasks), so files are
        neither tiny nor skewed. A table without parts is written by the tasks
        that compute it, which AQE or the scan has sized already: another
        shuffle would only move every row once more, unless ``rebalance`` asks for
        it. Rows are clustered inside each task.
        """
        if name not in self.tables:
            df = build()
            schema = df.schema
            if partition_by or rebalance:
                df = df.hint("rebalance", *(partition_by or []))
            order = (partition_by or []) + (cluster_by or [])
            if order:
                df = df.sortWithinPartitions(*order)
            w = df.write.mode("overwrite").option("maxRecordsPerFile", 5_000_000)
            if partition_by:
                w = w.partitionBy(*partition_by)
            path = f"{self.root}/{name}"
            w.parquet(path)
            back = self.spark.read.schema(schema).parquet(path)
            self.tables[name] = back.select(*schema.names)
        return self.tables[name]
