"""Connected components of a link table, by hooking and pointer jumping.

Each round, every node hooks to its smallest smaller neighbour; pointers are
doubled until they end at roots; links are then drawn between roots, and only
those that still join two of them go into the next round. Links from a hub to
its leaves are gone after one round. All joins are between stored tables, one
side with unique keys, so Spark may split a hub's side. With at most
``FEW_LINKS`` links, a fixed number, these tables go to ``FEW_TASKS`` tasks and
are joined by broadcast: the rounds would else cost a wave of all shuffle
partitions several times each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmart.llm.common import cut


FEW_LINKS = 100_000
FEW_TASKS = 12


def kept(table: DataFrame, few: bool = False) -> DataFrame:
    return cut(table.coalesce(FEW_TASKS) if few else table)


def ordered(links: DataFrame, few: bool = False) -> DataFrame:
    return kept(links.where("a <> b").select(F.greatest("a", "b").alias("a"),
                                             F.least("a", "b").alias("b")).distinct(), few)


def followed(table: DataFrame, column: str, up: DataFrame, few: bool = False) -> DataFrame:
    """``table`` with ``column`` replaced by what it points to in ``up``, if anything."""
    to = up.select(F.col("a").alias("_at"), F.col("p").alias("_to"))
    return table.join(F.broadcast(to) if few else to, F.col(column) == F.col("_at"), "left").withColumn(
        column, F.coalesce("_to", column)).drop("_at")


def components(links: DataFrame) -> DataFrame:
    """(a, b) links between longs -> (node, root): every node that has a link,
    and the smallest node of its component. Self-links and nulls are ignored."""
    edges, roots = ordered(links), None
    few = edges.count() <= FEW_LINKS
    while True:
        up = kept(edges.groupBy("a").agg(F.min("b").alias("p")), few)
        while True:
            jumped = kept(followed(up, "p", up, few), few)
            up = jumped.select("a", "p")
            if jumped.where("_to is not null").isEmpty():
                break
        new = up.select(F.col("a").alias("node"), F.col("p").alias("root"))
        roots = new if roots is None else kept(
            followed(roots, "root", up, few).drop("_to").unionByName(new), few)
        edges = ordered(followed(followed(edges, "a", up, few).drop("_to"), "b", up, few), few)
        if edges.isEmpty():
            tops = roots.select(F.col("root").alias("node"), "root").distinct()
            return kept(roots.unionByName(tops), few)
