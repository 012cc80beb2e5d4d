"""Sharding by sampled splitters, law ``bytes``: shards of near equal bytes.

Records are ordered by the hash of their text, then of their id, so equal texts
lie together. A size-weighted sample of these keys gives quantile boundaries; a
range that turns out overfull is sampled again and subdivided, inside one
text's copies too if they are many. A sample is what falls under a threshold of
the keys' exponential, so about ``SAMPLE`` keys come to the driver at any size. The exact bytes of the ranges, and a running
sum inside each range, then place the cut points between shards.

A group of equal texts inside a range stays in one shard if it has at most
``WHOLE`` of a shard's bytes; a larger group is divided record by record.

Defined cases: null text counts as empty (size 1, CRC 0); null doc_id hashes as
null; rows alike in doc_id and text have one key and stay together; unlike texts
of one hash lie as if they were equal; a very long text is one row of its size,
never divided; an empty
table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelmart.llm.common import cut, uniform

SHARDS = 8
#: size-weighted sample and ranges made from it
SAMPLE = 4096
RANGES = 128
#: share of a shard up to which a group of equal texts is not divided
WHOLE = 0.02
LOWEST = -(1 << 63)


def keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"), *order_of())


def order_of() -> tuple[Column, Column]:
    return (F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("_key"),
            F.xxhash64(F.col("doc_id"), F.lit(7)).alias("_tie"))


def sampled(rows: DataFrame, n: int, size: int) -> list[tuple[int, int]]:
    """About ``n`` keys of rows of ``size`` bytes together, in order, each drawn
    with probability by its size: exponential keys under a threshold."""
    drawn = -F.log(uniform(F.col("doc_id"), F.col("_key"))) / F.col("size")
    got = rows.where(drawn < n / max(1, size)).select("_key", "_tie")
    return sorted((r["_key"], r["_tie"]) for r in got.collect())


def splitters(sample: list[tuple[int, int]], step: float) -> list[tuple[int, int]]:
    """Every ``step``-th key of a sample. A text met once gives its first key;
    one met again is a large group and is divided at its own ids."""
    out: list[tuple[int, int]] = []
    at = step
    while at < len(sample):
        key, tie = sample[int(at)]
        out.append((key, LOWEST) if not out or out[-1][0] != key else (key, tie))
        at += step
    return sorted(set(out))


def range_of(marks: list[tuple[int, int]]) -> Column:
    """How many boundaries are at or before a row's (key, tie)."""
    if not marks:
        return F.lit(0)
    keys = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(t).alias("t")) for k, t in marks])
    own = F.struct(F.col("_key").alias("k"), F.col("_tie").alias("t"))
    return F.size(F.filter(keys, lambda b: b <= own))


def ranges(rows: DataFrame, total: int) -> tuple[list[tuple[int, int]], list[tuple[int, int, int]]]:
    """Boundaries, and (range, bytes, rows) of each range."""
    drawn = sampled(rows, SAMPLE, total)
    marks = splitters(drawn, max(1.0, len(drawn) / RANGES))
    while True:
        sized = sorted(tuple(r) for r in rows.groupBy(range_of(marks).alias("r")).agg(
            F.sum("size"), F.count("*")).collect())
        over = [(r, b) for r, b, n in sized if b > 4 * total / RANGES and n > 1]
        if not over:
            return marks, sized
        # at most RANGES / 4 ranges are overfull; each is sampled on its own
        more = set(marks)
        for r, b in over:
            own = sampled(rows.where(range_of(marks) == r), SAMPLE // 8, b)
            more |= set(splitters(own, max(1.0, len(own) / 8)))
        if len(more) == len(marks):  # rows all alike: nothing to divide
            return marks, sized
        marks = sorted(more)


def placed(rows: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Rows with shard, and ``_at``: their place in the order of all rows."""
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    marks, sized = ranges(rows, total)
    offset, first, b, n = {}, {}, 0, 0
    for r, size, count in sized:
        offset[r], first[r], b, n = b, n, b + size, n + count
    share = max(1.0, total / shards)

    def look(table: dict[int, int]) -> Column:  # one entry for each range
        pairs = [F.lit(table.get(r, 0)).cast("long") for r in range(len(marks) + 1)]
        return F.element_at(F.array(*pairs), F.col("_r") + 1)

    inside = Window.partitionBy("_r").orderBy("_key", "_tie")
    alike = Window.partitionBy("_r", "_key")
    ranked = rows.withColumn("_r", range_of(marks)).select(
        "*", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)).alias("_end"),
        F.row_number().over(inside).alias("_n"))
    grouped = ranked.select("*", F.sum("size").over(alike).alias("_group"),
                            F.max("_end").over(alike).alias("_group_end"),
                            F.max("_end").over(alike.orderBy("_tie")).alias("_alike_end"))
    middle = look(offset) + F.when(
        F.col("_group") <= WHOLE * share, F.col("_group_end") - F.col("_group") / 2.0
    ).otherwise(F.col("_alike_end") - F.col("size") / 2.0)
    return grouped.select(
        "doc_id", "size", "text_crc32", "_key", "_tie",
        F.least(F.floor(middle / share), F.lit(shards - 1)).cast("int").alias("shard"),
        (look(first) + F.col("_n") - 1).alias("_at"))


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row."""
    done = cut(placed(cut(keyed(docs)), shards))
    starts = {r["shard"]: r["at"] for r in done.groupBy("shard").agg(
        F.min("_at").alias("at")).collect()}  # one entry for each shard
    first = F.element_at(F.array(*[F.lit(starts.get(s, 0)).cast("long") for s in range(shards)]),
                         F.col("shard") + 1)
    return done.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                       (F.col("_at") - first).alias("slot"),
                       F.lit(None).cast("int").alias("grown_shard"))


def sharded_rows(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``docs`` with a column ``shard``. The cut points between shards, one key
    each, are all that is needed, so the texts are not moved."""
    done = cut(placed(cut(keyed(docs)), shards))
    cuts = sorted((r["shard"], r["k"]["_key"], r["k"]["_tie"]) for r in done.groupBy(
        "shard").agg(F.min(F.struct("_key", "_tie")).alias("k")).collect())
    key, tie = order_of()
    own = F.struct(key.alias("k"), tie.alias("t"))
    number = F.lit(0)
    for s, k, t in cuts:
        number = F.when(own >= F.struct(F.lit(k).alias("k"), F.lit(t).alias("t")),
                        F.lit(s)).otherwise(number)
    return docs.select(*[c for c in docs.columns if c != "shard"], number.cast("int").alias("shard"))
