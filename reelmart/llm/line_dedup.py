"""Line dedup by levelled sorted runs of line hashes.

The lines of a table (128-bit hashes of their keys) are stored once, dealt into
batches of descending doc_id. Batch after batch meets the runs written so far
in a merge join: keys that no run has are new, and the batch's largest doc_id
is their holder; of the others only the count is added. The batch's keys then
become a sorted run of their own. Runs stand in levels; as soon as a level has
``fan`` of them they are compacted into one run of the next level, so a batch
meets few runs and each key is rewritten once a level.

After the last batch the runs tell which keys stand in enough documents and
who holds them. The lines of other documents with such keys are joined by
hash, their positions gathered per document, and the texts rebuilt without.
A frequent line is reduced to a row a task before it is shuffled, and in the
joins it is the large side that Spark may split.

Defined cases: a null or empty text is one empty line, which is never dropped;
keys are compared after stripping ASCII blanks and lowering A-Z only. Rows of
one doc_id are one document: a line in two of them counts once, and all rows of
the holder keep it. A null doc_id is one document, smaller than any other.
Repeated rows all stay, each treated alike; several equal lines of the holder
all stay. Very long texts are split whole; the dropped positions of a document
are at most its lines. An empty table gives no rows. Other columns, also of
clashing names, are not looked at.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmart.llm.common import BLANKS, shared_folder, stored

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MIN_POINTS = 20
MIN_DOCS = 3
#: batches of about equal numbers of documents, in descending doc_id
BATCHES = 4
#: runs of one level that are compacted into one of the next
FAN = 2
KEY = ["h1", "h2"]


def line_key(line: Column) -> Column:
    return F.translate(F.trim(line, F.lit(BLANKS)), UPPER, UPPER.lower())


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


class Runs:
    """Sorted runs of keys (h1, h2; n documents; holder) in levels.

    Each run is a Parquet folder; a batch that is written again under its
    number replaces its own run only, and compacted runs are read no more.
    """

    def __init__(self, folder: str, fan: int = FAN):
        self.folder, self.fan, self.levels, self.written = folder, fan, [], 0

    def store(self, rows: DataFrame, level: int) -> DataFrame:
        path = f"{self.folder}/level={level}/run={self.written:06d}"
        self.written += 1
        rows.sortWithinPartitions(*KEY).write.parquet(path)
        return rows.sparkSession.read.schema(rows.schema).parquet(path)

    def all(self) -> DataFrame:
        return reduce(DataFrame.unionByName, [r for level in self.levels for r in level])

    def add(self, keys: DataFrame) -> None:
        """Keys of one batch (h1, h2, n, holder), each once."""
        if any(self.levels):  # anti join and its complement by one merge join
            found = self.all().select(*KEY, F.lit(True).alias("found")).distinct()
            keys = keys.join(found.hint("merge"), KEY, "left").select(
                *KEY, "n", F.when(F.col("found").isNull(), F.col("holder")).alias("holder"))
        self.put(self.store(keys, 0), 0)

    def put(self, run: DataFrame, level: int) -> None:
        if len(self.levels) == level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fan:
            merged = merge(reduce(DataFrame.unionByName, self.levels[level]))
            self.levels[level] = []
            self.put(self.store(merged, level + 1), level + 1)


def merge(rows: DataFrame) -> DataFrame:
    """One row a key: its documents, and the one holder a run has for it (the
    key of a null doc_id has none)."""
    return rows.groupBy(*KEY).agg(F.sum("n").alias("n"), F.max("holder").alias("holder"))


def line_rows(docs: DataFrame, batches: int) -> DataFrame:
    """A row for every line that may be dropped; batch 0 has the largest ids."""
    cuts = docs.select(F.percentile_approx("doc_id", [i / batches for i in range(1, batches)], 1000)
                       .alias("cuts")).first()["cuts"] or [] if batches > 1 else []
    batch = F.lit(0)
    for c in cuts:
        batch = batch + (F.coalesce(F.col("doc_id") < F.lit(c), F.lit(True))).cast("int")
    lines = docs.select("doc_id", F.xxhash64("text").alias("t"), batch.alias("batch"),
                        F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
    key = lines.withColumn("key", line_key(F.col("line"))).where(F.length("key") >= MIN_POINTS)
    return key.select("doc_id", "t", "batch", "pos", F.xxhash64("key").alias("h1"),
                      F.xxhash64(F.lit(len(UPPER)), "key").alias("h2"))


def dropped_lines(docs: DataFrame, min_docs: int = MIN_DOCS, batches: int = BATCHES,
                  fan: int = FAN) -> DataFrame:
    """doc_id, t (hash of the text) and the positions of the lines that go."""
    spark = docs.sparkSession
    rows = stored(line_rows(docs, batches), "lines", ["batch"])
    runs = Runs(f"{shared_folder(spark).rstrip('/')}/runs-{uuid.uuid4().hex[:12]}", fan)
    for b in range(batches):
        held = rows.where(F.col("batch") == b).select(*KEY, "doc_id").distinct()
        runs.add(held.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("holder")))
    # stored, so that both sides of the join come by plain exchanges and Spark may split a hot line
    hot = stored(merge(runs.all()).where(F.col("n") >= min_docs), "frequent-lines")
    return (rows.join(hot, KEY).where(~F.col("doc_id").eqNullSafe(F.col("holder")))
            .groupBy("doc_id", "t").agg(F.collect_set("pos").alias("gone")))


def dedup(docs: DataFrame, min_docs: int = MIN_DOCS, batches: int = BATCHES,
          fan: int = FAN) -> DataFrame:
    """doc_id, n_lines, n_dropped and the kept text of every document."""
    docs = docs.select("doc_id", "text")
    gone = dropped_lines(docs, min_docs, batches, fan).select(
        F.col("doc_id").alias("_id"), F.col("t").alias("_t"), "gone")
    joined = docs.withColumn("t", F.xxhash64("text")).join(
        gone, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("t") == F.col("_t")), "left")
    lines = joined.select("doc_id", lines_of(F.col("text")).alias("lines"), "gone")
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    kept = F.when(F.col("gone").isNull(), F.array_join("lines", "\n")).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get("lines", i)), "\n"))
    return lines.select("doc_id", F.size("lines").cast("long").alias("n_lines"),
                        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_dropped"),
                        kept.alias("kept_text"))
