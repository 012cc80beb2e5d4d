"""Mixing sources to target weights (Efraimidis-Spirakis sampling).

Every document gets an exponential key, ``-ln(u) / weight``, with ``u`` from a
hash of its id and ``weight`` from a quality measure of its text. Within a
source, documents in key order form a weighted sample without replacement;
their sizes are prefix-summed up to the source's token budget. A target of more
than the source's size takes complete epochs first; only the remaining fraction
is selected by keys.

No window ever holds a whole source: keys are dealt to buckets, bucket sums
give every bucket its offset, and only the one bucket in which the budget ends
is sorted. What remains is a cutoff for each source, applied as a map.

Defined cases: null text has size 0 and full weight; null source is a source of
its own, last in order; null doc_id hashes as the empty text; rows of one doc_id
and source whose texts weigh the same share their key and are taken together,
other ties go by doc_id; very long texts are measured whole; a document without
words is taken as any other and counts 0; an empty table gives an empty result;
other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelmart.llm.common import WORD, cut, maybe_broadcast, uniform

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0
#: rows of one bucket aimed at
BUCKET_ROWS = 100_000


def size_of(text: str = "text") -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(text: str = "text") -> Column:
    """1 for clean prose, down to 0.05 for texts half made of ASCII signs and digits."""
    signs = F.regexp_count(F.col(text), F.lit("[!-@\\[-`{-~]"))
    share = signs / F.greatest(F.length(text), F.lit(1))
    return F.coalesce(F.greatest(F.lit(0.05), 1 - 2 * share), F.lit(1.0))


def draw_key(weight: Column) -> Column:
    return -F.log(uniform(F.col("doc_id"))) / weight


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE,
                   most: float = MOST) -> DataFrame:
    """(source, source_size) -> with target.

    Sources by code point, null last, weigh ``weights``, repeating. They share
    ``share`` x all sizes by weight, each at most ``most`` x its own size. In
    order of size / weight, the capped sources come first; the level of the
    first source that fits under its cap is the level of all after it. The
    frame has one row for each source, so its windows are small.
    """
    everything = Window.partitionBy()
    ranked = sizes.select(
        "source", "source_size",
        (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1).alias("_i"))
    ranked = ranked.withColumn("_w", F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (F.col("_i") % len(weights) + 1).cast("int")))
    line = Window.orderBy(F.col("source_size") / F.col("_w"), "_i")
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    level = ((share * F.sum("source_size").over(everything)
              - most * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
             / (F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(before), F.lit(0.0))))
    filled = ranked.select("*", F.row_number().over(line).alias("_pos"), level.alias("_level"))
    fits = F.col("_level") * F.col("_w") <= most * F.col("source_size")
    first = F.min(F.when(fits, F.struct("_pos", "_level"))).over(everything)
    return filled.select("source", "source_size", "_w", "_pos", first.alias("_first")).select(
        "source", "source_size",
        F.when(F.col("_first").isNull() | (F.col("_pos") < F.col("_first._pos")),
               most * F.col("source_size"))
        .otherwise(F.col("_first._level") * F.col("_w")).alias("target"))


def draws(docs: DataFrame) -> DataFrame:
    """(source, doc_id, size, key): one narrow row for each document."""
    return docs.select("source", "doc_id", size_of().alias("size"),
                       draw_key(quality_weight()).alias("_key"))


def cutoffs(narrow: DataFrame, buckets: int, **law) -> DataFrame:
    """One row for each source: source_size, target, complete epochs, and the
    last (bucket, key, doc_id) that the fractional selection still takes."""
    dealt = narrow.withColumn("_bucket", bucket_of(buckets))
    sums = cut(dealt.groupBy("source", "_bucket").agg(F.sum("size").alias("_sum")))
    targets = source_targets(sums.groupBy("source").agg(F.sum("_sum").alias("source_size")), **law)
    targets = targets.withColumn("_epochs", F.when(
        F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
    targets = cut(targets.withColumn("_rest", F.col("target")
                                     - F.col("_epochs") * F.col("source_size")))
    t = targets.withColumnRenamed("source", "_s")
    line = Window.partitionBy("source").orderBy("_bucket")
    ends = (sums.withColumn("_end", F.sum("_sum").over(line))
            .join(t, F.col("source").eqNullSafe(F.col("_s")))
            .where("_end > _rest and _end - _sum <= _rest and _sum > 0")
            .select("source", "_rest", F.col("_bucket").alias("_cut"),
                    (F.col("_end") - F.col("_sum")).alias("_offset")))
    ends = cut(ends)
    e = maybe_broadcast(ends.withColumnRenamed("source", "_s"), ends.count())
    inside = dealt.join(e, F.col("source").eqNullSafe(F.col("_s"))
                        & (F.col("_bucket") == F.col("_cut")))
    # rows of one key are one draw
    keyed = inside.groupBy("source", "_rest", "_offset", "_key", "doc_id").agg(
        F.sum("size").alias("_size"))
    upto = Window.partitionBy("source").orderBy("_key", F.col("doc_id").asc_nulls_first())
    last = (keyed.withColumn("_end", F.col("_offset") + F.sum("_size").over(upto))
            .where("_end - _size / 2.0 <= _rest")
            .groupBy("source").agg(F.max(F.struct("_key", F.struct("doc_id"))).alias("_last")))
    c = ends.select(F.col("source").alias("_s"), "_cut")
    picked = last.withColumnRenamed("source", "_p")
    return (targets.join(c, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
            .join(picked, F.col("source").eqNullSafe(F.col("_p")), "left").drop("_p"))


def bucket_of(buckets: int) -> Column:
    """Keys in order, to buckets: 1 - exp(-key) spreads unit-weight keys evenly."""
    return F.least(F.floor((1 - F.exp(-F.col("_key"))) * buckets), F.lit(buckets - 1)).cast("int")


def copies(buckets: int) -> Column:
    """How often a row joined with its source's cutoff is taken."""
    chosen = (F.col("_rest") > 0) & (
        F.col("_cut").isNull() | (F.col("_bucket") < F.col("_cut"))
        | ((F.col("_bucket") == F.col("_cut"))
           & F.coalesce(F.struct("_key", F.struct("doc_id")) <= F.col("_last"), F.lit(False))))
    return (F.col("_epochs") + chosen.cast("long")).cast("long")


def plan_buckets(docs: DataFrame) -> int:
    return max(64, min(65_536, -(-docs.count() // BUCKET_ROWS)))


def with_copies(rows: DataFrame, marks: DataFrame, buckets: int) -> DataFrame:
    """Rows (with source, doc_id, _key) and their cutoff, and how often each is taken."""
    m = maybe_broadcast(marks.withColumnRenamed("source", "_s"), marks.count())
    joined = rows.withColumn("_bucket", bucket_of(buckets)).join(
        m, F.col("source").eqNullSafe(F.col("_s")))
    return joined.withColumn("_copies", copies(buckets))


def mix(docs: DataFrame, **law) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for every row of ``docs``."""
    narrow = cut(draws(docs))
    buckets = plan_buckets(narrow)
    marks = cut(cutoffs(narrow, buckets, **law))
    return with_copies(narrow, marks, buckets).select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * F.col("_copies")).alias("taken"))


def mixed_rows(docs: DataFrame, **law) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it (0 to 2 times)."""
    narrow = cut(draws(docs))
    buckets = plan_buckets(narrow)
    marks = cut(cutoffs(narrow, buckets, **law))
    inner = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("_row"),
                        "source", "doc_id", draw_key(quality_weight()).alias("_key"))
    taken = with_copies(inner, marks, buckets).where("_copies > 0")
    return (taken.select("_row", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))))
            .select("_row.*"))
