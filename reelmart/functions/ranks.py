"""Order statistics that never sort a whole group in one task.

A window ``PARTITION BY g ORDER BY v`` puts every row of ``g`` on one task;
if one group holds a third of the data, that task holds a third of the data.
The helpers below work in two levels instead:

1. counts per (group, value) - a partial aggregate, so a hot value collapses
   map-side;
2. approximate quantile boundaries split a group's distinct values into
   ranges, and ranges that still hold more than ``most`` values are split
   again, until none does (equal values always share a range);
3. running sums go over range totals and, inside a range, over its distinct
   values (``most`` of them at most).

Results are exact: boundaries only decide where work is split, never what
is counted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelmart.sources.scratch import counted

#: distinct values that one task may sort
MOST_VALUES = 200_000


def split_ranges(counts: DataFrame, n: int, part: list[str], value: str, buckets: int,
                 most: int) -> DataFrame:
    """``counts`` (``n`` rows, values distinct in each part) with a column
    ``_bucket``: ranges in the order of the values, of ``most`` rows at most."""
    probs = [i / buckets for i in range(1, buckets)]
    rows = counts.withColumn("_bucket", F.lit(0).cast("decimal(38,0)"))
    while n > most:
        keys = [*part, "_bucket"]
        big = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most).drop("_n")
        bounds, n_big = counted(
            rows.join(big, keys, "left_semi").groupBy(*keys)
            .agg(F.percentile_approx(value, probs, 10 * buckets).alias("_bounds")), "bounds")
        if not n_big:
            break
        v = F.col(value)
        place = F.coalesce(F.size(F.filter("_bounds", lambda b: b < v)), F.lit(0))
        split = rows.join(bounds, keys, "left").withColumn(
            "_bucket", (F.col("_bucket") * buckets + place).cast("decimal(38,0)")).drop("_bounds")
        rows, n = counted(split, "ranges")
    return rows


def value_ranks(df: DataFrame, part: list[str], value: str, buckets: int = 64,
                most: int = MOST_VALUES) -> DataFrame:
    """Per (part, value): ``t`` rows with this value, ``less`` rows with a
    smaller value, ``n`` rows in the group. Rows with a NULL value are
    ignored."""
    d = df.where(F.col(value).isNotNull())
    counts, n = counted(d.groupBy(*part, value).agg(F.count(F.lit(1)).alias("t")), "values")
    cb = split_ranges(counts, n, part, value, buckets, most)
    tot = cb.groupBy(*part, "_bucket").agg(F.sum("t").alias("_bt"))
    before = Window.partitionBy(*part).orderBy("_bucket") \
        .rowsBetween(Window.unboundedPreceding, -1)
    tot = (tot.withColumn("_off", F.coalesce(F.sum("_bt").over(before), F.lit(0)))
           .withColumn("n", F.sum("_bt").over(Window.partitionBy(*part))))
    inside = Window.partitionBy(*part, "_bucket").orderBy(value) \
        .rowsBetween(Window.unboundedPreceding, -1)
    cb = cb.withColumn("_lb", F.coalesce(F.sum("t").over(inside), F.lit(0)))
    return (cb.join(tot, part + ["_bucket"])
            .select(*part, value, "t", (F.col("_off") + F.col("_lb")).alias("less"), "n"))


def average_rank(ranks: DataFrame) -> F.Column:
    """1-based average rank of tied values: less + (t + 1) / 2."""
    return F.col("less") + (F.col("t") + 1) / 2.0


def exact_median(df: DataFrame, part: list[str], value: str, buckets: int = 64,
                 most: int = MOST_VALUES) -> DataFrame:
    """Exact median per group (linear interpolation between the two middle
    order statistics), from ``value_ranks``: no group is ever sorted or held
    in one aggregation buffer."""
    r = value_ranks(df, part, value, buckets, most)
    lo = F.floor((F.col("n") - 1) / 2)
    hi = F.ceil((F.col("n") - 1) / 2)
    at = lambda pos: (F.col("less") <= pos) & (pos < F.col("less") + F.col("t"))
    m = r.groupBy(*part).agg(F.max(F.when(at(lo), F.col(value))).alias("_lo"),
                             F.max(F.when(at(hi), F.col(value))).alias("_hi"))
    return m.select(*part, (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * 0.5).alias("median"))


def previous_in_group(df: DataFrame, keys: list[str], order: str, value: str,
                      width: int = 1_000_000) -> DataFrame:
    """``lag(value) OVER (PARTITION BY keys ORDER BY order)`` without a
    whole-group partition: rows are cut into ranges of ``order`` of size
    ``width``; the lag runs inside each range, and the first row of a range
    takes the last value of the previous non-empty range (a window over one
    row per range). Returns ``df`` with a ``_prev`` column."""
    b = F.floor(F.col(order) / width)
    d = df.withColumn("_b", b)
    within = Window.partitionBy(*keys, "_b").orderBy(order)
    d = d.withColumn("_prev_in", F.lag(value).over(within)) \
        .withColumn("_rn", F.row_number().over(within))
    last = d.groupBy(*keys, "_b").agg(F.max_by(value, order).alias("_last"))
    carry = last.withColumn("_carry", F.lag("_last").over(Window.partitionBy(*keys).orderBy("_b"))) \
        .select(*keys, "_b", "_carry")
    d = d.join(carry, keys + ["_b"], "left")
    prev = F.when(F.col("_rn") == 1, F.col("_carry")).otherwise(F.col("_prev_in"))
    return d.withColumn("_prev", prev).drop("_b", "_prev_in", "_rn", "_carry")
