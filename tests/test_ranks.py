"""Two-level order statistics equal their one-window definitions."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from reelmart.functions.ranks import average_rank, exact_median, previous_in_group, value_ranks


def _data(spark):
    rows = [(g, float((i * 7919) % 23), i) for g in ("hot", "cold") for i in range(200 if g == "hot" else 9)]
    return spark.createDataFrame(rows, "g string, v double, i long")


def test_value_ranks_match_window_average_rank(spark):
    d = _data(spark)
    r = value_ranks(d, ["g"], "v", buckets=4)
    got = {(x.g, x.v): x.ar for x in r.select("g", "v", average_rank(r).alias("ar")).collect()}
    w = Window.partitionBy("g").orderBy("v")
    ties = Window.partitionBy("g", "v")
    ref = d.select("g", "v", (F.rank().over(w) + (F.count(F.lit(1)).over(ties) - 1) / 2.0)
                   .alias("ar")).distinct()
    assert got == {(x.g, x.v): x.ar for x in ref.collect()}


def test_exact_median_matches_percentile(spark):
    d = _data(spark)
    got = {x.g: x.median for x in exact_median(d, ["g"], "v", buckets=4).collect()}
    ref = {x.g: x.m for x in d.groupBy("g").agg(F.median("v").alias("m")).collect()}
    assert got.keys() == ref.keys()
    assert all(abs(got[k] - ref[k]) < 1e-12 for k in got)


def test_previous_in_group_crosses_ranges(spark):
    d = _data(spark).withColumn("val", F.concat(F.lit("x"), F.col("i").cast("string")))
    got = {(x.g, x.i): x._prev for x in previous_in_group(d, ["g"], "i", "val", width=7).collect()}
    ref = d.select("g", "i", F.lag("val").over(Window.partitionBy("g").orderBy("i")).alias("p"))
    assert got == {(x.g, x.i): x.p for x in ref.collect()}
