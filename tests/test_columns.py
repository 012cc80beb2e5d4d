"""Column helpers on the branches the registered keys do not reach."""

from pyspark.sql import functions as F

from reelmart.functions import columns as C


def _one(spark, col):
    return spark.range(1).select(col.alias("x")).first().x


def test_to_seconds_forms(spark):
    assert _one(spark, C.to_seconds(F.lit("42"))) == 42.0
    assert _one(spark, C.to_seconds(F.lit("1:05"))) == 65.0
    assert _one(spark, C.to_seconds(F.lit("1:00:05.5"))) == 3605.5
    assert _one(spark, C.to_seconds(F.lit("x:y"))) is None


def test_landing_key_dev_fallback(spark):
    assert _one(spark, C.landing_key(F.lit(""), F.lit("a"), F.lit(".mp4"))) == "landing/video/a.mp4"
    assert _one(spark, C.landing_key(F.lit("c1"), F.lit("a"), F.lit(".mov"))) == \
        "landing/c1/video/a.mov"
    assert _one(spark, C.bronze_key(F.lit(None).cast("string"), F.lit("a"))) == \
        "bronze/asset_raw/a.parquet"


def test_extension_and_mime(spark):
    assert _one(spark, C.extension(F.lit("clip"))) == ".mp4"
    assert _one(spark, C.extension(F.lit("a.b.WEBM"))) == ".WEBM"
    assert _one(spark, C.mime_type(F.lit(".WEBM"))) == "video/webm"
    assert _one(spark, C.mime_type(F.lit(".mkv"))) == "video/mp4"


def test_asset_type_and_duration(spark):
    assert _one(spark, C.asset_type_from_folder(F.lit("Our WINNERS 2024"))) == "EDITED"
    assert _one(spark, C.asset_type_from_folder(F.lit("raw_video"))) == "RAW"
    assert _one(spark, C.whole_seconds_from_ms(F.lit(1999))) == 1
    assert _one(spark, C.whole_seconds_from_ms(F.lit(0))) is None


def test_padded_sequence_never_truncates(spark):
    assert _one(spark, C.padded_sequence(F.lit(7))) == "007"
    assert _one(spark, C.padded_sequence(F.lit(1000))) == "1000"


def test_normal_tail_polynomial(spark):
    p = _one(spark, C.two_sided_normal_p(F.lit(1.959963984540054)))
    assert abs(p - 0.05) < 1e-6
    assert abs(_one(spark, C.two_sided_normal_p(F.lit(0.0))) - 1.0) < 1e-6  # A&S error < 7.5e-8


def test_literal_table_is_jvm_side(spark):
    t = C.literal_table(spark, [("a", 1), ("b", 2)], "k STRING, v BIGINT")
    assert sorted(map(tuple, t.collect())) == [("a", 1), ("b", 2)]
    plan = t._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" not in plan and "Python" not in plan
