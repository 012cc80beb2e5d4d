"""What lies on disk while a query runs: layers are packed, and what a job has
shuffled or read for good is deleted."""

import glob

from pyspark.sql import functions as F

from reelmart.plans.registry import QUERIES
from reelmart.sources.scratch import new_scratch, scratch_root
from tests.conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def folders(spark, label: str) -> set[str]:
    return set(glob.glob(f"{scratch_root(spark).removeprefix('file://')}/reelmart-{label}-*"))


def test_a_captured_export_is_not_kept(spark):
    """Before, both platforms' exports lay beside their captures, unpacked, until the session ended."""
    before = folders(spark, "perf-raw")
    rows = QUERIES["perf_raw_capture"](spark, SF_SMALL)
    root, = folders(spark, "perf-raw") - before
    assert rows.count() and not glob.glob(f"{root}/export/*")
    stored = glob.glob(f"{root}/bronze/*/data/*/*.parquet")
    assert stored and all(f.endswith(".zstd.parquet") for f in stored)
    files = spark.read.parquet(*stored).select("source_file").distinct().collect()
    assert files and all(f.source_file.endswith(".csv.gz") for f in files)


def test_what_a_job_has_shuffled_goes_with_it(spark):
    spark.range(1000).repartition(7, "id").write.parquet(new_scratch(spark, "shuffled"))
    held = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [held.apply(i).getName() for i in range(held.size())]
    spark.range(1000).repartition(7, "id").write.parquet(new_scratch(spark, "shuffled"))
    held = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    after = [held.apply(i).getName() for i in range(held.size())]
    assert not [n for n in set(after) - set(names) if n.startswith("shuffle_") and n.endswith(".data")]


def test_an_audited_export_is_not_kept(spark):
    before = folders(spark, "perf-audit")
    assert QUERIES["perf_capture_audit"](spark, SF_SMALL).count() == 2
    root, = folders(spark, "perf-audit") - before
    assert not glob.glob(f"{root}/export/*")


def test_a_large_batch_is_merged_some_parts_at_a_time(spark, monkeypatch):
    """Before, all parts of a batch were shuffled together, however many rows it had."""
    from reelmart.sources import versioned
    monkeypatch.setattr(versioned, "MOST_MERGED", 3)
    table, met = versioned.VersionedTable(spark, new_scratch(spark, "groups")), []

    def put(rows):
        def combine(old, new):
            met.append(sorted({r.m or "null" for r in new.collect()}))
            return (new if old is None else old.unionByName(new)).groupBy("m").agg(F.sum("v").cast("int").alias("v"))
        table.merge(spark.createDataFrame(rows, "m string, v int"), F.col("m"), combine)

    put([("a", 1), ("a", 2), ("b", 3), ("b", 4), ("c", 5), (None, 6)])
    assert met == [["a"], ["b", "c"], ["null"]] and table.versions() == [1]
    put([("b", 10), ("d", 7)])
    assert met[3:] == [["b", "d"]]
    got = {(r.m, r.v) for r in table.read().collect()}
    assert got == {("a", 3), ("b", 17), ("c", 5), ("d", 7), (None, 6)}
    put([])
    assert table.read().count() == 5
    assert versioned.parts_together({"a": 9, "b": 1, "c": 2, "d": 1}) == [["a"], ["b", "c"], ["d"]]


def test_early_pulls_and_restatements_are_written_in_one_pass(spark):
    before = folders(spark, "perf-stream")
    rows = QUERIES["stream_perf_upsert"](spark, SF_SMALL)
    root, = folders(spark, "perf-stream") - before
    assert {f.split("=")[1] for f in glob.glob(f"{root}/pulls/pull=*")} == {"a", "b"}
    assert "pull" not in rows.columns


def test_chunks_of_both_runs_are_dealt_out_once(spark):
    """Before, each (asset, item) of either run was shuffled, sorted and joined. A
    missing item equals no other, repeated ones count once."""
    from reelmart.operators import quality as Q
    kind = "asset_id string, chunk_sequence int, chunk_theme string, keywords array<string>, standalone_score int"
    run1 = spark.createDataFrame([("x", 1, "t", ["k", "k", "l"], 3), ("x", 2, "t", None, 4), ("y", 1, None, [None], 2),
                                  (None, 1, "t", ["k"], 1)], kind)
    run2 = spark.createDataFrame([("x", 1, "t", ["k", "m"], 4), ("y", 1, None, [], 5), ("z", 1, "t", [], 1)], kind)
    assets = spark.createDataFrame([("x", "c"), ("y", "d"), ("z", "e")], "asset_id string, client_id string")
    out = Q.golden_gate(run1, run2, assets)
    # x: t, k, l against t, k, m; y: a missing item in each, which differ; z: in the second run only
    assert {(r.client_id, r.n_assets, r.mean_jaccard, r.score_agreement, r.passes) for r in out.collect()} == {
        ("c", 1, 0.5, 1.0, False), ("d", 1, 0.0, 0.0, False), ("e", 1, 0.0, None, False)}
    assert "FullOuter" not in out._jdf.queryExecution().toString()


def test_suites_are_reported_one_by_one(spark):
    """Before, the shuffles of all suites lay on disk together."""
    from reelmart.operators import quality as Q
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "a")], "k int, v string")
    rules = [("unique", "k", None, "CRITICAL"), ("not_null", "k", None, "HIGH")]
    rep = Q.expectations_report({"one": df, "two": df.limit(1)}, {"one": rules, "two": rules})
    assert "Exchange" not in plan(rep)
    assert {(r.suite, r.expectation, r.n_checked, r.n_failed) for r in rep.collect()} == {
        ("one", "unique(k)", 2, 2), ("one", "not_null(k)", 3, 1), ("two", "unique(k)", 1, 0), ("two", "not_null(k)", 1, 0)}


def test_checks_are_reconciled_one_by_one(spark):
    """Before, the shuffles of all three checks lay on disk together."""
    rep = QUERIES["reconcile_keys"](spark, SF_SMALL)
    assert "Exchange" not in plan(rep) and rep.count() == 3
