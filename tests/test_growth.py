"""Steps whose shuffles and sorts grew faster than their input."""

import glob
import os

from pyspark.sql import functions as F

from reelmart.operators import assemble as A
from reelmart.operators import extract as EX
from reelmart.operators import perf as P
from reelmart.operators import quality as Q
from reelmart.operators import search as SR
from reelmart.sources import files as FS
from reelmart.sources import landing as L
from reelmart.sources.scratch import new_scratch
from reelmart.sources.store import LayerStore
from reelmart.sources.versioned import VersionedTable


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


def test_hooks_of_one_class_are_walked_once(spark):
    n = 500
    c = spark.range(n).select(F.format_string("h%04d", "id").alias("chunk_id"), F.lit("a").alias("asset_id"),
                              F.lit("Hook").alias("chunk_theme"), F.lit(4).alias("standalone_score"),
                              F.lit("c").alias("client_id"))
    c = c.unionByName(spark.createDataFrame([("n1", "a", "CTA", 5, "c"), ("n2", "a", "CTA", 4, "c")], c.schema))
    e = c.select("chunk_id", F.lit("CTA").alias("compatible_theme"))
    elig = A.eligible_chunks(c, None)
    cand = A.top_candidates(elig, 4).select(
        "client_id", F.col("chunk_theme").alias("step_theme"), F.col("chunk_id").alias("cand_chunk"),
        F.col("standalone_score").alias("cand_score"), "theme_rank")
    classes = A.hook_classes(elig, cand, e)
    assert classes.count() == n
    assert classes.select("client_id", "themes", "own").distinct().count() == 5  # 4 candidates, all the rest
    again = elig.unionByName(elig.where("chunk_id = 'h0400'"))  # a hook of two rows goes its own way
    assert A.hook_classes(again, cand, e).where("own = 'h0400'").count() == 1
    got = {(r.hook_chunk, r.sequence, r.sequence_score) for r in A.assemble(c, None, e, depth=3, k=2).collect()}
    assert got == {(f"h{i:04d}", f"h{i:04d}>{x}>{y}", 13) for i in range(n) for x, y in (("n1", "n2"), ("n2", "n1"))}


def test_missing_parents_meet_no_join(spark):
    chunks = spark.createDataFrame([("k1", "a", 1), ("k2", "b", 1), ("k3", "x", 1)],
                                   "chunk_id string, asset_id string, chunk_sequence int")
    assets = spark.createDataFrame([("a", "c", "A", "RAW", None), ("b", "c", "B", "EDITED", "a"),
                                    ("d", "c", "D", "EDITED", "gone")],
                                   "asset_id string, client_id string, asset_name string, asset_type string, "
                                   "parent_asset_id string")
    out = SR.clip_provenance(chunks, assets)
    assert {(r.chunk_id, r.parent_asset_id, r.parent_asset_name) for r in out.collect()} \
        == {("k1", None, None), ("k2", "a", "A")}
    optimized = plan(out).split("== Physical Plan")[0].split("== Optimized")[1]
    outer = optimized[optimized.index("Join LeftOuter"):].splitlines()
    assert any("isnotnull(parent_asset_id" in line for line in outer[:4])


def test_latest_pull_carries_a_row_once(spark):
    d = spark.createDataFrame([("1", "meta", 1, 5, None), ("1", "meta", 2, 3, 4), ("1", "meta", 2, 3, 9)],
                              "ad_id string, platform_name string, load_ts int, x int, y int") \
        .withColumn("perf_date", F.lit("d"))
    out = P.latest_pull(d)
    assert [(r.load_ts, r.x, r.y) for r in out.collect()] == [(2, 3, 9)]
    assert "max_by" not in plan(out)


def test_whole_tables_are_written_where_they_are_computed(spark):
    rows = spark.range(0, 400, 1, 4)
    store = LayerStore(spark, "growth")
    assert store.table("t", lambda: rows).count() == 400
    assert len(glob.glob(f"{store.root}/t/part-*".replace("file:", ""))) == 4
    path = new_scratch(spark, "overwritten")
    assert FS.overwritten(rows, path).count() == 400
    assert len(glob.glob(f"{path}/data/*/part-*".replace("file:", ""))) == 4


def test_capture_knows_the_size_of_its_list_of_files(spark, monkeypatch):
    path, known = new_scratch(spark, "capture"), []
    spark.range(6).repartition(3).write.option("header", True).csv(f"{path}/in")
    stored = FS.counted
    monkeypatch.setattr(FS, "counted", lambda df, label: known.append(stored(df, label)) or known[-1])
    for _ in range(2):
        assert FS.capture_raw_csv(spark, f"{path}/in", "id BIGINT", f"{path}/t").count() == 6
    assert [n for _, n in known] == [len(glob.glob(f"{path}/in/part-*".replace("file:", "")))] * 2


def test_objects_are_written_by_tasks_as_spark_names_them(spark):
    rows = [("c/1", "a=1", "x\ny"), (None, "b", None), ("é %", "d^", "ü"), ("c/1", "e", "")]
    df = spark.createDataFrame(rows, "client_id string, asset_id string, text string")
    path = new_scratch(spark, "objects")
    FS.write_landing(df, f"{path}/ours")
    (df.select("client_id", "asset_id", F.col("text").alias("value")).repartition("asset_id")
     .write.partitionBy("client_id", "asset_id").text(f"{path}/spark"))
    got, want = ({(r.client_id, r.asset_id, r.length, r.content_sha256)
                  for r in FS.scan_landing(spark, f"{path}/{name}").collect()} for name in ("ours", "spark"))
    assert got == want and len(got) == 4
    top = L.folders(spark.createDataFrame([(f"{path}/ours",)], "prefix string"))
    assert L.folders(top).count() == 4  # a row an object, to be shared out


def test_only_assets_to_call_for_are_dealt_out(spark, monkeypatch):
    root, seen = new_scratch(spark, "rounds"), []
    lacking = EX._lacking
    monkeypatch.setattr(EX, "_lacking", lambda rows, have: seen.append(rows) or lacking(rows, have))
    assets = spark.createDataFrame([("a", "c", "h", "x"), ("a", "c", "h", "x"), ("b", "c", "h", "y")],
                                   "asset_id string, client_id string, content_sha256 string, text string")
    bronze, runs = VersionedTable(spark, f"{root}/bronze"), VersionedTable(spark, f"{root}/runs")
    call = lambda a: {"raw_response": '{"chunks": []}'}
    assert EX.extract(assets, call, bronze, runs, attempts=1, slices=2, pause_sec=0.0) == 0
    assert bronze.read().count() == 2 and runs.read().count() == 2
    assert not any("Deduplicate" in plan(rows) for rows in seen if "text" in rows.columns)


def test_reconcile_counts_both_sides_in_one_pass(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (None, "y"), (2, None)], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (None, "y"), (3, None)], "k int, v string")
    out = Q.reconcile("r", a, b, ["k", "v"])
    r = out.first()
    assert (r.n_base, r.n_view, r.n_base_only, r.n_view_only, r.reconciled) == (4, 3, 2, 1, False)
    assert "Join" not in plan(out)
